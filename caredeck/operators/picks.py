"""Five representative complaint rows, one per business use, as diverse in category as possible."""

from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from .replies import MIN_CONFIDENCE, template_texts
from .retrieval import complaint_query, retrieve, with_documents
from .risk import active_signals

EXACT = "exact_match"
FALLBACK = "transparent_fallback_highest_available_diverse_row"
WHY = (
    "Bu temsilî örnek, kesin churn iddiası üretmeden yaşam döngüsü, değer, risk ve deneyim sinyalleriyle proaktif "
    "elde tutma önceliklendirmesini gösterir."
)


@dataclass(frozen=True)
class Case:
    name: str
    use: str
    condition: str
    calm_first: bool = False


# The cases, in the order in which they choose.
CASES = (
    Case(
        "Billing escalation / plan mismatch or refund / billing risk",
        "Risk-aware complaint triage + high-value protection",
        "problem_category = 'billing' and has_billing_dispute = 1",
    ),
    Case(
        "Technical outage + retention risk",
        "Retention risk prioritization + technical service recovery",
        "problem_category in ('data', 'coverage', 'connectivity', 'speed', 'voice', 'equipment', 'installation')"
        " and has_technical_outage = 1 and has_churn_risk = 1",
    ),
    Case(
        "Misunderstood customer / high friction / potential mismatch",
        "Friction-aware agent copilot",
        "friction_level_v3 = 'high' and (potential_agent_mismatch = 1 or agent_clarification_count_v3 > 0"
        " or customer_repetition_count_v3 > 0)",
    ),
    Case(
        "High-value at-risk customer",
        "High-value customer protection",
        "high_value_customer = 1 and (priority_level in ('P1 High', 'P2 Medium') or business_risk_level = 'high')",
    ),
    Case(
        "KB-grounded standard support / self-service",
        "LLM-powered RAG resolution copilot",
        "priority_level in ('P2 Medium', 'P3 Low') and friction_level_v3 = 'low'",
        calm_first=True,
    ),
)


def candidates(features, key):
    """Few rows (case, place, key, category) from which any outcome of the choice can be made.

    A case has to avoid at most four rows and four categories, so its best five rows of each of
    its best categories suffice; the same holds for the fallback, which ignores the condition.
    """
    n = len(CASES)
    keep = n * (2 * n - 1)
    columns = ("problem_category", "business_risk_score", "friction_score_v3", key)
    tagged = features.select(
        *columns,
        F.explode(
            F.array_compact(
                F.array(
                    *[F.when(F.expr(case.condition), F.lit(i)) for i, case in enumerate(CASES)],
                    F.lit(n),  # any row, riskiest first
                    F.lit(n + 1),  # any row, calmest first
                )
            )
        ).alias("case"),
    )
    calm = F.col("case").isin([i for i, case in enumerate(CASES) if case.calm_first] + [n + 1])
    order = [
        F.when(calm, F.col("friction_score_v3")).otherwise(-F.col("business_risk_score")),
        F.when(calm, F.col("business_risk_score")).otherwise(0),
        F.col(key),
    ]
    # Spark limits ranked groups before the exchange, so a category or case of any size is fine.
    best = tagged.withColumn("n", F.row_number().over(Window.partitionBy("case", "problem_category").orderBy(*order)))
    best = best.where(F.col("n") <= n)
    best = best.withColumn("place", F.row_number().over(Window.partitionBy("case").orderBy(*order)))
    return best.where(F.col("place") <= keep).select("case", "place", F.col(key).alias("key"), "problem_category")


def choose(rows):
    """[(case, key, reason)] from the candidate rows: each case takes an unused row, new categories first."""
    by_case = {}
    for row in sorted(rows, key=lambda r: r["place"]):
        by_case.setdefault(row["case"], []).append(row)
    used, seen, chosen = set(), set(), []
    for i, case in enumerate(CASES):
        for pool, why in ((i, EXACT), (len(CASES) + int(case.calm_first), FALLBACK)):
            free = [r for r in by_case.get(pool, []) if r["key"] not in used]
            if free:
                pick = min(free, key=lambda r: (r["problem_category"] in seen, r["place"]))
                used.add(pick["key"])
                seen.add(pick["problem_category"])
                chosen.append((i, pick["key"], why))
                break
    return chosen


def picked_rows(features, index, key="complaint_id", k=3, nfkc=False, written=None):
    """The chosen rows with their documents and template texts, one record per case.

    `written` holds the same rows without their texts, where they are written: the choice is made there, and `features`
    is asked for the chosen rows only.
    """
    spark = features.sparkSession
    chosen = choose(candidates(features if written is None else written, key).collect())
    data = [(i, CASES[i].name, CASES[i].use, CASES[i].calm_first, k_, why) for i, k_, why in chosen]
    kind = features.schema[key].dataType.simpleString()
    labels = spark.createDataFrame(
        data, f"case int, case_name string, business_use_case string, calm boolean, `{key}` {kind}, reason string"
    )
    # Named one by one, the keys reach the scan, so that no other row is built.
    rows = features.where(F.col(key).isin([k_ for _, k_, _ in chosen])).join(F.broadcast(labels), key)
    queries = rows.withColumn("query", complaint_query(rows.columns, nfkc)).select(key, "query")
    # A few hits meet the documents where these are.
    documents = with_documents(F.broadcast(retrieve(index, queries, k, key=key, nfkc=nfkc)), index, key, content=True)
    full = template_texts(rows.join(documents, key, "left"))
    weak = F.col("calm") & (F.size("retrieved_documents") > 0) & (F.col("retrieved_documents")[0]["score"] < MIN_CONFIDENCE)
    return full.select(
        "case_name",
        F.col("case_name").alias("example_name"),
        "business_use_case",
        F.concat("reason", F.when(weak, "; low_rag_confidence").otherwise("")).alias("fallback_reason"),
        "customer_id",
        "billing_year_month",
        "lifecycle_status_v2",
        "customer_segment",
        F.col("problem_category").alias("detected_category"),
        F.col("problem_subcategory").alias("detected_subcategory"),
        F.col("problem_subcategory").alias("probable_intent"),
        F.lit(None).cast("double").alias("intent_confidence"),
        "friction_score_v3",
        "friction_level_v3",
        "business_risk_score",
        "business_risk_level",
        "priority_level",
        active_signals().alias("risk_signals"),
        "recommended_queue",
        "recommended_business_action",
        "retrieved_documents",
        F.lit(WHY).alias("why_this_case_matters_for_retention"),
        "confirmation_prompt",
        "conversation_summary",
        "suggested_agent_reply",
    )
