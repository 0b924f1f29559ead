"""Phrase-based complaint signals."""

from pyspark.sql import functions as F

from ..functions.lexicon import TELECOM_TR
from ..functions.numeric import flag, share, total
from ..functions.text import any_found, find_phrases, found_count, found_hits, normalize, reason

SIGNALS = (
    "has_legal_risk",
    "has_churn_risk",
    "has_billing_dispute",
    "has_technical_outage",
    "potential_agent_mismatch",
    "high_frustration_flag",
)

_WORK = (
    "_full", "_customer", "_agent", "_category", "_legal", "_churn", "_billing_strong", "_billing_context",
    "_technical_strong", "_technical_context", "_billing_action", "_tech_action",
)


def complaint_signals(complaints, lexicon=TELECOM_TR, nfkc=False):
    """Complaints with flags, reasons and counters. Stateless, so it also runs on a stream.

    Legal, churn, billing and technical phrases are looked for in both sides' text; repetition,
    unresolved and frustration in the customer's, clarification and actions in the agent's.
    """
    have = complaints.columns

    def source(name, default):
        return F.col(name) if name in have else default

    full = source("full_text", F.lit(""))
    texts = complaints.withColumns(
        {
            "_full": normalize(full, nfkc),
            "_customer": normalize(source("customer_text", full), nfkc),
            "_agent": normalize(source("agent_text", F.lit("")), nfkc),
            "_category": F.lower(F.coalesce(source("problem_category", F.lit("")), F.lit(""))),
        }
    )
    families = ("legal", "churn", "billing_strong", "billing_context", "technical_strong", "technical_context")
    said = ("repetition", "unresolved", "frustration")
    answered = ("clarification", "billing_action", "tech_action")
    # One pass over each text finds the phrases of all families that are looked for in it.
    found = texts.withColumns(
        {
            "_full": find_phrases(F.col("_full"), *[getattr(lexicon, name) for name in families]),
            "_customer": find_phrases(F.col("_customer"), *[getattr(lexicon, name) for name in said]),
            "_agent": find_phrases(F.col("_agent"), *[getattr(lexicon, name) for name in answered]),
        }
    )
    hits = found.withColumns({f"_{name}": found_hits(F.col("_full"), getattr(lexicon, name)) for name in families})
    hits = hits.withColumns(
        {f"_{name}": any_found(F.col("_agent"), getattr(lexicon, name)) for name in ("billing_action", "tech_action")}
    )
    is_billing = F.col("_category").isin(*lexicon.billing_categories)
    is_technical = F.col("_category").isin(*lexicon.technical_categories)
    flags = hits.withColumns(
        {
            "has_legal_risk": flag(_any("_legal")),
            "has_churn_risk": flag(_any("_churn")),
            "has_billing_dispute": flag(_any("_billing_strong") | (is_billing & _any("_billing_context"))),
            "has_technical_outage": flag(_any("_technical_strong") | (is_technical & _any("_technical_context"))),
            "legal_signal_reason": reason(F.col("_legal")),
            "churn_signal_reason": reason(F.col("_churn"), "retention_keyword"),
            "billing_signal_reason": _guarded("billing", is_billing),
            "technical_signal_reason": _guarded("technical", is_technical),
            "customer_repetition_count_v3": found_count(F.col("_customer"), lexicon.repetition),
            "unresolved_problem_count_v3": found_count(F.col("_customer"), lexicon.unresolved),
            "customer_frustration_count_v3": found_count(F.col("_customer"), lexicon.frustration),
            "agent_clarification_count_v3": found_count(F.col("_agent"), lexicon.clarification),
            # The agent acted on the other kind of problem only.
            "potential_agent_mismatch": flag(
                (is_billing & F.col("_tech_action") & ~F.col("_billing_action"))
                | (is_technical & F.col("_billing_action") & ~F.col("_tech_action"))
            ),
        }
    )
    return flags.withColumn("high_frustration_flag", flag(F.col("customer_frustration_count_v3") > 0)).drop(*_WORK)


def _any(hits):
    return F.size(hits) > 0


def _guarded(kind, fits):
    """Reason from the strong hits, else the context hits, marked where the category backs the context."""
    strong, context = F.col(f"_{kind}_strong"), F.col(f"_{kind}_context")
    used = F.when(F.size(strong) > 0, strong).otherwise(context)
    guard = F.when(fits & (F.size(context) > 0), "; category_guard").otherwise("")
    return F.concat(reason(used, f"{kind}_keyword"), guard)


def signal_distribution(complaints):
    """Count and rate per signal, one row each."""
    sums = complaints.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("signal"),
                    total(F.col(name) == 1).alias("row_count"),
                    share(F.col(name) == 1).alias("rate"),
                )
                for name in SIGNALS
            ]
        ).alias("rows")
    )
    return sums.select(F.inline("rows"))


def signal_by_category(complaints):
    """Mean of each signal per category, null category included."""
    return complaints.groupBy("problem_category").agg(*[F.avg(name).alias(name) for name in SIGNALS])
