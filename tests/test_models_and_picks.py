import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caredeck.operators import findings, knowledge, metrics, models, picks
from caredeck.operators.customer_month import TARGET

from .helpers import complaint, frame


@pytest.fixture(scope="module")
def table(spark):
    """Customer-months whose target follows two columns, with gaps and an uneven class."""
    rng = random.Random(7)
    rows = []
    for i in range(300):
        values = {c: round(rng.uniform(0, 10), 3) for c in models.NUMERIC}
        values["avg_bill"] = None if i % 11 == 0 else values["avg_bill"]
        cats = {c: rng.choice(["a", "b", "c"]) for c in models.CATEGORICAL}
        pull = values["months_active"] - values["max_friction_score_v3"] + (3 if cats["lifecycle_status_v2"] == "a" else 0)
        rows.append(values | cats | {TARGET: int(pull + rng.gauss(0, 2) > 4), "customer_id": i, "billing_year_month": "2024-01"})
    schema = ", ".join(
        [f"{c} double" for c in models.NUMERIC] + [f"{c} string" for c in models.CATEGORICAL]
        + [f"{TARGET} int", "customer_id int", "billing_year_month string"]
    )
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema).cache()


def newton(x, y):
    """Balanced logistic regression with C = 1 and a free intercept."""
    n, counts = len(y), np.bincount(y)
    weight = n / (2.0 * counts[y])
    x = np.hstack([x, np.ones((n, 1))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 0
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (weight * (p - y)) + ridge @ beta
        beta -= np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + ridge, gradient)
    return beta


def test_logistic_regression_equals_newton(table):
    model = models.fit_models(table, ["logistic_regression"])["logistic_regression"]
    rows = table.toPandas()
    numbers = rows[list(models.NUMERIC)].astype(float)
    numbers = numbers.fillna(numbers.median())
    scaled = (numbers - numbers.mean()) / numbers.std(ddof=0)
    dummies = [(rows[c] == v).astype(float) for c in models.CATEGORICAL for v in ("a", "b", "c")]
    beta = newton(np.column_stack([scaled.to_numpy(), *dummies]), rows[TARGET].to_numpy())
    fitted = model.stages[-1]
    assert fitted.coefficients.toArray() == pytest.approx(beta[:-1], abs=2e-4)
    importance = models.feature_importance(model, table).collect()
    sizes = [abs(r["importance"]) for r in importance]
    assert sizes == sorted(sizes, reverse=True) and len(sizes) == len(models.NUMERIC) + 9
    assert {importance[0]["feature"], importance[1]["feature"]} == {"num__months_active", "num__max_friction_score_v3"}


@pytest.mark.parametrize("name, small", [("random_forest", {"numTrees": 15}), ("hist_gradient_boosting", {"maxIter": 8})])
def test_trees_rank_well(table, monkeypatch, name, small):
    make = models.classifier
    monkeypatch.setattr(models, "classifier", lambda n, rows: make(n, rows).setParams(**small))
    model = models.fit_models(table, [name])[name]
    scored = models.score_rows(model, table).withColumn("y", F.col(TARGET))
    assert metrics.score_quality(scored).first()["roc_auc"] > 0.85
    importance = models.feature_importance(model, table)
    known = importance.where("importance is not null").count()
    assert known == (len(models.NUMERIC) + 9 if name == "random_forest" else 0)


def test_choice_of_model(spark):
    rows = [
        ("business_risk_baseline", "validation", 0.9, 0.9, 9.0),
        ("random_forest", "validation", 0.5, 0.4, 2.0),
        ("logistic_regression", "validation", 0.5, None, 7.5),
        ("logistic_regression", "test", 0.0, 0.0, 0.0),
    ]
    table = spark.createDataFrame(
        rows, "model string, split string, average_precision_pr_auc double, precision_top_5pct double, lift_top_5pct double"
    )
    assert models.choose_model(table) == "logistic_regression"


CONDITIONS = (
    lambda r: r["problem_category"] == "billing" and r["has_billing_dispute"] == 1,
    lambda r: r["problem_category"] in ("data", "coverage", "connectivity", "speed", "voice", "equipment", "installation")
    and r["has_technical_outage"] == 1 and r["has_churn_risk"] == 1,
    lambda r: r["friction_level_v3"] == "high" and (
        r["potential_agent_mismatch"] == 1 or r["agent_clarification_count_v3"] > 0 or r["customer_repetition_count_v3"] > 0
    ),
    lambda r: r["high_value_customer"] == 1 and (
        r["priority_level"] in ("P1 High", "P2 Medium") or r["business_risk_level"] == "high"
    ),
    lambda r: r["priority_level"] in ("P2 Medium", "P3 Low") and r["friction_level_v3"] == "low",
)


def greedy(rows):
    """The choice made over all rows, one case after the other."""
    used, seen, out = set(), set(), []
    for i, condition in enumerate(CONDITIONS):
        free = [r for r in rows if r["id"] not in used]
        fits = [r for r in free if condition(r)]
        calm = i == 4

        def order(r):
            risk = (r["friction_score_v3"], r["business_risk_score"]) if calm else (-r["business_risk_score"],)
            return (r["problem_category"] in seen, *risk, r["id"])

        pick = min(fits or free, key=order, default=None)
        if pick is None:
            continue
        used.add(pick["id"])
        seen.add(pick["problem_category"])
        out.append((i, pick["id"], picks.EXACT if fits else picks.FALLBACK))
    return out


@pytest.mark.parametrize("seed, n", [(1, 400), (2, 60), (3, 12), (4, 3)])
def test_picks_equal_the_greedy_choice(spark, seed, n):
    rng = random.Random(seed)
    # One category holds most rows.
    categories = ["billing"] * 8 + ["data", "coverage", "roaming", None]
    rows = [
        complaint(
            id=i, problem_category=rng.choice(categories), business_risk_score=rng.randint(0, 6) * 10,
            friction_score_v3=rng.randint(0, 5), friction_level_v3=rng.choice(["low", "high"]),
            business_risk_level=rng.choice(["low", "high"]), priority_level=rng.choice(["P1 High", "P2 Medium", "P3 Low"]),
            has_billing_dispute=rng.randint(0, 1), has_technical_outage=rng.randint(0, 1), has_churn_risk=rng.randint(0, 1),
            potential_agent_mismatch=rng.randint(0, 1), high_value_customer=rng.randint(0, 1),
        )
        for i in range(n)
    ]
    if n < 100:
        rows = [r | {"high_value_customer": 0} for r in rows]
    rows[0]["problem_category"] = "billing"
    chosen = picks.choose(picks.candidates(frame(spark, rows).repartition(5), "id").collect())
    assert chosen == greedy(rows)


def test_findings(spark):
    rows = [
        complaint(
            problem_category="data", priority_level="P1 High", business_risk_level="high", high_value_customer=1,
            friction_level_v3="high", total_revenue=1234.5,
        ),
        complaint(problem_category="data", priority_level="P3 Low", business_risk_level="low"),
        complaint(problem_category="a", priority_level="P3 Low", business_risk_level="low"),
    ]
    people = spark.range(1500)
    bills = spark.createDataFrame([(1,), (0,), (0,), (0,)], "bill_shock_flag int")
    got = {r["topic"]: r["finding"] for r in findings.findings(people, people, frame(spark, rows), bills).collect()}
    assert len(got) == 9
    assert got["Veri ölçeği"] == "1,500 müşteri, 1,500 harcama satırı ve 3 şikâyet satırı işlendi."
    assert "data" in got["Şikâyet odağı"] and "33.3%" in got["Friction"] and "25.0%" in got["Bill shock"]
    assert "{'P3 Low': 2, 'P1 High': 1}" in got["Risk ve öncelik"]
    assert got["High-value koruma"].endswith("sayısı 1; tarihsel gelir toplamı 1,234.50.")
    assert got["RAG"].endswith("ölçüm yok.")


def test_picks_build_the_chosen_rows_only(spark, tmp_path, monkeypatch):
    """The choice reads the written table without texts; texts are asked for by the chosen keys."""
    rows = [
        complaint(
            complaint_id=i, problem_category="billing", problem_subcategory="s", lifecycle_status_v2="a", customer_segment="b",
            friction_score_v3=i % 3, business_risk_score=i, business_risk_level="low", priority_level="P3 Low",
            recommended_queue="q", recommended_business_action="r", first_customer_message="m", customer_text=f"w{i}",
        )
        for i in range(30)
    ]
    features = frame(spark, rows)
    docs = spark.createDataFrame(
        [(i, f"d{i}", "t", "c", f"w{i}", f"w{i}") for i in range(30)],
        "doc_no long, document_id string, title string, category string, content string, content_norm string",
    )
    index, asked = knowledge.KnowledgeIndex(docs), []
    search = picks.retrieve
    monkeypatch.setattr(picks, "retrieve", lambda index, queries, *a, **k: asked.append(queries) or search(index, queries, *a, **k))
    features.write.parquet(f"{tmp_path}/features")
    features = spark.read.parquet(f"{tmp_path}/features")
    both = picks.picked_rows(features, index, written=features.drop("customer_text", "first_customer_message"))
    got = {(r["case_name"], r["retrieved_documents"][0]["document_id"]) for r in both.collect()}
    assert got == {(r["case_name"], r["retrieved_documents"][0]["document_id"]) for r in picks.picked_rows(features, index).collect()}
    assert len(got) == 5
    plan = asked[0]._jdf.queryExecution().executedPlan().toString()
    assert any("PushedFilters" in line and "In(complaint_id" in line for line in plan.splitlines())
