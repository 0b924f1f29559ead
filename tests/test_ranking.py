import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caredeck.operators import metrics, ranking
from caredeck.operators.customer_month import customer_months, time_split

from .helpers import by, complaint, frame


def scored(spark, pairs, split="test"):
    rows = [(split, i, "2024-01", y, s, float(i + 1)) for i, (y, s) in enumerate(pairs)]
    return spark.createDataFrame(
        rows, "split string, customer_id int, billing_year_month string, y int, score double, total_revenue double"
    )


SAMPLE = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.7), (1, 0.2), (0, 0.1)]


def test_score_quality(spark):
    got = metrics.score_quality(scored(spark, SAMPLE)).first()
    assert tuple(got) == pytest.approx((0.611111, 0.7, 0.313333), abs=1e-6)
    one_class = metrics.score_quality(scored(spark, [(1, 0.5), (1, 0.7)])).first()
    assert one_class["roc_auc"] is None and one_class["average_precision_pr_auc"] is None


def test_top_percent(spark):
    got = metrics.topk_metrics(metrics.rank_scores(scored(spark, SAMPLE))).first()
    for p in (1, 5, 10):
        assert got[f"precision_top_{p}pct"] == 1
        assert got[f"recall_top_{p}pct"] == pytest.approx(1 / 3)
        assert got[f"lift_top_{p}pct"] == 2
        assert got[f"revenue_capture_top_{p}pct"] == pytest.approx(1 / 9)
    cells = by(metrics.confusion_top(metrics.rank_scores(scored(spark, SAMPLE)), ()), "actual", "pred_0", "pred_1")
    assert cells == {"actual_0": (3, 0), "actual_1": (2, 1)}


def test_groups_are_ranked_apart(spark):
    both = scored(spark, SAMPLE, "a").unionByName(scored(spark, [(1 - y, s) for y, s in SAMPLE], "b"))
    table = metrics.evaluate(both, metrics.rank_scores(both, ("split",)), ("split",))
    got = by(table, "split", "roc_auc", "precision_top_5pct")
    assert got["a"] == pytest.approx((0.611111, 1), abs=1e-6)
    assert got["b"] == pytest.approx((1 - 0.611111, 0), abs=1e-6)


def test_deciles(spark):
    ranked = metrics.rank_scores(scored(spark, [(i % 2, 1 - i / 100) for i in range(12)]))
    sizes = by(metrics.decile_table(ranked, ()), "decile", "customer_months")
    assert [d for d in sorted(sizes) for _ in range(sizes[d])] == [1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10]
    single = metrics.decile_table(metrics.rank_scores(scored(spark, [(1, 0.5)])), ()).first()
    assert single["decile"] == 1


def test_percentile(spark):
    rows = scored(spark, [(0, 0.2), (0, 0.2), (1, 0.5)])
    assert by(ranking.with_percentile(rows, "score"), "customer_id", "risk_percentile") == {0: 0.5, 1: 0.5, 2: 1.0}


def test_positions_and_totals_with_a_hot_value(spark):
    """A third of the rows share one value; ranks stay dense and totals exact."""
    random.seed(3)
    values = [7] * 400 + [random.randint(0, 1000) for _ in range(800)]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v int").repartition(6)
    got = ranking.with_position(rows, [F.col("v"), F.col("i")]).collect()
    expected = {i: n for n, (v, i) in enumerate(sorted((v, i) for i, v in enumerate(values)))}
    assert {r["i"]: r["position"] for r in got} == expected
    totals = ranking.with_running_totals(rows, [F.col("v"), F.col("i")], {"upto": F.col("v")}).collect()
    running, total = {}, 0
    for v, i in sorted((v, i) for i, v in enumerate(values)):
        total += v
        running[i] = total
    assert {r["i"]: r["upto"] for r in totals} == running


def test_quantiles(spark):
    rows = spark.createDataFrame([(v, None if v > 30 else v * 2) for v in (10.0, 20.0, 30.0, 40.0, 50.0)], "a double, b double")
    got = {(r["column"], r["p"]): r["value"] for r in ranking.quantiles(rows, {"a": [0.8, 0.5, 0.0], "b": [0.5]}).collect()}
    assert got == {("a", 0.8): pytest.approx(42), ("a", 0.5): 30, ("a", 0.0): 10, ("b", 0.5): 40}


def test_no_window_over_the_whole_table(spark):
    plans = [
        metrics.rank_scores(scored(spark, SAMPLE)),
        metrics.score_quality(scored(spark, SAMPLE)),
        metrics.calibration_table(scored(spark, SAMPLE), ()),
        ranking.with_percentile(scored(spark, SAMPLE), "score"),
    ]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan or "hashpartitioning(_part" in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_baseline(spark):
    rows = spark.createDataFrame(
        [("a", 10), ("a", 30), ("a", None), ("b", 5), ("b", 5)], "split string, max_business_risk_score int"
    )
    got = [r["score"] for r in metrics.rule_baseline(rows).orderBy("split", "max_business_risk_score").collect()]
    assert got == pytest.approx([0, 1 / 3, 1, 0, 0])


def months_table(spark, count):
    rows = [(c, 2024 * 12 + m) for m in range(1, count + 3) for c in range(2)]
    return spark.createDataFrame(rows, "customer_id int, month_index int")


@pytest.mark.parametrize("count, sizes", [(3, (1, 1, 1)), (8, (4, 2, 2))])
def test_time_split(spark, count, sizes):
    got = time_split(months_table(spark, count)).groupBy("split").agg(
        F.countDistinct("month_index").alias("n"), F.min("month_index").alias("m")
    ).orderBy("m")
    assert [(r["split"], r["n"]) for r in got.collect()] == list(zip(("train", "validation", "test"), sizes))


def test_time_split_needs_three_months(spark):
    with pytest.raises(Exception, match="fewer than three"):
        time_split(months_table(spark, 2)).collect()


def test_customer_month(spark):
    extra = {
        "business_risk_score": 10, "friction_score_v3": 1, "priority_level": "P3 Low", "lifecycle_status_v2": "x",
        "no_billable_activity_next_2m": 0,
    } | {
        n: 1.0 for n in (
            "avg_bill", "avg_data_usage", "months_active", "active_month_ratio", "months_since_last_spending",
            "inactive_gap_count", "reactivation_count", "previous_bill_amount", "rolling_3m_avg_bill",
            "bill_change_abs", "bill_change_pct",
        )
    }
    rows = [
        complaint(**extra) | {"problem_category": "b", "problem_subcategory": None},
        complaint(**extra) | {"problem_category": "a", "problem_subcategory": None, "priority_level": "P0 Critical"},
        complaint(**extra) | {"problem_category": None, "problem_subcategory": None, "no_billable_activity_next_2m": None},
    ]
    rows[0]["business_risk_score"] = 44
    table = customer_months(frame(spark, rows).withColumn("problem_subcategory", F.col("problem_subcategory").cast("string")))
    got = table.first()
    assert (got["complaint_count"], got["unique_problem_category_count"]) == (3, 2)
    # A tie goes to the smaller label; no label at all is 'unknown'.
    assert (got["dominant_problem_category"], got["dominant_problem_subcategory"]) == ("a", "unknown")
    assert (got["max_business_risk_score"], got["max_priority_rank"]) == (44, 4)
    assert got["no_billable_activity_next_2m"] == 0


@pytest.mark.parametrize("inside, accuracy", [(5, 100), (40, 20), (100_000, 10_000)])
def test_quantiles_by_bracket(spark, monkeypatch, inside, accuracy):
    """Brackets that hold too many values are narrowed again; ties and few values end the search."""
    monkeypatch.setattr(ranking, "INSIDE", inside)
    monkeypatch.setattr(ranking, "BRACKET", accuracy)
    draw = np.random.default_rng(6)
    values = {
        "even": np.arange(4000.0), "drawn": draw.standard_normal(4000), "tied": np.repeat([1.0, 2.0, 5.0, 5.5], [1, 2999, 999, 1]),
        "skewed": draw.pareto(0.5, 4000),
    }
    rows = spark.createDataFrame([tuple(float(c[i]) for c in values.values()) for i in range(4000)], list(values))
    rows = rows.unionByName(spark.createDataFrame([(None,) * 4] * 7, rows.schema)).repartition(5)
    ps = [0.0, 0.1, 0.25, 0.5, 0.8, 0.9, 0.95, 0.999, 1.0]
    got = {(r["column"], r["p"]): r["value"] for r in ranking.quantiles(rows, {n: ps for n in values}).collect()}
    for name, column in values.items():
        for p in ps:
            assert got[name, p] == pytest.approx(np.quantile(column, p), rel=1e-12, abs=1e-12)


def test_percentile_with_a_hot_score(spark):
    """Half of the rows share a score: they are looked up in place, and no task of the rest holds more than its share."""
    scores = [0.5] * 3000 + [i / 3000 for i in range(3000)] + [None] * 5
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "customer_id long, score double")
    ranked = ranking.with_percentile(rows, "score")
    got = {r["customer_id"]: r["risk_percentile"] for r in ranked.collect()}
    known = sorted(s for s in scores if s is not None)
    low, ties = known.index(0.5), known.count(0.5)
    assert got[0] == pytest.approx((low + (ties + 1) / 2) / len(known)) and got[6003] is None
    assert got[3000] == pytest.approx(1 / len(known)) and len(got) == len(scores)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_offsets_are_a_local_table(spark):
    """No Python worker makes the rows of the partitions' offsets."""
    parts = spark.createDataFrame([(2, 5), (0, 3), (1, 4)], "_part long, n long")
    offsets = ranking._offsets(parts, ["n"])
    assert sorted(map(tuple, offsets.collect())) == [(0, 0), (1, 3), (2, 7)]
    assert "LocalTableScan" in offsets._jdf.queryExecution().executedPlan().toString()
    assert ranking._offsets(parts.limit(0), ["n"]).count() == 0
