"""Ranking metrics for scored rows: columns y (0/1), score, total_revenue and row keys.

`by` names the groups (model, split) that are measured side by side; there are few of them, and
each may hold any number of rows.
"""

from functools import reduce

from pyspark.sql import functions as F

from .customer_month import KEYS
from .ranking import join_groups, with_rank, with_running_totals

TOP_PERCENTS = (1, 5, 10)
BUCKETS = 10


def best_first(keys=KEYS):
    """Highest score first, equal scores by key."""
    return [F.desc("score"), *[F.col(k) for k in keys]]


def rank_scores(scored, by=(), keys=KEYS):
    """Scored rows with their rank and the size of their group; the tables below share it."""
    return with_rank(scored, best_first(keys), by)


def score_quality(scored, by=()):
    """ROC AUC, average precision and Brier score per group; the first two null for one class."""
    levels = scored.groupBy(*by, "score").agg(
        F.sum(F.col("y").cast("long")).alias("pos"), F.count("*").alias("n")
    )
    running = with_running_totals(
        levels, [*map(F.col, by), F.desc("score")], {"pos_upto": F.col("pos"), "n_upto": F.col("n")}
    )
    groups = running.groupBy(*by).agg(
        F.min(F.col("pos_upto") - F.col("pos")).alias("pos_before"),
        F.min(F.col("n_upto") - F.col("n")).alias("n_before"),
        F.sum("pos").alias("positives"),
        F.sum("n").alias("rows"),
    )
    steps = join_groups(running, groups, by).withColumns(
        {
            "hits": F.col("pos_upto") - F.col("pos_before"),
            "seen": F.col("n_upto") - F.col("n_before"),
            "neg": F.col("n") - F.col("pos"),
            "negatives": F.col("rows") - F.col("positives"),
        }
    )
    negatives_below = F.col("negatives") - (F.col("seen") - F.col("hits"))
    both = (F.max("positives") > 0) & (F.max("negatives") > 0)
    won = F.sum(F.col("pos") * (negatives_below + F.col("neg") / 2.0))
    return steps.groupBy(*by).agg(
        F.when(both, F.try_divide(won, F.max("positives").cast("double") * F.max("negatives"))).alias("roc_auc"),
        F.when(both, F.try_divide(F.sum(F.col("pos").cast("double") * F.col("hits") / F.col("seen")), F.max("positives"))).alias(
            "average_precision_pr_auc"
        ),
        (
            F.sum(F.col("pos") * (1 - F.col("score")) ** 2 + F.col("neg") * F.col("score") ** 2) / F.max("rows")
        ).alias("brier_score"),
    )


def top_rows(percent):
    """Rows in the top `percent` of a group: at least one, rounded up, in whole numbers."""
    return F.greatest(F.lit(1).cast("long"), F.expr(f"(group_rows * {percent} + 99) div 100"))


def topk_metrics(ranked, by=(), percents=TOP_PERCENTS):
    """Precision, recall, lift and revenue capture of the top percents, one row per group."""
    y = F.col("y").cast("long")
    revenue = F.coalesce("total_revenue", F.lit(0.0))
    sums = {"rows": F.count("*"), "pos": F.sum(y), "rev": F.sum(F.when(y == 1, revenue))}
    for p in percents:
        inside = F.col("rank") <= top_rows(p)
        sums |= {
            f"n_{p}": F.count_if(inside),
            f"pos_{p}": F.sum(F.when(inside, y)),
            f"rev_{p}": F.sum(F.when(inside & (y == 1), revenue)),
        }
    table = ranked.groupBy(*by).agg(*[e.alias(n) for n, e in sums.items()])

    def ratio(a, b):
        return F.coalesce(F.try_divide(F.coalesce(a, F.lit(0)).cast("double"), b.cast("double")), F.lit(0.0))

    columns = []
    for p in percents:
        precision = ratio(F.col(f"pos_{p}"), F.col(f"n_{p}"))
        columns += [
            precision.alias(f"precision_top_{p}pct"),
            ratio(F.col(f"pos_{p}"), F.col("pos")).alias(f"recall_top_{p}pct"),
            ratio(precision, ratio(F.col("pos"), F.col("rows"))).alias(f"lift_top_{p}pct"),
            ratio(F.col(f"rev_{p}"), F.col("rev")).alias(f"revenue_capture_top_{p}pct"),
        ]
    return table.select(*by, *columns)


def evaluate(scored, ranked, by):
    """Score quality and top-percent metrics side by side, one row per group."""
    return score_quality(scored, by).join(F.broadcast(topk_metrics(ranked, by)), list(by))


def precision_at_k(metrics, by=("split",), percents=TOP_PERCENTS):
    """Long table of precision, recall and lift per group and percent."""
    return _long(metrics, by, percents, ("precision", "recall", "lift"))


def revenue_capture(metrics, by=("split",), percents=TOP_PERCENTS):
    """Long table of revenue capture per group and percent."""
    return _long(metrics, by, percents, ("revenue_capture",))


def _long(metrics, by, percents, names):
    rows = F.array(
        *[
            F.struct(F.lit(p).alias("top_k_percent"), *[F.col(f"{n}_top_{p}pct").alias(n) for n in names])
            for p in percents
        ]
    )
    return metrics.select(*by, F.inline(rows))


def confusion_top(ranked, by=("split",), percent=5):
    """Confusion counts with the top `percent` taken as positive; all four cells always present."""
    predicted = F.col("rank") <= top_rows(percent)
    actual = F.col("y") == 1
    counts = ranked.groupBy(*by).agg(
        F.count_if(~actual & ~predicted).alias("n00"),
        F.count_if(~actual & predicted).alias("n01"),
        F.count_if(actual & ~predicted).alias("n10"),
        F.count_if(actual & predicted).alias("n11"),
    )
    cells = [
        F.struct(F.lit(f"actual_{a}").alias("actual"), F.col(f"n{a}0").alias("pred_0"), F.col(f"n{a}1").alias("pred_1"))
        for a in (0, 1)
    ]
    return counts.select(*by, F.inline(F.array(*cells)))


def _bucket():
    """Ten buckets of equal rank width over ranks 1..N, in whole numbers."""
    return F.when(F.col("group_rows") <= 1, F.lit(1).cast("long")).otherwise(
        F.greatest(
            F.lit(1).cast("long"), F.expr(f"({BUCKETS} * (rank - 1) + group_rows - 2) div (group_rows - 1)")
        )
    )


def decile_table(ranked, by=("split",)):
    """Deciles of the score, 1 the highest."""
    y = F.col("y").cast("long")
    return (
        ranked.withColumn("decile", _bucket())
        .groupBy(*by, "decile")
        .agg(
            F.count("*").alias("customer_months"),
            F.avg(y).alias("target_rate"),
            F.sum(y).alias("captured_targets"),
            F.coalesce(F.sum("total_revenue"), F.lit(0.0)).alias("captured_revenue"),
            F.avg("score").alias("avg_score"),
        )
    )


def calibration_table(scored, by=("split",), keys=KEYS):
    """Predicted against observed risk in ten buckets of the score, lowest first."""
    ranked = with_rank(scored, [F.col("score"), *map(F.col, keys)], by)
    return (
        ranked.withColumn("bucket", _bucket())
        .groupBy(*by, "bucket")
        .agg(
            F.count("*").alias("rows"),
            F.avg("score").alias("avg_predicted_risk"),
            F.avg(F.col("y").cast("long")).alias("observed_rate"),
        )
    )


def rule_baseline(table, by=("split",), column="max_business_risk_score"):
    """Min-max scaled rule score per group, 0 where the score is constant."""
    value = F.coalesce(F.col(column), F.lit(0)).cast("double")
    spans = table.groupBy(*by).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    scaled = F.coalesce(F.try_divide(value - F.col("_low"), F.col("_high") - F.col("_low")), F.lit(0.0))
    return join_groups(table, spans, by).withColumn("score", scaled).drop("_low", "_high")


def union_all(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)
