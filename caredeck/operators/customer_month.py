"""Customer-month modelling table and its split by time."""

from pyspark.sql import functions as F

from ..functions.months import month_index

TARGET = "no_billable_activity_next_2m"
KEYS = ("customer_id", "billing_year_month")

# Rank of each priority.
PRIORITY_RANKS = {"P3 Low": 1, "P2 Medium": 2, "P1 High": 3, "P0 Critical": 4}

# New column -> complaint column whose maximum it holds.
# The columns of the customer-month table and what they are the maximum of.
_MAXIMA = {
    "max_friction_score_v3": "friction_score_v3",
    "max_business_risk_score": "business_risk_score",
    "any_has_churn_risk": "has_churn_risk",
    "any_has_billing_dispute": "has_billing_dispute",
    "any_has_technical_outage": "has_technical_outage",
    "any_has_legal_risk": "has_legal_risk",
    "any_potential_agent_mismatch": "potential_agent_mismatch",
    "any_bill_shock_flag": "bill_shock_flag",
    "any_repeat_complaint_next_2m": "repeat_complaint_next_2m",
} | {
    name: name
    for name in (
        "high_value_customer", "total_revenue", "avg_bill", "avg_data_usage", "months_active", "active_month_ratio",
        "months_since_last_spending", "inactive_gap_count", "reactivation_count", "previous_bill_amount",
        "rolling_3m_avg_bill", "bill_change_abs", "bill_change_pct",
    )
}


def dominant(column):
    """Most frequent non-null value as text, ties to the smallest, 'unknown' if there is none."""
    return F.coalesce(F.mode(F.col(column).cast("string"), True), F.lit("unknown"))


def customer_months(complaints):
    """One row per customer-month: counts, dominant labels, maxima and the target.

    One exchange. The label histograms and category sets hold one entry per distinct label, and
    are merged before the exchange, so a hot customer-month stays small.
    """
    rank = F.coalesce(
        *[F.when(F.col("priority_level") == level, rank) for level, rank in PRIORITY_RANKS.items()], F.lit(0)
    )
    return complaints.groupBy(*KEYS).agg(
        F.max(month_index(F.col("billing_year_month"))).alias("month_index"),
        F.count("*").alias("complaint_count"),
        F.size(F.collect_set("problem_category")).alias("unique_problem_category_count"),
        dominant("problem_category").alias("dominant_problem_category"),
        dominant("problem_subcategory").alias("dominant_problem_subcategory"),
        dominant("lifecycle_status_v2").alias("lifecycle_status_v2"),
        F.max(rank).alias("max_priority_rank"),
        *[F.max(source).alias(name) for name, source in _MAXIMA.items()],
        F.coalesce(F.max(TARGET), F.lit(0)).cast("int").alias(TARGET),
    )


def time_split(table, horizon_month=None, unlabelled=None):
    """Add `split` (train, validation, test) by month; the last two months are dropped, or kept as split `unlabelled`.

    The label of the last two months is censored, and so is that of any month after
    `horizon_month` - 2 if the last month of spending is given.
    """
    month = F.col("month_index")
    # Distinct months only: bounded by the calendar.
    known = table.agg(F.array_sort(F.collect_set("month_index")).alias("months")).select(
        F.filter(
            "months",
            lambda m: m <= (F.array_max("months") if horizon_month is None else F.lit(horizon_month)) - 2,
        ).alias("months")
    )
    count = F.size("months")
    bounds = known.select(
        F.when(
            count >= 3,
            F.struct(
                F.element_at("months", F.greatest(F.lit(1), F.floor(count * F.lit(0.6)).cast("int"))).alias("train"),
                F.element_at("months", F.greatest(F.lit(2), F.floor(count * F.lit(0.8)).cast("int"))).alias("validation"),
                F.element_at("months", -1).alias("test"),
            ),
        )
        .otherwise(F.raise_error(F.lit("fewer than three usable months for a split by time")))
        .alias("last")
    ).scalar()
    split = F.when(month <= bounds["train"], "train").when(month <= bounds["validation"], "validation").when(month <= bounds["test"], "test")
    if unlabelled is not None:
        return table.withColumn("split", F.coalesce(split, F.lit(unlabelled)))
    return table.withColumn("split", split).where(F.col("split").isNotNull())
