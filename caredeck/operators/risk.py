"""Auditable business risk score, priority and bands."""

from functools import reduce

from pyspark.sql import functions as F

from ..functions.numeric import flag, share, total

PREFIX = "risk_component_"
PRIORITIES = ("P0 Critical", "P1 High", "P2 Medium", "P3 Low")

# Points per active signal.
WEIGHTS = {
    "legal": 40,
    "churn": 30,
    "high_frustration": 20,
    "high_friction": 15,
    "repeat": 15,
    "billing": 15,
    "technical": 10,
    "high_value": 10,
    "bill_shock": 10,
}

# Names of the active signals shown with a picked row, and their columns.
RISK_SIGNALS = {
    "legal": "has_legal_risk",
    "churn_candidate": "has_churn_risk",
    "billing_dispute": "has_billing_dispute",
    "technical_outage": "has_technical_outage",
    "potential_agent_mismatch": "potential_agent_mismatch",
    "bill_shock": "bill_shock_flag",
    "high_value": "high_value_customer",
    "repeat_next_2m": "repeat_complaint_next_2m",
}


def risk_priority(complaints, weights=WEIGHTS):
    """Complaints with one column per risk component, their sum, level, priority and band.

    A missing signal (say, a customer without profile) counts as absent.
    """
    active = {
        "legal": F.col("has_legal_risk"),
        "churn": F.col("has_churn_risk"),
        "high_frustration": F.col("high_frustration_flag"),
        "high_friction": flag(F.col("friction_level_v3") == "high"),
        "repeat": F.col("repeat_complaint_next_2m"),
        "billing": F.col("has_billing_dispute"),
        "technical": F.col("has_technical_outage"),
        "high_value": F.col("high_value_customer"),
        "bill_shock": F.col("bill_shock_flag"),
    }
    parts = complaints.withColumns(
        {PREFIX + name: F.coalesce(active[name].cast("int"), F.lit(0)) * points for name, points in weights.items()}
    )
    # Any further risk_component_* column of the input counts too.
    found = [F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in parts.columns if c.startswith(PREFIX)]
    scored = parts.withColumn("business_risk_score", reduce(lambda a, b: a + b, found))
    score = F.col("business_risk_score")
    scored = scored.withColumn(
        "business_risk_level", F.when(score <= 19, "low").when(score <= 49, "medium").otherwise("high")
    )
    legal, churn = F.col("has_legal_risk") == 1, F.col("has_churn_risk") == 1
    valued = F.coalesce(F.col("high_value_customer"), F.lit(0)) == 1
    critical = legal | (score >= 90) | (churn & (F.col("friction_level_v3") == "high") & valued)
    return scored.withColumns(
        {
            "priority_level": F.when(critical, PRIORITIES[0])
            .when(churn | (F.col("business_risk_level") == "high"), PRIORITIES[1])
            .when(F.col("business_risk_level") == "medium", PRIORITIES[2])
            .otherwise(PRIORITIES[3]),
            "risk_score_band": F.when(score <= 19, "0-19")
            .when(score <= 39, "20-39")
            .when(score <= 59, "40-59")
            .when(score <= 79, "60-79")
            .otherwise("80+"),
        }
    )


def active_signals():
    """Array of the names of a row's active risk signals."""
    return F.array_compact(F.array(*[F.when(F.col(c) == 1, F.lit(n)) for n, c in RISK_SIGNALS.items()]))


def component_summary(complaints):
    """Total points, active rows and active rate per risk component."""
    names = [c for c in complaints.columns if c.startswith(PREFIX)]
    rows = [
        F.struct(
            F.lit(name).alias("component"),
            F.coalesce(F.sum(F.col(name).cast("long")), F.lit(0).cast("long")).alias("total_points"),
            total(F.col(name) > 0).alias("active_rows"),
            share(F.col(name) > 0).alias("active_rate"),
        )
        for name in names
    ]
    return complaints.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def _high_value(complaints):
    return complaints.where(F.col("high_value_customer") == 1)


def high_value_at_risk(complaints, limit=None, keys=("customer_id", "billing_year_month")):
    """High-value rows at high risk, riskiest first; with `limit`, at most so many."""
    at_risk = _high_value(complaints).where(F.col("business_risk_level") == "high")
    ordered = at_risk.orderBy(F.desc("business_risk_score"), *keys)
    return ordered if limit is None else ordered.limit(limit)


def high_value_at_risk_summary(complaints):
    """Distinct customers at risk and their revenue.

    historical_revenue adds a customer's revenue once per complaint row, as the published table
    does; distinct_customer_revenue adds it once per customer.
    """
    at_risk = _high_value(complaints).where(F.col("business_risk_level") == "high")
    per_customer = at_risk.groupBy("customer_id").agg(
        F.sum("total_revenue").alias("by_row"), F.max("total_revenue").alias("once")
    )
    return per_customer.agg(
        F.count("customer_id").alias("high_value_at_risk_customers"),
        F.coalesce(F.sum("by_row"), F.lit(0.0)).alias("historical_revenue"),
        F.coalesce(F.sum("once"), F.lit(0.0)).alias("distinct_customer_revenue"),
    )


def high_value_revenue_by_priority(complaints):
    """Distinct high-value customers and row-weighted revenue per priority."""
    per_customer = (
        _high_value(complaints)
        .groupBy("priority_level", "customer_id")
        .agg(F.sum("total_revenue").alias("by_row"))
    )
    return per_customer.groupBy("priority_level").agg(
        F.count("customer_id").alias("customer_count"),
        F.coalesce(F.sum("by_row"), F.lit(0.0)).alias("historical_revenue"),
    )
