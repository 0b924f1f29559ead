"""Customer lifecycle from billing months."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.months import month_index


def lifecycle(spending):
    """One row per customer: activity span, gaps, revenue and lifecycle status.

    Rows collapse to customer-months before anything is ordered, so a customer's window never
    holds more rows than there are calendar months, however many bills they have.
    """
    months = (
        spending.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "billing_year_month")
        .agg(
            F.sum("bill_amount").alias("bill_sum"),
            F.count("bill_amount").alias("bill_rows"),
            F.sum("data_usage").alias("usage_sum"),
            F.count("data_usage").alias("usage_rows"),
        )
        .withColumn("month", month_index(F.col("billing_year_month")))
    )
    by_month = Window.partitionBy("customer_id").orderBy("month")
    step = F.col("month") - F.lag("month").over(by_month)
    # Two spellings of one month give a step of 0: no new active month, no gap.
    months = months.withColumn("new_month", F.coalesce(step > 0, F.lit(True))).withColumn(
        "gap", F.greatest(F.coalesce(step - 1, F.lit(0)), F.lit(0))
    )
    last_month = spending.where(F.col("customer_id").isNotNull()).agg(
        F.max(month_index(F.col("billing_year_month")))
    )
    per_customer = months.groupBy("customer_id").agg(
        F.min_by("billing_year_month", "month").alias("first_active_month"),
        F.max_by("billing_year_month", "month").alias("last_active_month"),
        F.min("month").alias("first_month_index"),
        F.max("month").alias("last_month_index"),
        F.count_if("new_month").alias("months_active"),
        F.count_if(F.col("gap") > 0).alias("inactive_gap_count"),
        F.max("gap").alias("max_inactive_gap"),
        F.sum("gap").alias("total_inner_gap_months"),
        F.coalesce(F.sum("bill_sum"), F.lit(0.0)).alias("total_revenue"),
        F.try_divide(F.sum("bill_sum"), F.sum("bill_rows")).alias("avg_bill"),
        F.try_divide(F.sum("usage_sum"), F.sum("usage_rows")).alias("avg_data_usage"),
    )
    window = F.col("last_month_index") - F.col("first_month_index") + 1
    facts = per_customer.withColumns(
        {
            "observed_window_months": window,
            "active_month_ratio": F.col("months_active") / window,
            "months_since_last_spending": last_month.scalar() - F.col("last_month_index"),
            "reactivation_count": F.col("inactive_gap_count"),
        }
    )
    return facts.withColumn("lifecycle_status_v2", _status())


def _status():
    since, ratio = F.col("months_since_last_spending"), F.col("active_month_ratio")
    # First match wins. A recent customer without gaps has ratio 1, so the last three names
    # cannot occur; they are kept because consumers may list them.
    return (
        F.when(F.col("months_active") < 3, "short_observed_history")
        .when(since >= 6, "extended_no_spending")
        .when(since >= 2, "recent_no_spending")
        .when(F.col("reactivation_count") > 0, "reactivated_after_gap")
        .when(ratio >= 0.95, "continuous_observed")
        .when((since <= 1) & (ratio >= 0.70), "active_recent_regular")
        .when(since <= 1, "active_recent_irregular")
        .otherwise("other_irregular")
    )
