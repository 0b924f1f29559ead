"""Repeat complaints in the following months."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.months import month_index
from ..functions.numeric import flag, share, total


def repeat_months(complaints):
    """Distinct customer-months with their repeat flags; several complaints in a month count once."""
    months = (
        complaints.select("customer_id", "billing_year_month")
        .distinct()
        .withColumn("month_index", month_index(F.col("billing_year_month")))
    )
    ahead = Window.partitionBy("customer_id").orderBy("month_index")
    return months.withColumns(
        {
            "repeat_complaint_next_1m": flag(F.count("*").over(ahead.rangeBetween(1, 1)) > 0),
            "repeat_complaint_next_2m": flag(F.count("*").over(ahead.rangeBetween(1, 2)) > 0),
        }
    )


def repeat_flags(complaints):
    """Complaints with month_index and the three repeat columns."""
    months = repeat_months(complaints).select(
        "customer_id", "billing_year_month", "repeat_complaint_next_1m", "repeat_complaint_next_2m"
    )
    return with_repeat_default(
        complaints.withColumn("month_index", month_index(F.col("billing_year_month"))).join(
            months, ["customer_id", "billing_year_month"], "left"
        )
    )


def with_repeat_default(complaints):
    """Null flags to 0, plus repeat_complaint as the two-month flag."""
    filled = complaints.fillna(0, ["repeat_complaint_next_1m", "repeat_complaint_next_2m"])
    return filled.withColumn("repeat_complaint", F.col("repeat_complaint_next_2m"))


def _rates():
    return [
        share(F.col("repeat_complaint_next_1m") == 1).alias("repeat_next_1m_rate"),
        share(F.col("repeat_complaint_next_2m") == 1).alias("repeat_next_2m_rate"),
    ]


def repeat_summary(complaints):
    return complaints.agg(
        F.count("*").alias("complaint_rows"),
        *_rates(),
        total(F.col("repeat_complaint_next_1m") == 1).alias("repeat_next_1m_rows"),
        total(F.col("repeat_complaint_next_2m") == 1).alias("repeat_next_2m_rows"),
    )


def repeat_by_category(complaints):
    return complaints.groupBy("problem_category").agg(F.count("*").alias("complaint_count"), *_rates())
