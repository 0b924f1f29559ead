"""Customer profile: lifecycle, age band and revenue segment."""

from pyspark.sql import functions as F

from ..functions.numeric import flag
from .ranking import quantile

# Upper age of each band.
AGE_BANDS = ((25, "<=25"), (35, "26-35"), (45, "36-45"), (55, "46-55"), (65, "56-65"), (200, "65+"))
HIGH_VALUE_SEGMENT = "High value (top 20% revenue)"
STANDARD_SEGMENT = "Standard value"


def age_band(age):
    band = F.when(age <= 0, F.lit(None).cast("string"))
    for upper, label in AGE_BANDS:
        band = band.when(age <= upper, label)
    return band


def high_value_threshold(profile, p=0.80):
    """One-row frame with the revenue that starts the high-value segment."""
    return quantile(profile, "total_revenue", p)


def customer_profile(customer, lifecycle, reference_year=2026, p=0.80):
    """(profile, threshold frame): customers with lifecycle facts and segment."""
    joined = customer.join(lifecycle, "customer_id", "left").withColumn(
        "age", F.lit(reference_year) - F.col("birth_year")
    )
    threshold = high_value_threshold(joined.select("total_revenue"), p)
    high = flag(F.col("total_revenue") >= threshold.scalar())
    profile = (
        joined.withColumn("age_band", age_band(F.col("age")))
        .withColumn("high_value_customer", high)
        .withColumn(
            "customer_segment",
            F.when(F.col("high_value_customer") == 1, HIGH_VALUE_SEGMENT).otherwise(STANDARD_SEGMENT),
        )
    )
    return profile, threshold
