"""Operational count, rate and crosstab tables."""

from functools import reduce

from pyspark.sql import functions as F

from ..functions.numeric import flag, share


def value_counts(df, column, name="complaint_count"):
    """Rows per non-null value, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(name))
    return counts.orderBy(F.desc(name), column)


def crosstab(df, rows, column, levels, normalise=False):
    """Row counts per `rows` value and level, levels as columns; shares of the row if `normalise`.

    Every listed level gets a column, also when it never occurs.
    """
    table = (
        df.where(F.col(rows).isNotNull() & F.col(column).isNotNull())
        .groupBy(rows)
        .agg(*[F.count_if(F.col(column) == level).alias(level) for level in levels])
    )
    if not normalise:
        return table
    row_total = reduce(lambda a, b: a + b, [F.col(f"`{level}`") for level in levels])
    return table.select(rows, *[F.try_divide(F.col(f"`{level}`"), row_total).alias(level) for level in levels])


def monthly_kpi(spending, complaints):
    """Active customers, revenue, usage, ARPU and complaint load per billing month."""
    # Customers are counted after collapsing to customer-months, so no task sees a raw month.
    per_customer = spending.groupBy("billing_year_month", "customer_id").agg(
        F.sum("bill_amount").alias("bill"), F.sum("data_usage").alias("usage"), F.count("data_usage").alias("rows")
    )
    months = per_customer.groupBy("billing_year_month").agg(
        F.count("customer_id").alias("active_customers"),
        F.coalesce(F.sum("bill"), F.lit(0.0)).alias("total_revenue"),
        F.try_divide(F.sum("usage"), F.sum("rows")).alias("avg_data_usage"),
    )
    load = complaints.groupBy("billing_year_month").agg(F.count("*").alias("complaint_count"))
    joined = months.join(load, "billing_year_month", "left").fillna(0, ["complaint_count"])
    return joined.withColumns(
        {
            "arpu": F.try_divide("total_revenue", "active_customers"),
            "complaints_per_1000_active_customers": F.try_divide("complaint_count", "active_customers") * 1000,
        }
    )


def data_scale(customer, spending, complaints):
    """Row counts of the three tables in one row."""
    def rows(df):
        return df.agg(F.count("*")).scalar()

    spark = customer.sparkSession
    return spark.range(1).select(
        rows(customer).alias("customer_rows"),
        rows(spending).alias("spending_rows"),
        rows(complaints).alias("complaint_rows"),
    )


BILL_SHOCK_NOTE = "context feature; causal claim is not made"


def bill_shock_summary(bills):
    return bills.agg(share(F.col("bill_shock_flag") == 1).alias("bill_shock_rate")).withColumn(
        "same_month_billing_complaint_lift", F.lit(BILL_SHOCK_NOTE)
    )


def complaint_totals(complaints):
    """One row of the totals that the findings and the KPI strip quote."""
    at_risk = (F.col("high_value_customer") == 1) & (F.col("business_risk_level") == "high")
    # First per customer and label, so that distinct customers need no second pass over raw rows.
    parts = complaints.groupBy("customer_id", "problem_category", "priority_level", "business_risk_level").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("friction_level_v3") == "high").alias("tense"),
        F.sum(flag(at_risk)).alias("at_risk_rows"),
        F.sum(F.when(at_risk, F.col("total_revenue"))).alias("at_risk_revenue"),
    )
    at_risk_customers = (
        parts.where("at_risk_rows > 0").select("customer_id").distinct().agg(F.count("customer_id")).scalar()
    )
    top_category = value_counts(complaints, "problem_category").limit(1).select("problem_category").scalar()
    high_risk = F.col("business_risk_level") == "high"
    urgent = F.col("priority_level").isin("P0 Critical", "P1 High")

    def rows_where(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0).cast("long"))

    def distribution(column, levels):
        return F.map_from_arrays(
            F.array(*map(F.lit, levels)), F.array(*[rows_where(F.col(column) == level) for level in levels])
        )

    totals = parts.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("complaints"),
        F.coalesce(F.try_divide(F.sum("tense"), F.sum("n")), F.lit(0.0)).alias("high_friction_rate"),
        rows_where(high_risk).alias("high_risk_complaints"),
        F.coalesce(F.try_divide(rows_where(high_risk), F.sum("n")), F.lit(0.0)).alias("high_risk_rate"),
        rows_where(urgent).alias("p0_p1_complaints"),
        F.coalesce(F.sum("at_risk_revenue"), F.lit(0.0)).alias("at_risk_revenue"),
        distribution("priority_level", ("P0 Critical", "P1 High", "P2 Medium", "P3 Low")).alias("priorities"),
        distribution("business_risk_level", ("high", "medium", "low")).alias("risk_levels"),
    )
    return totals.withColumns({"largest_category": top_category, "at_risk_customers": at_risk_customers})


def kpi_strip(customer, bills, complaints, precision_at_5, hit_at_3):
    """One row of headline figures; the last two come from the model and retrieval metrics."""
    return complaint_totals(complaints).select(
        customer.agg(F.count("*")).scalar().alias("customers"),
        "complaints",
        "largest_category",
        "high_friction_rate",
        bill_shock_summary(bills).select("bill_shock_rate").scalar().alias("bill_shock_rate"),
        "high_risk_complaints",
        "p0_p1_complaints",
        F.col("at_risk_customers").alias("high_value_at_risk_customers"),
        precision_at_5.alias("precision_top_5pct"),
        hit_at_3.alias("hit_at_3"),
    )
