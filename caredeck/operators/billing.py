"""Bill shock, nearby billing complaints and the no-billable-activity label."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.months import month_index
from ..functions.numeric import flag
from ..storage import materialise
from .ranking import with_position

# Rows of the ordered table that one task handles when a customer is split.
CHUNK_ROWS = 1_000_000
_PRIOR_ROWS = 3


def billing_complaints(complaints):
    """Whether a customer-month has a billing complaint (columns customer_id, billing_year_month)."""
    return complaints.groupBy("customer_id", "billing_year_month").agg(
        F.max(flag(F.col("problem_category") == "billing")).alias("same_month_billing_complaint")
    )


def bill_shock(spending, complaints, threshold=0.30, hot_rows=CHUNK_ROWS):
    """Spending rows with bill-change facts, complaint flags and the label.

    Prior bills are prior rows in (month, bill, usage) order, not prior calendar months.
    Customers with more than `hot_rows` rows are split over tasks; everyone else needs one
    exchange by customer.
    """
    everything = spending.withColumn("month_index", month_index(F.col("billing_year_month")))
    rows = everything.where(F.col("customer_id").isNotNull())
    nobody = _without_customer(everything.where(F.col("customer_id").isNull()))
    flags = billing_complaints(complaints).select(
        "customer_id",
        month_index(F.col("billing_year_month")).alias("month_index"),
        F.col("same_month_billing_complaint").alias("_billing"),
    )
    hot = _hot_customers(rows, hot_rows)
    if hot is None:
        bills = _prior_bills(_month_context(rows, flags), ["customer_id"])
        return _shock(bills.unionByName(nobody), threshold)

    cold_rows, hot_part = rows.join(hot, "customer_id", "left_anti"), rows.join(hot, "customer_id", "left_semi")
    cold = _prior_bills(_month_context(cold_rows, flags), ["customer_id"])
    # A hot customer still has few distinct months; only the row order needs the split.
    months = hot_part.select("customer_id", "month_index").distinct()
    context = _month_context(months, flags.join(hot, "customer_id", "left_semi"))
    context = context.withColumnsRenamed({"customer_id": "_customer", "month_index": "_month"})
    same = F.expr("customer_id = _customer and month_index <=> _month")
    split = _prior_bills_split(hot_part, hot_rows).join(context, same).drop("_customer", "_month")
    return _shock(cold.unionByName(split).unionByName(nobody), threshold)


def _hot_customers(rows, limit):
    """Broadcastable ids of customers with more than `limit` rows (at most rows/limit ids), or None."""
    counts = rows.groupBy("customer_id").agg(F.count("*").alias("_rows")).where(F.col("_rows") > limit)
    found = counts.select("customer_id").collect()
    if not found:
        return None
    return F.broadcast(rows.sparkSession.createDataFrame(found, rows.select("customer_id").schema))


def _without_customer(rows):
    """Rows without a customer id have no prior bills, no complaints and no later activity."""
    return rows.withColumns(
        {
            "previous_bill_amount": F.lit(None).cast("double"),
            "rolling_3m_avg_bill": F.lit(None).cast("double"),
            "same_month_billing_complaint": F.lit(0),
            "next_month_billing_complaint": F.lit(0),
            "no_billable_activity_next_2m": F.lit(1),
        }
    )


def _month_context(rows, flags):
    """Complaint flags and label per row, by range frames over one partitioning by customer.

    The complaint flags ride along as extra rows and are dropped again; that saves two joins.
    """
    marked = rows.withColumn("_spend", F.lit(1)).unionByName(flags, allowMissingColumns=True)
    months = Window.partitionBy("customer_id").orderBy("month_index")
    return (
        marked.withColumns(
            {
                "same_month_billing_complaint": F.max("_billing").over(months.rangeBetween(0, 0)),
                "next_month_billing_complaint": F.max("_billing").over(months.rangeBetween(1, 1)),
                "_later": F.count("_spend").over(months.rangeBetween(1, 2)),
            }
        )
        .where("_spend = 1")
        .withColumns(
            {
                "same_month_billing_complaint": F.coalesce("same_month_billing_complaint", F.lit(0)),
                "next_month_billing_complaint": F.coalesce("next_month_billing_complaint", F.lit(0)),
                "no_billable_activity_next_2m": flag(F.col("_later") == 0),
            }
        )
        .drop("_spend", "_billing", "_later")
    )


def _bill_order():
    return [F.col("billing_year_month"), F.col("bill_amount"), F.col("data_usage")]


def _prior_bills(rows, keys, order=None):
    window = Window.partitionBy(*keys).orderBy(*(order or _bill_order()))
    return rows.withColumns(
        {
            "previous_bill_amount": F.lag("bill_amount").over(window),
            "rolling_3m_avg_bill": F.avg("bill_amount").over(window.rowsBetween(-_PRIOR_ROWS, -1)),
        }
    )


def _prior_bills_split(rows, chunk_rows):
    """Prior bills of customers too big for one task.

    The ordered rows are cut into chunks; the last rows of a chunk are repeated at the head of
    the next one, so that every row sees all its prior rows inside its own chunk.
    """
    # A written row number parts rows that are equal in every column, so that no range is stuck with them all.
    numbered = materialise(rows.withColumn("_row", F.monotonically_increasing_id()))
    placed = with_position(numbered, [F.col("customer_id"), *_bill_order(), F.col("_row")], "_position")
    chunk_rows = max(chunk_rows, _PRIOR_ROWS)
    chunk = F.floor(F.col("_position") / chunk_rows)
    into_next = F.col("_position") % chunk_rows >= chunk_rows - _PRIOR_ROWS
    chunks = F.when(into_next, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    repeated = placed.withColumn("_home", chunk).withColumn("_chunk", F.explode(chunks))
    done = _prior_bills(repeated, ["_chunk", "customer_id"], [F.col("_position")])
    return done.where("_chunk = _home").drop("_row", "_position", "_home", "_chunk")


def _shock(rows, threshold):
    change = F.col("bill_amount") - F.col("previous_bill_amount")
    return (
        rows.withColumn("bill_change_abs", change)
        .withColumn("bill_change_pct", F.try_divide("bill_change_abs", F.nullif("previous_bill_amount", F.lit(0.0))))
        .withColumn("bill_shock_flag", flag(F.col("bill_change_pct") >= threshold))
    )
