import pytest
from pyspark.sql import functions as F

from caredeck.operators.billing import bill_shock
from caredeck.operators.lifecycle import lifecycle
from caredeck.operators.profile import age_band, customer_profile
from caredeck.operators.repeats import repeat_flags

from .helpers import by

SPENDING = "customer_id string, billing_year_month string, bill_amount double, data_usage double"


def spending(spark, months):
    rows = [(c, f"2024-{m}", 10.0, 1.0) for c, ms in months.items() for m in ms.split(",")]
    return spark.createDataFrame(rows, SPENDING)


def test_lifecycle(spark):
    table = lifecycle(
        spending(
            spark,
            {"c1": "10,11,12", "c2": "08,09,12", "c3": "01,02,03", "c4": "08,09,10", "c5": "12,12", "c6": "09,10,11"},
        )
    )
    got = by(
        table, "customer_id", "months_active", "observed_window_months", "months_since_last_spending",
        "inactive_gap_count", "max_inactive_gap", "total_inner_gap_months", "lifecycle_status_v2",
    )
    assert got == {
        "c1": (3, 3, 0, 0, 0, 0, "continuous_observed"),
        "c2": (3, 5, 0, 1, 2, 2, "reactivated_after_gap"),
        "c3": (3, 3, 9, 0, 0, 0, "extended_no_spending"),
        "c4": (3, 3, 2, 0, 0, 0, "recent_no_spending"),
        "c5": (1, 1, 0, 0, 0, 0, "short_observed_history"),
        "c6": (3, 3, 1, 0, 0, 0, "continuous_observed"),
    }
    assert by(table, "customer_id", "total_revenue")["c5"] == 20.0
    assert by(table, "customer_id", "first_active_month", "last_active_month")["c2"] == ("2024-08", "2024-12")


def test_lifecycle_drops_missing_ids(spark):
    rows = [(None, "2024-05", 1.0, 1.0), ("a", "2024-01", None, None)]
    table = lifecycle(spark.createDataFrame(rows, SPENDING)).collect()
    assert [(r["customer_id"], r["total_revenue"], r["avg_bill"], r["months_since_last_spending"]) for r in table] == [
        ("a", 0.0, None, 0)
    ]


COMPLAINTS = "customer_id string, billing_year_month string, problem_category string"


def test_bill_shock(spark):
    bills = spark.createDataFrame(
        [("a", f"2024-0{i}", b, 1.0) for i, b in enumerate((100.0, 130.0, 0.0, 50.0), 1)], SPENDING
    )
    complaints = spark.createDataFrame([("a", "2024-02", "billing"), ("a", "2024-02", "data")], COMPLAINTS)
    got = by(
        bill_shock(bills, complaints), "billing_year_month", "previous_bill_amount", "rolling_3m_avg_bill",
        "bill_change_abs", "bill_change_pct", "bill_shock_flag", "same_month_billing_complaint",
        "next_month_billing_complaint", "no_billable_activity_next_2m",
    )
    assert got["2024-01"] == (None, None, None, None, 0, 0, 1, 0)
    assert got["2024-02"] == (100, 100, 30, pytest.approx(0.3), 1, 1, 0, 0)
    assert got["2024-03"] == (130, 115, -130, -1, 0, 0, 0, 0)
    assert got["2024-04"] == (0, pytest.approx(76.666667), 50, None, 0, 0, 0, 1)


def test_split_customer_equals_whole_customer(spark):
    """A customer with most of the rows, several per month, and the same customer cut into chunks."""
    rows = [("hot", f"20{10 + i // 12 % 8}-{i % 12 + 1:02d}", float(i * 7 % 13), 1.0) for i in range(300)]
    rows += [("hot", "2016-05", 4.0, 1.0)] * 60 + [("b", f"2012-{i:02d}", float(i), 1.0) for i in range(1, 10, 3)]
    rows += [(None, "2012-01", 5.0, 1.0)] * 2 + [("hot", None, 2.0, 1.0)]
    bills = spark.createDataFrame(rows, SPENDING)
    complaints = spark.createDataFrame(
        [("hot", "2012-03", "billing"), ("hot", "2013-01", "data"), ("b", "2012-02", "billing")], COMPLAINTS
    )
    whole = bill_shock(bills, complaints)
    split = bill_shock(bills, complaints, hot_rows=10)
    finer = bill_shock(bills, complaints, hot_rows=3)
    names = sorted(whole.columns)

    def rows_of(df):
        return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)

    assert rows_of(split) == rows_of(whole) == rows_of(finer)
    assert whole.count() == len(rows)
    # Brute force over the ordered rows.
    ordered = sorted((m or "", b) for c, m, b, _ in rows if c == "hot")
    expected = sorted(
        ((m or None, b, ordered[i - 1][1] if i else None) for i, (m, b) in enumerate(ordered)), key=repr
    )
    got = split.where("customer_id = 'hot'").select("billing_year_month", "bill_amount", "previous_bill_amount").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected


def test_label_and_repeats(spark):
    months = ("2024-01", "2024-01", "2024-02", "2024-04")
    bills = spark.createDataFrame([("a", m, float(i), 1.0) for i, m in enumerate(months)], SPENDING)
    complaints = spark.createDataFrame([("a", m, "data") for m in months], COMPLAINTS)
    label = bill_shock(bills, complaints).orderBy("billing_year_month", "bill_amount")
    assert [r["no_billable_activity_next_2m"] for r in label.collect()] == [0, 0, 0, 1]
    flags = repeat_flags(complaints).orderBy("billing_year_month").collect()
    assert [r["repeat_complaint_next_1m"] for r in flags] == [1, 1, 0, 0]
    assert [r["repeat_complaint_next_2m"] for r in flags] == [1, 1, 1, 0]


def test_profile(spark):
    ages = spark.createDataFrame([(a,) for a in (0, 25, 26, 65, 66, 200, 201)], "a int")
    bands = [r["b"] for r in ages.select(age_band(F.col("a")).alias("b")).collect()]
    assert bands == [None, "<=25", "26-35", "56-65", "65+", "65+", None]
    customer = spark.createDataFrame([(str(i), "x", 1990) for i in range(1, 7)], "customer_id string, city string, birth_year int")
    cycle = spark.createDataFrame([(str(i), 10.0 * i) for i in range(1, 6)], "customer_id string, total_revenue double")
    profile, threshold = customer_profile(customer, cycle)
    assert threshold.first()["value"] == pytest.approx(42)
    assert by(profile, "customer_id", "high_value_customer") == {"1": 0, "2": 0, "3": 0, "4": 0, "5": 1, "6": 0}
    assert by(profile, "customer_id", "customer_segment")["6"] == "Standard value"
