"""The complaint feature table, from the four cleaned inputs to routing."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.months import month_index
from ..operators.billing import bill_shock
from ..operators.friction import friction
from ..operators.lifecycle import lifecycle
from ..operators.profile import customer_profile
from ..operators.repeats import repeat_months, with_repeat_default
from ..operators.risk import risk_priority
from ..operators.routing import routing
from ..operators.signals import complaint_signals
from ..storage import materialise

PROFILE_COLUMNS = (
    "customer_id", "lifecycle_status_v2", "total_revenue", "avg_bill", "avg_data_usage", "high_value_customer",
    "customer_segment", "months_active", "active_month_ratio", "months_since_last_spending", "inactive_gap_count",
    "reactivation_count",
)
BILL_FLAGS = (
    "bill_shock_flag", "same_month_billing_complaint", "next_month_billing_complaint", "no_billable_activity_next_2m",
)
BILL_COLUMNS = (
    "customer_id", "billing_year_month", "previous_bill_amount", "rolling_3m_avg_bill", "bill_change_abs",
    "bill_change_pct", *BILL_FLAGS,
)


@dataclass(frozen=True)
class FeatureTables:
    lifecycle: DataFrame
    profile: DataFrame
    threshold: DataFrame
    bills: DataFrame
    features: DataFrame


def month_context(complaints, profile, bills):
    """Profile, bill and repeat columns per customer-month that has complaints (narrow rows)."""
    return (
        repeat_months(complaints)
        .drop("month_index")
        .join(profile.select(*PROFILE_COLUMNS), "customer_id", "left")
        .join(bills.select(*BILL_COLUMNS), ["customer_id", "billing_year_month"], "left")
    )


def enrich(complaints, context):
    """Complaints with their customer-month's context.

    The narrow facts were joined among themselves before, so the wide complaint rows (with their
    texts) move at most once, and adaptive execution can split a hot customer there.
    """
    joined = complaints.join(context, ["customer_id", "billing_year_month"], "left")
    joined = joined.withColumn("month_index", month_index(F.col("billing_year_month")))
    return with_repeat_default(joined.fillna(0, list(BILL_FLAGS)))


def score(enriched, turns=None):
    """Friction, risk, priority and routing on enriched complaints with their signals; `turns` is friction's."""
    return routing(risk_priority(friction(enriched, turns)))


def build_features(customer, spending, complaints, reference_year=2026, nfkc=False):
    """All feature tables. Two narrow layers are written once because two steps read them:
    the lifecycle (threshold and profile) and the context (turn quantiles and features).
    """
    cycle = materialise(lifecycle(spending))
    profile, threshold = customer_profile(customer, cycle, reference_year)
    bills = bill_shock(spending, complaints)
    context = materialise(month_context(complaints, profile, bills))
    # Signals are read off the texts before the join, which then moves texts only for those who ask for them.
    enriched = enrich(complaint_signals(complaints, nfkc=nfkc), context)
    signals = [c for c in enriched.columns if c not in {*complaints.columns, *context.columns, "month_index"}]
    enriched = enriched.select(*[c for c in enriched.columns if c not in signals], *signals)
    return FeatureTables(cycle, profile, threshold, bills, score(enriched, complaints))
