import pytest

from caredeck.operators import risk, rollups
from caredeck.operators.conversations import flatten_complaints
from caredeck.operators.friction import friction
from caredeck.operators.ranking import quantiles
from caredeck.operators.routing import CLOSING_ACTION, LADDER, routing
from caredeck.operators.signals import complaint_signals, signal_distribution

from .helpers import by, complaint, frame


def test_flatten(spark):
    schema = "customer_id string, chat_history array<struct<history_id:int,site:string,text:string>>"
    turns = [(2, "agent", "b"), (1, "customer", "a"), (3, "system", "s"), (None, "Customer", "z")]
    rows = flatten_complaints(spark.createDataFrame([("x", turns), ("y", None)], schema))
    got = by(
        rows, "customer_id", "customer_text", "agent_text", "full_text", "turn_count", "customer_turn_count",
        "agent_turn_count", "first_customer_message", "last_customer_message",
    )
    assert got["x"] == ("z a", "b s", "z a b s", 4, 2, 2, "z", "a")
    assert got["y"] == ("", "", "", 0, 0, 0, "", "")


def test_signals(spark):
    rows = spark.createDataFrame(
        [
            (1, "billing", "fatura geldi", "modem", "fatura geldi modem"),
            (2, "data", "yavaş internet, bıktım", "fatura", "yavaş internet, bıktım fatura"),
            (3, "other", "dava ve iptal; fazla ücret", "", "dava ve iptal; fazla ücret"),
            (4, None, "hala devam ediyor", "tekrar eder misiniz", "hala devam ediyor tekrar eder misiniz"),
        ],
        "id int, problem_category string, customer_text string, agent_text string, full_text string",
    )
    got = by(
        complaint_signals(rows), "id", "has_legal_risk", "has_churn_risk", "has_billing_dispute",
        "has_technical_outage", "potential_agent_mismatch", "billing_signal_reason", "technical_signal_reason",
    )
    # The reason of a context hit is given even where the flag stays 0.
    assert got[1] == (0, 0, 1, 0, 1, "billing_keyword:fatura; category_guard", "technical_keyword:modem")
    assert got[2] == (0, 0, 0, 1, 1, "billing_keyword:fatura", "technical_keyword:yavas internet; category_guard")
    assert got[3] == (1, 1, 1, 0, 0, "billing_keyword:fazla ucret", "")
    assert got[4] == (0, 0, 0, 0, 0, "", "")
    counts = by(
        complaint_signals(rows), "id", "unresolved_problem_count_v3", "customer_frustration_count_v3",
        "agent_clarification_count_v3", "high_frustration_flag",
    )
    assert counts == {1: (0, 0, 0, 0), 2: (0, 1, 0, 1), 3: (0, 0, 0, 0), 4: (1, 0, 1, 0)}
    shares = by(signal_distribution(complaint_signals(rows)), "signal", "row_count", "rate")
    assert shares["potential_agent_mismatch"] == (2, 0.5)


def test_friction(spark):
    # Twenty short conversations, then one long and one very long one, so the limits are known.
    cases = {
        "high": complaint(turn_count=1, customer_repetition_count_v3=1, customer_frustration_count_v3=2),
        "frustrated": complaint(turn_count=1, customer_frustration_count_v3=1),
        "unclear": complaint(turn_count=1, agent_clarification_count_v3=1),
        "long": complaint(turn_count=8),
        "verylong": complaint(turn_count=9),
    }
    rows = [row | {"name": name} for name, row in cases.items()]
    rows += [complaint(turn_count=1) | {"name": f"plain{i}"} for i in range(26)]
    rows += [complaint(turn_count=8) | {"name": f"long{i}"} for i in range(2)]
    got = by(friction(frame(spark, rows)), "name", "friction_score_v3", "friction_level_v3")
    assert got["high"] == (5, "high")
    assert got["frustrated"] == (3, "medium")
    assert got["unclear"] == (2, "medium")
    assert got["plain1"] == (0, "low")
    assert got["verylong"] == (3, "medium")


def test_turn_quantiles(spark):
    rows = spark.createDataFrame([(v,) for v in (2, 3, 4, 5, 20, None)], "t int")
    assert [r["value"] for r in quantiles(rows, {"t": [0.9, 0.95]}).sort("p").collect()] == pytest.approx([14, 17])


def test_risk(spark):
    cases = {
        "legal": complaint(has_legal_risk=1),
        "churn": complaint(has_churn_risk=1),
        "many": complaint(
            has_churn_risk=1, high_frustration_flag=1, friction_level_v3="high", repeat_complaint_next_2m=1,
            has_billing_dispute=1,
        ),
        "shock": complaint(has_billing_dispute=1, bill_shock_flag=1),
        "technical": complaint(has_technical_outage=1),
        "no profile": complaint(high_value_customer=None, has_billing_dispute=1),
    }
    table = risk.risk_priority(frame(spark, [row | {"name": name} for name, row in cases.items()]))
    got = by(table, "name", "business_risk_score", "business_risk_level", "priority_level", "risk_score_band")
    assert got == {
        "legal": (40, "medium", "P0 Critical", "40-59"),
        "churn": (30, "medium", "P1 High", "20-39"),
        "many": (95, "high", "P0 Critical", "80+"),
        "shock": (25, "medium", "P2 Medium", "20-39"),
        "technical": (10, "low", "P3 Low", "0-19"),
        "no profile": (15, "low", "P3 Low", "0-19"),
    }
    assert by(routing(table), "name", "recommended_queue")["no profile"] == "Billing Review"
    summary = by(risk.component_summary(table), "component", "total_points", "active_rows")
    assert summary["risk_component_billing"] == (45, 3)


def test_routing_ladder(spark):
    rungs = [
        complaint(has_legal_risk=1, has_billing_dispute=1),
        complaint(has_technical_outage=1, has_churn_risk=1),
        complaint(has_billing_dispute=1, high_value_customer=1),
        complaint(has_churn_risk=1, high_value_customer=1),
        complaint(has_billing_dispute=1),
        complaint(has_technical_outage=1),
        complaint(friction_level_v3="high"),
        complaint(potential_agent_mismatch=1),
        complaint(has_churn_risk=1),
    ]
    got = by(
        routing(frame(spark, [row | {"i": i} for i, row in enumerate(rungs)])), "i", "recommended_queue",
        "recommended_business_action",
    )
    for i, rule in enumerate(LADDER):
        assert got[i] == (rule.queue, "; ".join((*rule.actions, CLOSING_ACTION)))


def test_high_value_tables(spark):
    rows = [
        complaint(customer_id=1, high_value_customer=1, business_risk_level="high", priority_level="P1 High", total_revenue=5.0),
        complaint(customer_id=1, high_value_customer=1, business_risk_level="high", priority_level="P1 High", total_revenue=5.0),
        complaint(customer_id=2, high_value_customer=1, business_risk_level="low", priority_level="P3 Low", total_revenue=7.0),
        complaint(customer_id=3, high_value_customer=None, business_risk_level="high", priority_level="P1 High"),
    ]
    table = frame(spark, rows)
    assert tuple(risk.high_value_at_risk_summary(table).first()) == (1, 10.0, 5.0)
    assert by(risk.high_value_revenue_by_priority(table), "priority_level", "customer_count", "historical_revenue") == {
        "P1 High": (1, 10.0), "P3 Low": (1, 7.0),
    }


def test_crosstab_and_counts(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), (None, "x"), ("b", None)], "r string, c string")
    assert by(rollups.crosstab(rows, "r", "c", ("x", "y", "z")), "r", "x", "y", "z") == {"a": (2, 1, 0)}
    shares = by(rollups.crosstab(rows, "r", "c", ("x", "y", "z"), True), "r", "x", "y", "z")
    assert shares["a"] == pytest.approx((2 / 3, 1 / 3, 0))
    assert [tuple(r) for r in rollups.value_counts(rows, "r", "n").collect()] == [("a", 3), ("b", 1)]
