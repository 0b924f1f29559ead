"""Queue and action rules, first match wins."""

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    when: str
    queue: str
    actions: tuple


# The rule ladder. Conditions are SQL over the flags of _flags().
LADDER = (
    Rule(
        "legal",
        "Legal / Escalation / Senior Support",
        ("senior escalation", "legal risk review", "documented callback plan"),
    ),
    Rule(
        "technical and churn",
        "Technical Support + Retention",
        ("technical outage diagnosis", "retention callback after technical update"),
    ),
    Rule(
        "billing and (churn or valued)",
        "Billing Review + Retention",
        ("billing review", "retention-safe explanation", "proactive callback"),
    ),
    Rule(
        "churn and valued",
        "Retention + Senior Support",
        ("retention callback", "high-value customer protection review"),
    ),
    Rule("billing", "Billing Review", ("billing review", "explain relevant bill/plan items")),
    Rule("technical", "Technical Support", ("technical ticket", "service quality follow-up")),
    Rule(
        "tense",
        "Senior Agent / No-repeat Handoff",
        ("conversation summary", "senior agent no-repeat handoff"),
    ),
    Rule(
        "mismatch",
        "KB-grounded Response Review",
        ("KB-grounded response review", "confirm customer intent before next action"),
    ),
    Rule(
        "true",
        "Standard Support + RAG",
        ("source-grounded standard support", "self-service guidance if source confidence is high"),
    ),
)
CLOSING_ACTION = "cite KB document_id or use expert fallback"


def _flags():
    def on(name):
        return F.coalesce(F.col(name), F.lit(0)) != 0

    return {
        "legal": on("has_legal_risk"),
        "churn": on("has_churn_risk"),
        "billing": on("has_billing_dispute"),
        "technical": on("has_technical_outage"),
        "valued": on("high_value_customer"),
        "mismatch": on("potential_agent_mismatch"),
        "tense": F.coalesce(F.col("friction_level_v3") == "high", F.lit(False)),
    }


def routing(complaints):
    """Complaints with recommended_queue and recommended_business_action."""
    flags = _flags()
    judged = complaints.withColumn("_is", F.struct(*[test.alias(name) for name, test in flags.items()]))
    name = re.compile(rf"\b({'|'.join(flags)})\b")

    def holds(rule):
        return F.expr(name.sub(r"_is.\1", rule.when))

    def pick(value):
        return reduce(lambda chain, rule: chain.when(holds(rule), value(rule)), LADDER, F)

    def todo(rule):
        return F.lit("; ".join(dict.fromkeys((*rule.actions, CLOSING_ACTION))))

    return judged.withColumns(
        {
            "recommended_queue": pick(lambda rule: F.lit(rule.queue)),
            "recommended_business_action": pick(todo),
        }
    ).drop("_is")
