"""Conversation friction score and level."""

from pyspark.sql import functions as F

from ..functions.numeric import flag, share, total
from .ranking import quantiles

FRICTION_LEVELS = ("high", "low", "medium")


def friction(complaints, turns=None):
    """Complaints with long-conversation flags, friction score (0..15) and level.

    `turns` is a cheaper table of the same turn counts to take the limits from, where there is one.
    """
    counts = (complaints if turns is None else turns).select("turn_count")
    found = {row["p"]: row["value"] for row in quantiles(counts, {"turn_count": [0.90, 0.95]}).collect()}
    limits = [F.lit(found.get(p)).cast("double") for p in (0.90, 0.95)]
    repeated = F.col("customer_repetition_count_v3") > 0
    unresolved = F.col("unresolved_problem_count_v3") > 0
    frustrated = F.col("customer_frustration_count_v3") > 0
    unclear = F.col("agent_clarification_count_v3") > 0
    mismatch = F.col("potential_agent_mismatch") == 1
    scored = complaints.withColumns(
        {
            "long_conversation_flag_v3": flag(F.col("turn_count") >= limits[0]),
            "very_long_conversation_flag_v3": flag(F.col("turn_count") >= limits[1]),
        }
    ).withColumn(
        "friction_score_v3",
        2 * flag(repeated)
        + 2 * flag(unresolved)
        + 3 * flag(frustrated)
        + 2 * flag(unclear)
        + 3 * flag(mismatch)
        + F.col("long_conversation_flag_v3")
        + 2 * F.col("very_long_conversation_flag_v3"),
    )
    severe = frustrated & (repeated | unresolved | mismatch)
    level = (
        F.when((F.col("friction_score_v3") >= 5) | severe, "high")
        .when(F.col("friction_score_v3") <= 1, "low")
        .otherwise("medium")
    )
    return scored.withColumn("friction_level_v3", level)


def mismatch_summary(complaints):
    mismatch = F.col("potential_agent_mismatch") == 1
    return complaints.agg(
        total(mismatch).alias("potential_agent_mismatch_rows"),
        share(mismatch).alias("potential_agent_mismatch_rate"),
    )
