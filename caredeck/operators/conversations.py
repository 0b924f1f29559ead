"""Conversation flattening: who said what, in order."""

from pyspark.sql import functions as F

# Speakers counted as the customer; everyone else counts as the agent side.
CUSTOMER_SITES = ("customer", "musteri", "user")


def turns_to_history(turns, key, turn, site, text):
    """One row per conversation from one row per turn; the array is what flatten_complaints reads.

    A conversation's texts meet in one row because the flattened record is that row.
    """
    history = F.collect_list(
        F.struct(F.col(turn).cast("int").alias("history_id"), F.col(site).alias("site"), F.col(text).alias("text"))
    )
    return turns.groupBy(F.col(key).alias("customer_id")).agg(history.alias("chat_history"))


def flatten_complaints(complaints):
    """Replace chat_history by turn counts, texts per side and the customer's first and last message."""
    history = F.coalesce(F.col("chat_history"), F.array().cast(complaints.schema["chat_history"].dataType))
    ordered = F.array_sort(history, _by_turn)
    said = complaints.withColumn("_turns", ordered)
    said = said.withColumns(
        {
            "_customer": F.filter("_turns", _is_customer),
            "_agent": F.filter("_turns", lambda turn: ~_is_customer(turn)),
        }
    )
    said = said.withColumns({name: _texts(name) for name in ("_turns", "_customer", "_agent")})
    return said.withColumns(
        {
            "turn_count": F.size("_turns"),
            "customer_turn_count": F.size("_customer"),
            "agent_turn_count": F.size("_agent"),
            "customer_text": F.array_join("_customer", " "),
            "agent_text": F.array_join("_agent", " "),
            "full_text": F.array_join("_turns", " "),
            "first_customer_message": F.coalesce(F.try_element_at("_customer", F.lit(1)), F.lit("")),
            "last_customer_message": F.coalesce(F.try_element_at("_customer", F.lit(-1)), F.lit("")),
        }
    ).drop("chat_history", "_turns", "_customer", "_agent")


def _by_turn(left, right):
    a, b = F.coalesce(left["history_id"], F.lit(0)), F.coalesce(right["history_id"], F.lit(0))
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


def _is_customer(turn):
    return F.lower(F.coalesce(turn["site"], F.lit(""))).isin(*CUSTOMER_SITES)


def _texts(turns):
    return F.transform(turns, lambda turn: F.coalesce(turn["text"], F.lit("")))
