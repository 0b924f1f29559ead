"""Prompts out, completions in: requests keyed by their content, so that equal prompts are asked once and a rerun asks
only for what is missing."""

from pyspark.sql import functions as F


def with_request_ids(rows):
    """Rows of replies.prompts with request_id, the hash of their messages."""
    return rows.withColumn("request_id", F.sha2(F.to_json("messages"), 256))


def usable(completions):
    """One row per request: an answer if there is any, else the last error by name. Rows without a request are left out."""
    failed = F.col("text").isNull()
    error = F.col("error") if "error" in completions.columns else F.lit(None).cast("string")
    kept = completions.where(F.col("request_id").isNotNull()).groupBy("request_id").agg(
        F.min("text").alias("text"), F.max(F.when(failed, error)).alias("error")
    )
    return kept.withColumn("error", F.when(F.col("text").isNull(), F.col("error")))


def missing_requests(prompts, completions):
    """(request_id, messages) that no completion answers yet, once each; failed ones are asked again.

    Equal prompts are merged inside the tasks first, so one prompt of very many rows is one row per task.
    """
    answered = usable(completions).where(F.col("text").isNotNull()).select("request_id")
    asked = prompts.groupBy("request_id").agg(F.first("messages").alias("messages"))
    return asked.join(answered, "request_id", "left_anti")


def with_completions(prompts, completions, key):
    """(key, text, error) of every prompt row that has a completion, for replies.citation_guard."""
    return prompts.select(key, "request_id").join(usable(completions), "request_id").select(key, "text", "error")
