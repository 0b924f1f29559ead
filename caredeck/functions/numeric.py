"""Small numeric helpers."""

from pyspark.sql import functions as F


def safe_divide(numerator, denominator, default=0.0):
    """numerator/denominator, or `default` where the denominator is null or zero."""
    return F.when(denominator.isNull() | (denominator == 0), F.lit(default)).otherwise(
        F.try_divide(numerator, denominator)
    )


def flag(condition):
    """1 where the condition holds, 0 where it is false or null."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def share(condition):
    """Share of a group's rows where the condition holds; 0 for an empty group."""
    return F.coalesce(F.avg(flag(condition).cast("double")), F.lit(0.0))


def total(condition):
    """Number of a group's rows where the condition holds."""
    return F.coalesce(F.sum(flag(condition).cast("long")), F.lit(0).cast("long"))
