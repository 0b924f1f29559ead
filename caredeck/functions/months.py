"""Billing-month keys as integers."""

from pyspark.sql import functions as F


def month_index(label, strict=False):
    """year*12 + month of a label such as '2024-03' or 202403.

    `strict` raises on a month outside 1..12 instead of computing on.
    """
    text = label.cast("string")
    year, month = F.substring(text, 1, 4).cast("int"), F.substring(text, -2, 2).cast("int")
    index = year * 12 + month
    if not strict:
        return index
    return F.when(month.between(1, 12) | text.isNull(), index).otherwise(
        F.raise_error(F.concat(F.lit("bad billing month: "), text))
    )
