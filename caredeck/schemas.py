"""Schemas of the four raw inputs and the columns each must carry."""

from pyspark.sql import types as T

CUSTOMER = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("birth_year", T.IntegerType()),
    ]
)
SPENDING = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("billing_year_month", T.StringType()),
        T.StructField("bill_amount", T.DoubleType()),
        T.StructField("data_usage", T.DoubleType()),
    ]
)
TURN = T.StructType(
    [
        T.StructField("history_id", T.IntegerType()),
        T.StructField("site", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
COMPLAINTS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("billing_year_month", T.StringType()),
        T.StructField("problem_category", T.StringType()),
        T.StructField("problem_subcategory", T.StringType()),
        T.StructField("chat_history", T.ArrayType(TURN)),
    ]
)
REFERENCE = T.StructType(
    [
        T.StructField("document_id", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)

RAW = {"customer": CUSTOMER, "spending": SPENDING, "complaints": COMPLAINTS, "reference": REFERENCE}


def validate_columns(df, table):
    """Raise ValueError naming the columns of raw table `table` that `df` lacks."""
    missing = [name for name in RAW[table].fieldNames() if name not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks required columns: {missing}")
    return df
