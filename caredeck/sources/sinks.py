"""Table sinks."""


def save_table(df, path):
    """Write Parquet for a .parquet path, nested JSON for .json, else CSV with a header."""
    writer = df.write.mode("overwrite")
    if path.endswith(".parquet"):
        writer.parquet(path)
    elif path.endswith(".json"):
        writer.json(path)
    else:
        writer.option("header", True).option("escape", '"').csv(path)
    return path
