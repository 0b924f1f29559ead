"""Customer-month rows as they arrive, scored by a saved model, each batch once.

Scoring a row needs no other row, but its percentile is a rank within its batch, so batches are scored one by one. A
batch writes its own folder, batch=<id>, and replaces it when it is run again after a failure: every row is scored once.
"""

from ..operators.models import load_model, predict


def score_arrivals(spark, folder, schema, model_path, out, checkpoint, files_per_batch=100):
    """Score the Parquet files not yet seen in `folder` into the table `out`; returns when all are in."""
    model = load_model(model_path)

    def write(rows, batch):
        predict(model, rows).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
