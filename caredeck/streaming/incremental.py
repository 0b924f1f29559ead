"""Complaint files as they arrive: the row-level stages run unchanged on a stream.

Replaces reading a growing export in chunks. Flattening and signals are stateless, so no
watermark or state is needed; the sink's checkpoint makes each file count once.
"""

from ..operators.conversations import flatten_complaints
from ..operators.signals import complaint_signals
from ..schemas import COMPLAINTS


def complaint_stream(spark, folder, files_per_batch=100):
    """Flattened complaints with signals from JSON-lines files appearing in `folder`."""
    raw = (
        spark.readStream.schema(COMPLAINTS)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )
    return complaint_signals(flatten_complaints(raw))


def append_signals(spark, folder, out, checkpoint, files_per_batch=100):
    """Append the files not yet seen to the Parquet table `out`; returns when all are in."""
    query = (
        complaint_stream(spark, folder, files_per_batch)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
