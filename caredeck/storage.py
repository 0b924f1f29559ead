"""Intermediate tables written to the cluster's shared checkpoint folder."""

import tempfile
import uuid


def scratch_folder(spark):
    """The folder `spark.checkpoint.dir` names; a temporary one only for local sessions."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="caredeck-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


# What a written table was shuffled from goes as soon as it is written; else it stays until the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Written tables hold long texts, and lists of hashes that repeat within a file.
_WRITTEN = {"compression": "zstd", "parquet.dictionary.page.size": 8 << 20}


def materialise(df):
    """Write `df` once and read it back: fixes its rows and cuts its lineage.

    Used where two reads must see the same row placement (ranks), or where a result is read
    many times (training data, retrieval index).
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**_WRITTEN).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(df):
    """Delete a table that materialise() wrote, once nothing will read it again."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard_scratch(spark):
    """Delete the session's own scratch folder; for the end of a job."""
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
