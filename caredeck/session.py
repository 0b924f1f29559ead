"""Session settings the jobs, tests and bench share."""

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(name, master=None, shuffle_partitions=None, **conf):
    """A session with adaptive execution and skew handling on.

    On a cluster leave `master` and `shuffle_partitions` unset and let spark-submit decide.
    """
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a hot join key even where that costs one more exchange later on.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped = set()


def ship_package(spark):
    """Send this package to the Python workers, for operators whose tasks run its code."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp()}/{package.name}", "zip", root_dir=package.parent, base_dir=package.name
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
