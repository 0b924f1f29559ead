"""Raw JSON scans and the processed Parquet layer."""

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conversations import flatten_complaints
from ..schemas import RAW, REFERENCE, validate_columns
from .json_objects import COMPRESSED, object_texts, parse_objects
from .publish import publish, published

# Names of the processed layer's tables.
PROCESSED = {
    "customer": "customer_clean.parquet",
    "spending": "spending_clean.parquet",
    "complaints": "complaints_flat.parquet",
    "reference": "reference_clean.parquet",
}


def read_json_lines(spark, path, table):
    """JSON lines, plain or .gz, under the table's schema; blank lines are skipped, bad ones raise.

    A scan with a schema cannot tell an absent column from nulls, so a column the first record
    lacks is looked for in the rest of the file before it counts as missing.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    first = lines.limit(1).collect()
    present = set(json.loads(first[0]["value"])) if first else set()
    missing = [
        name
        for name in RAW[table].fieldNames()
        if name not in present and lines.where(F.array_contains(F.json_object_keys("value"), name)).isEmpty()
    ]
    if missing:
        raise ValueError(f"{table} lacks required columns: {missing}")
    return _spread(spark.read.schema(RAW[table]).option("mode", "FAILFAST").json(path))


def _spread(rows):
    """Rows of compressed files, each of which only one task can read, dealt to as many tasks as the session shuffles to."""
    files = rows.inputFiles()
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks) if len(files) < tasks and any(f.endswith(COMPRESSED) for f in files) else rows


def read_reference(spark, path, pretty=False):
    """Consecutive JSON objects of a knowledge base.

    Objects may follow each other in any layout, and a file is read by many tasks (a compressed one by one task).
    `pretty` scans once instead of twice, but expects each object to close with a brace at the start of a line; a piece
    that holds anything but one whole object fails the read.
    """
    if pretty:
        return _read_pretty(spark, path)
    return parse_objects(object_texts(spark, path), REFERENCE, ("document_id", "content"))


def _read_pretty(spark, path):
    pieces = spark.read.option("lineSep", "\n}").text(path).where(F.trim(F.translate("value", "\n\r\t", "")) != "")
    # An array of the piece parses only if the piece is one object; two objects lack the comma between them.
    parsed = pieces.select(
        F.from_json(F.concat(F.lit("["), "value", F.lit("\n}]")), T.ArrayType(REFERENCE), {"mode": "FAILFAST"}).alias("records")
    )
    return parsed.select(F.inline_outer("records"))


@dataclass(frozen=True)
class CareTables:
    customer: DataFrame
    spending: DataFrame
    complaints: DataFrame
    reference: DataFrame


def load_or_build(spark, raw, processed, rebuild=False, pretty=False):
    """The processed tables: the newest published set, else built from `raw` and published as one.

    `raw` maps customer, spending, complaints and reference to paths; `pretty` is read_reference's.
    """
    paths = None if rebuild else published(spark, processed)
    if paths is None:
        built = {name: read_json_lines(spark, raw[name], name) for name in ("customer", "spending", "complaints")}
        built["complaints"] = flatten_complaints(validate_columns(built["complaints"], "complaints"))
        built["reference"] = validate_columns(read_reference(spark, raw["reference"], pretty), "reference")
        paths = publish(spark, processed, built, PROCESSED)
    return CareTables(**{name: spark.read.parquet(paths[name]) for name in PROCESSED})


def load_processed(spark, processed, hint):
    """The newest published set; raises FileNotFoundError with `hint` if there is none."""
    paths = published(spark, processed)
    if paths is None:
        raise FileNotFoundError(f"{processed} holds no published tables: {hint}")
    return CareTables(**{name: spark.read.parquet(paths[name]) for name in PROCESSED})


def read_table(spark, path, hint):
    """A table an earlier job wrote; raises FileNotFoundError with `hint` if it is not there."""
    if not exists(spark, path):
        raise FileNotFoundError(f"{path} not found: {hint}")
    return spark.read.parquet(path)


def exists(spark, path):
    """Whether a path exists on its Hadoop file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
