"""Secret scan: base patterns, and long tokens judged by how many repositories and owners hold the same value."""

import re

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .common import materialise, ship_package

#: Kinds in the order their spans are listed; `token` is the kind this method adds.
KINDS = ("assign", "access", "hex", "token")

# The base patterns.
ASSIGN = re.compile(
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Every access and hex match of full length lies in such a run; the runs are also what `token` is picked from.
LONG_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: A value held by so many owners or more is a copied example; a value of one owner may be a live credential.
COPIED_OWNERS = 3
#: Distinct characters of a value that looks drawn at random.
LIVE_DISTINCT = 8
TOKEN_DISTINCT = 12
#: A value with more than this share of all occurrences is joined by broadcast; at most 1 / HOT_SHARE values have it.
HOT_SHARE = 0.001

FOUND = pa.schema(
    [
        ("row", pa.int64()), ("doc_id", pa.int64()), ("repository", pa.string()), ("owner", pa.string()),
        ("found", pa.list_(pa.struct([
            ("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("live", pa.bool_()), ("value", pa.binary()),
        ]))),
    ]
)


def _looks_live(value):
    """Letters and digits mixed, and too many different characters for a placeholder."""
    return len(set(value)) >= LIVE_DISTINCT and any("0" <= c <= "9" for c in value) and any(c.isalpha() for c in value)


def _looks_like_token(value):
    """A run of upper case, lower case and digits with the variety of an encoded random key."""
    return (
        len(set(value)) >= TOKEN_DISTINCT
        and any("0" <= c <= "9" for c in value)
        and any("a" <= c <= "z" for c in value)
        and any("A" <= c <= "Z" for c in value)
    )


def candidates(text):
    """(start, kind, end, value) of every base match and of every token that no base match touches."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if len(m[1]) >= ASSIGN_LEAST:
                found.append((m.start(), 0, m.end(), m[1]))
    runs = [(m.start(), m[0]) for m in LONG_RUN.finditer(text)]
    for kind, pattern, least in ((1, ACCESS, ACCESS_LEAST), (2, HEX, HEX_LEAST)):
        for at, run in runs:
            found += [(at + m.start(), kind, at + m.end(), m[0]) for m in pattern.finditer(run) if len(m[0]) >= least]
    found.sort()
    if runs:
        taken = [(start, end) for start, _, end, _ in found]
        i = reach = 0
        for at, run in runs:
            while i < len(taken) and taken[i][0] < at + len(run):
                reach = max(reach, taken[i][1])
                i += 1
            if reach <= at and _looks_like_token(run):
                found.append((at, 3, at + len(run), run))
        found.sort()
    return found


def _scan_batches(batches):
    for batch in batches:
        texts = batch.column("text")
        found = []
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            found.append(
                [
                    {"start": start, "kind": kind, "end": end, "live": _looks_live(value), "value": xxhash.xxh3_128_digest(value)}
                    for start, kind, end, value in candidates(text)
                ]
                if text
                else []
            )
        columns = [batch.column(n) for n in ("row", "doc_id", "repository", "owner")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(found, FOUND.field("found").type)], schema=FOUND)


def ownership(found):
    """Per value: distinct owners and repositories, and occurrences. Counted in three steps, each of which sums up
    inside the tasks first, so a value that a third of the documents hold is one row per task and repository."""
    held = found.select("repository", "owner", F.explode("found.value").alias("value"))
    per_repository = held.groupBy("value", "owner", "repository").agg(F.count("*").alias("n"))
    per_owner = per_repository.groupBy("value", "owner").agg(F.count("*").alias("r"), F.sum("n").alias("n"))
    return per_owner.groupBy("value").agg(
        F.count("*").alias("n_owners"), F.sum("r").alias("n_repositories"), F.sum("n").alias("n_occurrences")
    )


def _with_ownership(occurrences, values):
    """Occurrences with their value's counts. The few frequent values, whose number is bounded by HOT_SHARE, are
    broadcast; no other value holds more than that share of the rows, so no task of the shuffled join is hot."""
    total = values.agg(F.sum("n_occurrences")).scalar()
    frequent = F.broadcast(values.where(F.col("n_occurrences") > total * F.lit(HOT_SHARE)))
    rare = values.where(F.col("n_occurrences") <= total * F.lit(HOT_SHARE))
    return occurrences.join(frequent, "value").unionByName(occurrences.join(frequent, "value", "left_anti").join(rare, "value"))


def find_secrets(docs, key="doc_id", text="text", repository="source", owner=None):
    """One row per document: its spans with the verdict on each value.

    Columns: the key, `repository`, `owner` and `spans`, an array of (start, kind, end, value_owners, value_repositories,
    verdict) ordered by start and kind, positions in code points. `owner` is a column expression; by default the part of
    the repository's name before its first slash. Values are compared by 128-bit hashes, so no secret leaves the scan.
    Base matches (`assign`, `access`, `hex`) are always listed. A `token` is added where a long run of mixed characters
    looks drawn at random and belongs to one owner alone. Verdicts: `example` for values of COPIED_OWNERS owners or more,
    `live` for live-looking values of one owner, `unclear` for the rest.

    Whole texts are scanned, one at a time. Null and empty texts have no spans. A null repository or owner is one unnamed
    repository or owner. Repeated rows and null keys stay rows of their own; other columns are not read. An empty table
    gives no rows.
    """
    ship_package(docs.sparkSession)
    home = F.col(f"`{repository}`").cast("string")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("long").alias("doc_id"), home.alias("repository"),
        (F.split_part(home, F.lit("/"), F.lit(1)) if owner is None else owner.cast("string")).alias("owner"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    schema = (
        "row long, doc_id long, repository string, owner string, "
        "found array<struct<start:long, kind:int, end:long, live:boolean, value:binary>>"
    )
    found = materialise(rows.mapInArrow(_scan_batches, schema))
    holders = found.where(F.size("found") > 0)
    values = materialise(ownership(holders))
    judged = _with_ownership(holders.select("row", F.inline("found")), values)
    single = F.col("n_owners") == 1
    verdict = F.when(F.col("n_owners") >= COPIED_OWNERS, "example").when(single & F.col("live"), "live").otherwise("unclear")
    judged = judged.where((F.col("kind") < 3) | single).withColumn("verdict", verdict)
    span = F.struct(
        "start", "kind", "end", F.col("n_owners").alias("value_owners"), F.col("n_repositories").alias("value_repositories"), "verdict"
    )
    spans = judged.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    nothing = F.array().cast(spans.schema["spans"].dataType)
    return found.join(spans, "row", "left").select(
        F.col("doc_id").alias(key), "repository", "owner", F.coalesce("spans", nothing).alias("spans")
    )


def listed(spans):
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")
