"""Consecutive JSON objects in any layout, each file read by many tasks.

A task cannot know whether its part of a file starts inside a string or an object. So a first scan finds, for each part
and each of the three states it may start in, the state it ends in and how deep it goes; the parts' effects are composed
in file order, which tells every part's true start; a second scan cuts the objects where the depth returns to 0. Objects
that cross parts are put together from their pieces.
"""

import json
import re

import pyarrow as pa
from pyspark.sql import functions as F

from ..session import ship_package

OUT, IN, ESCAPED = range(3)
#: Parts are read as runs that end with a closing brace, so that a file without line breaks is divided as well.
END = "}"
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")

_BRACES = re.compile(r"[{}]")
_INSIDE = re.compile(r'(?:[^"\\]|\\.)*', re.DOTALL)
_EFFECT = pa.schema(
    [("file", pa.string()), ("size", pa.int64()), ("start", pa.int64()), ("bytes", pa.int64())]
    + [(f"{name}_{state}", pa.int64()) for state in range(3) for name in ("end", "depth", "low")]
)
_PIECE = pa.schema([("file", pa.string()), ("opened", pa.int64()), ("start", pa.int64()), ("text", pa.string())])


def walk(text, state, depth=0, low=0, cuts=None):
    """(state, depth, lowest depth) after `text`; `cuts` collects the places right after a brace that closes depth 1."""
    at, size = 0, len(text)
    if state == ESCAPED and size:
        at, state = 1, IN
    while at < size:
        if state == IN:
            at = _INSIDE.match(text, at).end()
            if at == size:
                return IN, depth, low
            if text[at] == "\\":
                return ESCAPED, depth, low
            at, state = at + 1, OUT
            continue
        quote = text.find('"', at)
        stop = size if quote < 0 else quote
        for brace in _BRACES.finditer(text, at, stop):
            if brace[0] == "{":
                depth += 1
            else:
                depth -= 1
                low = min(low, depth)
                if cuts is not None and depth == 0:
                    cuts.append(brace.end())
        at, state = stop + 1, state if quote < 0 else IN
    return state, depth, low


def _runs(batches):
    """(file, size, start, text) of each run in order, its closing brace restored."""
    for batch in batches:
        files, sizes, starts = (batch.column(n).to_pylist() for n in ("file", "size", "start"))
        values = batch.column("value")
        for i in range(batch.num_rows):
            yield files[i], sizes[i], starts[i], values[i].as_py() + END


def _with_ends(batches):
    """(file, start, text, whether the part ends with it) of each run."""
    held = None
    for file, _, start, text in _runs(batches):
        if held:
            yield *held, held[:2] != (file, start)
        held = (file, start, text)
    if held:
        yield *held, True


def _effects(batches):
    """One row per part: its effect on each start state."""
    part, done = None, []
    for file, size, start, text in _runs(batches):
        if part is None or part[:3] != [file, size, start]:
            if part:
                done.append(part)
            part = [file, size, start, 0, *[x for state in range(3) for x in (state, 0, 0)]]
        part[3] += len(text.encode())
        for state in range(3):
            part[4 + 3 * state : 7 + 3 * state] = walk(text, *part[4 + 3 * state : 7 + 3 * state])
    if part:
        done.append(part)
    if done:
        columns = zip(*done, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _EFFECT, strict=True)], schema=_EFFECT)


def compose(parts):
    """(file, start) -> (state, depth, opened, whether the file's last run lacks its brace), from rows of _EFFECT.

    `opened` is the start of the last part before this one that reaches depth 0: an object still open here began there.
    """
    starts, files = {}, {}
    for part in parts:
        files.setdefault(part["file"], []).append(part)
    for file, own in files.items():
        own.sort(key=lambda p: p["start"])
        bare = sum(p["bytes"] for p in own) > own[0]["size"]
        state = depth = 0
        opened = own[0]["start"]
        for part in own:
            starts[file, part["start"]] = (state, depth, opened, bare and part is own[-1])
            low = depth + part[f"low_{state}"]
            if depth == 0 or low <= 0:
                opened = part["start"]
            depth += part[f"depth_{state}"]
            state = part[f"end_{state}"]
        if file.lower().endswith(COMPRESSED):  # sizes don't tell whether a brace ends the file; depth does
            bare = depth < 0
            starts[file, own[-1]["start"]] = (*starts[file, own[-1]["start"]][:3], bare)
    return starts


def _cutter(shared):
    """Whole objects of a part, and pieces of those it shares with others; both as rows of _PIECE.

    `opened` is null for a whole object; else pieces of one file with the same `opened` make one object.
    """

    def cut(batches):
        known = shared.value
        part, out, rest, size = None, [], [], 0

        def rows():
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE, strict=True)], schema=_PIECE)

        for file, start, text, last in _with_ends(batches):
            if part != (file, start):
                part = (file, start)
                if part not in known:
                    raise RuntimeError("the files were divided anew between the scans; set spark.sql.files.minPartitionNum")
                state, depth, opened, bare = known[part]
                first = depth > 0 or state != OUT
                opened = opened if first else start
            if last and bare:
                text = text[:-1]
            cuts = []
            state, depth, _ = walk(text, state, depth, 0, cuts)
            if depth < 0:  # a stray brace; what it ends fails to parse
                depth, cuts = 0, [*cuts, len(text)]
            at = 0
            for to in cuts:
                rest.append(text[at:to])
                out.append((file, opened if first else None, start, "".join(rest)))
                size += len(out[-1][3])
                rest.clear()
                first, opened, at = False, start, to
            rest.append(text[at:])
            if last:
                out.append((file, opened, start, "".join(rest)))
                rest.clear()
            if size > 1 << 24:
                size = 0
                yield rows()
        if out:
            yield rows()

    return cut


def object_texts(spark, path):
    """One row (text) per top-level JSON object of the files under `path`, in any layout; other text between objects
    stays with its neighbour, so that parsing fails. Two scans of the files, one row per part on the driver."""
    ship_package(spark)
    runs = spark.read.option("lineSep", END).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"), "value",
    )
    kinds = {pa.string(): "string", pa.int64(): "long"}

    def ddl(schema):
        return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)

    starts = compose(runs.mapInArrow(_effects, ddl(_EFFECT)).collect())
    shared = spark.sparkContext.broadcast(starts)
    pieces = runs.mapInArrow(_cutter(shared), ddl(_PIECE))
    whole = pieces.where("opened is null").select("text")
    crossing = pieces.where("opened is not null").groupBy("file", "opened").agg(
        F.array_sort(F.collect_list(F.struct("start", "text"))).alias("parts")
    )
    joined = crossing.select(F.array_join("parts.text", "").alias("text"))
    return whole.unionByName(joined).where(~F.col("text").rlike(r"\A\s*\z"))


def parse_objects(texts, schema, fields):
    """Rows of `fields` (strings but for the last, taken as it is) of JSON texts; anything but one object raises."""

    def parse(batches):
        for batch in batches:
            records = [json.loads(text) for text in batch.column("text").to_pylist()]
            columns = [[str(r[fields[0]]) for r in records], *[[r[f] for r in records] for f in fields[1:]]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=list(fields))

    return texts.mapInArrow(parse, schema)
