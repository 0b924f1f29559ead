"""MinHash near-duplicates: HyperMinHash registers, banded; corrected estimates; exact confirmation."""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import RollingHash, WordHashes, materialise, mix, ship_package, small_batches, texts
from .components import components

WORDS = 5
REGISTERS = 128
MANTISSA_BITS = 10
PER_BAND = 4
PERCENT = 75
#: At the threshold an estimate's standard error is 0.038 with 128 registers; pairs nearly five of them below are dropped.
ESTIMATE_SLACK = 0.18
#: Buckets of up to this many open members are compared by a join, larger ones in tiles of about so many shingles.
SMALL = 32
TILE_SHINGLES = 4_000_000
#: Up to this many keys (a counted 32 MB: id, two hashes, class) pick their rows by a broadcast; beyond it all rows are shuffled.
BROADCAST_IDS = 1_000_000

SKETCH_SCHEMA = "doc_id long, t1 long, t2 long, n_shingles long, f1 long, f2 long, bands array<long>"


def _words(text):
    """Words as bytes, A-Z lowered; every byte of \\x20 and \\x09-\\x0D parts them."""
    return text.lower().split()


def shingle_hashes(words, cache, rolling, size=WORDS):
    """Sorted distinct 64-bit hashes of the word shingles; fewer words than `size` make one shingle."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    sums = rolling.prefix(cache.of(words))
    start = np.arange(max(1, n - size + 1))
    return np.unique(rolling.runs(sums, start, np.minimum(start + size, n)))


def registers(shingles):
    """HyperMinHash of sorted distinct hashes: per bucket, leading zeros of the smallest and the bits that follow.

    A register is (leading zeros + 1) << 10 | mantissa in 16 bits; 0 marks an empty bucket.
    """
    out = np.zeros(REGISTERS, np.uint16)
    scrambled = np.sort(mix(shingles))
    bucket = (scrambled >> np.uint64(64 - 7)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, np.int64)
    value = scrambled[first] << np.uint64(7)
    length = np.frexp((value >> np.uint64(11)).astype(np.float64))[1]
    zeros = np.minimum(53 - length, 53).astype(np.uint64)
    mantissa = (value << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA_BITS)
    out[bucket[first]] = (((zeros + np.uint64(1)) << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16)
    return out


def estimate(left, right, n_left, n_right):
    """Jaccard estimates for rows of registers, without the matches expected from chance collisions.

    Minima of independent buckets of n and m values fall into one register with a chance of about
    0.7213 * n * m / (n + m)^2 / 2^mantissa bits (mean register width over the density of both minima).
    """
    used = (left > 0) | (right > 0)
    same = ((left == right) & used).sum(axis=1)
    chance = 0.7213 * n_left * n_right / np.maximum(n_left + n_right, 1) ** 2 / 2**MANTISSA_BITS
    return (same / np.maximum(used.sum(axis=1), 1) - chance) / (1 - chance)


def _sketch_batches(batches):
    cache, rolling = WordHashes(), RollingHash()
    for batch in batches:
        counts, prints, bands = [], [], []
        for text in batch.column("text").to_pylist():
            words = _words(text) if text else []
            shingles = shingle_hashes(words, cache, rolling)
            counts.append(len(shingles))
            prints.append(np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), np.int64))
            bands.append(registers(shingles).view(np.int64))
        width = REGISTERS // PER_BAND
        offsets = pa.array(np.arange(0, len(counts) * width + 1, width, dtype=np.int32))
        prints = np.array(prints, np.int64).reshape(-1, 2)
        flat = np.concatenate(bands) if bands else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("doc_id", "t1", "t2")), pa.array(counts, pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1]),
                pa.ListArray.from_arrays(offsets, pa.array(flat)),
            ],
            names=["doc_id", "t1", "t2", "n_shingles", "f1", "f2", "bands"],
        )


def _text_keys(text):
    """Two 64-bit hashes that tell texts of one doc_id apart; null counts as a text of its own."""
    return F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")


def sketches(docs):
    """Per row of `docs`: number of distinct shingles, fingerprint of the word sequence, registers as 64-bit bands."""
    return texts(docs).select("*", *_text_keys(F.col("text"))).mapInArrow(_sketch_batches, SKETCH_SCHEMA)


@F.pandas_udf(T.DoubleType())
def _estimated(left: pd.Series, right: pd.Series, n_left: pd.Series, n_right: pd.Series) -> pd.Series:
    if not len(left):
        return pd.Series([], dtype="float64")
    a, b = (np.ascontiguousarray(np.stack(x.to_numpy()), np.int64).view(np.uint16) for x in (left, right))
    return pd.Series(estimate(a, b, n_left.to_numpy(np.float64), n_right.to_numpy(np.float64)))


def _confirm_batches(batches):
    """The pairs whose full shingle sets reach the threshold, in whole numbers."""
    cache, rolling = WordHashes(), RollingHash()
    for batch in batches:
        keep, known, known_id = [], None, None
        rows = zip(*(batch.column(c).to_pylist() for c in ("a", "text_a", "text_b")), strict=True)
        for a, text_a, text_b in rows:
            if a != known_id:
                known, known_id = shingle_hashes(_words(text_a), cache, rolling), a
            keep.append(_linked(known, shingle_hashes(_words(text_b), cache, rolling)))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _likely(pairs, reps):
    """The pairs (a, b) whose registers make the threshold possible."""
    side = lambda x: reps.select(F.col("node").alias(x), F.col("bands").alias(f"s_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .filter(_estimated("s_a", "s_b", "n_a", "n_b") >= PERCENT / 100 - ESTIMATE_SLACK)
        .select("a", "b").distinct()
    )


def _few(keys):
    """Counted keys, to be broadcast if there are few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys


def _single_texts(nodes, classes, docs):
    """(node, text) of the classes `nodes`; texts of other classes are not moved."""
    wanted = materialise(nodes.join(classes.select("node", "doc_id", "t1", "t2", "copies"), "node"))
    keyed = texts(docs).filter("doc_id is not null and text is not null").select("*", *_text_keys(F.col("text")))
    full = materialise(keyed.join(_few(wanted), ["doc_id", "t1", "t2"]).select("node", "copies", "text"))
    # A row that occurs again would give its text again.
    return full.filter("copies = 1").union(full.filter("copies > 1").dropDuplicates(["node"]))


def _confirmed(likely, classes, docs):
    """The pairs whose texts reach the threshold; only texts that stand for a class in a pair are joined to them."""
    likely = materialise(likely)
    nodes = likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))).distinct()
    full = _single_texts(nodes, classes, docs)
    with_texts = (
        likely.join(full.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(full.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    )
    return materialise(with_texts.mapInArrow(_confirm_batches, "a long, b long"))


def _set_batches(batches):
    """(node, shingles): sorted distinct hashes of each text's shingles."""
    cache, rolling = WordHashes(), RollingHash()
    for batch in batches:
        sets = [shingle_hashes(_words(t), cache, rolling) for t in batch.column("text").to_pylist()]
        offsets = pa.array(np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32))
        values = pa.array(np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.ListArray.from_arrays(offsets, values)], names=["node", "shingles"])


class _Forest:
    """Components that links have joined so far."""

    def __init__(self, labels):
        self.root = {label: label for label in labels}

    def find(self, x):
        while self.root[x] != x:
            self.root[x] = x = self.root[self.root[x]]
        return x

    def join(self, a, b):
        self.root[self.find(a)] = self.find(b)


def _linked(left, right):
    """Whether two shingle sets reach the threshold, in whole numbers."""
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= PERCENT * (len(left) + len(right) - both)


def _tile(group):
    """Links between the components in two tiles of a bucket: one per pair of components that it joins, so no more rows
    than members, however many pairs reach the threshold.

    Only sizes that allow it meet (the smaller set has three quarters of the larger at least), and a pair is judged
    in the first band that puts it into one bucket. Registers rule pairs out; of the others, the likeliest first, those
    whose components are not joined yet are compared by their whole shingle sets.
    """
    group = group.sort_values("n_shingles", kind="stable")
    bands = np.ascontiguousarray(np.stack(group["bands"].to_numpy()), np.int64)
    sketch = bands.view(np.uint16)
    used = (sketch > 0).astype(np.float32)
    ids, size, component = (group[c].to_numpy(np.int64) for c in ("node", "n_shingles", "component"))
    sets = [np.asarray(s, np.int64).view(np.uint64) for s in group["shingles"]]
    band, i, j = (int(group[c].iloc[0]) for c in ("band", "i", "j"))
    first, second = (np.flatnonzero(group["tile"].to_numpy() == t) for t in (i, j))
    forest, out = _Forest(component.tolist()), []
    for at in range(0, len(first), 64):
        x = first[at : at + 64]
        y = second[(100 * size[second] >= PERCENT * size[x[0]]) & (PERCENT * size[second] <= 100 * size[x[-1]])]
        if i == j:
            y = y[y > x[0]]
        if not len(y):
            continue
        same = ((sketch[x][:, None, :] == sketch[y][None, :, :]) & (sketch[x][:, None, :] > 0)).sum(axis=2)
        filled = used[x].sum(1)[:, None] + used[y].sum(1)[None, :] - used[x] @ used[y].T
        n, m = size[x][:, None].astype(float), size[y][None, :].astype(float)
        chance = 0.7213 * n * m / (n + m) ** 2 / 2**MANTISSA_BITS
        likeness = (same / filled - chance) / (1 - chance)
        near = likeness >= PERCENT / 100 - ESTIMATE_SLACK
        near &= component[x][:, None] != component[y][None, :]
        if i == j:
            near &= x[:, None] < y[None, :]
        a, b = np.nonzero(near)
        order = np.argsort(-likeness[a, b], kind="stable")
        a, b = x[a[order]], y[b[order]]
        new = ~((bands[a, :band] == bands[b, :band]) & (bands[a, :band] != 0)).any(axis=1)
        for p, q in zip(a[new].tolist(), b[new].tolist(), strict=True):
            if forest.find(component[p]) != forest.find(component[q]) and _linked(sets[p], sets[q]):
                forest.join(component[p], component[q])
                out.append((p, q))
    a, b = (ids[list(c)] for c in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 2
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _across(members, found, reps, classes, docs):
    """Pairs of different components in the buckets that hold several, beyond those with the hub: all likely ones of
    small buckets, and of large ones as many as it takes to join what belongs together."""
    parts = members.join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    split = (
        parts.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        .filter("lo < hi").select("band", "key", "n")
    )
    open_rows = materialise(parts.join(split, ["band", "key"]).filter("node <> hub").select("band", "key", "node", "n_shingles", "component", "n"))
    small = open_rows.filter(F.col("n") <= SMALL)
    left = small.select("band", "key", F.col("node").alias("a"), F.col("component").alias("ca"))
    right = small.select("band", "key", F.col("node").alias("b"), F.col("component").alias("cb"))
    pairs = left.join(right, ["band", "key"]).filter("a < b and ca <> cb").select("a", "b").distinct()
    crowded = open_rows.filter(F.col("n") > SMALL)
    sets = _single_texts(crowded.select("node").distinct(), classes, docs).mapInArrow(_set_batches, "node long, shingles array<long>")
    # Registers and shingles meet once per class, not once per band.
    wide = materialise(sets.join(reps.select("node", "bands"), "node"))
    weight = crowded.groupBy("band", "key").agg(F.sum("n_shingles").alias("weight"))
    large = (
        crowded.join(weight, ["band", "key"])
        .withColumn("tiles", F.ceil(F.col("weight") / TILE_SHINGLES).cast("int"))
        .withColumn("tile", F.expr("cast(pmod(xxhash64(node, 'tile'), tiles) as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
        .select(
            "band", "key", "node", "n_shingles", "component", "tile",
            F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
        )
        .join(wide, "node")
    )
    tiled = large.groupBy("band", "key", "i", "j").applyInPandas(_tile, "a long, b long")
    return _likely(pairs, reps).union(tiled).distinct()


def _judged(docs):
    """Row per document: doc_id, t1, t2, n_shingles, f1, f2, component_id, kept; see `near_duplicates`."""
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    rows = materialise(sketches(docs))
    live = rows.filter("n_shingles > 0 and doc_id is not null")
    # Rows of one class have one word sequence, hence the same shingles and registers.
    grouped = materialise(
        live.groupBy("f1", "f2").agg(
            F.min(F.struct("doc_id", "t1", "t2")).alias("first"), F.count(F.lit(1)).alias("copies"),
            F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
        ).select("f1", "f2", "first.*", "copies", "n_shingles", "bands")
    )
    # doc_id may name several classes, so they get numbers of their own, in the order of doc_id.
    order = ["doc_id", "f1", "f2"]
    classes = materialise(grouped.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("node", F.monotonically_increasing_id()))
    reps = classes.select("node", "n_shingles", "bands")

    bands = reps.select("node", "n_shingles", F.posexplode("bands").alias("band", "key")).filter("key <> 0")
    shared = bands.groupBy("band", "key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last")
    members = materialise(bands.join(shared.drop("last"), ["band", "key"]))
    stars = members.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = _confirmed(_likely(stars, reps), classes, docs)
    found = materialise(components(links))
    more = _confirmed(_across(members, found, reps, classes, docs), classes, docs)
    final = found
    if not more.isEmpty():
        final = materialise(components(links.union(more)))

    # The smallest number of a component is the class of its smallest doc_id.
    named = final.join(classes.select(F.col("node").alias("component"), F.col("doc_id").alias("named")), "component")
    whole = classes.select("node", "f1", "f2", "doc_id").join(named, "node", "left").select(
        "f1", "f2", F.coalesce("named", "doc_id").alias("component_id"), F.expr("component is null or component = node").alias("leads"),
    )
    flagged = rows.drop("bands").withColumn("live", F.expr("n_shingles > 0 and doc_id is not null"))
    joined = flagged.filter("live").join(whole, ["f1", "f2"], "left").unionByName(
        flagged.filter("not live").withColumn("component_id", F.col("doc_id")).withColumn("leads", F.lit(True))
    )
    kept = F.col("leads") & F.col("doc_id").eqNullSafe(F.col("component_id"))
    return joined.select("doc_id", "t1", "t2", "n_shingles", "f1", "f2", "component_id", kept.alias("kept"))


def near_duplicates(docs):
    """Row per document: doc_id, n_shingles, component_id, kept; links are Jaccard >= 0.75 on word 5-shingles.

    Documents of one word sequence are one class, which its smallest doc_id stands for. The representatives'
    HyperMinHash registers form 32 bands of four; a band's members are first compared with its smallest doc_id
    only, which joins a group of near copies in linear work. In buckets that still hold two components, pairs of
    different components are then compared: in small buckets all likely ones, in large ones in tiles that compare by
    registers, then by shingles, and emit one link per two components joined, so that the rows grow with the members and
    no component is lost to the shortcut.
    Pairs are estimated from the registers (chance collisions taken off) and confirmed on the full sets. A pair at
    the threshold shares no band with a chance of (1 - 0.75^4)^32 = 5e-6.

    Null text, empty text and text without words: an empty set, linked with nothing. Null doc_id: linked with
    nothing, component_id null, kept. A repeated row gets the result of its twin; rows that share an id but not a
    text are judged by their own text, and if such rows are near-duplicates of each other and share the smallest
    doc_id, those of one word sequence are kept. Empty input gives an empty result; other columns are ignored.
    """
    return _judged(docs).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one_of_each(docs):
    """`docs` without near-duplicates: the rows that are kept, those of one doc_id and word sequence in one row.

    Each row is judged by its own text, so rows that share a doc_id but not a word sequence all stay unless they
    are near-duplicates. Rows with a null doc_id all stay.
    """
    key = ["doc_id", "t1", "t2"]
    verdict = materialise(_judged(docs))
    known = verdict.filter("kept and doc_id is not null")
    repeated = known.groupBy("doc_id", "f1", "f2").count().filter("count > 1").drop("count")
    again = materialise(known.join(repeated, ["doc_id", "f1", "f2"]).select(*key, "f1", "f2").distinct())
    gone = materialise(verdict.filter("not kept").select(*key).distinct())
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), *_text_keys(F.col("text").cast("binary")))
    single = whole.join(_few(materialise(gone.union(again.select(*key)))), key, "left_anti")
    once = whole.join(_few(again), key).groupBy("doc_id", "f1", "f2").agg(F.min("row").alias("row"))
    return single.select("row").union(once.select("row")).select("row.*")
