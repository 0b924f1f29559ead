"""Prefix trie of conversations: sorted shards finish their own nodes, nodes on splitter paths are reduced.

A conversation is a path of fixed-width symbols, one per turn: 16 bytes that stand for role and text, then the text's
word count in 8. Symbols sort like any bytes, a prefix before what extends it, so each node's members are neighbours.
"""

import hashlib
import math
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import materialise, ship_package

SYMBOL = 24
#: Paths per shard, and shards the sample is wanted for per shuffle partition at least.
SHARD_PATHS, SHARDS_PER_PARTITION = 50_000, 2
#: Sampled paths per shard; sampled paths and splitters may hold this many bytes in all, on the driver and in the broadcast.
SAMPLED, SKELETON_BYTES = 16, 8 << 20
#: Characters of one piece of a skeleton node's list of conversations; rows of one output batch.
PIECE_CHARS, BATCH_ROWS = 1 << 16, 20_000

WORD = r"[^\x20\x09-\x0D]+"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: A finished node, or (skeleton set) the part of a skeleton node that one shard has; `top` is the skeleton node above a
#: finished node whose parent is one. Rows with a piece carry text of a skeleton node's list only.
SHARD_ROW = f"{NODE}, skeleton long, top long, shard long, piece long, ids string"
_EMPTY = hashlib.sha256().hexdigest()


def symbols(role, text):
    """Hex symbol of a turn: 128 bits of the SHA-256 of role and text, then the words of the text."""
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    words = F.lpad(F.hex(F.regexp_count(text, F.lit(WORD)).cast("long")), 16, "0")
    return F.concat(F.upper(F.substring(F.sha2(named, 256), 1, 32)), words)


def own_paths(turns, key="conv_id", turn="turn", role="role", text="text"):
    """(conv_id, path): each conversation's turns in order, null turn numbers first; turns of one number follow each
    other by role, then by their symbol. Only symbols are exchanged, never texts."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    rows = turns.select(
        F.col(f"`{key}`").cast("long").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").alias("turn"), role.alias("role"), symbols(role, text).alias("symbol")).alias("t"),
    ).where(F.col("conv_id").isNotNull())
    paths = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return paths.select("conv_id", F.unhex(F.array_join("t.symbol", "")).alias("path"))


def rebuilt_paths(paths):
    """The first h turns of conversation c - c % 20, then c's own turns after its first h; h = crc32(decimal c) % 4."""
    base = F.col("conv_id") - F.col("conv_id") % 20
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    bases = paths.where(F.col("conv_id") % 20 == 0).select(
        F.col("conv_id").alias("base"), F.substring("path", 1, 3 * SYMBOL).alias("start")
    )
    cut = (F.col("h") * SYMBOL).cast("int")
    start = F.coalesce(F.col("start").substr(F.lit(1), cut), F.lit(b""))
    rest = F.col("path").substr(cut + 1, F.length("path"))
    joined = paths.select("conv_id", "path", base.alias("base"), head.alias("h")).join(bases, "base", "left")
    return joined.select("conv_id", F.concat(start, rest).alias("path"))


def common_depth(a, b):
    """Turns that two paths share from the start."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // SYMBOL
    low, high = 0, size // SYMBOL
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * SYMBOL] == b[: middle * SYMBOL]:
            low = middle
        else:
            high = middle - 1
    return low


def words_of(path, depth):
    return int.from_bytes(path[depth * SYMBOL - 8 : depth * SYMBOL], "big") if depth else 0


class Skeleton:
    """Trie of the splitters' paths. A splitter (path, conv_id) starts a shard; `nodes[i]` numbers the nodes of its path
    from the root down. A node with members in several shards is a prefix of a splitter between them."""

    def __init__(self, splitters):
        self.splitters = splitters
        self.parents, self.words, self.depths = [-1], [0], [0]
        self.nodes = []
        before, numbers = b"", [0]
        for path, _ in splitters:
            numbers = numbers[: common_depth(before, path) + 1]
            for depth in range(len(numbers), len(path) // SYMBOL + 1):
                self.parents.append(numbers[-1])
                self.words.append(words_of(path, depth))
                self.depths.append(depth)
                numbers.append(len(self.parents) - 1)
            self.nodes.append(numbers)
            before = path

    def shard(self, path, conv):
        return bisect_right(self.splitters, (path, conv))

    def above(self, shard, path):
        """Skeleton nodes on a path of the shard, the root first: such a node is on the path of the splitter at
        either end of the shard."""
        best = [0]
        for i in (shard - 1, shard):
            if 0 <= i < len(self.splitters):
                nodes = self.nodes[i][: common_depth(self.splitters[i][0], path) + 1]
                best = nodes if len(nodes) > len(best) else best
        return best


def choose_splitters(paths):
    """Quantiles of a sample by hash of the id. The sample's and the splitters' bytes are bounded: where sampled paths
    are long, fewer are kept, and shards grow instead."""
    spark = paths.sparkSession
    n, mean = paths.agg(F.count("*"), F.coalesce(F.avg(F.length("path")), F.lit(0.0))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(SHARDS_PER_PARTITION * partitions, math.ceil(n / SHARD_PATHS))
    wanted = min(SAMPLED * shards, int(SKELETON_BYTES / (mean + SYMBOL)))
    share = max(1, n // max(1, wanted))
    sample = paths.where(F.pmod(F.xxhash64("conv_id", F.lit(13)), F.lit(share)) == 0)
    # A path of more than 1/64 of the bound can't be a splitter.
    sample = sample.where(F.length("path") <= SKELETON_BYTES // 64).select("path", "conv_id")
    kept = sorted((bytes(r["path"]), r["conv_id"]) for r in sample.collect())
    step = max(1, len(kept) // shards)
    splitters = kept[step::step]
    while sum(len(p) for p, _ in splitters) > SKELETON_BYTES:
        splitters = splitters[1::2]
    return splitters


class _Open:
    """A node some members of which were read."""

    __slots__ = ("conv", "convs", "children", "leaves", "saved", "ends", "waiting", "skeleton", "pieces")

    def __init__(self, conv, skeleton):
        self.conv, self.skeleton = conv, skeleton
        self.convs = self.children = self.leaves = self.saved = self.pieces = 0
        self.ends, self.waiting = None, []


class _Shard:
    """Reads one shard's conversations in (path, conv_id) order and leaves rows of SHARD_ROW."""

    def __init__(self, skeleton, number, out):
        self.skeleton, self.number, self.out = skeleton, number, out
        self.path, self.stack = b"", []

    def add(self, path, conv):
        keep = common_depth(self.path, path) + 1 if self.stack else 0
        if keep <= len(path) // SYMBOL:  # else it is the path of the row before
            self.close(keep)
            above = self.skeleton.above(self.number, path)
            for depth in range(keep, len(path) // SYMBOL + 1):
                self.stack.append(_Open(conv, above[depth] if depth < len(above) else None))
            self.path = path
        for node in self.stack:
            node.convs += 1
            node.conv = min(node.conv, conv)
        self.end_here(self.stack[-1], conv)

    def end_here(self, node, conv):
        if node.skeleton is None:
            if node.ends is None:
                node.ends = hashlib.sha256(str(conv).encode())
            else:
                node.ends.update(b",%d" % conv)
            return
        node.ends = node.ends or []
        node.ends.append(str(conv))
        if len(node.ends) * 12 >= PIECE_CHARS:
            self.piece(node)

    def piece(self, node):
        if node.ends:
            self.out.append((*[None] * 8, node.skeleton, None, self.number, node.pieces, ",".join(node.ends)))
            node.pieces += 1
            node.ends = []

    def close(self, keep):
        """Finish the nodes below the first `keep` of the stack."""
        while len(self.stack) > keep:
            depth = len(self.stack) - 1
            node, above = self.stack.pop(), self.stack[-1] if self.stack else None
            if node.skeleton is not None:
                self.piece(node)
                counts = (node.convs, node.children, node.leaves, node.saved)
                self.out.append((node.conv, depth, None, *counts, None, node.skeleton, None, self.number, None, None))
                continue
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.convs - 1) * words_of(self.path, depth)
            above.children += 1
            above.leaves += leaves
            above.saved += saved
            ends = node.ends.hexdigest() if node.ends else _EMPTY
            row = [node.conv, depth, None, node.convs, node.children, leaves, saved, ends]
            for child in node.waiting:
                child[2] = node.conv
                self.out.append((*child, *[None] * 5))
            if above.skeleton is None:
                above.waiting.append(row)
            else:
                self.out.append((*row, None, above.skeleton, *[None] * 3))


def _finish_shards(shared, schema):
    names = [f.name for f in schema]

    def run(batches):
        skeleton, shard, out = shared.value, None, []

        def rows():
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], names=names)

        for batch in batches:
            numbers, paths, convs = (batch.column(n) for n in ("shard", "path", "conv_id"))
            for i in range(batch.num_rows):
                number = numbers[i].as_py()
                if shard is None or shard.number != number:
                    if shard:
                        shard.close(0)
                    shard = _Shard(skeleton, number, out)
                shard.add(paths[i].as_py(), convs[i].as_py())
                if len(out) >= BATCH_ROWS:
                    yield rows()
        if shard:
            shard.close(0)
        if out:
            yield rows()

    return run


def _shard_numbers(shared):
    def run(batches):
        skeleton = shared.value
        for batch in batches:
            paths, convs = batch.column("path"), batch.column("conv_id")
            numbers = [skeleton.shard(paths[i].as_py(), convs[i].as_py()) for i in range(batch.num_rows)]
            yield batch.append_column("shard", pa.array(numbers, pa.int64()))

    return run


def _hash_pieces(batches):
    """SHA-256 per skeleton node of its pieces in order, joined by commas; one piece in memory at a time."""
    node, digest, done = None, None, []
    for batch in batches:
        for number, ids in zip(batch.column("skeleton").to_pylist(), batch.column("ids"), strict=True):
            if number != node:
                if digest:
                    done.append((node, digest.hexdigest()))
                node, digest = number, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.as_py().encode())
    if digest:
        done.append((node, digest.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["skeleton", "ends_sha256"])


def _rolled_up(skeleton, parts):
    """Rows of the skeleton's nodes from the reduced parts: children before parents, each adds to its parent."""
    size = len(skeleton.parents)
    convs, children, leaves, saved = (np.zeros(size, object) for _ in range(4))
    conv = [None] * size
    for row in parts:
        i = row["skeleton"]
        conv[i] = row["conv_id"]
        convs[i], children[i], leaves[i], saved[i] = (row[n] for n in ("n_convs", "n_children", "n_leaves", "saved_tokens"))
    for i in sorted(range(size), key=lambda i: -skeleton.depths[i]):
        if not children[i]:
            leaves[i] = 1
        saved[i] += (convs[i] - 1) * skeleton.words[i]
        above = skeleton.parents[i]
        if above >= 0:
            children[above] += 1
            leaves[above] += leaves[i]
            saved[above] += saved[i]
    return [
        (i, conv[i], skeleton.depths[i], conv[skeleton.parents[i]] if i else None, convs[i], children[i], leaves[i], saved[i])
        for i in range(size)
    ]


def prefix_trie(paths):
    """One row per node of the trie of `paths` (conv_id long, path binary): NODE's columns.

    Splitters cut the sorted (path, conv_id) pairs into shards; the trie of their paths, the skeleton, is broadcast (at
    most SKELETON_BYTES of paths). A shard reads its conversations in order and finishes every node that is no prefix of
    a splitter, since all its members are there. The skeleton's nodes get partial sums from each shard, which Spark adds
    up, and are rolled up along the skeleton. A path that very many conversations share is split by conv_id.

    A conversation's symbols (SYMBOL bytes per turn) are one row. A task holds the finished nodes that wait for their
    parent's smallest member, at most its shard's. The list of conversations that end at one skeleton node is hashed by
    one task, as SHA-256 asks for, from pieces of PIECE_CHARS that are read one at a time. No paths give no rows.
    """
    spark = paths.sparkSession
    ship_package(spark)
    paths = materialise(paths)
    skeleton = Skeleton(choose_splitters(paths))
    shared = spark.sparkContext.broadcast(skeleton)
    numbered = paths.mapInArrow(_shard_numbers(shared), "conv_id long, path binary, shard long")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sharded = numbered.repartition(partitions, "shard").sortWithinPartitions("shard", "path", "conv_id")
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in SHARD_ROW.split(", "))])
    rows = materialise(sharded.mapInArrow(_finish_shards(shared, schema), SHARD_ROW))

    parts = rows.where("skeleton is not null and piece is null").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(n).alias(n) for n in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    pieces = rows.where("piece is not null").select("skeleton", "shard", "piece", "ids")
    ordered = pieces.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "piece")
    ends = ordered.mapInArrow(_hash_pieces, "skeleton long, ends_sha256 string")
    known = parts.collect()  # the skeleton's nodes, bounded by SKELETON_BYTES
    upper = _rolled_up(skeleton, known) if known else []
    names = NODE.replace(", ends_sha256 string", "")
    upper = spark.createDataFrame(upper, f"skeleton long, {names}")
    tops = F.broadcast(upper.select(F.col("skeleton").alias("top"), F.col("conv_id").alias("top_conv")))
    columns = [c.split()[0] for c in NODE.split(", ")]
    finished = rows.where("skeleton is null").join(tops, "top", "left")
    finished = finished.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "top_conv")).select(columns)
    upper = upper.join(ends, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
    return finished.unionByName(upper.select(columns))


def conversation_trie(turns, key="conv_id", turn="turn", role="role", text="text"):
    """The prefix trie of the rebuilt conversations of a turn table, one row per node.

    Null roles and texts count as empty, null turn numbers come first, rows without a conversation take no part,
    repeated rows are turns of their own. Word counts cover whole texts. Other columns are not read.
    """
    return prefix_trie(rebuilt_paths(materialise(own_paths(turns, key, turn, role, text))))
