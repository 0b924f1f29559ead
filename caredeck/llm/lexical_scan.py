"""Ranked lexical search: one scan of the texts with an Aho-Corasick automaton of all item terms, no document index."""

import math
import uuid
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from caredeck.operators.ranking import with_running_totals

from .common import materialise, ship_package

#: Bytes of item text that one automaton takes; more items are searched in several scans.
BLOCK_BYTES = 8 << 20
#: Entries of a task's (document, item) score table, and of the list of (document, term, item) triples behind it.
SCORE_CELLS, TRIPLES = 1 << 18, 1 << 22

# ASCII letters and digits and every non-ASCII byte make terms, A-Z in lower case; the rest parts them.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def guarded(text):
    """Bytes of a text with a blank on either side of every term."""
    return b" " + text.translate(_BYTES) + b" "


def terms(text):
    return guarded(text).split()


def automaton(vocabulary):
    """Finds ' term ' for every term; a term's number is its place in `vocabulary` (bytes)."""
    machine = ahocorasick.Automaton()
    for number, term in enumerate(vocabulary):
        # One character per byte, so that positions and automaton states are bytes.
        machine.add_word(f" {term.decode('latin-1')} ", number)
    if vocabulary:
        machine.make_automaton()
    return machine


_built = {}


def _automaton_of(shared):
    """The worker's automaton of a broadcast vocabulary; the last one is kept for the worker's next task."""
    if shared.id not in _built:
        _built.clear()
        _built[shared.id] = automaton(shared.value)
    return _built[shared.id]


def _ragged(rows, kind):
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int64))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array([x for r in rows for x in r], kind))


class _Named:
    """A broadcast value with a name that a worker can remember it by."""

    def __init__(self, spark, value):
        self.id, self._shared = uuid.uuid4().hex, spark.sparkContext.broadcast(value)

    @property
    def value(self):
        return self._shared.value


def _counter(shared):
    def count(batches):
        machine = _automaton_of(shared)
        found = len(machine) > 0
        for batch in batches:
            texts, lengths, numbers, counts = batch.column("text"), [], [], []
            for i in range(batch.num_rows):
                text = guarded(texts[i].as_py() or b"")
                lengths.append(len(text.split()))
                tf = Counter(n for _, n in machine.iter(text.decode("latin-1"))) if found else {}
                numbers.append(list(tf))
                counts.append(list(tf.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()), _ragged(numbers, pa.int32()), _ragged(counts, pa.int64())],
                names=["doc_id", "n", "term", "tf"],
            )

    return count


class Best:
    """The k best (score, document) per item so far, with the score an item's next entry must reach."""

    def __init__(self, items, k):
        self.k, self.bar = k, np.ones(items, np.int64)
        self.kept = [np.empty(0, t) for t in (np.int64, np.int64, bool, np.int64)]

    def add(self, scores, docs, missing):
        """`scores`: documents by items."""
        doc, item = np.nonzero(scores >= self.bar)
        if not len(doc):
            return
        new = (item, scores[doc, item], missing[doc], docs[doc])
        item, score, none, doc = (np.concatenate(pair) for pair in zip(self.kept, new, strict=True))
        order = np.lexsort((doc, none, -score, item))
        item, score, none, doc = item[order], score[order], none[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        full = place == self.k - 1
        self.bar[item[full]] = score[full]
        keep = place < self.k
        self.kept = [c[keep] for c in (item, score, none, doc)]


def _scorer(shared, k):
    """Scores of a task's documents against every item of the block; leaves k rows per item and task at most."""

    def score(batches):
        weight, n_docs, total, starts, sizes, items, repeats, n_items = shared.value
        best = Best(n_items, k)
        for batch in batches:
            ids = batch.column("doc_id")
            missing = np.asarray(ids.is_null())
            docs = ids.fill_null(0).to_numpy(zero_copy_only=False)
            length = batch.column("n").to_numpy().astype(np.int64)
            offsets = batch.column("term").offsets.to_numpy().astype(np.int64)
            term = batch.column("term").values.to_numpy()
            tf = batch.column("tf").values.to_numpy()
            m = 75 + (25 * length * n_docs) // max(total, 1)
            doc = np.repeat(np.arange(len(docs)), np.diff(offsets))
            term, tf = term[offsets[0] : offsets[-1]], tf[offsets[0] : offsets[-1]]
            part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
            triples = np.concatenate(([0], np.cumsum(sizes[term])))
            offsets = offsets - offsets[0]
            at = 0
            while at < len(docs):
                # As many documents as fit both tables, one at least.
                fit = np.searchsorted(triples[offsets], triples[offsets[at]] + TRIPLES, side="right") - 1
                to = max(at + 1, min(at + max(1, SCORE_CELLS // n_items), fit, len(docs)))
                lo, hi = offsets[at], offsets[to]
                n = sizes[term[lo:hi]]
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[term[lo:hi]], n)
                table = np.zeros((to - at, n_items), np.int64)
                cell = np.repeat(doc[lo:hi] - at, n) * n_items + items[place]
                np.add.at(table.reshape(-1), cell, np.repeat(part[lo:hi], n) * repeats[place])
                best.add(table, docs[at:to], missing[at:to])
                at = to
        item, value, none, doc = best.kept
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(doc, pa.int64(), mask=none), pa.array(value, pa.int64())],
            names=["item", "doc_id", "score"],
        )

    return score


def _blocks(items):
    """Item rows (number, item_id, text) with their block; a block holds at most BLOCK_BYTES of text, or one item."""
    rows = materialise(items.withColumn("row", F.monotonically_increasing_id()))
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 64).cast("long")
    running = with_running_totals(rows.withColumn("size", size), [F.col("row")], {"upto": F.col("size")})
    return materialise(running.withColumn("block", F.floor((F.col("upto") - F.col("size")) / BLOCK_BYTES)))


def _search_block(docs, rows, k):
    """The k best documents of each item of one block: (item, doc_id, score), k rows per item and task at most."""
    spark = docs.sparkSession
    wanted = [Counter(terms((row["text"] or "").encode())) for row in rows]
    vocabulary = sorted(set().union(*wanted))
    number = {term: i for i, term in enumerate(vocabulary)}
    schema = "doc_id long, n long, term array<int>, tf array<long>"
    counted = materialise(docs.mapInArrow(_counter(_Named(spark, vocabulary)), schema))
    n_docs, total = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    # One row per term of the block.
    for row in counted.select(F.explode("term").alias("term")).groupBy("term").count().collect():
        df[row["term"]] = row["count"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    links = sorted((number[t], item, count) for item, counts in enumerate(wanted) for t, count in counts.items())
    term, item, repeats = (np.array(c, np.int64) for c in zip(*links, strict=True)) if links else [np.zeros(0, np.int64)] * 3
    sizes = np.bincount(term, minlength=len(vocabulary))
    facts = (weight, n_docs, total, np.cumsum(sizes) - sizes, sizes, item, repeats, len(rows))
    shared = spark.sparkContext.broadcast(facts)
    return counted.mapInArrow(_scorer(shared, k), "item long, doc_id long, score long")


def rank_documents(docs, items, k=20, key="doc_id", text="text", item_key="item_id", item_text="text"):
    """Rows (item key, rank, document key, score): the k highest-scoring documents of every item.

    Every item term is a guarded word of one automaton per block of items (BLOCK_BYTES of item text, so the broadcast is
    bounded); a scan of the whole texts counts each document's terms and the automaton's matches. Those counts are
    written, document frequencies are summed from them, and a second pass over the counts scores each document against
    all items of the block, keeping the k best per item and task. Scores are 64-bit integers.

    Null and empty texts have no terms and do not count as documents with terms; items without terms get no rows. Equal
    scores are ordered by ascending key, null keys last; repeated rows are documents of their own, so are repeated items.
    Empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    items = _blocks(items.select(F.col(f"`{item_key}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text")))
    found = None
    for (block,) in items.select("block").distinct().sort("block").collect():
        rows = items.where(F.col("block") == block).sort("row").collect()  # bounded by BLOCK_BYTES
        numbers = [(i, row["item_id"], block) for i, row in enumerate(rows)]
        names = spark.createDataFrame(numbers, "item long, item_id long, block long")
        hits = _search_block(docs, rows, k).join(F.broadcast(names), "item")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = spark.createDataFrame([], "item long, doc_id long, score long, item_id long, block long")
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item_id").alias(item_key), "rank", F.col("doc_id").alias(key), "score")
