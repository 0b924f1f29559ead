"""Substring dedup: winnowed anchors seed repeats, extension both ways finds them whole, later copies go."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import SECOND_BASE, RollingHash, WordHashes, long_column, materialise, ship_package, texts

WINDOW = 50
#: Any 50 consecutive words hold a whole run of ANCHOR + SPAN - 1 words, hence at least one winnowed anchor.
ANCHOR = 20
SPAN = WINDOW - ANCHOR + 1
REACH = WINDOW - ANCHOR


def _sliding(values, size, pick):
    """Minimum or maximum of every run of `size` values, by doubling."""
    out, width = values, 1
    while 2 * width <= size:
        out = pick(out[:-width], out[width:])
        width *= 2
    rest = size - width
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def winnowed(grams):
    """Positions whose value is the smallest of some run of SPAN grams; chosen by content alone, so equal
    passages choose equal anchors. Ties are all chosen."""
    lowest = _sliding(grams, SPAN, np.minimum)
    edge = np.zeros(SPAN - 1, np.uint64)
    best = _sliding(np.concatenate((edge, lowest, edge)), SPAN, np.maximum)
    return np.flatnonzero(best == grams)


def _anchor_batches(batches):
    cache, rolling = WordHashes(), RollingHash()
    for batch in batches:
        ids, rows = batch.column("doc_id").to_pylist(), []
        for doc, text in zip(ids, batch.column("text").to_pylist(), strict=True):
            words = text.split()
            n = len(words)
            if n < WINDOW:
                continue
            sums = rolling.prefix(cache.of(words))
            start = np.arange(n - ANCHOR + 1)
            grams = rolling.runs(sums, start, start + ANCHOR)
            at = winnowed(grams)
            before = rolling.runs(sums, np.maximum(at - REACH, 0), at)
            after = rolling.runs(sums, at + ANCHOR, np.minimum(at + WINDOW, n))
            rows.append((np.full(len(at), doc), at, grams[at], before, after))
        if rows:
            doc, at, key, before, after = (np.concatenate(c) for c in zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(at, pa.int32()), *(pa.array(long_column(c)) for c in (key, before, after))],
                names=["doc_id", "at", "key", "before", "after"],
            )


def _window_batches(batches):
    """Two 64-bit hashes of every 50-word window that holds one of the document's listed anchors."""
    cache, first, second = WordHashes(), RollingHash(), RollingHash(SECOND_BASE)
    for batch in batches:
        rows = []
        for doc, text, at in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "at")), strict=True):
            hashes = cache.of(text.split())
            at = np.array(at, np.int64)
            start = np.unique((at[:, None] - np.arange(REACH + 1)[None, :]).ravel())
            start = start[(start >= 0) & (start <= len(hashes) - WINDOW)]
            one, two = (r.runs(r.prefix(hashes), start, start + WINDOW) for r in (first, second))
            rows.append((np.full(len(start), doc), start, one, two))
        if rows:
            doc, start, one, two = (np.concatenate(c) for c in zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(start, pa.int32()), pa.array(long_column(one)), pa.array(long_column(two))],
                names=["doc_id", "start", "w1", "w2"],
            )


def repeats(docs):
    """Runs of words that repeat in a document of smaller doc_id: doc_id, from_word, to_word (exclusive, may pass the end).

    Seeds: every run of 20 words that winnowing picks, in at least two documents. An occurrence whose whole
    reach (30 words either side, as far as the document goes) equals that of the first document with the same
    reach is extended in one comparison: every 50-word window through it repeats. Of each different reach one
    document is left, its first; for seeds with several, the extension goes on window by window: the windows
    through the seed are hashed (128 bits) and held against those of the other first documents. Both steps group
    by content and keep the smallest doc_id, so a passage that a third of the documents hold makes one row per
    occurrence and never a pair. Overlapping runs make up the maximal repeats.
    """
    ship_package(docs.sparkSession)
    whole = texts(docs).filter("doc_id is not null and text is not null")
    anchors = materialise(whole.mapInArrow(_anchor_batches, "doc_id long, at int, key long, before long, after long"))
    shared = anchors.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    seeds = materialise(anchors.join(shared.select("key", "lo"), "key"))
    reach = seeds.groupBy("key", "before", "after").agg(F.min("doc_id").alias("first"), F.first("lo").alias("lo"))
    several = reach.groupBy("key").agg(F.max("first").alias("top"), F.min("first").alias("low")).filter("low < top").select("key")
    judged = materialise(
        seeds.drop("lo").join(reach.drop("lo"), ["key", "before", "after"]).withColumn("settled", F.expr("doc_id > first"))
    )
    whole_reach = judged.filter("settled").select(
        "doc_id", F.greatest(F.col("at") - REACH, F.lit(0)).alias("from_word"), (F.col("at") + WINDOW).alias("to_word")
    )

    open_seeds = judged.filter("not settled").join(several, "key").groupBy("doc_id").agg(F.collect_set("at").alias("at"))
    windows = materialise(
        whole.join(open_seeds, "doc_id").mapInArrow(_window_batches, "doc_id long, start int, w1 long, w2 long")
    )
    origin = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    found = windows.join(origin.drop("hi"), ["w1", "w2"]).filter("doc_id > lo").select(
        "doc_id", F.col("start").alias("from_word"), (F.col("start") + WINDOW).alias("to_word")
    )
    return whole_reach.union(found)


def _keep_batches(batches):
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("text", "starts", "ends")), strict=True):
            words = text.split() if text else []
            n = len(words)
            if starts:
                depth = np.zeros(n + 1, np.int64)
                np.add.at(depth, np.minimum(starts, n), 1)
                np.add.at(depth, np.minimum(ends, n), -1)
                stay = np.flatnonzero(np.cumsum(depth[:n]) == 0)
                words = [words[i] for i in stay.tolist()]
            n_words.append(n)
            n_removed.append(n - len(words))
            kept.append(b" ".join(words).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_text"],
        )


def without_repeats(docs):
    """Row per document: doc_id, n_words, n_removed, kept_text (the kept words joined by one space).

    A word goes if a 50-word window over it also starts in a document of smaller doc_id; windows are judged on the
    input. Repeats inside one document stay. Null or empty text: no words. Null doc_id: nothing removed, and its
    windows count for no other document. Rows that share a doc_id are one document: what repeats in an earlier
    one goes from each. An empty table gives an empty result; other columns are ignored.
    """
    runs = repeats(docs).groupBy("doc_id").agg(F.collect_list(F.struct("from_word", "to_word")).alias("runs"))
    marked = (
        texts(docs).join(runs, "doc_id", "left")
        .select("doc_id", "text", F.col("runs.from_word").alias("starts"), F.col("runs.to_word").alias("ends"))
    )
    return marked.mapInArrow(_keep_batches, "doc_id long, n_words long, n_removed long, kept_text string")
