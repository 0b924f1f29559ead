"""Helpers the corpus operators share: word hashing in tasks, column guards, batches, written intermediate tables."""

import numpy as np
import xxhash
from pyspark.sql import functions as F

from caredeck.session import ship_package
from caredeck.storage import materialise

#: Words a task remembers. Texts keep bringing words that occur once, so more of them cost memory and save little time.
CACHE_WORDS = 100_000
#: Rows of whole texts that go to a Python worker at a time, and Spark's option for it.
TEXT_ROWS = 1_000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BASE = np.uint64(0x9E3779B97F4A7C15)
SECOND_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

__all__ = ["WordHashes", "RollingHash", "mix", "materialise", "ship_package", "small_batches", "texts", "long_column"]


def small_batches(spark):
    """Rows of whole texts go to Python TEXT_ROWS at a time, unless the session says how many.

    The executor and the worker both hold a batch, and the worker its values once more, per core.
    """
    if spark.conf.get(BATCH_ROWS, None) is None:
        spark.conf.set(BATCH_ROWS, str(TEXT_ROWS))


class WordHashes(dict):
    """64-bit hash of each word (bytes), remembered up to a bounded number of words."""

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words):
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(h):
    """A bijective scrambling of 64-bit values, so that their order is as good as random."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


class RollingHash:
    """Polynomial hashes (mod 2^64) of any run of words in a document, from one prefix sum."""

    def __init__(self, base=BASE):
        self.base = int(base)
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n):
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers))
            self.powers, self.inverses = (
                np.concatenate(([np.uint64(1)], np.full(size - 1, np.uint64(b)))).cumprod(dtype=np.uint64)
                for b in (self.base, self.inverse)
            )

    def prefix(self, hashes):
        self._grow(len(hashes) + 1)
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.powers[: len(hashes)], dtype=np.uint64, out=sums[1:])
        return sums

    def runs(self, sums, start, end):
        """Hash of words[start:end] for arrays of bounds; runs of unlike length never share a formula."""
        length = (end - start).astype(np.uint64)
        return mix((sums[end] - sums[start]) * self.inverses[start] + length * _M1)


def texts(docs, key="doc_id", text="text"):
    """Only the key (as long) and the UTF-8 bytes of the text; other columns of any name stay out."""
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))


def long_column(values):
    """uint64 numpy values as Spark longs of the same bits."""
    return np.asarray(values, dtype=np.uint64).view(np.int64)
