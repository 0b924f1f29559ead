"""Toxicity by a classifier chain: linear models in a fixed order, later ones fed the earlier ones' probabilities."""

import functools
import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CACHE_WORDS, materialise, ship_package, small_batches

#: Categories in chain order, as conditions on the columns of `labels`.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1", "severe": "toxic = 1 and quality = 0"}
DECIDING = "toxic"
#: The models are fitted on about this many labelled rows, chosen by a hash of doc_id.
LABELLED_ROWS = 20_000
PENALTY = 5e-4
STEPS = 80
WORDS_PER_CATEGORY = 1_500
LEAST_DOCUMENTS = 5
#: Features that a task counts before it hands the counts on.
MOST_COUNTED = 100_000
LEAST_CHI2 = 12.0
FOLDS = 3
#: Lengths of the beginnings of words that count as words of their own, so that inflected forms share one.
HEADS = (4, 5, 6)
THRESHOLD = 0.5


_LETTERS = re.compile(r"[^\W\d_]+")


class Features(dict):
    """Features of a blank-separated word: its lower-case runs of letters and the beginnings of longer ones.

    With `known` (feature -> number), only those, by number. Remembers a bounded number of words.
    """

    def __init__(self, known=None):
        super().__init__()
        self.known = known

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = []
        for run in _LETTERS.findall(word.lower()):
            found.append(run)
            found += ["^" + run[:size] for size in HEADS if len(run) > size]
        if self.known is not None:
            found = [self.known[f] for f in found if f in self.known]
        value = self[word] = tuple(found)
        return value

    def of(self, text):
        out = set()
        for word in set(text.split()) if text else ():
            out.update(self[word])
        return out


def _count_batches(batches, categories):
    """Per feature: documents of the task that hold it, in all and per category; in parts of about MOST_COUNTED features."""
    features, seen = Features(), Counter()
    totals = [Counter() for _ in categories]
    for batch in batches:
        flags = list(zip(*(batch.column(c).to_pylist() for c in categories), strict=True))
        for text, truth in zip(batch.column("text").to_pylist(), flags, strict=True):
            found = features.of(text)
            seen.update(found)
            for total, yes in zip(totals, truth, strict=True):
                if yes:
                    total.update(found)
            if len(seen) >= MOST_COUNTED:
                yield _counted(seen, totals, categories)
                seen, totals = Counter(), [Counter() for _ in categories]
    yield _counted(seen, totals, categories)


def _counted(seen, totals, categories):
    words = list(seen)
    columns = [pa.array([float(c[w]) for w in words], pa.float64()) for c in (seen, *totals)]
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *columns], names=["word", "n", *categories])


def _known_batches(batches, words, keep):
    features = Features({w: i for i, w in enumerate(words)})
    for batch in batches:
        found = [sorted(features.of(text)) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in keep), pa.array(found, pa.list_(pa.int64()))], names=[*keep, "words"]
        )


def _score_batches(batches, words, weights):
    """Probabilities along the chain; `weights`: per category intercept, weight per word, weights of earlier ones."""
    features = Features({w: i for i, w in enumerate(words)})
    for batch in batches:
        columns = [[] for _ in weights]
        for text in batch.column("text").to_pylist():
            at, earlier = list(features.of(text)), []
            for (intercept, by_word, by_earlier), out in zip(weights, columns, strict=True):
                z = intercept + sum(by_word[i] for i in at) + sum(w * p for w, p in zip(by_earlier, earlier, strict=True))
                p = 1 / (1 + math.exp(-z)) if z > -700 else 0.0
                earlier.append(p)
                out.append(p)
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), *(pa.array(c, pa.float64()) for c in columns)],
            names=[*names, *(f"p_{c}" for c in CATEGORIES)],
        )


def labelled_sample(docs, labels, rows=LABELLED_ROWS):
    """At most about `rows` labelled documents: doc_id, text, fold and a 0/1 column per category, written once."""
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    truth = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.expr(f"cast({rule} as double)").alias(c) for c, rule in CATEGORIES.items()],
    ).dropna()
    n = truth.count()
    if n > rows:
        truth = truth.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * rows / n))
    # Bounded by `rows`, so a broadcast: the documents' texts are not shuffled.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialise(
        texts.join(F.broadcast(truth.dropDuplicates(["doc_id"])), "doc_id")
        .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)))
    )


def vocabulary(sample):
    """Words that speak for or against a category by chi-squared, at most WORDS_PER_CATEGORY of them each."""
    totals = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in CATEGORIES]).first()
    names = list(CATEGORIES)
    schema = "word string, n double, " + ", ".join(f"{c} double" for c in names)
    counted = sample.select("text", *names).mapInArrow(functools.partial(_count_batches, categories=names), schema)
    seen = materialise(
        counted.groupBy("word").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).filter(F.col("n") >= LEAST_DOCUMENTS)
    )
    words = set()
    for c in names:
        total, positive = float(totals["n"]), float(totals[c] or 0)
        if not 0 < positive < total:
            continue
        a, b = F.col(c), F.col("n") - F.col(c)
        gap = a * (total - positive - b) - b * (positive - a)
        chi2 = gap * gap * total / (F.col("n") * (total - F.col("n") + 0.5) * positive * (total - positive))
        best = seen.withColumn("chi2", chi2).filter(F.col("chi2") >= LEAST_CHI2).orderBy(F.desc("chi2"), "word")
        words |= {r.word for r in best.limit(WORDS_PER_CATEGORY).collect()}
    return sorted(words)


@dataclass
class Linear:
    """A logistic model: intercept, weight per word, weights of the earlier categories' probabilities."""

    intercept: float
    by_word: list
    by_earlier: list


class Rows:
    """The labelled sample in compressed rows: word numbers, truths, folds and probabilities so far."""

    def __init__(self, table, words):
        table = table.sort_by([("doc_id", "ascending")])
        found = table.column("words").combine_chunks()
        self.width, self.n = words, len(table)
        self.at = found.flatten().to_numpy(zero_copy_only=False)
        self.row = np.repeat(np.arange(self.n), np.diff(found.offsets.to_numpy()))
        self.fold = table.column("fold").to_numpy()
        self.truth = {c: table.column(c).to_numpy() for c in CATEGORIES}
        self.earlier = np.zeros((self.n, 0))

    def margins(self, weights):
        words, rest = weights[: self.width], weights[self.width :]
        z = np.bincount(self.row, words[self.at], minlength=self.n) + rest[0]
        return z + self.earlier @ rest[1:]

    def loss(self, weights, truth, use):
        """Penalised mean log loss over the rows of `use`, and its gradient."""
        z, total = self.margins(weights), use.sum()
        value = (use * (np.logaddexp(0, z) - truth * z)).sum() / total
        slope = use * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - truth) / total
        back = np.bincount(self.at, slope[self.row], minlength=self.width)
        grad = np.concatenate((back, [slope.sum()], self.earlier.T @ slope))
        held = weights.copy()
        held[self.width] = 0
        return value + PENALTY / 2 * held @ held, grad + PENALTY * held

    def fit(self, category, use):
        """Weights by limited-memory BFGS with a halving line search."""
        truth = self.truth[category]
        x = np.zeros(self.width + 1 + self.earlier.shape[1])
        f, g = self.loss(x, truth, use)
        steps = []
        for _ in range(STEPS):
            d, kept = -g, []
            for s, y, rho in reversed(steps):
                a = rho * (s @ d)
                kept.append(a)
                d = d - a * y
            if steps:
                s, y, _ = steps[-1]
                d = d * ((s @ y) / (y @ y))
            for (s, y, rho), a in zip(steps, reversed(kept), strict=True):
                d = d + s * (a - rho * (y @ d))
            slope, t = g @ d, 1.0
            if slope > -1e-10:
                break
            while True:
                to, (f2, g2) = x + t * d, self.loss(x + t * d, truth, use)
                if f2 <= f + 1e-4 * t * slope or t < 1e-8:
                    break
                t /= 2
            s, y = to - x, g2 - g
            if s @ y > 1e-14:
                steps = [*steps[-9:], (s, y, 1 / (s @ y))]
            x, f, g = to, f2, g2
        return x


@dataclass
class Chain:
    """The vocabulary and, per category in chain order, the fitted linear model."""

    words: list
    models: dict

    def score(self, rows):
        """`rows` with `text` -> the other columns and a probability column p_<category> per link of the chain."""
        weights = [(m.intercept, m.by_word, m.by_earlier) for m in self.models.values()]
        fields = [f for f in rows.schema.fields if f.name != "text"]
        schema = T.StructType([*fields, *(T.StructField(f"p_{c}", T.DoubleType()) for c in CATEGORIES)])
        return rows.mapInArrow(functools.partial(_score_batches, words=self.words, weights=weights), schema)


def fit(docs, labels):
    """The fitted chain, or None without labelled documents or telling words.

    In chain order, a category's model is fitted on all sampled rows with the earlier categories' out-of-fold
    probabilities as further inputs: for those, models fitted without a row's fold predict it, so that later
    models meet probabilities as uncertain as the ones they will meet in use. Spark gathers the sample's features;
    the sample is bounded by LABELLED_ROWS, and the fits run on the driver.
    """
    sample = labelled_sample(docs, labels)
    words = vocabulary(sample) if not sample.isEmpty() else []
    if not words:
        return None
    keep = ["doc_id", "fold", *CATEGORIES]
    schema = T.StructType([*(sample.schema[c] for c in keep), T.StructField("words", T.ArrayType(T.LongType()))])
    known = sample.select("text", *keep).mapInArrow(functools.partial(_known_batches, words=words, keep=keep), schema)
    rows, models = Rows(known.toArrow(), len(words)), {}
    everyone = np.ones(rows.n)
    for category in CATEGORIES:
        x = rows.fit(category, everyone)
        models[category] = Linear(float(x[rows.width]), x[: rows.width].tolist(), x[rows.width + 1 :].tolist())
        unseen = np.zeros(rows.n)
        for f in range(FOLDS):
            out = rows.fold == f
            if out.any():
                z = rows.margins(rows.fit(category, (~out).astype(float)) if not out.all() else x)
                unseen[out] = 1 / (1 + np.exp(-np.clip(z[out], -500, 500)))
        rows.earlier = np.column_stack((rows.earlier, unseen))
    return Chain(words, models)


def score(docs, labels):
    """Row per row of `docs`: doc_id, a probability per category, toxic (boolean).

    Every document is scored over its whole text, in one pass without a shuffle. Null or empty text has no words
    and gets the models' base rates. Null doc_id stays null; repeated rows score alike; labels with nulls are left
    out, a document labelled twice counts once. Without labelled documents every probability is 0 and nothing is
    toxic. Columns other than doc_id and text are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _scored(rows, fit(docs, labels), "doc_id").select("doc_id", *[f"p_{c}" for c in CATEGORIES], "toxic")


def without_toxic(docs, labels):
    """The rows of `docs`, all columns, that the chain does not call toxic."""
    whole = docs.select(F.struct("*").alias("row"), "text")
    return _scored(whole, fit(docs, labels), "row").filter("not toxic").select("row.*")


def _scored(docs, chain, carry):
    rows = docs.select(carry, "text")
    if chain is None:
        rows = rows.drop("text").withColumns({f"p_{c}": F.lit(0.0) for c in CATEGORIES})
    else:
        rows = chain.score(rows)
    return rows.withColumn("toxic", F.col(f"p_{DECIDING}") >= THRESHOLD)
