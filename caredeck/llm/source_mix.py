"""Mixing sources to target weights: flow over membership patterns, then seeded selection."""

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from caredeck.operators.ranking import with_position

from .common import materialise, ship_package
from .components import components

SHARE = 1.5
MOST = 2
WEIGHTS = (3, 1, 2)
SEED = 20_240_501
BUCKETS = 4096


def targets(sizes, weights, share=SHARE, most=MOST):
    """Target per source: `share` of all sizes by weight, none above `most` times its size, the excess reshared.

    `sizes`: {source: size}; `weights`: {source: weight}. Sources at their bound leave the sharing, the rest
    divide what is left, until none is above.
    """
    budget, free, out = share * sum(sizes.values()), set(sizes), {}
    while free:
        total = sum(weights[s] for s in free)
        full = [s for s in free if budget * weights[s] / total >= most * sizes[s]]
        if not full:
            out |= {s: budget * weights[s] / total for s in free}
            break
        for s in full:
            out[s] = float(most * sizes[s])
            budget -= out[s]
            free.discard(s)
    return out


class Flow:
    """Largest flow by blocking flows over levels; whole capacities."""

    def __init__(self, nodes):
        self.edges, self.out = [], [[] for _ in range(nodes)]

    def add(self, a, b, capacity):
        self.out[a].append(len(self.edges))
        self.edges.append([b, capacity])
        self.out[b].append(len(self.edges))
        self.edges.append([a, 0])
        return len(self.edges) - 2

    def _levels(self, source):
        level, now = [None] * len(self.out), [source]
        level[source] = 0
        while now:
            after = []
            for a in now:
                for e in self.out[a]:
                    b, capacity = self.edges[e]
                    if capacity > 0 and level[b] is None:
                        level[b] = level[a] + 1
                        after.append(b)
            now = after
        return level

    def run(self, source, sink):
        """Add to the flow until it is the largest; flow on edges out of `source` never goes back."""
        while (level := self._levels(source))[sink] is not None:
            at, path, a = [0] * len(self.out), [], source
            while True:
                if a == sink:
                    amount = min(self.edges[e][1] for e in path)
                    for e in path:
                        self.edges[e][1] -= amount
                        self.edges[e ^ 1][1] += amount
                    full = next(k for k, e in enumerate(path) if not self.edges[e][1])
                    a = self.edges[path[full] ^ 1][0]
                    del path[full:]
                elif at[a] < len(self.out[a]):
                    e = self.out[a][at[a]]
                    b, capacity = self.edges[e]
                    if capacity > 0 and level[b] == level[a] + 1:
                        path.append(e)
                        a = b
                    else:
                        at[a] += 1
                elif path:
                    a = self.edges[path.pop() ^ 1][0]
                    at[a] += 1
                else:
                    break


def route(patterns, quotas, most=MOST):
    """Words to take of each membership pattern: {pattern: words} for {pattern (tuple of sources): size}.

    Patterns offer their size once per repetition to the sources they belong to; sources take up to their quota.
    The r-th repetition is offered when the flow of those before it is the largest possible, and what is taken
    then stays taken: the flow is the largest and, of those, the one that repeats least.
    """
    sources = sorted(quotas, key=lambda s: (s is None, "" if s is None else s))
    number = {s: 1 + len(patterns) + i for i, s in enumerate(sources)}
    sink = 1 + len(patterns) + len(sources)
    flow, tiers = Flow(sink + 1), {p: [] for p in patterns}
    for i, (pattern, size) in enumerate(patterns.items(), 1):
        for s in pattern:
            flow.add(i, number[s], most * size)
    for s in sources:
        flow.add(number[s], sink, round(quotas[s]))
    for _ in range(most):
        for i, (pattern, size) in enumerate(patterns.items(), 1):
            tiers[pattern].append(flow.add(0, i, size))
        flow.run(0, sink)
    return {p: sum(flow.edges[e ^ 1][1] for e in es) for p, es in tiers.items()}


def word_count(text):
    """Runs of characters other than space and \\x09-\\x0D; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _targets(sizes, total, weights):
    """`targets` for a source table of any size: source_name, source_size, position, target.

    Sources at their bound are those whose bound is no more than weight * level, where level = what the others
    share / their weights. The level only rises, so each round is one sum over the sources, until no source newly
    is at its bound.
    """
    listed = F.array(*[F.lit(float(w)) for w in weights])
    placed = with_position(sizes, [F.col("source_name").asc_nulls_last()])
    table = materialise(placed.withColumn("weight", F.element_at(listed, (F.col("position") % len(weights) + 1).cast("int"))))
    bound = F.col("source_size") * MOST
    n, words, share, level = 0, 0, None, F.lit(0.0)
    budget, at_bound = 0.0, F.lit(False)
    while True:
        sums = table.agg(
            F.count(F.when(at_bound, 1)).alias("n"), F.sum("source_size").alias("words"),
            F.coalesce(F.sum(F.when(at_bound, bound)), F.lit(0)).alias("given"), F.sum(F.when(~at_bound, F.col("weight"))).alias("weight"),
        ).first()
        if share is None:
            words = sums.words or 0
            share = SHARE * total / max(1, words)
            budget = share * words
        elif sums.n == n:
            break
        n = sums.n
        if sums.weight is None:
            at_bound = F.lit(True)
            break
        left = budget - sums.given
        level = F.lit(left) * F.col("weight") / F.lit(sums.weight)
        at_bound = level >= bound
    return materialise(table.withColumn("target", F.when(at_bound, bound.cast("double")).otherwise(level)))


def _route_group(group):
    """The flow of one group of connected sources: a row per pattern, and one without size per source's quota."""
    rows = group[group["size"].notna()].sort_values("pattern")
    # Sources by position: null is a source like any other.
    patterns = {tuple(p): int(n) for p, n in zip(rows["places"], rows["size"], strict=True)}
    quotas = {int(p[0]): q for p, q in zip(group["places"], group["quota"], strict=True) if q == q and q is not None}
    taken = route(patterns, quotas)
    return pd.DataFrame({"pattern": rows["pattern"].to_numpy(), "pattern_take": [taken[p] for p in patterns]})


def _plan(patterns, weights):
    """Pattern table (pattern, members, size) -> per pattern: size and words to take, and per source: size and target.

    A source that is in no pattern with another one takes its quota or all it has MOST times, by a join. Connected
    sources are routed together with all their patterns, each group in a task.
    """
    parts = materialise(patterns.select("pattern", "size", F.explode("members").alias("source_name")))
    sizes = parts.groupBy("source_name").agg(F.sum("size").alias("source_size"))
    total = patterns.agg(F.sum("size")).first()[0] or 0
    table = _targets(sizes, total, weights)
    placed = materialise(
        parts.withColumnRenamed("source_name", "s").join(table.select("source_name", "position", F.rint("target").cast("long").alias("quota")), F.expr("s <=> source_name"))
        .select("pattern", "size", "position", "quota")
    )
    shared = placed.groupBy("pattern").agg(F.min("position").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("pattern", "a")
    groups = materialise(components(placed.join(shared, "pattern").select("a", F.col("position").alias("b"))))
    lone = placed.join(groups, F.col("position") == F.col("node"), "left_anti").select(
        "pattern", F.col("size").alias("pattern_size"), F.least(F.col("size") * MOST, "quota").alias("pattern_take")
    )
    grouped = materialise(placed.join(groups, F.col("position") == F.col("node")).drop("node"))
    offers = grouped.groupBy("component", "pattern").agg(
        F.array_sort(F.collect_list("position")).alias("places"), F.first("size").cast("double").alias("size"), F.lit(None).cast("double").alias("quota")
    )
    wanted = grouped.groupBy("component", "position").agg(F.first("quota").cast("double").alias("quota")).select(
        "component", F.lit(None).cast("string").alias("pattern"), F.array("position").alias("places"), F.lit(None).cast("double").alias("size"), "quota"
    )
    ship_package(patterns.sparkSession)
    routed = offers.union(wanted).groupBy("component").applyInPandas(_route_group, "pattern string, pattern_take long")
    together = routed.join(patterns.select("pattern", F.col("size").alias("pattern_size")), "pattern").select("pattern", "pattern_size", "pattern_take")
    return materialise(lone.union(together)), table.select("source_name", "source_size", "target")


def _drawn(rows, seed):
    """Rows with the pattern's key and the seeded draw, whose top bits name one of 4,096 buckets."""
    return (
        rows.withColumn("pattern", F.to_json("members")).withColumn("draw", F.xxhash64("doc_id", "size", F.lit(seed)))
        .withColumn("bucket", F.pmod(F.shiftright("draw", 20), F.lit(BUCKETS)))
    )


def repetitions(rows, sized, weights=WEIGHTS, seed=SEED):
    """`rows` (doc_id, size, members, anything else) with source_size, target and times (0, 1 or 2).

    `sized` is the same rows' written doc_id, size and members. Documents are aggregated by membership pattern
    (the sorted array of sources); `_plan` says how many words each pattern gives, for any number of patterns and sources. All its documents are taken as
    often as goes into that; for the rest they come in the order of a seeded hash, up to the one whose middle
    passes the amount. To find that place without ordering a source in one task, the words per bucket of the hash
    range are summed first, and only the bucket that holds the place is ordered.
    """
    drawn = _drawn(sized, seed)
    sums = materialise(drawn.groupBy("pattern", "members", "bucket").agg(F.sum("size").alias("words")))
    patterns = materialise(sums.groupBy("pattern", "members").agg(F.sum("words").alias("size")))
    plan, table = _plan(patterns, weights)
    before = F.sum("words").over(Window.partitionBy("pattern").orderBy("bucket")) - F.col("words")
    cuts = (
        sums.withColumn("before", before)
        .join(plan, "pattern")
        .withColumn("base", F.expr("if(pattern_size > 0, pattern_take div pattern_size, 0)"))
        .withColumn("rest", F.expr("pattern_take - base * pattern_size"))
        .groupBy("pattern").agg(
            F.first("base").alias("base"), F.first("rest").alias("rest"),
            F.max(F.expr("if(before <= rest, struct(bucket, before), null)")).alias("cut"),
        )
        .select("pattern", "base", "rest", F.col("cut.bucket").alias("cut"), F.col("cut.before").alias("before"))
    )
    # One row per pattern, with what its documents show of their first source: broadcast only while it is small.
    first = patterns.select("pattern", F.expr("members[0]").alias("s")).join(table, F.expr("s <=> source_name"))
    facts = materialise(cuts.join(first.select("pattern", "source_size", "target"), "pattern"))
    placed = _drawn(rows, seed).join(facts, "pattern")
    order = Window.partitionBy("pattern").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    at_cut = placed.filter("bucket = cut").withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    picked = at_cut.withColumn("extra", F.expr("if(2 * ahead + size <= 2 * rest, 1, 0)")).drop("ahead")
    others = placed.filter("bucket <> cut").withColumn("extra", F.expr("if(bucket < cut, 1, 0)"))
    return picked.unionByName(others).withColumn("times", F.expr("if(size = 0, 0, least(base + extra, 2))"))


def _sized(docs, members):
    listed = F.array(F.col("source").cast("string")) if members is None else F.array_sort(F.array_distinct(F.col(members)))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text")).alias("size"), listed.alias("members"))


def mix(docs, weights=WEIGHTS, seed=SEED, members=None):
    """Row per document: doc_id, size, source_size, target, taken.

    `members`: column with a document's array of sources; by default its `source` alone. Size: words of the text
    (null: 0). Sources by code point, null last, weigh `weights`, repeating. A document of several sources shows
    the first one's source_size and target. `taken` is 0, 1 or 2 times the size: whole documents only. Each
    pattern's taken words differ from what the flow gives it by at most half a document.

    Null source: a source of its own. Null doc_id and repeated rows: each row is a document. Documents without
    words: taken 0. An empty table gives an empty result; other columns are ignored. Reruns agree: the draw
    hashes doc_id, size and the seed.
    """
    sized = materialise(_sized(docs, members))
    mixed = repetitions(sized, sized, weights, seed)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).cast("long").alias("taken"))


def mixed_documents(docs, weights=WEIGHTS, seed=SEED):
    """The rows of `docs`, all columns, each as often as the mix takes it (documents without words stay once)."""
    whole = docs.select(F.struct("*").alias("row"), "doc_id", "text", "source")
    rows = whole.select("row", F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text")).alias("size"), F.array(F.col("source").cast("string")).alias("members"))
    sized = materialise(rows.drop("row"))
    copies = F.expr("array_repeat(row, if(size = 0, 1, cast(times as int)))")
    return repetitions(rows, sized, weights, seed).select(F.explode(copies).alias("row")).select("row.*")
