"""Ranks, running totals and exact quantiles over a whole table, with no single-task window.

All of them range-partition the rows on a total order, write that placement once (range bounds
are sampled, so a second evaluation could place rows differently) and add each partition's
offset. Only one row per partition reaches the driver.
"""

import math
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..storage import materialise

# monotonically_increasing_id() keeps the row's place in its partition in the low 33 bits.
_PLACE_BITS = 33
# Values with more than 1 / HOT_VALUES of the rows are looked up by broadcast; there are at most so many.
HOT_VALUES = 1000
# Accuracy of the approximate percentiles around a quantile; distinct values that are fetched from between them.
BRACKET, INSIDE = 10_000, 100_000


def _placed(df, order, partitions=None):
    """`df` in range partitions, each row with its partition (_part) and place in it (_slot)."""
    ranges = order if partitions is None else (partitions, *order)
    ordered = df.repartitionByRange(*ranges).sortWithinPartitions(*order)
    ordered = ordered.withColumn("_slot", F.monotonically_increasing_id())
    return materialise(ordered).withColumn("_part", F.shiftright("_slot", _PLACE_BITS))


def _offsets(parts, names):
    """Broadcastable table of what lies before each partition, per summed column."""
    rows = sorted(parts.collect(), key=lambda row: row["_part"])
    before = {n: [0, *accumulate(row[n] for row in rows)][: len(rows)] for n in names}
    columns = {"_part": [row["_part"] for row in rows]} | {f"_before_{n}": before[n] for n in names}
    # From Arrow the rows are a local table; from a list they would pass through Python workers of their own.
    data = pa.table({name: pa.array(values, pa.int64()) for name, values in columns.items()})
    return F.broadcast(parts.sparkSession.createDataFrame(data))


def with_position(df, order, name="position", partitions=None):
    """Add each row's 0-based position in the total order `order` (columns or sort expressions).

    With `partitions`, the rows are written by so many tasks.
    """
    placed = _placed(df, order, partitions)
    offsets = _offsets(placed.groupBy("_part").agg(F.count("*").alias("n")), ["n"])
    place = F.col("_slot").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        placed.join(offsets, "_part")
        .withColumn(name, F.col("_before_n") + place)
        .drop("_part", "_slot", "_before_n")
    )


def with_running_totals(df, order, totals):
    """Add inclusive running sums in the total order; `totals` maps new name -> integer column."""
    placed = _placed(df, order)
    sums = [F.sum(column).cast("long").alias(name) for name, column in totals.items()]
    offsets = _offsets(placed.groupBy("_part").agg(*sums), list(totals))
    inside = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.join(offsets, "_part")
        .withColumns({n: F.col(f"_before_{n}") + F.sum(c).over(inside) for n, c in totals.items()})
        .drop("_part", "_slot", *[f"_before_{n}" for n in totals])
    )


def with_rank(df, order, by=(), rank="rank", size="group_rows"):
    """Add the 1-based rank in `order` inside each `by` group and the group's row count.

    `by` must have few groups (splits, models); their rows may be any number.
    """
    placed = with_position(df, [F.col(c) for c in by] + list(order), "_position")
    groups = placed.groupBy(*by).agg(F.min("_position").alias("_first"), F.count("*").alias(size))
    joined = join_groups(placed, groups, by)
    return joined.withColumn(rank, F.col("_position") - F.col("_first") + 1).drop("_position", "_first")


def join_groups(df, groups, by):
    """Attach per-group facts (few groups); without `by`, the facts are one row."""
    if by:
        return df.join(F.broadcast(groups), list(by))
    return df.withColumn("_facts", groups.select(F.struct("*")).scalar()).select("*", "_facts.*").drop("_facts")


def with_percentile(df, score, by=(), name="risk_percentile"):
    """Average rank of the score divided by the row count (ties share their mean rank).

    Equal scores are counted before they move. Scores that hold a large share of the rows are looked up in a broadcast
    of at most HOT_VALUES rows, in place; no other score has more than 1 / HOT_VALUES of the rows, so the shuffled
    lookup of the rest has no hot key.
    """
    keys = [*by, score]
    scores = df.where(F.col(score).isNotNull()).groupBy(*keys).agg(F.count("*").alias("_ties"))
    running = with_running_totals(scores, [F.col(k) for k in keys], {"_upto": F.col("_ties")})
    groups = running.groupBy(*by).agg(
        F.min(F.col("_upto") - F.col("_ties")).alias("_below"), F.sum("_ties").alias("_rows")
    )
    pct = (F.col("_upto") - F.col("_below") - (F.col("_ties") - 1) / F.lit(2.0)) / F.col("_rows")
    lookup = materialise(join_groups(running, groups, by).select(*keys, "_ties", pct.alias(name)))
    floor = lookup.agg(F.sum("_ties") / F.lit(HOT_VALUES)).scalar()
    hot = F.broadcast(lookup.where(F.col("_ties") > floor).select(*keys, name))
    rest = lookup.where(F.col("_ties") <= floor).select(*keys, name)
    placed = df.join(hot, keys, "left")
    # A null score has no percentile, hence the left join.
    others = placed.where(F.col(name).isNull()).drop(name).join(rest, keys, "left")
    return placed.where(F.col(name).isNotNull()).unionByName(others)


def _blend(low, high, fraction):
    """Linear interpolation, computed from the nearer end."""
    return low + (high - low) * fraction if fraction < 0.5 else high - (high - low) * (1 - fraction)


class _Bracket:
    """Bounds around the two values a quantile lies between; no bounds at first."""

    def __init__(self, name, p):
        self.name, self.p = name, p
        self.low = self.high = self.total = self.rows = self.values = None
        self.below = 0

    def places(self):
        """The 0-based places of the two values, and how far the quantile is from the first to the second."""
        at = (self.total - 1) * self.p
        return math.floor(at), math.ceil(at), at - math.floor(at)

    def holds(self, column):
        """Whether a value lies between the bounds."""
        fits = column.isNotNull()
        fits = fits if self.low is None else fits & (column >= self.low)
        return fits if self.high is None else fits & (column <= self.high)

    def shares(self):
        """Probabilities, inside the present bounds, between which both places are sure to lie."""
        margin = 3 / BRACKET
        if self.total is None:
            low = high = self.p
        else:
            first, second, _ = self.places()
            low, high = (first - self.below) / self.rows, (second - self.below + 1) / self.rows
        return [max(0.0, low - margin), min(1.0, high + margin)]

    def value(self):
        """From the (value, count) pairs inside the bounds."""
        first, second, fraction = self.places()
        passed, found = self.below, {}
        for value, n in sorted(self.values):
            for place in (first, second):
                if passed <= place < passed + n:
                    found[place] = value
            passed += n
        return _blend(found[first], found[second], fraction)


def _narrow(values, brackets):
    """Tighter bounds for each bracket, by approximate percentiles of the rows inside it; none where the rows are few."""
    wanted = []
    for i, b in enumerate(brackets):
        column = F.col(f"`{b.name}`")
        inside = F.when(b.holds(column), column)
        wanted += [F.count(inside), F.percentile_approx(inside, b.shares(), BRACKET)]
    facts = list(values.agg(*[c.alias(f"_{i}") for i, c in enumerate(wanted)]).first())
    for b, rows, bounds in zip(brackets, facts[::2], facts[1::2], strict=True):
        b.total = rows if b.total is None else b.total
        b.rows = rows
        if rows > INSIDE:
            b.low, b.high = bounds


def _count_inside(values, brackets):
    """Count the rows below each bracket and the distinct values in it; fetch those that are few."""
    cells = []
    for i, b in enumerate(brackets):
        column = F.col(f"`{b.name}`")
        below = F.lit(False) if b.low is None else column < b.low
        cell = F.struct(F.lit(i).alias("i"), below.alias("below"), F.when(~below, column).alias("value"))
        cells.append(F.when(below | b.holds(column), cell))
    counted = values.select(F.inline(F.array_compact(F.array(*cells)))).groupBy("i", "below", "value").agg(F.count("*").alias("n"))
    counted = materialise(counted)
    for row in counted.groupBy("i", "below").agg(F.sum("n").alias("rows"), F.count("*").alias("distinct")).collect():
        b = brackets[row["i"]]
        if row["below"]:
            b.below = row["rows"]
        else:
            b.rows, b.distinct = row["rows"], row["distinct"]
    few = [i for i, b in enumerate(brackets) if b.distinct <= INSIDE]
    fetched = {i: [] for i in few}
    for row in counted.where(F.col("i").isin(few) & ~F.col("below")).collect():
        fetched[row["i"]].append((row["value"], row["n"]))
    for i, pairs in fetched.items():
        brackets[i].values = pairs


def quantiles(df, wanted):
    """Exact quantiles with linear interpolation, nulls ignored, for any number of distinct values.

    `wanted` maps column -> list of probabilities. Gives rows (column, p, value); a column with no values gives none.
    Nothing is sorted as a whole: approximate percentiles bracket each quantile, rows below the bracket are counted, and
    only the distinct values inside, INSIDE at most, are fetched with their counts; a bracket that holds more is narrowed
    again. Each round is two aggregates of the table, which is read as it is, so hand in a written one if it is costly.
    """
    values = df.select([F.col(f"`{n}`").cast("double").alias(n) for n in wanted])
    brackets = [_Bracket(n, float(p)) for n, ps in wanted.items() for p in ps]
    _narrow(values, brackets)
    brackets = [b for b in brackets if b.rows]
    open_ = brackets
    while open_:
        _count_inside(values, open_)
        open_ = [b for b in open_ if b.values is None]
        if open_:
            _narrow(values, open_)
    data = [(b.name, b.p, b.value()) for b in brackets]
    return df.sparkSession.createDataFrame(data, "column string, p double, value double")


def quantile(df, column, p):
    """One-row frame (value) with one exact quantile; null for a column without values."""
    return quantiles(df, {column: [p]}).agg(F.max("value").alias("value"))
