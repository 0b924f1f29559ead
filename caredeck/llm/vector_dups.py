"""Embedding near-duplicates by collision counting over sorted one-dimensional projections."""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .common import materialise, ship_package
from .components import components

THRESHOLD = 0.9
SEED = 7_919
#: Projections whose windows are counted, and the window's half width in standard deviations of a projection.
PROJECTIONS = 32
HALF_WIDTH = 0.75
#: Vectors meet in cells that about this many share; a cell's vectors are cut into tiles of at most TILE.
CELL = 2048
TILE = 1536
#: Chance that a pair at the threshold fails the count, and that it shares no cell.
MISS_COUNT = 1e-4
MISS_CELL = 1e-3


def _normal_below(x):
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def least_count(threshold=THRESHOLD, projections=PROJECTIONS, half_width=HALF_WIDTH, miss=MISS_COUNT):
    """Collisions a pair at the threshold reaches but for a chance of `miss`.

    The projections of unit vectors at cosine c on a Gaussian direction differ by a normal of variance 2 - 2c, so a
    query-centred window of half width h catches the other with p = 2 Phi(h / sqrt(2 - 2c)) - 1, and the count is
    binomial.
    """
    p = 2 * _normal_below(half_width / math.sqrt(2 - 2 * threshold)) - 1
    below, count = 0.0, 0
    while True:
        below += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if below > miss:
            return count
        count += 1


def tables_for(bits, threshold=THRESHOLD, miss=MISS_CELL):
    """Cell tables needed so that a pair at the threshold shares a cell of one but for a chance of `miss`."""
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return 1 if bits == 0 else math.ceil(math.log(miss) / math.log(1 - same))


def directions(size, tables, bits):
    """Fixed Gaussian directions: PROJECTIONS for the counts, then `bits` per table for the cells."""
    return np.random.default_rng(SEED).standard_normal((size, PROJECTIONS + tables * bits))


def _unit_batches(batches):
    for batch in batches:
        ids, out, size = [], [], []
        for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
            if vec_id is None or not vector or any(c is None for c in vector):
                continue
            x = np.array(vector, np.float64)
            top = np.abs(x).max()
            if np.isfinite(top) and top > 0:
                ids.append(vec_id)
                x = x / top
                out.append((x / np.sqrt(x @ x)).tobytes())
                size.append(len(vector))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(out, pa.binary()), pa.array(size, pa.int32())], names=["vec_id", "unit", "size"]
        )


def _cells(units, tables, bits):
    """Cell number of every vector in every table: the signs of the table's projections."""
    signs = units @ directions(units.shape[1], tables, bits)[:, PROJECTIONS:] > 0
    weights = (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(0, np.int64)
    return signs.reshape(len(units), tables, bits).astype(np.int64) @ weights


def _cell_batches(batches, tables, bits):
    for batch in batches:
        units, sizes = batch.column("unit").to_pylist(), batch.column("size").to_pylist()
        cells = [None] * len(units)
        for size in set(sizes):
            rows = [i for i, s in enumerate(sizes) if s == size]
            for i, c in zip(rows, _cells(np.stack([np.frombuffer(units[i]) for i in rows]), tables, bits).tolist(), strict=True):
                cells[i] = c
        yield pa.RecordBatch.from_arrays(
            [batch.column("rep"), batch.column("copies"), batch.column("unit"), batch.column("size"), pa.array(cells, pa.list_(pa.int64()))],
            names=["rep", "copies", "unit", "size", "cells"],
        )


def collisions(left, right, half_width=HALF_WIDTH):
    """Per pair of rows, in how many projections `right` lies in the window of `half_width` around `left`.

    Each projection of `right` is sorted; a window is a range of ranks found by bisection.
    """
    count = np.zeros((len(left), len(right)), np.int8)
    ranks = np.empty(len(right), np.int16)
    for j in range(left.shape[1]):
        order = np.argsort(right[:, j], kind="stable")
        ranks[order] = np.arange(len(right), dtype=np.int16)
        line = right[order, j]
        low = np.searchsorted(line, left[:, j] - half_width, "left").astype(np.int16)
        high = np.searchsorted(line, left[:, j] + half_width, "right").astype(np.int16)
        count += (ranks >= low[:, None]) & (ranks < high[:, None])
    return count


def _tile(group, bits, least):
    """Partial link counts and spanning links of one pair of tiles of a cell.

    A pair is judged in the first table that puts it into one cell, so nothing counts twice.
    """
    group = group.sort_values("rep", kind="stable")
    units = np.stack([np.frombuffer(u) for u in group["unit"]])
    cells = np.stack(group["cells"].to_numpy())
    reps, copies = group["rep"].to_numpy(np.int64), group["copies"].to_numpy(np.int64)
    table, i, j = (int(group[c].iloc[0]) for c in ("table", "i", "j"))
    lines = units @ directions(units.shape[1], cells.shape[1], bits)[:, :PROJECTIONS]
    first = np.flatnonzero(group["tile"].to_numpy() == i)
    second = first if i == j else np.flatnonzero(group["tile"].to_numpy() == j)
    a, b = np.nonzero(collisions(lines[first], lines[second]) >= least)
    a, b = first[a], second[b]
    if i == j:
        a, b = a[a < b], b[a < b]
    keep = []
    for at in range(0, len(a), 100_000):
        x, y = a[at : at + 100_000], b[at : at + 100_000]
        near = np.einsum("ij,ij->i", units[x], units[y]) >= THRESHOLD
        x, y = x[near], y[near]
        new = ~(cells[x, :table] == cells[y, :table]).any(axis=1)
        keep.append((x[new], y[new]))
    a = np.concatenate([k[0] for k in keep]) if keep else np.empty(0, np.int64)
    b = np.concatenate([k[1] for k in keep]) if keep else np.empty(0, np.int64)
    links = np.bincount(a, copies[b], len(reps)) + np.bincount(b, copies[a], len(reps))
    root = np.arange(len(reps))
    while True:
        least_of = root.copy()
        np.minimum.at(least_of, a, root[b])
        np.minimum.at(least_of, b, root[a])
        least_of = least_of[least_of]
        if (least_of == root).all():
            break
        root = least_of
    linked = links > 0
    return pd.DataFrame({"rep": reps[linked], "links": links[linked].astype(np.int64), "root": reps[root][linked]})


def near_duplicates(embeddings):
    """Row per vector: vec_id, n_links, component_id, kept; links are cosines of 0.9 or more, in double precision.

    Equal unit vectors are one class with a number of copies. Classes meet in cells, by the signs of a few random
    projections, in as many tables as give a pair at the threshold a shared cell but for 0.1 %; the number of signs
    grows with the logarithm of the table, so a cell stays near CELL vectors. In a cell, collisions of the
    sorted projections in query-centred windows are counted for each pair, and the pairs that reach the count
    calibrated for the threshold are verified exactly. A cell of many close vectors is cut into tiles by hash and
    every pair of tiles is a task of its own. Tasks return counts and spanning links, never pairs.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors only meet
    those of their own length. Null vec_id: no links, component_id null, kept. Repeated rows are copies of each
    other. An empty table gives an empty result; other columns are ignored.
    """
    spark = embeddings.sparkSession
    ship_package(spark)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    units = materialise(rows.mapInArrow(_unit_batches, "vec_id long, unit binary, size int"))
    classes = materialise(units.groupBy("unit", "size").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    n = classes.count()
    bits = max(0, math.ceil(math.log2(max(1, n) / CELL)))
    tables, least = tables_for(bits), least_count()

    with_cells = materialise(
        classes.select("rep", "copies", "unit", "size").mapInArrow(
            lambda batches: _cell_batches(batches, tables, bits),
            "rep long, copies long, unit binary, size int, cells array<long>",
        )
    )
    placed = with_cells.select("rep", "copies", "unit", "size", "cells", F.posexplode("cells").alias("table", "cell"))
    full = placed.groupBy("size", "table", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumn(
        "tiles", F.ceil(F.col("n") / TILE).cast("int")
    )
    # One row per cell in use, at most one per CELL / 2 vectors and table on average: joined, not broadcast by hand.
    tiled = placed.join(full.drop("n"), ["size", "table", "cell"]).withColumn("tile", F.expr("cast(pmod(xxhash64(rep, 'tile'), tiles) as int)"))
    pairs = tiled.withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)"))).select(
        "size", "table", "cell", "rep", "copies", "unit", "cells", "tile",
        F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
    )
    found = materialise(
        pairs.groupBy("size", "table", "cell", "i", "j").applyInPandas(lambda g: _tile(g, bits, least), "rep long, links long, root long")
    )
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    whole = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    judged = (
        classes.join(links, "rep", "left").join(whole.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "unit", "size", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    live = units.join(judged, ["unit", "size"]).select("vec_id", "n_links", "component_id")
    others = rows.select("vec_id").exceptAll(units.select("vec_id")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return live.union(others).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
