"""Exact top-k by inner product: dual-tree search over cover trees of query blocks and data blocks."""

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import materialise, ship_package

BLOCK = 4096
QUERY_BLOCK = 1024
LEAF = 24
#: Data leaves a query leaf meets before its worst kth score is looked at again; doubles from there.
FIRST_LEAVES = 32
SHRINK = 0.7
EXACT = 2.0**53
#: Below every score; no score yet.
NONE = np.int64(1 - 2**63)

RESULT = "query_id long, vec_id long, score long"


class CoverTree:
    """Nested balls around points of a block. Each level's radius is SHRINK times the one above.

    A node's centre is one of its points; its children's centres lie in it, further apart from one another than the
    children's radius, and every point of the node is within that radius of the child it belongs to. `radius` holds
    the true distance to the furthest point (the covering radius). Nodes of LEAF points or less, or of one distinct
    point, are leaves. `order` lists the points so that a node owns order[start:end].
    """

    def __init__(self, points):
        self.points = points
        self.order = np.arange(len(points))
        self.center, self.radius, self.start, self.end, self.children = [], [], [], [], []
        if len(points):
            away = self._distance(0, self.order)
            self._grow(self.order, away)
        self.center, self.start, self.end = (np.array(x, np.int64) for x in (self.center, self.start, self.end))
        self.radius = np.array(self.radius, np.float64)

    def _distance(self, center, members):
        gap = self.points[members] - self.points[center]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def _grow(self, members, away):
        """Depth first, so that a subtree's points stand together: lays out `order` as it goes."""
        layout, stack = [], [(members, away, None)]
        while stack:
            members, away, parent = stack.pop()
            node = len(self.center)
            self.center.append(int(members[np.argmin(away)]))
            self.radius.append(float(away.max()))
            self.children.append([])
            if parent is not None:
                self.children[parent].append(node)
            self.start.append(None)
            self.end.append(None)
            if len(members) <= LEAF or self.radius[node] == 0.0:
                layout.append((node, members))
                continue
            parts = self._split(members, away, self.radius[node] * SHRINK)
            stack += [(m, a, node) for m, a in parts]
        at = 0
        for node, members in layout:
            self.order[at : at + len(members)] = members
            self.start[node], self.end[node] = at, at + len(members)
            at += len(members)
        for node in range(len(self.center) - 1, -1, -1):
            for c in self.children[node]:
                self.start[node] = self.start[c] if self.start[node] is None else min(self.start[node], self.start[c])
                self.end[node] = self.end[c] if self.end[node] is None else max(self.end[node], self.end[c])

    def _split(self, members, away, radius):
        parts = []
        while len(members):
            near = away <= radius
            parts.append((members[near], away[near]))
            members = members[~near]
            if len(members):
                away = self._distance(members[0], members)
        return parts


def _bounds(queries, data, q, x, q_norm):
    """Largest inner product any pair of points of the node pairs can have, rounded up."""
    qc, xc = queries.center[q], data.center[x]
    mid = np.einsum("ij,ij->i", queries.points[qc], data.points[xc])
    x_norm = np.sqrt(np.einsum("ij,ij->i", data.points[xc], data.points[xc]))
    bound = mid + q_norm[q] * data.radius[x] + x_norm * queries.radius[q] + queries.radius[q] * data.radius[x]
    return bound + 1e-9 * (np.abs(mid) + (q_norm[q] + queries.radius[q]) * (x_norm + data.radius[x])) + 1e-6


class DualTree:
    """The k best of a data block for every query of a query block. Scores descend, ties go to the smaller vec_id.

    Pairs of nodes are taken level by level; a pair goes when even its bound is below the worst kth score of the
    queries in its query node. A query leaf meets data leaves in the order of falling bounds, so that kth scores rise
    early and the rest can go.
    """

    def __init__(self, query_ids, queries, vec_ids, vectors, k):
        self.q_ids, self.x_ids, self.k = query_ids, vec_ids, k
        self.q, self.x = CoverTree(queries), CoverTree(vectors)
        most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1]
        self.whole = most < EXACT
        self.q_norm = np.sqrt(np.einsum("ij,ij->i", queries, queries))[self.q.center]
        self.score = np.full((len(queries), k), NONE)
        self.best = np.full((len(queries), k), -1, np.int64)

    def _products(self, q, x):
        if self.whole:
            return (self.q.points[q] @ self.x.points[x].T).astype(np.int64)
        return self.q.points[q].astype(np.int64) @ self.x.points[x].astype(np.int64).T

    def _leaves(self, qn, xns):
        """Scores of a query leaf against the points of several data leaves."""
        q = self.q.order[self.q.start[qn] : self.q.end[qn]]
        x = np.concatenate([self.x.order[a:b] for a, b in zip(self.x.start[xns].tolist(), self.x.end[xns].tolist(), strict=True)])
        found = self._products(q, x)
        ids = np.broadcast_to(self.x_ids[x], found.shape)
        found = np.where(ids == self.q_ids[q][:, None], NONE, found)
        score = np.concatenate((self.score[q], found), axis=1)
        ids = np.concatenate((self.best[q], ids), axis=1)
        pick = np.lexsort((ids, -score), axis=1)[:, : self.k]
        self.score[q] = np.take_along_axis(score, pick, 1)
        self.best[q] = np.take_along_axis(ids, pick, 1)

    def _worst(self, nodes):
        kth = self.score[:, -1][self.q.order]
        return np.minimum.reduceat(np.append(kth, -NONE), np.column_stack((self.q.start[nodes], self.q.end[nodes])).ravel())[::2]

    def run(self):
        """(query_id, vec_id, score) of everything found."""
        if len(self.q_ids) and len(self.x_ids):
            self._descend()
        row, place = np.nonzero(self.score > NONE)
        return self.q_ids[row], self.best[row, place], self.score[row, place]

    def _descend(self):
        pairs, leaves = (np.zeros(1, np.int64), np.zeros(1, np.int64)), []
        q_leaf = np.array([not c for c in self.q.children])
        x_leaf = np.array([not c for c in self.x.children])
        while len(pairs[0]):
            q, x = pairs
            bound = _bounds(self.q, self.x, q, x, self.q_norm)
            keep = bound >= self._worst(q)
            q, x, bound = q[keep], x[keep], bound[keep]
            both = q_leaf[q] & x_leaf[x]
            leaves.append((bound[both], q[both], x[both]))
            q, x = q[~both], x[~both]
            split_q = x_leaf[x] | (~q_leaf[q] & (self.q.radius[q] > self.x.radius[x]))
            nq, nx = [], []
            for side, other, chosen, tree, out, rest in (
                (q, x, split_q, self.q, nq, nx), (x, q, ~split_q, self.x, nx, nq)
            ):
                kids = [tree.children[n] for n in side[chosen].tolist()]
                out.append(np.array([c for ks in kids for c in ks], np.int64))
                rest.append(np.repeat(other[chosen], [len(ks) for ks in kids]).astype(np.int64))
            pairs = np.concatenate(nq), np.concatenate(nx)
        bound, q, x = (np.concatenate(c) for c in zip(*leaves, strict=True))
        order = np.lexsort((-bound, q))
        bound, q, x = bound[order], q[order], x[order]
        cuts = np.flatnonzero(np.r_[True, q[1:] != q[:-1], True])
        for at, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            node, step = int(q[at]), FIRST_LEAVES
            while at < end:
                upto = min(end, at + step)
                live = bound[at:upto] >= self._worst(q[at : at + 1])[0]
                if not live.any():
                    break
                self._leaves(node, x[at:upto][live])
                at, step = upto, 2 * step


def _search(group, k):
    is_query = group["is_query"].to_numpy(bool)
    ids = group["vec_id"].to_numpy(np.int64)
    vectors = np.stack([np.frombuffer(v, np.float64) for v in group["vector"]]) if len(group) else np.empty((0, 1))
    q, v, s = DualTree(ids[is_query], vectors[is_query], ids[~is_query], vectors[~is_query], k).run()
    return pd.DataFrame({"query_id": q, "vec_id": v, "score": s})


def _quantise_batches(batches, scale):
    for batch in batches:
        ids, out, size = [], [], []
        for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
            if vec_id is None or not vector or any(c is None for c in vector):
                continue
            x = np.floor(scale * np.array(vector, np.float64))
            if np.isfinite(x).all():
                ids.append(vec_id)
                out.append(x.tobytes())
                size.append(len(vector))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(out, pa.binary()), pa.array(size, pa.int32())], names=["vec_id", "vector", "size"]
        )


def top_k(embeddings, k=5, every=50, scale=256):
    """Row per query and place: query_id, rank (from 1), vec_id, score; the k best inner products of whole numbers.

    Components become floor(scale * x) in double precision. Queries are the rows whose vec_id is divisible by
    `every`; candidates are all rows but those of the query's own vec_id; ties go to the smaller vec_id.

    Both sides are cut into blocks of bounded size by a hash of vec_id. Each pair of a query block and a data block
    is one group: its task builds a cover tree of either side and searches them together. Blocks' best k are
    ranked per query. No key is hot: blocks are dealt by hash, whatever the vectors.

    Vectors that are null or empty or hold null or non-finite components, and null ids, take no part; vectors only
    meet those of their own length. Repeated rows are candidates once each; rows of a query's vec_id are one query
    per row and tie as such. Fewer than k candidates: all of them. An empty table gives an empty result; other
    columns are ignored.
    """
    ship_package(embeddings.sparkSession)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    vectors = materialise(
        rows.mapInArrow(functools.partial(_quantise_batches, scale=scale), "vec_id long, vector binary, size int")
    )
    is_query = F.col("vec_id") % every == 0
    n_all, n_query = vectors.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    data_blocks, query_blocks = max(1, -(-n_all // BLOCK)), max(1, -(-n_query // QUERY_BLOCK))
    spread = lambda salt, n: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n))
    data = vectors.withColumn("x", spread("x", data_blocks)).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = (
        vectors.filter(is_query).dropDuplicates(["vec_id", "vector"])
        .withColumn("q", spread("q", query_blocks)).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(data_blocks - 1))))
    )
    columns = [F.col("size"), F.col("q").cast("long").alias("q"), F.col("x").cast("long").alias("x"), F.col("vec_id"), F.col("vector")]
    groups = data.select(*columns, F.lit(False).alias("is_query")).union(queries.select(*columns, F.lit(True).alias("is_query")))
    found = groups.groupBy("size", "q", "x").applyInPandas(lambda group: _search(group, k), RESULT)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
