"""Hard negatives by inner product: cover trees over norm-augmented candidates, in blocks.

A candidate x gets one more component ``sqrt(M^2 - |x|^2)`` (M: the largest norm of its block),
which puts all candidates of a block on one sphere, where a nearer point is one of larger inner
product with the anchor (0 in that component). Over these points a cover tree is built level by
level: the children of a node are centres that cover its points at half the radius and lie
farther apart than that; every node keeps the true covering radius R of its points. The inner
product of an anchor q with any point of a node lies within ``q.c - |q| R .. q.c + |q| R``.

The descent is best-first: the open nodes of largest upper bound are opened next; nodes whose
bounds lie outside of the window of scores, or below the worst of the rows found so far when
those are complete, are skipped; rows of leaves are verified with exact integers.

Layout. Candidates are dealt to blocks of bounded size, anchors to slices of bounded size, and
each (block, slice) is one small group. Each block gives its first rows per anchor, and the
first of these over all blocks are the result. Equal vectors of one label are cut to the few
of smallest id that any result can name, before they are dealt out.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.base import materialize

LEAST_BLOCK, MOST_BLOCK = 2048, 16384    # candidates in a block
SLICE = 4096                             # anchors in a slice
LEAF = 8                                 # points up to which a node is not divided
OPEN = 64                                # nodes opened at once
EXACT = 2.0 ** 52


class Tree:
    """A cover tree over the rows of an integer matrix, its nodes in arrays."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        x = rows.astype(np.float64)
        square = np.einsum("ij,ij->i", x, x)
        most = square.max(initial=0.0)
        self.points = np.concatenate([x, np.sqrt(np.maximum(most - square, 0.0))[:, None]], axis=1)
        self.slack = 1e-9 * (most + 1.0)    # rounding of bounds, as a score
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.inner: list[np.ndarray | None] = []    # children of a node, or
        self.leaf: list[np.ndarray | None] = []     # the points of a leaf
        everything = np.arange(len(rows))
        self.root = self._node(0, everything)
        level = [(self.root, everything, self.radius[self.root])]
        while level:
            level = [x for node, members, r in level for x in self._divide(node, members, r / 2)]
        self.centre_of = np.array(self.centre)
        self.radius_of = np.array(self.radius)

    def _node(self, centre: int, members: np.ndarray) -> int:
        far = self.points[members] - self.points[centre]
        self.centre.append(centre)
        self.radius.append(math.sqrt(np.einsum("ij,ij->i", far, far).max(initial=0.0)))
        self.inner.append(None)
        self.leaf.append(members)
        return len(self.centre) - 1

    def _divide(self, node: int, members: np.ndarray, r: float) -> list[tuple[int, np.ndarray, float]]:
        """Cover the node's points with radius ``r``; the children that can be divided further."""
        if len(members) <= LEAF or self.radius[node] <= 0:
            return []
        r = min(r, self.radius[node] / 2)
        centres, owner = self._cover(members, r)
        order = np.argsort(owner, kind="stable")
        parts = np.split(members[order], np.flatnonzero(np.diff(owner[order])) + 1)
        children = [self._node(int(c), part) for c, part in zip(centres, parts, strict=True)]
        self.inner[node], self.leaf[node] = np.array(children), None
        return [(c, part, r) for c, part in zip(children, parts, strict=True)]

    def _cover(self, members: np.ndarray, r: float, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Centres farther than ``r`` apart that cover ``members``, and each member's centre."""
        pts = self.points[members]
        square = np.einsum("ij,ij->i", pts, pts)
        chosen: list[int] = []
        owner = np.full(len(members), -1)
        for a in range(0, len(members), step):
            b = min(a + step, len(members))
            if chosen:
                had = np.array(chosen)
                d2 = square[a:b, None] + square[had] - 2 * pts[a:b] @ pts[had].T
                near = d2.argmin(axis=1)
                covered = d2[np.arange(b - a), near] <= r * r
                owner[a:b][covered] = near[covered]
            within = square[a:b, None] + square[a:b] - 2 * pts[a:b] @ pts[a:b].T <= r * r
            for i in range(b - a):
                if owner[a + i] < 0:
                    chosen.append(a + i)
                    owner[a:b][within[i] & (owner[a:b] < 0)] = len(chosen) - 1
                    owner[a + i] = len(chosen) - 1
        return members[np.array(chosen)], owner

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact inner products of rows with an integer vector."""
        part = self.rows[at]
        if np.abs(part).max(initial=0) * float(np.abs(q).max(initial=0)) * max(len(q), 1) < EXACT:
            return (part.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        return part.astype(object) @ q.astype(object)

    def bounds(self, nodes: np.ndarray, q: np.ndarray, length: float) -> tuple[np.ndarray, np.ndarray]:
        mid = self.points[self.centre_of[nodes], :-1] @ q
        wide = self.radius_of[nodes] * length * (1 + 1e-9) + self.slack
        return mid - wide, mid + wide

    def first(self, q: np.ndarray, ids: np.ndarray, wanted: np.ndarray, most: int,
              low: float = -math.inf, high: float = math.inf, start=None) -> list[tuple[int, int, int]]:
        """The first ``most`` rows by (score descending, id) with ``low <= score <= high`` among
        those ``wanted``: (score, -id, row). ``start``: the root's children with their bounds."""
        x = q.astype(np.float64)
        length = math.sqrt(x @ x)
        nodes, under, over = start if start is not None else self.open_root(x, length)
        found: list = []        # a heap of the best rows, the worst first
        while len(nodes):
            worst = found[0][0] if len(found) == most else -math.inf
            keep = (over >= max(low, worst)) & (under <= high)
            nodes, under, over = nodes[keep], under[keep], over[keep]
            if not len(nodes):
                break
            best = np.argpartition(-over, OPEN)[:OPEN] if len(nodes) > OPEN else np.arange(len(nodes))
            opened, rest = nodes[best], np.ones(len(nodes), bool)
            rest[best] = False
            nodes, under, over = nodes[rest], under[rest], over[rest]
            points = [self.leaf[n] for n in opened if self.leaf[n] is not None]
            if points:
                at = np.concatenate(points)
                at = at[wanted[at]]
                s = self.scores(at, q)
                ok = (s >= low) & (s <= high)
                for row in zip(s[ok].tolist(), (-ids[at[ok]]).tolist(), at[ok].tolist(), strict=True):
                    if len(found) < most:
                        heapq.heappush(found, row)
                    elif row > found[0]:
                        heapq.heapreplace(found, row)
            inner = [self.inner[n] for n in opened if self.inner[n] is not None]
            if inner:
                more = np.concatenate(inner)
                lo, hi = self.bounds(more, x, length)
                nodes, under, over = np.concatenate([nodes, more]), np.concatenate([under, lo]), np.concatenate([over, hi])
        return sorted(found, reverse=True)

    def open_root(self, x: np.ndarray, length: float):
        top = self.inner[self.root]
        top = np.array([self.root]) if top is None else top
        return (top, *self.bounds(top, x, length))


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dims).astype(np.int64)


def _by_size(column: pa.ChunkedArray) -> dict[int, np.ndarray]:
    sizes = np.array(column.combine_chunks().value_lengths().to_pylist(), np.int64)
    return {int(d): np.flatnonzero(sizes == d) for d in np.unique(sizes)}


def _pairs(cands: pa.Table, anchors: pa.Table) -> Iterator[tuple[Tree, dict, pa.Table, np.ndarray]]:
    """Trees of the block, one for each vector length, with the anchors of that length."""
    mine = _by_size(cands.column("vector"))
    for dims, at in _by_size(anchors.column("vector")).items():
        if dims in mine:
            rows = cands.take(pa.array(mine[dims]))
            tree = Tree(_matrix(rows.column("vector"), dims))
            info = {"id": rows.column("vec_id").to_numpy(), "label": rows.column("label").to_numpy()}
            some = anchors.take(pa.array(at))
            yield tree, info, some, _matrix(some.column("vector"), dims)


def _positives(most: int):
    schema = pa.schema([("anchor_id", pa.int64()), ("anchor", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(cands: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if len(cands) and len(anchors):
            for tree, info, some, vectors in _pairs(cands, anchors):
                ids, labels = some.column("vec_id").to_pylist(), some.column("label").to_pylist()
                for k, (q, key) in enumerate(zip(vectors, some.column("anchor").to_pylist(), strict=True)):
                    wanted = info["label"] == labels[k]
                    same = np.flatnonzero(wanted & (info["id"] == ids[k]))
                    wanted[same[(tree.rows[same] == q).all(axis=1)]] = False     # the anchor itself
                    out.extend((ids[k], key, -i, s) for s, i, _ in tree.first(q, info["id"], wanted, most))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, schema.types)], schema=schema)
    return run


def _negatives(most: int, low: int, high: int):
    schema = pa.schema([("anchor_id", pa.int64()), ("anchor", pa.int64()), ("place", pa.int32()), ("positive_id", pa.int64()),
                        ("positive_score", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(cands: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if len(cands) and len(anchors):
            for tree, info, some, vectors in _pairs(cands, anchors):
                ids, labels = some.column("vec_id").to_pylist(), some.column("label").to_pylist()
                keys, windows = some.column("anchor").to_pylist(), some.column("positives").to_pylist()
                for k, q in enumerate(vectors):
                    wanted = info["label"] != labels[k]
                    x = q.astype(np.float64)
                    start = tree.open_root(x, math.sqrt(x @ x))
                    for p in windows[k]:
                        # low * p <= 100 * score <= high * p, in whole numbers
                        under, over = -(-low * p["score"] // 100), high * p["score"] // 100
                        if under <= over:
                            out.extend((ids[k], keys[k], p["place"], p["vec_id"], p["score"], -i, s) for s, i, _ in
                                       tree.first(q, info["id"], wanted, most, under, over, start))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, schema.types)], schema=schema)
    return run


def quantise(vector: Column, scale: int) -> Column:
    """Whole numbers ``floor(scale * x)``; NULL for a null vector and for one with a component
    that is null or not finite."""
    x = F.transform(vector, lambda c: c.cast("double"))
    good = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return F.when(good, F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long")))


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of its label: the first
    ``negatives`` rows of other labels whose score is ``low`` to ``high`` per cent of the
    positive's.

    ``rows``: vec_id, embedding, label; ``is_anchor`` is a condition on vec_id. Scores are
    integer inner products of the quantised vectors, higher first, ties to the smaller vec_id.
    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Edge cases: rows with a null vec_id, label or vector, or with a null or non-finite
    component, take no part; repeated rows (same vec_id, label and vector) are one row, rows of
    one vec_id that differ are rows of their own; vectors of another length have no score with
    an anchor; an empty table has no result; a score beyond 64 bits is an error; other columns
    are ignored.
    """
    spark = rows.sparkSession
    valid = materialize(
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                    quantise(F.col("embedding"), scale).alias("vector"))
        .filter("vec_id is not null and label is not null and vector is not null").distinct(), "hard-rows")
    # of equal vectors of one label only the first can be named: the positives, and the anchor itself
    order = Window.partitionBy("label", "vector").orderBy("vec_id")
    cands = materialize(valid.withColumn("n", F.row_number().over(order))
                        .filter(F.col("n") <= max(positives + 1, negatives)).drop("n"), "hard-candidates")
    anchors = valid.filter(is_anchor).withColumn("anchor", F.xxhash64("label", "vector"))
    n, n_anchors = cands.count(), anchors.count()
    share = n // (2 * spark.sparkContext.defaultParallelism)
    blocks = max(1, math.ceil(n / min(max(share, LEAST_BLOCK), MOST_BLOCK)))
    slices = max(1, math.ceil(n_anchors / SLICE))
    dealt = (cands.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks)))
             .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))))

    def meet(some: DataFrame, fn, schema: str) -> DataFrame:
        other = (some.withColumn("slice", F.pmod(F.xxhash64("vec_id", "anchor"), F.lit(slices)).cast("int"))
                 .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))
        return dealt.groupBy("block", "slice").cogroup(other.groupBy("block", "slice")).applyInArrow(fn, schema)

    key = ["anchor_id", "anchor"]
    first = lambda *by: Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id")
    best = (meet(anchors, _positives(positives), "anchor_id long, anchor long, vec_id long, score long")
            .withColumn("place", F.row_number().over(first(*key))).filter(F.col("place") <= positives))
    per = materialize(best.groupBy(*key).agg(F.collect_list(F.struct("place", "vec_id", "score")).alias("positives")),
                      "hard-positives")
    asked = anchors.join(per.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "anchor"])
    found = meet(asked, _negatives(negatives, low, high),
                 "anchor_id long, anchor long, place int, positive_id long, positive_score long, vec_id long, score long")
    return (found.withColumn("rank", F.row_number().over(first(*key, "place"))).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
