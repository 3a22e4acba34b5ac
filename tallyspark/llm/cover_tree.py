"""Hard negatives by maximum inner product search in cover trees.

A candidate x is given one more component, sqrt(M^2 - |x|^2), that puts all
candidates on a sphere of radius M; the inner product with a query q is then
(|q|^2 + M^2 - d^2) / 2 for the distance d to (q, 0).  A tree node covers its
points by a ball, so its covering radius bounds the inner products below it
from both sides.  Descent is best first: nodes are opened in order of their
upper bounds, nodes whose interval meets no window, or cannot beat what a window
holds already, are skipped, and the points reached are scored exactly.

The top level lies between Spark tasks: centres fitted on a bounded sample,
every row below its nearest centre, exact covering radii from one aggregation.
A query is sent only to the cells whose interval meets one of its windows.
Rows of a cell are cut evenly into blocks, queries into chunks; one task builds
a block's tree and descends it for one chunk, so both sides of a task are
bounded.  Of equal vectors with equal labels only the first rows by id can be
among the first ``k``; the others are left out before anything is cut, which
keeps a vector with very many copies from filling blocks.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.llm import common, vectors
from tallyspark.operators.sizing import lookup_join

#: Radii of the levels of a tree shrink by this factor.
BASE = 2.0
BLOCK_ROWS, CHUNK_ROWS = 2048, 2048
#: Nodes opened together.
OPENED = 32
#: Cells of a vector length at most, rows a cell should have, and distinct
#: vectors that its centres are fitted on.
MAX_CELLS, CELL_ROWS, SAMPLE_ROWS = 1024, 4 * BLOCK_ROWS, 8192
#: Bounds are widened by this share of |q|^2 + M^2 against rounding.
SLACK = 1e-9
#: Integers up to here are exact in double precision.
EXACT = float(1 << 53)
LARGEST = (1 << 63) - 1

HITS = ("a_f long, a_r long, anchor_id long, window int, positive_id long, positive_score long, vec_id long, "
        "f long, r long, score long")


# -- one block ----------------------------------------------------------------
def quantized(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), whole numbers as doubles."""
    return np.floor(scale * x)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b`` as 64-bit integers
    (those beyond count as the largest or smallest): in double precision where
    no sum can pass 2^53, else in Python integers."""
    def longest(m):
        return np.sqrt((m ** 2).sum(axis=1)).max(initial=0.0)

    if longest(a) * longest(b) < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -LARGEST, LARGEST).astype(np.int64)


def interval(score: np.ndarray, radius: np.ndarray, q2: float, m2: float) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) inner product of a query of squared norm ``q2`` with
    the points of balls on the sphere of squared radius ``m2``: ``score`` is that
    with a ball's centre."""
    d = np.sqrt(np.maximum(q2 + m2 - 2 * score.astype(np.float64), 0))
    slack = SLACK * (q2 + m2)
    bounds = (q2 + m2 - (d + radius) ** 2) / 2 - slack, (q2 + m2 - np.maximum(d - radius, 0) ** 2) / 2 + slack
    return tuple(np.clip(x, -float(LARGEST), float(LARGEST)) for x in bounds)


class CoverTree:
    """Nodes in breadth-first order; the children of a node are neighbours, its
    first child has its centre.  ``points`` are distinct rows."""

    def __init__(self, points: np.ndarray, base: float = BASE):
        n2 = (points ** 2).sum(axis=1)
        self.m2 = float(n2.max(initial=0.0))
        extra = np.sqrt(np.maximum(self.m2 - n2, 0))
        apart = points @ points.T + extra[:, None] * extra[None, :]
        apart = np.sqrt(np.maximum(2 * self.m2 - 2 * apart, 0))  # all norms are M
        centre, radius, first, count = [0], [float(apart[0].max(initial=0.0))], [0], [0]
        queue = [np.arange(len(points))]  # members of the nodes not yet opened, centre first
        for node, members in enumerate(queue):
            if len(members) == 1:
                continue
            first[node], limit, left = len(centre), radius[node] / base, members
            while len(left):
                d = apart[left[0], left]
                near = d <= limit
                near[0] = True
                if len(left) == len(members) and near.all():  # equal up to rounding
                    near[1:] = False
                centre.append(int(left[0]))
                radius.append(float(d[near].max()))
                first.append(0)
                count.append(0)
                queue.append(left[near])
                left = left[~near]
            count[node] = len(centre) - first[node]
            queue[node] = members[:0]
        self.centre, self.radius = np.array(centre), np.array(radius)
        self.first, self.count = np.array(first), np.array(count)

    def children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of ``nodes``, and which of them have a centre of their own."""
        n = self.count[nodes]
        out = np.repeat(self.first[nodes] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        own = np.ones(len(out), bool)
        own[(np.cumsum(n) - n)[n > 0]] = False
        return out, own


class Block:
    """The candidate rows of a task: distinct vectors in a tree, rows by vector."""

    def __init__(self, z, label, ids, f, r):
        points, of = np.unique(z, axis=0, return_inverse=True)
        order = np.argsort(of.ravel(), kind="stable")
        self.points, self.tree = points, CoverTree(points)
        self.label, self.ids, self.f, self.r = (c[order] for c in (label, ids, f, r))
        self.start = np.searchsorted(of.ravel()[order], np.arange(len(points) + 1))

    def rows(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, place in ``points``) of the rows that have these vectors."""
        n = self.start[points + 1] - self.start[points]
        place = np.repeat(np.arange(len(points)), n)
        return np.arange(n.sum()) + np.repeat(self.start[points] - np.cumsum(n) + n, n), place

    def search(self, q: np.ndarray, top_scores: np.ndarray, allowed, windows: list[tuple[float, float]], k: int
               ) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, scores) of each window's first ``k`` by score and id.
        ``top_scores``: q's scores with the centres below the root; ``allowed``
        says which rows count."""
        tree, q2 = self.tree, float((q ** 2).sum())
        best = [(np.zeros(0, np.int64), top_scores[:0])] * len(windows)

        def take(points, scores):
            row, place = self.rows(points)
            ok = allowed(row)
            row, own = row[ok], scores[place[ok]]
            for w, (low, high) in enumerate(windows):
                inside = (own >= low) & (own <= high)
                got = np.concatenate([best[w][0], row[inside]])
                score = np.concatenate([best[w][1], own[inside]])
                if len(got) > 4 * k:
                    near = score >= np.partition(score, len(score) - k)[len(score) - k]
                    got, score = got[near], score[near]
                first = np.lexsort((self.r[got], self.f[got], self.ids[got], -score))[:k]
                best[w] = got[first], score[first]

        def wanted(low, high):
            out = np.zeros(len(low), bool)
            for (least, most), (got, score) in zip(windows, best, strict=True):
                beat = max(least, score[-1]) if len(got) == k else least
                out |= ~(high < beat) & ~(low > most)  # a bound that is no number skips nothing
            return out

        nodes, own = (np.zeros(1, np.int64), np.ones(1, bool)) if not tree.count[0] else tree.children(np.zeros(1, int))
        take(tree.centre[nodes], top_scores)
        inner_node = tree.count[nodes] > 0
        open_ = nodes[inner_node]
        low, high = interval(top_scores[inner_node], tree.radius[open_], q2, tree.m2)
        while len(open_):
            kept = np.flatnonzero(wanted(low, high))
            if not len(kept):
                break
            kept = kept[np.argsort(-high[kept], kind="stable")]
            now, later = kept[:OPENED], kept[OPENED:]
            nodes, own = tree.children(open_[now])
            score = inner(self.points[tree.centre[nodes]], q[None, :])[:, 0]
            take(tree.centre[nodes[own]], score[own])
            deeper = tree.count[nodes] > 0
            lows, highs = interval(score[deeper], tree.radius[nodes[deeper]], q2, tree.m2)
            open_ = np.concatenate([open_[later], nodes[deeper]])
            low, high = np.concatenate([low[later], lows]), np.concatenate([high[later], highs])
        return best


def window(positive_score: int, least_percent: int) -> tuple[int, int]:
    """The scores from ``least_percent`` of a positive's score up to it."""
    return -(-least_percent * positive_score // 100), positive_score


def search_group(table: pa.Table, scale: float, k: int, least_percent: int | None) -> pa.Table:
    """``HITS`` of the asking rows of ``table`` among its other rows: without
    ``least_percent`` the first ``k`` rows, with it those of other labels in
    each of the asking row's windows."""
    label = table.column("label").combine_chunks().dictionary_encode()
    label = (label.combine_chunks() if isinstance(label, pa.ChunkedArray) else label).indices.to_numpy()
    asks = table.column("asks").to_numpy()
    ids, f, r = (table.column(c).to_numpy() for c in ("vec_id", "__f", "__r"))
    names = [c.split()[0] for c in HITS.split(", ")]
    out = [[] for _ in names]
    if asks.any() and not asks.all():
        dim = len(table.column("x")[0])
        z = quantized(vectors.matrix(table.column("x"), dim), scale)
        block = Block(*(c[~asks] for c in (z, label, ids, f, r)))
        tree, windows = block.tree, table.column("windows")
        root = tree.centre[tree.children(np.zeros(1, int))[0]] if tree.count[0] else tree.centre[:1]
        asking = np.flatnonzero(asks)
        for at in range(0, len(asking), 256):
            part = asking[at:at + 256]
            tops = inner(z[part], block.points[root])
            for a, top in zip(part, tops, strict=True):
                if least_percent is not None:
                    given = windows[int(a)].as_py()
                    spans = [window(w["score"], least_percent) for w in given]
                    hits = block.search(z[a], top, lambda row: block.label[row] != label[a], spans, k)
                else:
                    given = [{"vec_id": None, "score": None}]
                    hits = block.search(z[a], top, lambda row: (block.f[row] != f[a]) | (block.r[row] != r[a]),
                                        [(-np.inf, np.inf)], k)
                for w, (of, (rows, scores)) in enumerate(zip(given, hits, strict=True)):
                    n = len(rows)
                    for column, values in zip(out, (
                            [f[a]] * n, [r[a]] * n, [ids[a]] * n, [w] * n, [of["vec_id"]] * n, [of["score"]] * n,
                            block.ids[rows], block.f[rows], block.r[rows], scores), strict=True):
                        column.extend(values)
    return pa.table({n: pa.array(c, pa.int32() if n == "window" else pa.int64())
                     for n, c in zip(names, out, strict=True)})


# -- between tasks ------------------------------------------------------------
def sphere(x: Column, scale: float) -> Column:
    """No less than the squared norm of the quantized vector."""
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + F.pow(F.abs(v * scale) + 1, F.lit(2.0)))


def cell_centres(sample: np.ndarray, cells: int, m2: float) -> np.ndarray:
    """At most ``cells`` rows of ``sample``, each the farthest from those
    before it on the sphere."""
    extra = np.sqrt(np.maximum(m2 - (sample ** 2).sum(axis=1), 0))
    picked, far = [0], np.full(len(sample), np.inf)
    while len(picked) < min(cells, len(sample)):
        last = picked[-1]
        far = np.minimum(far, 2 * m2 - 2 * (sample @ sample[last] + extra * extra[last]))
        if not far.max() > 0:
            break
        picked.append(int(far.argmax()))
    return sample[picked]


class Cells:
    """The cells of every vector length: centres in the order of cell numbers."""

    def __init__(self):
        self.of: dict[int, tuple[int, np.ndarray, float]] = {}  # length: (first cell, centres, M^2)
        self.count = 0

    def add(self, dim: int, centres: np.ndarray, m2: float) -> None:
        self.of[dim] = self.count, centres, m2
        self.count += len(centres)

    def nearest(self, z: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance to its centre) of each row."""
        first, centres, m2 = self.of[dim]
        e = [np.sqrt(np.maximum(m2 - (m ** 2).sum(axis=1), 0)) for m in (z, centres)]
        apart = np.sqrt(np.maximum(2 * m2 - 2 * (z @ centres.T + e[0][:, None] * e[1][None, :]), 0))
        own = apart.argmin(axis=1)
        # the square root of a difference of large numbers: widen what rounding may lose
        return first + own, apart[np.arange(len(z)), own] + np.sqrt(SLACK * m2)

    def meeting(self, q: np.ndarray, dim: int, radius: dict[int, float], windows: list[tuple[int, int]]) -> list[int]:
        """The cells that can hold inner products inside one of the windows."""
        first, centres, m2 = self.of[dim]
        reach = np.array([radius.get(first + c, -1.0) for c in range(len(centres))])
        low, high = interval(centres @ q, np.maximum(reach, 0), float((q ** 2).sum()), m2)
        met = reduce(np.logical_or, [~(high < a) & ~(low > b) for a, b in windows if a <= b],
                     np.zeros(len(centres), bool))
        return [first + int(c) for c in np.flatnonzero(met & ~(reach < 0))]


def by_length(batch: pa.RecordBatch, column: str):
    """(length, row numbers) of the vectors of a batch."""
    sizes = np.array([len(v) for v in batch.column(column)])
    return [(int(n), np.flatnonzero(sizes == n)) for n in np.unique(sizes)]


def mine(base: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, scale: float = 256.0,
         least_percent: int = 80, block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS, seed: int = 1) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each row of ``base`` (vec_id, embedding, label) for
    which ``is_anchor`` holds and each of its first ``positives`` other rows of
    the same label, the first ``negatives`` rows of another label that score at
    least ``least_percent`` and at most 100 % of the positive.  Scores are inner products of
    floor(scale * component); first is the higher score, then the smaller
    vec_id, then the place in the input.

    Rows with a null vec_id, label, vector or component, or a component that is
    not finite, take no part; zero vectors do.  Only vectors of equal length
    are compared.  Repeated rows are rows of their own, as anchors and as
    results.  A negative positive score has an empty window.  Scores beyond 64
    bits count as the nearest 64-bit integer.
    Other columns are ignored; an empty table gives no rows."""
    spark = common.ready(base.sparkSession)
    big = F.lit(float("inf"))
    rows = common.with_identity(base, F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"),
                                F.col("embedding").cast("array<double>").alias("x"), is_anchor.alias("asks"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * scale) < big))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    # of equal rows, as many can be needed as an anchor has results, and itself
    copies = Window.partitionBy("label", "x").orderBy("vec_id", "__f", "__r")
    most = max(positives + 1, negatives)
    held = common.stored(rows.drop("asks").withColumn("n", F.row_number().over(copies)).where(F.col("n") <= most)
                         .drop("n"), "negatives-rows")
    anchors = common.stored(rows.where("asks").drop("asks"), "negatives-anchors")

    def meet(left, right, windows):
        """Both sides in one frame: candidates and the rows that ask."""
        keys = ["block", "part", "chunk"]
        cols = ["vec_id", "label", "x", "__f", "__r"]
        none = F.lit(None).cast("array<struct<vec_id:bigint,score:bigint>>").alias("windows")
        left = left.select(*keys, *cols, none, F.lit(False).alias("asks"))
        right = right.select(*keys, *cols, F.col("windows") if windows else none, F.lit(True).alias("asks"))
        k = negatives if windows else positives
        return left.unionByName(right).groupBy(*keys).applyInArrow(
            lambda t: search_group(t, scale, k, least_percent if windows else None), HITS)

    def dealt(df, own, n_own, other, n_other, salt):
        return df.withColumns({own: F.pmod(F.xxhash64(F.lit(salt), "__f", "__r"), n_own).cast("int"),
                               other: F.explode(F.sequence(F.lit(0).cast("long"), n_other - 1))}
                              ).withColumn(other, F.col(other).cast("int"))

    def first(hits, k, *group):
        best = Window.partitionBy("a_f", "a_r", *group).orderBy(F.desc("score"), "vec_id", "f", "r")
        return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    # positives: blocks and chunks of one label and length
    kind = [F.col("label").alias("k_label"), F.size("x").alias("k_size")]
    pieces = (held.groupBy(*kind).agg(F.count("*").alias("n"))
              .join(anchors.groupBy(*kind).agg(F.count("*").alias("q")), ["k_label", "k_size"])
              .select("k_label", "k_size", F.ceil(F.col("n") / block_rows).alias("parts"),
                      F.ceil(F.col("q") / chunk_rows).alias("chunks")))
    pieces = common.stored(pieces, "negatives-labels")
    on = (F.col("label") == F.col("k_label")) & (F.size("x") == F.col("k_size"))
    block = F.struct("k_label", "k_size").alias("block")
    left = dealt(lookup_join(held, pieces, on, max_rows=100_000).withColumn("block", block),
                 "part", F.col("parts"), "chunk", F.col("chunks"), 7)
    right = dealt(lookup_join(anchors, pieces, on, max_rows=100_000).withColumn("block", block),
                  "chunk", F.col("chunks"), "part", F.col("parts"), 11)
    found = first(meet(left, right, False), positives)
    wanted = found.groupBy("a_f", "a_r").agg(F.sort_array(F.collect_list(
        F.struct("rank", "vec_id", "score"))).alias("w")).select(
        "a_f", "a_r", F.transform("w", lambda w: F.struct(w.vec_id, w.score)).alias("windows"))
    asking = common.stored(anchors.join(wanted.hint("merge"), (F.col("__f") == F.col("a_f")) &
                                        (F.col("__r") == F.col("a_r"))).drop("a_f", "a_r"), "negatives-positives")

    # negatives: the cells whose interval meets a window
    cells = Cells()
    sizes = held.groupBy(F.size("x").alias("k")).agg(F.count("*").alias("n"), F.max(sphere(F.col("x"), scale)).alias("m"))
    for s in sizes.orderBy("k").collect():  # one row per vector length
        sample = vectors.sample(held.where(F.size("x") == s.k), "x", SAMPLE_ROWS, seed)
        cells.add(s.k, cell_centres(quantized(sample, scale), min(MAX_CELLS, -(-s.n // CELL_ROWS)), s.m), s.m)
    if not cells.count:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")

    def place(batches):
        for b in batches:
            cell, far = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows)
            for dim, at in by_length(b, "x"):
                cell[at], far[at] = cells.nearest(quantized(vectors.matrix(b.column("x").take(at), dim), scale), dim)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(far)],
                                             [*b.schema.names, "block", "far"])

    ddl = held.schema.simpleString()[7:-1]
    placed = common.stored(held.mapInArrow(place, ddl + ",block:int,far:double"), "negatives-placed")
    filled = common.stored(placed.groupBy("block").agg(F.max("far").alias("radius"), F.count("*").alias("n")),
                           "negatives-cells")
    radius = {c.block: c.radius for c in filled.collect()}  # bounded: MAX_CELLS of each length

    def send(batches):
        for b in batches:
            out = [None] * b.num_rows
            windows = b.column("windows").to_pylist()
            for dim, at in by_length(b, "x"):
                z = quantized(vectors.matrix(b.column("x").take(at), dim), scale)
                for i, q in zip(at, z, strict=True):
                    out[i] = cells.meeting(q, dim, radius, [window(w["score"], least_percent) for w in windows[i]])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.int32()))],
                                             [*b.schema.names, "cells"])

    sent = common.stored(asking.mapInArrow(send, asking.schema.simpleString()[7:-1] + ",cells:array<int>")
                         .select("*", F.explode("cells").alias("block")).drop("cells"), "negatives-sent")
    cut = filled.join(sent.groupBy("block").agg(F.count("*").alias("q")), "block").select(
        "block", F.ceil(F.col("n") / block_rows).alias("parts"), F.ceil(F.col("q") / chunk_rows).alias("chunks"))
    cut = F.broadcast(common.stored(cut, "negatives-cut"))  # one row per cell
    left = dealt(placed.join(cut, "block"), "part", F.col("parts"), "chunk", F.col("chunks"), 17)
    right = dealt(sent.join(cut, "block"), "chunk", F.col("chunks"), "part", F.col("parts"), 19)
    return first(meet(left, right, True), negatives, "window").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
