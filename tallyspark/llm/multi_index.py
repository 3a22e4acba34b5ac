"""Embedding near-duplicates by an inverted multi-index.

Independent codebooks on the two halves of the unit vectors form a product
grid of cells, posted per label.  Each vector visits cells in the order of the
multi-sequence traversal until the target recall is met: the number of cells
is calibrated so that a vector turned in a random direction by exactly the
link threshold - the hardest link there is - is still found.  Every pair that
meets in a cell is verified by its cosine in double precision.

Copies meet in one distinct vector first.  A full cell is cut into blocks on
both sides, so a task's matrix is bounded however many rows share a cell; from
a task leave only link counts and connecting links, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import common, vectors

CODES = 16
TRAIN_ROWS = 8192
TARGET_RECALL = 0.99
BLOCK_ROWS = 2048
LLOYD_ROUNDS = 12


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # first, so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codebook(x: np.ndarray, codes: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's k-means of ``codes`` centres (fewer rows: the rows)."""
    if len(x) <= codes:
        return x.copy()
    centres = x[rng.choice(len(x), codes, replace=False)]
    for _ in range(LLOYD_ROUNDS):
        own = half_distances(x, centres).argmin(axis=1)
        for c in range(codes):
            centres[c] = x[own == c].mean(axis=0) if (own == c).any() else x[rng.integers(len(x))]
    return centres


def half_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres ** 2).sum(axis=1) - 2 * x @ centres.T + (x ** 2).sum(axis=1, keepdims=True)


def traversal(x: np.ndarray, books: tuple[np.ndarray, np.ndarray], cells: int) -> np.ndarray:
    """The first ``cells`` cells of every row's multi-sequence traversal.

    Cell (i-th nearest code, j-th nearest code) comes after the (i+1)(j+1) - 1
    cells it dominates, so only those with (i+1)(j+1) <= cells can be reached;
    they are sorted by their sum of half distances."""
    half = len(books[0][0])
    d1, d2 = half_distances(x[:, :half], books[0]), half_distances(x[:, half:], books[1])
    o1, o2 = np.argsort(d1, axis=1, kind="stable"), np.argsort(d2, axis=1, kind="stable")
    s1, s2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
    i, j = np.divmod(np.arange(len(books[0]) * len(books[1])), len(books[1]))
    reach = (i + 1) * (j + 1) <= cells
    i, j = i[reach], j[reach]
    first = np.argsort(s1[:, i] + s2[:, j], axis=1, kind="stable")[:, :cells]
    return np.take_along_axis(o1, i[first], 1) * len(books[1]) + np.take_along_axis(o2, j[first], 1)


def cells_for_recall(x: np.ndarray, books, cosine: float, recall: float, rng: np.random.Generator) -> int:
    """How many cells to visit so that ``recall`` of the sample's rows meet a
    partner at exactly the threshold cosine (either may find the other)."""
    turn = rng.normal(size=x.shape)
    turn -= (turn * x).sum(axis=1, keepdims=True) * x
    norm = np.linalg.norm(turn, axis=1, keepdims=True)
    y = cosine * x + np.sqrt(1 - cosine ** 2) * turn / np.where(norm > 0, norm, 1)
    every = len(books[0]) * len(books[1])
    tx, ty = traversal(x, books, every), traversal(y, books, every)
    met = np.minimum((tx == ty[:, :1]).argmax(axis=1), (ty == tx[:, :1]).argmax(axis=1))
    return int(np.sort(met)[min(len(met) - 1, int(np.ceil(recall * len(met))))]) + 1


def near_duplicates(embeddings: DataFrame, cosine: float = 0.93, codes: int = CODES, recall: float = TARGET_RECALL,
                    train_rows: int = TRAIN_ROWS, block_rows: int = BLOCK_ROWS, seed: int = 1) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``embeddings``
    (vec_id, embedding, label).

    Rows of equal, not null labels link at ``cosine`` or more; vectors are only
    compared with those of as many components.  Unusable vectors link with
    nothing and are components of their own.  Repeated rows link with each
    other.  ``component_id`` is the smallest vec_id of the component (null ids
    are passed over); ``kept`` is false where either is null."""
    common.ready(embeddings.sparkSession)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"),
                             F.col("embedding").cast("array<double>").alias("x"))
    rows = rows.withColumn("x", F.when(vectors.usable(F.col("x")) & F.col("label").isNotNull(), F.col("x")))
    out = rows.where("x is null").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                         F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    lengths = rows.where("x is not null").select(F.size("x").alias("dim")).distinct().orderBy("dim").collect()
    for s in lengths:
        out = out.unionByName(_of_length(rows.where(F.size("x") == s.dim), s.dim, cosine, codes, recall, train_rows,
                                         block_rows, seed))
    return out


def _of_length(rows: DataFrame, dim: int, cosine: float, codes: int, recall: float, train_rows: int, block_rows: int,
               seed: int) -> DataFrame:
    """The result for ``rows`` (vec_id, label, x) that all have ``dim``
    components."""
    distinct = common.stored(
        rows.groupBy("label", "x").agg(F.min("vec_id").alias("first"), F.count("*").alias("w"))
        .withColumn("node", F.monotonically_increasing_id()), "vectors-distinct")  # written once, so ids stay
    sample = vectors.sample(distinct, "x", train_rows, seed)
    rng, sample, half = np.random.default_rng(seed), unit(sample), max(1, dim // 2)
    books = codebook(sample[:, :half], codes, rng), codebook(sample[:, half:], codes, rng)
    n_cells = cells_for_recall(sample[:2000], books, cosine, recall, rng)

    def assign(batches):
        for b in batches:
            visits = traversal(unit(vectors.matrix(b.column("x"), dim)), books, n_cells).astype(np.int32)
            lists = pa.ListArray.from_arrays(np.arange(0, visits.size + 1, visits.shape[1], dtype=np.int32),
                                             pa.array(visits.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], [*b.schema.names, "visits"])

    posted = distinct.select("label", "x", "w", "node")
    posted = common.stored(posted.mapInArrow(assign, posted.schema.simpleString()[7:-1] + ",visits:array<int>"),
                           "vectors-posted")
    posted = posted.withColumn("own", F.element_at("visits", 1))
    probe = posted.select("label", "x", "w", "node", "own", F.explode("visits").alias("cell"))
    filled = posted.groupBy("label", F.col("own").alias("cell")).agg(F.count("*").alias("n"))
    visited = probe.groupBy("label", "cell").agg(F.count("*").alias("m"))
    cut = common.stored(filled.join(visited, ["label", "cell"]).select(
        "label", "cell", F.ceil(F.col("n") / block_rows).cast("int").alias("rs"),
        F.ceil(F.col("m") / block_rows).cast("int").alias("ps")), "vectors-cells")

    def deal(df, cell, own, other, own_n, other_n):
        met = df.join(cut.withColumnRenamed("cell", "c"), (df.label == cut.label) & (df[cell] == F.col("c")))
        met = met.select(*[df[c].alias(c) for c in df.columns if c != "cell"], F.col("c").alias("cell"), own_n, other_n)
        return met.select("*", F.pmod(F.xxhash64("node"), F.col(own_n)).cast("int").alias(own),
                          F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)).alias(other)).drop(own_n, other_n)

    resident = deal(posted, "own", "rb", "pb", "rs", "ps").select(
        "label", "cell", "rb", "pb", "node", "w", "x", "visits")
    probe = deal(probe, "cell", "pb", "rb", "ps", "rs").select(
        "label", "cell", "rb", "pb", "node", "w", "x", "own")

    def verify(key, left, right):
        n, m = left.num_rows, right.num_rows
        if not n or not m:
            return pa.table({c: pa.array([], pa.int64()) for c in ("a", "b", "n")})
        y, x = unit(vectors.matrix(left.column("x"), dim)), unit(vectors.matrix(right.column("x"), dim))
        y_id, y_w = left.column("node").to_numpy(), left.column("w").to_numpy()
        x_id, x_w = right.column("node").to_numpy(), right.column("w").to_numpy()
        linked = (x @ y.T >= cosine) & (x_id[:, None] != y_id[None, :])
        counts = linked @ y_w
        # a pair that also meets in x's own cell is counted for y there
        visits = np.asarray(left.column("visits").combine_chunks().flatten()).reshape(n, -1)
        own = right.column("own").to_numpy()
        back = np.zeros(n, np.int64)
        for cell in np.unique(own):
            there = own == cell
            back += np.where((visits == cell).any(axis=1), 0, x_w[there] @ linked[there])
        pairs = common.spanning_links(linked, same=False)
        x_hit, y_hit = np.flatnonzero(counts), np.flatnonzero(back)
        a = np.concatenate([x_id[x_hit], y_id[y_hit], x_id[[i for i, _ in pairs]].astype(np.int64)])
        n_out = np.concatenate([counts[x_hit], back[y_hit], np.zeros(len(pairs), np.int64)])
        none = len(x_hit) + len(y_hit)
        return pa.table({"a": pa.array(a, pa.int64()), "n": pa.array(n_out, pa.int64()),
                         "b": pa.array([None] * none + [int(y_id[j]) for _, j in pairs], pa.int64())}
                        ).select(["a", "b", "n"])

    key = ["label", "cell", "rb", "pb"]
    found = common.stored(resident.groupBy(*key).cogroup(probe.groupBy(*key))
                          .applyInArrow(verify, "a long, b long, n long"), "vectors-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    of = common.components(found.where("b is not null").select("a", "b"), "vectors-components")
    grouped = distinct.join(counts.hint("merge"), "node", "left").join(of.hint("merge"), "node", "left")
    grouped = common.stored(grouped.select("label", "x", "w", "first", F.coalesce("others", F.lit(0)).alias("others"),
                                           F.coalesce("component", "node").alias("component")), "vectors-grouped")
    smallest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    label = grouped.join(smallest.hint("merge"), "component").select(
        "label", "x", (F.col("others") + F.col("w") - 1).alias("n_links"), "component_id",
        F.lit(True).alias("joined"))
    out = rows.join(label.hint("merge"), ["label", "x"], "left")
    component = F.when(F.col("joined"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
