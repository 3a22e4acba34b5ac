"""Approximate nearest neighbours by a permutation index.

Candidates get one more component that gives all of them the same norm (queries
get 0 there), so that the order of inner products is that of distances and long
vectors are not lost among short ones.  Every vector is then represented by its
nearest pivots in order.  The first
``prefix`` of them are its postings in the pivots' inverted files; a query
reads the files of its own nearest pivots, which gives each vector's footrule
distance with location parameter ``prefix``, and the nearest ``shortlist``
share by footrule is reranked with exact inner products.

Vectors are dealt evenly into blocks and queries into chunks; one task builds
the inverted files of one block and searches them for one chunk.  Both sides
of a task are bounded whatever the table holds, a hot vector's copies are
spread over all blocks, and only ``k`` rows a query and block leave a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.llm import common, vectors

PIVOTS = 192
#: At most 255, so that a gain (up to prefix squared) fits 16 bits.
PREFIX = 128
SHORTLIST = 0.15
#: The shortlist of a block is never shorter than this.
LEAST_SHORTLIST = 400
BLOCK_ROWS = 8192
CHUNK_ROWS = 2048

COLUMNS = ["__f", "__r", "vec_id", "x", "block", "chunk"]
FOUND = "q_f long, q_r long, query_id long, vec_id long, score double"


def permutations(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` pivots of largest inner product of each row, in order."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :prefix]


def on_sphere(x: np.ndarray, norm: float) -> np.ndarray:
    """The rows of ``x`` divided by ``norm``, the largest of any candidate, with
    a last component that makes each of length 1."""
    x = x / norm
    return np.column_stack([x, np.sqrt(np.maximum(1 - (x ** 2).sum(axis=1), 0))])


def norm(x: Column) -> Column:
    """Euclidean norm of a usable vector, without overflow on the way."""
    top = F.array_max(F.transform(x, F.abs))
    return top * F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + (v / top) * (v / top)))


def inverted_files(perm: np.ndarray, n_pivots: int) -> np.ndarray:
    """Row p is pivot p's file: for each vector of the block the places left
    behind p in its prefix, 0 where it does not name p.  Most vectors name
    each pivot (prefix / pivots of them), so the files are kept dense."""
    n, prefix = perm.shape
    files = np.zeros((n_pivots, n), np.uint16)
    files[perm, np.arange(n)[:, None]] = np.arange(prefix, 0, -1, dtype=np.uint16)
    return files


def footrule_gain(query: np.ndarray, files: np.ndarray, gain: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Half of (largest possible footrule distance - footrule distance) of
    every row to a query's permutation; larger is nearer.  ``gain`` and
    ``step`` are buffers of a block's length."""
    gain[:] = 0
    for left, pivot in zip(range(len(query), 0, -1), query, strict=True):
        np.minimum(files[pivot], np.uint16(left), out=step)
        np.add(gain, step, out=gain)
    return gain


def search(base: DataFrame, is_query: Column, k: int = 20, n_pivots: int = PIVOTS, prefix: int = PREFIX,
           shortlist: float = SHORTLIST, least: int = LEAST_SHORTLIST, block_rows: int = BLOCK_ROWS,
           chunk_rows: int = CHUNK_ROWS, seed: int = 1) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each
    row of ``base`` (vec_id, embedding) for which ``is_query`` holds.

    Unusable vectors and rows without vec_id take no part; vectors are only
    compared with those of as many components.  Rows are told apart by their
    place in the input: repeated rows are queries and candidates of their own.
    Equal scores rank by vec_id; all rows tied at the end of a shortlist are
    reranked.  An empty table gives no rows."""
    spark = common.ready(base.sparkSession)
    rows = common.with_identity(base, F.col("vec_id").cast("long").alias("vec_id"),
                                F.col("embedding").cast("array<double>").alias("x"), is_query.alias("is_query"))
    rows = rows.where(vectors.usable(F.col("x")) & F.col("vec_id").isNotNull())
    sizes = rows.groupBy(F.size("x").alias("dim")).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("is_query"), 1)).alias("q"), F.max(norm(F.col("x"))).alias("norm"))
    found = spark.createDataFrame([], FOUND)
    for s in sizes.where("q > 0").orderBy("dim").collect():  # one row per vector length
        own = rows.where(F.size("x") == s.dim)
        pivots = on_sphere(vectors.sample(own, "x", n_pivots, seed), s.norm)
        found = found.unionByName(_found(own, s.dim, pivots, s.norm, min(prefix, len(pivots), 255), k, shortlist, least,
                                         -(-s.n // block_rows), -(-s.q // chunk_rows)))
    nearest = Window.partitionBy("q_f", "q_r").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _found(rows: DataFrame, dim: int, pivots: np.ndarray, longest: float, prefix: int, k: int, shortlist: float,
           least: int, blocks: int, chunks: int) -> DataFrame:
    """``FOUND``: the ``k`` best of each block for every query, among vectors of
    one length."""
    key = [F.col("__f"), F.col("__r")]

    def deal(df, own, n_own, other, n_other, salt):
        return df.withColumns({own: common.spread(n_own, F.lit(salt), *key),
                               other: F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))}).select(*COLUMNS)

    resident = deal(rows, "block", blocks, "chunk", chunks, 7)
    query = deal(rows.where("is_query"), "chunk", chunks, "block", blocks, 11)

    def search_block(table):
        asks = table.column("asks")
        left, right = table.filter(pc.invert(asks)), table.filter(asks)
        n, m = left.num_rows, right.num_rows
        if not n or not m:
            return pa.table({c.split()[0]: pa.array([], pa.float64() if "double" in c else pa.int64())
                             for c in FOUND.split(", ")})
        x, q = vectors.matrix(left.column("x"), dim), vectors.matrix(right.column("x"), dim)
        files = inverted_files(permutations(on_sphere(x, longest), pivots, prefix), len(pivots))
        ids, f, r = (left.column(c).to_numpy() for c in ("vec_id", "__f", "__r"))
        q_ids, q_f, q_r = (right.column(c).to_numpy() for c in ("vec_id", "__f", "__r"))
        depth = min(n, max(least, int(np.ceil(shortlist * n))))
        buffers = np.zeros((2, n), np.uint16)
        out = []
        # a query's last component is 0: its inner products are those of the rest
        for i, perm in enumerate(permutations(q / longest, pivots[:, :-1], prefix)):
            gain = footrule_gain(perm, files, *buffers)
            near = np.flatnonzero(gain >= np.partition(gain, n - depth)[n - depth])
            near = near[(f[near] != q_f[i]) | (r[near] != q_r[i])]
            score = (x[near] * q[i]).sum(axis=1)
            best = np.lexsort((ids[near], -score))[:k]
            out.append((np.full(len(best), i), ids[near[best]], score[best]))
        i, found, score = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table({"q_f": q_f[i], "q_r": q_r[i], "query_id": q_ids[i], "vec_id": found, "score": score})

    # A union, not a cogroup: both sides come from one frame, and a cogroup of
    # a frame with itself loses columns when that frame is not a plain scan.
    both = resident.withColumn("asks", F.lit(False)).unionByName(query.withColumn("asks", F.lit(True)))
    return both.groupBy("block", "chunk").applyInArrow(search_block, FOUND)
