"""SimHash near-duplicates, candidates pruned by pigeonring filtering.

A 64-bit fingerprint is cut into ``max_bits + 1`` segments on a ring.  If two
fingerprints differ in at most ``max_bits`` bits, some start segment begins a
chain whose first segment, first two segments, first three, ... all differ in
at most their proportional share (``length * max_bits / segments``, rounded
down) of the bits.  The first link of that chain allows no difference, so
candidates meet on one equal segment; the longer prefixes of the chain prune
them before the full Hamming check.

* Copies meet in one distinct fingerprint before any pairing.
* Buckets of up to ``light`` distinct fingerprints are paired by a self-join on
  (segment, value), with chain and distance in the join condition.
* Larger buckets are cut into blocks of ``block`` fingerprints; each pair of
  blocks is one task's matrix of differences, from which only connecting links
  leave (never all pairs).  Both ways check every pair of a bucket.
* Links are closed by ``common.components``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import common

SEED = 42
BITS = 64


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """The unsigned fingerprint of one whole text; 0 for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    if len(words) < words_per_shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_per_shingle)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """(__f, __r, doc_id, fp): row identity, and the fingerprint as a signed
    64-bit long."""
    names = ["__f", "__r", "doc_id", "fp"]

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t, words_per_shingle) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.array(fps, np.uint64).view(np.int64))], names)

    common.ready(docs.sparkSession)
    return (common.with_identity(docs, F.col("doc_id").cast("long").alias("doc_id"),
                                 F.col("text").cast("string").alias("text"))
            .select("__f", "__r", "doc_id", "text")
            .mapInArrow(run, "__f long, __r long, doc_id long, fp long"))


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the ``max_bits + 1`` segments."""
    m = max_bits + 1
    edges = [BITS * i // m for i in range(m + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def chain_masks(max_bits: int, start: int) -> list[tuple[int, int]]:
    """(signed mask, allowed differing bits) of each chain prefix from ``start``."""
    seg, out, mask = segments(max_bits), [], 0
    for length in range(1, len(seg) + 1):
        lo, width = seg[(start + length - 1) % len(seg)]
        mask |= ((1 << width) - 1) << lo
        out.append((mask - (1 << BITS) if mask >> (BITS - 1) else mask, length * max_bits // len(seg)))
    return out


def links(distinct: DataFrame, max_bits: int = 2, light: int = 64, block: int = 4096) -> DataFrame:
    """Connecting links (a, b) between distinct fingerprints (column ``fp``)
    at most ``max_bits`` bits apart: all of them in light buckets, a spanning
    set in larger ones."""
    seg = segments(max_bits)
    posting = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("seg"),
                 F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << width) - 1)).alias("val"))
        for i, (lo, width) in enumerate(seg)])).alias("k")).select("fp", "k.seg", "k.val")
    sizes = posting.groupBy("seg", "val").agg(F.count("*").alias("n")).where("n > 1")
    posting = common.stored(posting.join(sizes.hint("merge"), ["seg", "val"]), "simhash-postings")

    few = posting.where(F.col("n") <= light).select("seg", "val", "fp")
    a, b = few.withColumnRenamed("fp", "a"), few.withColumnRenamed("fp", "b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    near = F.col("a") < F.col("b")
    for start in range(len(seg)):
        for mask, allowed in chain_masks(max_bits, start)[1:]:
            near &= (F.col("seg") != start) | (F.bit_count(differ.bitwiseAND(F.lit(mask))) <= allowed)
    pairs = a.join(b.hint("merge"), ["seg", "val"]).where(near).select("a", "b")

    many = posting.where(F.col("n") > light).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    many = many.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    many = many.select("seg", "val", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    many = many.select("seg", "val", "fp", "own", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"))

    def block_links(key, table):
        start, i, j = key[0].as_py(), key[2].as_py(), key[3].as_py()
        fp, own = table.column("fp").to_numpy(), table.column("own").to_numpy()
        x, y = fp[own == i], fp[own == j]
        linked = np.zeros((len(x), len(y)), bool)
        for at in range(0, len(x), 256):
            d = x[at:at + 256, None] ^ y[None, :]
            ok = np.ones(d.shape, bool)
            for mask, allowed in chain_masks(max_bits, start)[1:]:
                ok &= np.bitwise_count((d & np.int64(mask)).view(np.uint64)) <= allowed
            linked[at:at + 256] = ok
        found = common.spanning_links(linked, same=i == j)
        return pa.table({"a": pa.array([int(x[r]) for r, _ in found], pa.int64()),
                         "b": pa.array([int(y[c]) for _, c in found], pa.int64())})

    dense = many.groupBy("seg", "val", "i", "j").applyInArrow(block_links, "a long, b long")
    return pairs.union(dense)


def near_duplicates(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(__f, __r, doc_id, fp, component, component_id) per row of ``docs``:
    row identity, fingerprint, and the component by a fingerprint of it and by
    its smallest doc_id.

    Null and empty texts have fingerprint zero and link like any other.
    ``component_id`` is the smallest doc_id of the component; rows without
    doc_id take part, but only a component without any doc_id has a null one.
    Repeated rows each return a row.  Only ``doc_id`` and ``text`` are read."""
    rows = common.stored(fingerprints(docs, words_per_shingle), "simhash-fingerprints")
    distinct = common.stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    of = common.components(links(distinct.select("fp"), max_bits), "simhash-components")
    grouped = distinct.join(of.hint("merge"), distinct.fp == of.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    grouped = common.stored(grouped, "simhash-grouped")
    smallest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    label = grouped.join(smallest.hint("merge"), "component").select("fp", "component", "component_id")
    return rows.join(label.hint("merge"), "fp").select("__f", "__r", "doc_id", "fp", "component", "component_id")


def keep_one(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id
    (null ids last, then the first in the input).  ``docs`` must be read from
    files, so that both passes over it see the same rows."""
    found = near_duplicates(docs, words_per_shingle, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__f", "__r")
    kept = found.groupBy("component").agg(F.min(order).alias("k")).select("k.__f", "k.__r")
    return common.with_identity(docs, common.whole_row(docs)).join(kept, ["__f", "__r"], "left_semi").select("doc.*")
