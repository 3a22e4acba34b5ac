"""Size checks behind every explicit broadcast.

``proven_small(df, n)`` counts the frame: each task counts its rows and only
one partial count per task is shuffled, so the answer is exact and a True
answer is a proof that the frame has <= n rows.  It costs one pass over the
checked frame (for a plain Parquet projection only the row-group metadata
is read).  The check is run on the side expected to be small (a dimension,
a batch, its key set), never on the large table it is joined to.

(``limit(n + 1).count()`` is not used: it plans as a per-task limit feeding a
single-partition exchange, so every task writes up to n + 1 rows into one
reducer's shuffle -- on a large input that funnels billions of rows at one
task instead of bounding the cost.)

Only frames proven this way, or bounded by construction, are broadcast by
hand; everything else is joined by sort-merge (``lookup_join``) or left to
Spark's size-checked auto-broadcast and AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Key sets up to this many rows are broadcast (a few tens of MB of keys).
BROADCAST_ROWS = 2_000_000
# Frames of whole rows also have to be this small.
BROADCAST_BYTES = 128 << 20

# Session setting that caps every size bound (rows), e.g. to suit executor
# memory; 0 proves only empty frames small, which shows the plans a cluster-sized
# input gets and still pays for the check (tools/explain.py AT_SCALE=1).
MAX_ROWS_CONF = "tallyspark.sizing.maxRows"


def proven_small(df: DataFrame, max_rows: int) -> bool:
    cap = df.sparkSession.conf.get(MAX_ROWS_CONF, None)
    if cap is not None:
        max_rows = min(max_rows, int(cap))
    return df.count() <= max_rows


def proven_light(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """``proven_small``, and the rows' values take at most ``max_bytes``: text
    and binary columns by their length, nested ones by that of their JSON, every
    column with 8 bytes besides.  For frames of whole rows, whose width is not
    bounded by their keys; costs a pass over all columns."""
    if not proven_small(df, max_rows):
        return False
    wide = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            wide.append(F.octet_length(F.col(f"`{f.name}`")))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            wide.append(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`").alias("v")))))
    row = F.lit(8 * len(df.columns)).cast("long")
    for w in wide:
        row = row + F.coalesce(w.cast("long"), F.lit(0).cast("long"))
    return (df.agg(F.sum(row)).first()[0] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, known_small: bool | None = None,
                       max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """(frame, broadcast?) -- the frame hinted for broadcast only when its row
    count is proven to be at most ``max_rows`` and, with ``max_bytes``, its size
    too (``known_small=True``: the caller already proved a bound it derives
    from, e.g. the batch it came from)."""
    if known_small or (known_small is None and (
            proven_small(df, max_rows) if max_bytes is None else proven_light(df, max_rows, max_bytes))):
        return F.broadcast(df), True
    return df, False


def split_by_keys(table: DataFrame, keys_df: DataFrame, keys: list[str],
                  max_rows: int = BROADCAST_ROWS, known_small: bool | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """(rows of ``table`` whose key is in ``keys_df``, the other rows).

    With a proven-small key set both are broadcast semi/anti joins that stream
    the large table without shuffling it; otherwise shuffle joins."""
    k, _ = broadcast_if_small(keys_df.select(*keys).distinct(), max_rows, known_small)
    return table.join(k, keys, "left_semi"), table.join(k, keys, "left_anti")


def lookup_join(big: DataFrame, dim: DataFrame, on, how: str = "inner",
                max_rows: int = BROADCAST_ROWS, known_small: bool | None = None) -> DataFrame:
    """Join a large frame to a look-up ``dim``.  The look-up is broadcast only
    when its size is proven (or bounded by construction, ``known_small``);
    otherwise the join is a sort-merge join on the key, so the large side is
    never broadcast on the strength of an estimate (a chain of joins is
    estimated as the product of its inputs, which can make a plain fact scan
    look like the smaller side)."""
    d, small = broadcast_if_small(dim, max_rows, known_small)
    return big.join(d if small else d.hint("merge"), on, how)


def hot_keys(big: DataFrame, key: str, share: float) -> DataFrame:
    """The values of ``key`` that more than ``share`` of all rows have: at most
    1 / share of them.  Counted map-side, one partial row per value and task."""
    counts = big.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    rows = big.count()
    return counts.filter(F.col("_n") > F.lit(share) * F.lit(rows)).select(key)


def hot_key_join(big: DataFrame, dim: DataFrame, big_key: str, dim_key: str, how: str = "inner",
                 share: float = 0.005, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A large frame joined (inner or left) to a large look-up with a unique
    ``dim_key``.  The rows of a hot key stay where they are and meet the few
    look-up rows of hot keys (at most 1 / ``share``) by broadcast; all others go
    through a sort-merge join, whose largest key is then small.  A look-up that
    is proven small is broadcast whole.  ``big`` is read again for the count, so
    store it first if it is costly."""
    if how not in ("inner", "left"):
        raise ValueError(how)
    on = F.col(big_key) == F.col(dim_key)
    if proven_small(dim, max_rows):
        return big.join(F.broadcast(dim), on, how)
    few = hot_keys(big, big_key, share).withColumnRenamed(big_key, "_hot")
    listed = [r[0] for r in few.collect()]  # at most 1 / share values
    hot = F.coalesce(F.col(big_key).isin(listed), F.lit(False)) if listed else F.lit(False)
    rest = big.filter(~hot).join(dim.hint("merge"), on, how)
    if not listed:
        return rest
    return big.filter(hot).join(F.broadcast(dim.filter(F.col(dim_key).isin(listed))), on, how).unionByName(rest)
