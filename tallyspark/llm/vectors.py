"""What the two vector operators share: usable vectors and matrices of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import common


def usable(embedding: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    big = F.lit(float("inf"))
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """A list column of ``dim`` numbers each as a double matrix."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(whole.flatten(), dtype=np.float64).reshape(len(whole), dim)


def sample(df: DataFrame, embedding: str, rows: int, seed: int) -> np.ndarray:
    """At most ``rows`` distinct vectors, those with the smallest seeded hash."""
    own = df.select(embedding).distinct().withColumn("h", F.xxhash64(F.lit(seed), embedding))
    got = common.smallest(own, rows, "h", embedding).collect()
    return np.array([r[0] for r in got], dtype=np.float64)
