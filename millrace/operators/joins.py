"""Dimension joins that broadcast only what has been measured."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_REPLICATED_ROWS = 1_000_000
MAX_REPLICATED_BYTES = 256 * 1024 * 1024


def fits_in_every_task(
    df: DataFrame, max_rows: int = MAX_REPLICATED_ROWS, max_bytes: int = MAX_REPLICATED_BYTES
) -> bool:
    """Whether ``df`` is within both bounds.

    Counts first, which reads no columns of a parquet table; the size in bytes is summed
    only over what has passed. Both are map-side combined, one row comes back.
    """
    if df.count() > max_rows:
        return False
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")).first()["bytes"]
    return (size or 0) <= max_bytes


def replicated_join(
    facts: DataFrame, dimension: DataFrame, on: str | Sequence[str], how: str = "inner",
    max_rows: int = MAX_REPLICATED_ROWS, max_bytes: int = MAX_REPLICATED_BYTES,
) -> DataFrame:
    """Join with the dimension copied to every task if it is proven small.

    A dimension over either bound is joined without a hint: a shuffle join, whose hot
    keys adaptive execution splits.
    """
    if fits_in_every_task(dimension, max_rows, max_bytes):
        dimension = F.broadcast(dimension)
    return facts.join(dimension, on, how)
