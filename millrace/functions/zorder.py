"""Z-order keys: the bits of several columns interleaved into one sortable number."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import as_long

MAX_BITS = 16  # bits per column, fewer when more than three columns share the 63
DEPTH_BITS = 8  # of equal-depth buckets: 256 per column
BORDER_ACCURACY = 10_000  # borders lie within this fraction of all rows of their rank


def _bucketed(value: Column, low: Column, high: Column, bits: int) -> Column:
    """``value`` in 0 .. 2**bits - 1, in equal steps from low to high; null counts as lowest."""
    step = F.shiftright(high - low, bits) + 1
    return F.coalesce(F.call_function("div", value - low, step), F.lit(0))


def interleave(columns: Sequence[Column], bits: int) -> Column:
    """Bit i of column j moves to bit ``i * len(columns) + j``."""
    width = len(columns)
    moved = [
        F.shiftleft(F.shiftright(col, i).bitwiseAND(F.lit(1)), i * width + j)
        for j, col in enumerate(columns)
        for i in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), moved)


def with_z_value(df: DataFrame, columns: Sequence[str], name: str = "_z") -> DataFrame:
    """Add the Z-order number of ``columns``; their ranges come from one min/max pass."""
    bits = min(MAX_BITS, 63 // len(columns))
    longs = [as_long(df, c) for c in columns]
    bounds = df.agg(
        F.struct(
            *[F.min(v).alias(f"lo{i}") for i, v in enumerate(longs)],
            *[F.max(v).alias(f"hi{i}") for i, v in enumerate(longs)],
        )
    ).scalar()
    staged = df.withColumn("_bounds", bounds)
    scaled = [
        _bucketed(v, F.col(f"_bounds.lo{i}"), F.col(f"_bounds.hi{i}"), bits) for i, v in enumerate(longs)
    ]
    return staged.withColumn(name, interleave(scaled, bits)).drop("_bounds")


def _borders(value: Column, bits: int) -> Column:
    """The values that part a column into 2**bits buckets of about equal numbers of rows, from a mergeable sketch."""
    ranks = [i / 2**bits for i in range(1, 2**bits)]
    return F.percentile_approx(value, ranks, F.lit(BORDER_ACCURACY))


def _depth_bucket(value: Column, borders: Column, bits: int) -> Column:
    """How many borders a value reaches, by halving the sorted list; null counts as lowest."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(bits))])
    reached = F.aggregate(
        steps, F.lit(0), lambda n, step: F.when(F.element_at(borders, n + step) <= value, n + step).otherwise(n)
    )
    return F.coalesce(F.when(value.isNotNull() & borders.isNotNull(), reached), F.lit(0)).cast("long")


def with_z_rank(df: DataFrame, columns: Sequence[str], name: str = "_z", bits: int = DEPTH_BITS) -> DataFrame:
    """Add a Z-order number over buckets of equal depth: outliers and skewed values cost no resolution.

    The borders of all columns come from one pass; every row is placed by ``bits`` comparisons a column.
    """
    bits = min(bits, 63 // len(columns))
    longs = [as_long(df, c) for c in columns]
    borders = df.agg(F.struct(*[_borders(v, bits).alias(f"b{i}") for i, v in enumerate(longs)])).scalar()
    ranked = df.withColumn("_borders", borders)
    buckets = [_depth_bucket(v, F.col(f"_borders.b{i}"), bits) for i, v in enumerate(longs)]
    return ranked.withColumn(name, interleave(buckets, bits)).drop("_borders")
