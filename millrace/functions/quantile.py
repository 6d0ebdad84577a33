"""Quantiles that stay bounded however many rows or distinct values there are."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGIT_BITS = 18  # a histogram level has at most 2**18 bins


def _unscaled_digits(field: T.StructField) -> tuple[int, int]:
    """(scale, number of 18-bit levels needed) for an exact numeric column."""
    kind = field.dataType
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        precision, scale = kind.precision, kind.scale
    elif isinstance(kind, T.IntegralType):
        precision, scale = 18, 0
    else:
        raise TypeError(f"exact_quantile needs an integer or decimal(<=18) column, {field.name} is {kind.simpleString()}")
    # one more bit for the sign; bigint values beyond 18 digits still fit the top level's 64-bit shift
    bits = 64 if scale == 0 and isinstance(kind, T.LongType) else math.ceil(precision * math.log2(10)) + 1
    return scale, math.ceil(bits / _DIGIT_BITS)


def exact_quantile(df: DataFrame, column: str, q: float = 0.5) -> DataFrame:
    """One row, one column ``column``: the smallest value at or above rank ceil(q * n).

    Selects digit by digit. Each level counts the values by their next 18 bits (a
    map-side combined ``groupBy``), finds the bin that holds the wanted rank and
    narrows to it, so no task ever sees more than 2**18 bins, where ``percentile_disc``
    keeps every distinct value in the memory of one task. decimal(10,2) takes two
    passes over the one column. Lazy: the levels are scalar subqueries of one plan.
    Nulls are skipped; with no values the result is one null.
    """
    field = df.schema[column]
    scale, levels = _unscaled_digits(field)
    value = F.col(column) if scale == 0 else F.col(column) * (10**scale)
    values = df.select(value.cast("long").alias("v")).where(F.col("v").isNotNull())

    in_order = Window.orderBy("digit")  # over at most 2**18 bins
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = None
    for shift in range((levels - 1) * _DIGIT_BITS, -1, -_DIGIT_BITS):
        rows = values
        if found is not None:
            picked = found.scalar()
            rows = values.where(F.shiftright("v", shift + _DIGIT_BITS) == picked["digit"])
        bins = rows.groupBy(F.shiftright("v", shift).alias("digit")).agg(F.count("*").alias("n"))
        bins = bins.select("digit", "n", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("total"))
        rank = F.greatest(F.ceil(F.col("total") * F.lit(float(q))), F.lit(1)) if found is None else picked["rank"]
        found = (
            bins.withColumn("rank", rank)
            .where(F.col("upto") >= F.col("rank"))
            .agg(F.min(F.struct("digit", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))).alias("found"))
        )
    answer = F.col("found.digit")
    if scale:
        answer = answer.cast("decimal(20,0)") / F.lit(10**scale)
    return found.select(answer.cast(field.dataType).alias(column))


def approx_quantile(df: DataFrame, column: str, q: float = 0.5, relative_error: float = 0.01) -> DataFrame:
    """One row from one pass: a value whose rank is within ``relative_error`` of ``q``.

    The sketch is of constant size. Which of the allowed values comes out may change
    with the partitioning, so use :func:`exact_quantile` where runs must agree.
    """
    accuracy = max(1, math.ceil(1 / relative_error))
    sketch = F.percentile_approx(column, F.lit(float(q)), F.lit(accuracy))
    return df.agg(sketch.cast(df.schema[column].dataType).alias(column))


SKETCH_K = 1024  # ranks within about 0.3 %


def quantile_sketch(df: DataFrame, column: str, groups: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """``groups``, ``rows`` and ``sketch`` of a numeric column, for keeping: one small binary per group and load."""
    value = F.col(column).cast("double")
    return df.where(value.isNotNull()).groupBy(*groups).agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double(value, k).alias("sketch")
    )


def merged_sketches(sketches: DataFrame, groups: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """The sketches of several loads as one per group, as if all rows had been read at once."""
    return sketches.groupBy(*groups).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, ranks: Sequence[float], name: str = "quantiles") -> DataFrame:
    """Adds the values at ``ranks``, an array; reads no row of the loads."""
    wanted = F.array(*[F.lit(float(r)) for r in ranks])
    return sketches.withColumn(name, F.kll_sketch_get_quantile_double("sketch", wanted))
