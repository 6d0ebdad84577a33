"""Hot keys cut into slices of about equal numbers of rows.

Windows per key hold a key's whole life in one task, and a single key may hold a third of the table. The
keys with very many rows are counted, and their rows cut at points of an equi-depth histogram: every n-th of
the rows that a hash of their key and order picks, in the rows' own order. The order includes the
tie-breakers, so a burst of rows at one time, or rows without a time, are cut like all others. Which rows are
picked plays no part in results, only in where the borders lie.

Keys are counted when a plan is built: without hot keys, the usual case, the plan has nothing of all this.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import all_of, quoted
from millrace.sinks.storage import stage

Cuts = tuple[DataFrame, DataFrame] | None

HOT_ROWS = 1_000_000  # a key with more rows than this is sliced ...
MAX_HOT_KEYS = 100_000  # ... if it also holds more than this fraction of all rows, which bounds hot keys and slices
SAMPLES_PER_SLICE = 128  # a slice of twice its size would need a deviation of eight times the standard one


def same_key(keys: Sequence[str], prefix: str = "_hot_") -> Column:
    """Whether the columns of both sides are equal, nulls alike."""
    return all_of([quoted(k).eqNullSafe(quoted(f"{prefix}{k}")) for k in keys])


def hot_keys(log: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys with very many rows, under ``_hot_`` names, and how many rows their slices hold.

    Fewer than ``MAX_HOT_KEYS`` keys, and about as many slices at most, whatever the table's size.
    """
    sizes = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    share = log.agg((F.count(F.lit(1)) / MAX_HOT_KEYS).alias("share")).scalar()  # reads no column
    per_slice = F.greatest(F.lit(hot_rows), F.ceil(share), F.lit(1)).cast("long")
    hot = sizes.where(F.col("_rows") > F.greatest(F.lit(hot_rows), share))
    return hot.select(*[quoted(k).alias(f"_hot_{k}") for k in keys], per_slice.alias("_per_slice"))


def slice_cuts(
    log: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int = HOT_ROWS
) -> Cuts:
    """Where hot keys are cut, as two small tables in the shared folder; None if no key is hot.

    The first has every ``_width``-th cut of a key in ``_borders``, the second the cuts between two such borders in
    ``_inner``, by key and ``_block``: a row is compared with about the square root of its key's cuts, twice.
    """
    hot = stage(hot_keys(log, keys, hot_rows), "hot_keys")
    if hot.isEmpty():
        return None
    every = F.greatest(F.lit(1).cast("long"), F.floor(F.col("_per_slice") / SAMPLES_PER_SLICE))
    picked = log.select(*keys, *order).join(F.broadcast(hot), same_key(keys)).where(F.pmod(F.xxhash64(*keys, *order), every) == 0)
    per_key = Window.partitionBy(*[f"_hot_{k}" for k in keys])
    step = F.floor(F.col("_per_slice") / every)
    named = [F.col(f"_hot_{k}") for k in keys]
    cuts = stage(
        picked.select(*named, F.struct(*order).alias("_point"), step.alias("_step"))
        .withColumn("_rank", F.row_number().over(per_key.orderBy("_point")))
        .where("_rank % _step = 0")
        .withColumn("_place", (F.col("_rank") / F.col("_step")).cast("long"))
        .withColumn("_width", F.ceil(F.sqrt(F.max("_place").over(per_key)))),
        "cuts",
    )
    is_border = F.col("_place") % F.col("_width") == 0
    borders = cuts.groupBy(*named).agg(
        F.sort_array(F.collect_list(F.when(is_border, F.col("_point")))).alias("_borders"), F.max("_width").alias("_width")
    )
    inner = cuts.where(~is_border).groupBy(*named, F.floor(F.col("_place") / F.col("_width")).alias("_block")).agg(
        F.sort_array(F.collect_list("_point")).alias("_inner")
    )
    return borders, inner


def with_slices(rows: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: Cuts) -> DataFrame:
    """``rows`` with ``_slice``, from 0 on and rising with ``order``; null for keys that are not cut."""
    if cuts is None:
        return rows.withColumn("_slice", F.lit(None).cast("long"))
    borders, inner = cuts
    point = F.struct(*order)
    passed = lambda points: F.size(F.filter(points, lambda c: c <= point))
    named = [f"_hot_{k}" for k in keys]
    blocks = rows.join(F.broadcast(borders), same_key(keys), "left").drop(*named)
    blocks = blocks.withColumn("_block", F.when(F.col("_borders").isNotNull(), passed(F.col("_borders"))).cast("long")).drop("_borders")
    within = inner.withColumnRenamed("_block", "_hot__block")
    placed = blocks.join(F.broadcast(within), same_key([*keys, "_block"]), "left").drop(*named, "_hot__block")
    number = F.col("_block") * F.col("_width") + F.coalesce(F.when(F.col("_inner").isNotNull(), passed(F.col("_inner"))), F.lit(0))
    return placed.withColumn("_slice", F.when(F.col("_block").isNotNull(), number)).drop("_block", "_width", "_inner")
