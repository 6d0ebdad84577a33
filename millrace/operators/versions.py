"""Change logs: latest row per key, as-of reads, batch history and retention."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row of each key in the order ``newest_first``, which must be total.

    Spark keeps one row per key in every map task before the shuffle (the row-number
    limit is pushed below the exchange), so a key that holds a third of the table
    reaches its reducer as one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_state(log: DataFrame, keys: Sequence[str], ts: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key by (ts, tie_breakers), which must be total.

    Gives what :func:`latest_per_key` gives, by an aggregate that is combined on the map
    side and sorts by the key alone: faster where keys have many rows, as in change logs;
    the window is faster where most keys have one or two.
    """
    rest = [c for c in log.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(ts, *tie_breakers)).alias("_row")
    columns = [F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in log.columns]
    return log.groupBy(*keys).agg(newest).select(*columns)


def as_of(
    log: DataFrame, keys: Sequence[str], ts: str, at: Any, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """The row in force for each key at time ``at`` (inclusive)."""
    moment = F.lit(at).cast(log.schema[ts].dataType)
    return latest_state(log.where(F.col(ts) <= moment), keys, ts, tie_breakers)


def batch_history(df: DataFrame, batch: str, ts: str) -> DataFrame:
    """One row per load batch: version number, rows and time span.

    The numbering runs over the aggregated rows, one per load, not over the table.
    """
    per_batch = df.groupBy(batch).agg(
        F.count(F.lit(1)).alias("row_count"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    version = F.row_number().over(Window.orderBy("first_ts", batch)) - 1
    return per_batch.withColumn("version", version)


def retain(
    log: DataFrame, keys: Sequence[str], ts: str, cutoff: Any, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """Drop the versions that were already superseded at ``cutoff``.

    What is left answers every as-of read from the cutoff on: the row in force at the
    cutoff for each key, and all rows after it. The rows after it pass straight through;
    only one row per key and map task of the older ones is shuffled.
    """
    moment = F.lit(cutoff).cast(log.schema[ts].dataType)
    in_force = as_of(log, keys, ts, cutoff, tie_breakers)
    # a row without a time cannot be proven superseded
    recent = log.where((F.col(ts) > moment) | F.col(ts).isNull())
    return recent.unionByName(in_force)
