"""Upsert (slowly changing dimension type 1) as a DataFrame operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import any_of


def key_list(keys: str | Sequence[str]) -> list[str]:
    """Keys as a list; a string may hold several, separated by commas."""
    return [k.strip() for k in keys.split(",")] if isinstance(keys, str) else list(keys)


def upsert(target: DataFrame, source: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``source`` put in by key.

    A target row whose key is in the source is replaced, other target rows stay, other
    source rows are added. Null keys match nothing. ``target`` holds one row per key;
    two source rows for one target row are an error, raised when the plan runs. The
    source must have all target columns; columns only it has are left out.

    The target is read and joined once, against the source's distinct keys; a batch small enough
    by Spark's own size check is broadcast, and then the target is not shuffled at all.
    Rows with a null key are dealt out by their hash. The source is read twice.
    """
    on = key_list(keys)
    absent = [c for c in target.columns if c not in source.columns]
    if absent:
        raise ValueError(f"source lacks target columns: {', '.join(absent)}")

    # Grouping by the hash as well keeps the aggregate's own partitioning from serving the
    # join. The join then has a fresh shuffle on both sides, and only such joins does
    # adaptive execution split at a hot key.
    per_key = source.groupBy(*on, F.hash(*on).alias("_hash")).agg(F.count(F.lit(1)).alias("_source_rows")).drop("_hash")
    ambiguous = F.raise_error(F.lit(f"upsert: several source rows match one target row on ({', '.join(on)})"))
    untouched = F.when(F.col("_source_rows") > 1, ambiguous.cast("boolean")).otherwise(
        F.col("_source_rows").isNull()
    )
    no_key = any_of([F.col(k).isNull() for k in on])
    dealt = target.withColumn("_spread", F.when(no_key, F.xxhash64(*target.columns)).otherwise(F.lit(0).cast("long")))
    named = per_key.withColumn("_spread", F.lit(0).cast("long"))
    kept = dealt.join(named, [*on, "_spread"], "left").where(untouched)
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def upsert_newer(
    target: DataFrame, source: DataFrame, keys: str | Sequence[str], ts: str, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """Upsert in which the newest row of a key wins, whichever side it comes from.

    Safe for late and repeated batches: an older row never replaces a newer one.
    """
    from millrace.operators.versions import latest_per_key

    newest_first = [F.col(c).desc() for c in (ts, *tie_breakers)]
    return latest_per_key(target.unionByName(source.select(*target.columns)), key_list(keys), newest_first)


def upsert_batch(
    target: DataFrame, batch: DataFrame, keys: str | Sequence[str], ts: str, batch_column: str
) -> DataFrame:
    """``target`` with a load's rows put in, newest row of a key first, as often as the load is run.

    A target row stays unless the batch has its key with the same or a later ``ts``, or an earlier run of the same
    batch (``batch_column``) wrote it. Of several batch rows of a key and time one is taken. Null keys match
    nothing. Columns that only one side has are null on the other. ``batch`` is read several times, and holds one
    load; a small one is broadcast by Spark's own size check, and the target is then not shuffled.
    """
    from millrace.operators.versions import latest_per_key

    on = key_list(keys)
    no_key = any_of([F.col(k).isNull() for k in on])
    rest = sorted(c for c in batch.columns if c not in on)
    newest = latest_per_key(batch.where(~no_key), on, [F.desc(ts), F.desc(F.xxhash64(*rest)), *[F.desc(c) for c in on]])
    loaded = batch.select(F.col(batch_column).alias("_loading")).limit(1).select("_loading").scalar()
    others = target.where(~F.coalesce(F.col(batch_column).eqNullSafe(loaded), F.lit(False)))
    arriving = newest.select(*[F.col(k).alias(f"_{k}") for k in on], F.col(ts).alias("_arriving"))
    same = [F.col(k) == F.col(f"_{k}") for k in on]
    later = F.col(ts) > F.col("_arriving")
    kept = others.where(~no_key).join(arriving, same, "left").where(F.col(f"_{on[0]}").isNull() | later).select(*target.columns)
    ahead = others.join(arriving, same).where(later).select(*[F.col(k).alias(f"_{k}") for k in on])
    put_in = newest.join(ahead, same, "left_anti")
    return (
        kept.unionByName(others.where(no_key))
        .unionByName(put_in, allowMissingColumns=True)
        .unionByName(batch.where(no_key), allowMissingColumns=True)
    )
