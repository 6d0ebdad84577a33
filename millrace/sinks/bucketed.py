"""Silver tables bucketed on their merge key: a merge moves the batch to the buckets and reads the table in place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import all_of, quoted
from millrace.operators.merge import key_list
from millrace.sinks.layers import staged
from millrace.sinks.storage import path_exists, recover_table, replace_registered, table_path

BUCKETS = 64


def upsert_in_buckets(target: DataFrame, batch: DataFrame, keys: str | Sequence[str], buckets: int) -> DataFrame:
    """What :func:`millrace.operators.merge.upsert` gives, in one full join: the target is read once and not shuffled.

    ``target`` is a table in ``buckets`` buckets on the keys, in this order. Rows whose key is null meet nothing; in a table
    by key they lie in one bucket, so tables with very many of them are better merged by :func:`~millrace.sinks.layers.write_silver`.
    """
    on = key_list(keys)
    absent = [c for c in target.columns if c not in batch.columns]
    if absent:
        raise ValueError(f"source lacks target columns: {', '.join(absent)}")
    dealt = batch.select(*[quoted(c).alias(f"_new_{c}") for c in target.columns]).repartition(buckets, *[quoted(f"_new_{k}") for k in on])
    of_key = F.count(F.lit(1)).over(Window.partitionBy(*[quoted(f"_new_{k}") for k in on]))
    counted = dealt.withColumn("_source_rows", of_key)
    present = target.withColumn("_stored", F.lit(True))
    same = all_of([quoted(k) == quoted(f"_new_{k}") for k in on])
    joined = present.join(counted.hint("merge"), same, "full")
    arrived = F.col("_source_rows").isNotNull()
    ambiguous = F.raise_error(F.lit(f"upsert: several source rows match one target row on ({', '.join(on)})"))
    checked = F.when(F.col("_stored") & (F.col("_source_rows") > 1), ambiguous.cast("boolean")).otherwise(F.lit(True))
    merged = [F.when(arrived, quoted(f"_new_{c}")).otherwise(quoted(c)).alias(c) for c in target.columns]
    return joined.where(checked).select(*merged)


def merge_bucketed(
    df: DataFrame, root: str, table: str, *, merge_keys: str | Sequence[str], buckets: int = BUCKETS, name: str | None = None
) -> str:
    """Upsert into a silver table stored in buckets on its merge keys, which the first load makes; returns its registered name.

    All loads name the same number of buckets. The new files are complete before the old ones go; one writer at a time.
    """
    spark, path, name, on = df.sparkSession, table_path(root, "silver", table), name or table, key_list(merge_keys)
    recover_table(spark, path)
    with staged(df) as batch:
        rows = batch.repartition(buckets, *[quoted(k) for k in on])
        if path_exists(spark, path) and spark.catalog.tableExists(name):
            rows = upsert_in_buckets(spark.table(name), batch, on, buckets)
        writer = rows.write.format("parquet").mode("overwrite").bucketBy(buckets, *on).sortBy(*on)
        replace_registered(spark, writer, path, name)
    return name


