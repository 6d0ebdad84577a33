"""Stored type-2 histories, brought up to date batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.scd import scd2_merge_observed, scd2_observed, versions_of
from millrace.operators.slices import HOT_ROWS
from millrace.sinks.layers import balanced, staged, touched_partitions
from millrace.sinks.storage import path_exists, read_typed, recover_table, replace_table, table_path

BUCKET = "_bucket"
BUCKETS = 64


def merge_history(
    changes: DataFrame, root: str, table: str, *, keys: Sequence[str], ts: str, attributes: Sequence[str],
    tie_breakers: Sequence[str] = (), buckets: int = BUCKETS, hot_rows: int = HOT_ROWS,
) -> None:
    """Merge a batch into the observed history stored as a silver table, which it begins if there is none.

    Rows are stored by a bucket of their key; only the buckets the batch has keys in are read and rewritten.
    Late rows and repeated batches give what one load of all rows would. All loads of a table name the same
    number of buckets. One writer at a time.
    """
    spark, path = changes.sparkSession, table_path(root, "silver", table)
    recover_table(spark, path)
    by = {"keys": keys, "ts": ts, "attributes": attributes, "tie_breakers": tie_breakers, "hot_rows": hot_rows}
    in_bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    columns = [*keys, *attributes, ts, *tie_breakers]
    with staged(changes.select(*columns).withColumn(BUCKET, in_bucket)) as batch:
        if not path_exists(spark, path):
            observed = scd2_observed(batch, **by).withColumn(BUCKET, in_bucket)
            replace_table(balanced(observed, [BUCKET]), path, partition_cols=[BUCKET])
            return
        target = read_typed(spark, path, "parquet", {BUCKET: T.IntegerType()})
        touched = touched_partitions(target, batch, [BUCKET]).drop(BUCKET)
        merged = scd2_merge_observed(touched, batch.drop(BUCKET), **by).withColumn(BUCKET, in_bucket)
        balanced(merged, [BUCKET]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
        spark.catalog.refreshByPath(path)


def read_history(
    spark: SparkSession, root: str, table: str, *, keys: Sequence[str], ts: str, attributes: Sequence[str]
) -> DataFrame:
    """The type-2 history that :func:`merge_history` keeps; the filter on changes reaches the files."""
    stored = read_typed(spark, table_path(root, "silver", table), "parquet", {BUCKET: T.IntegerType()})
    return versions_of(stored, keys, ts, attributes)
