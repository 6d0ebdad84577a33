"""Writers of the bronze, silver and gold layers."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any, Literal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import any_of
from millrace.operators.joins import replicated_join
from millrace.operators.merge import key_list, upsert
from millrace.operators.versions import as_of, batch_history
from millrace.sinks import changes, delta
from millrace.sinks.storage import (
    delete_path,
    partition_columns,
    path_exists,
    read_stored,
    read_typed,
    recover_table,
    replace_registered,
    replace_table,
    scratch_dir,
    table_path,
)

Distribution = Literal["HASH", "ROUND_ROBIN", "REPLICATE"]

# A bucket is read by one task: beyond this many rows it must not exceed its even share this often.
MAX_BUCKET_ROWS = 50_000_000
MAX_BUCKET_SKEW = 4

MAX_NAMED_PARTITIONS = 1000


def with_batch_metadata(
    df: DataFrame, source: str, batch_id: str, ingested_at: dt.datetime | None = None
) -> DataFrame:
    """Add when, from where and with which batch the rows were loaded."""
    return df.withColumns(
        {
            "_ingestion_timestamp": F.lit(ingested_at) if ingested_at else F.current_timestamp(),
            "_source_system": F.lit(source),
            "_batch_id": F.lit(batch_id),
        }
    )


def balanced(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Bring rows of a partition together for few, even files.

    A rebalance, unlike a repartition, lets adaptive execution split a partition value
    that holds far more rows than the others over several tasks.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_cols]) if partition_cols else df


def write_bronze(
    df: DataFrame, root: str, table: str, *, source: str, batch_id: str,
    ingested_at: dt.datetime | None = None, partition_cols: Sequence[str] = (),
    mode: str = "overwrite", fmt: str = "parquet",
) -> int:
    """Land raw rows with batch metadata; returns the number written, counted by the write itself.

    Modes are ``overwrite``, ``append``, which adds a batch again if it is run again, and ``batch``: batches add up,
    each in a directory of its own, and one that is run again replaces what it wrote before (:func:`read_batch`).
    """
    written = Observation()
    rows = with_batch_metadata(balanced(df, partition_cols), source, batch_id, ingested_at)
    rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    if fmt != "delta" and mode == "overwrite":
        replace_table(rows, table_path(root, "bronze", table), fmt, list(partition_cols))
        return written.get["rows"]
    if mode == "batch":
        partition_cols = ["_batch_id", *partition_cols]
        writer = rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = rows.write.format(fmt).mode(mode)
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.save(table_path(root, "bronze", table))
    return written.get["rows"]


def read_table(
    spark: SparkSession, root: str, layer: str, table: str, *, merge_schema: bool = False, fmt: str = "parquet"
) -> DataFrame:
    """Read a layer's table; ``merge_schema`` unites the columns of all loads (reads every footer)."""
    options = {"mergeSchema": "true"} if merge_schema else {}
    return read_stored(spark, table_path(root, layer, table), fmt, **options)


def read_batch(spark: SparkSession, root: str, table: str, batch_id: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """One batch of a bronze table written with mode ``batch``, in the columns of ``schema``; opens its directory only."""
    stamped = with_batch_metadata(spark.createDataFrame([], schema), "", batch_id).schema
    return spark.read.format(fmt).schema(stamped).load(table_path(root, "bronze", table)).where(F.col("_batch_id") == batch_id)


def read_batches(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame:
    """All batches of such a table, with the columns of all of them; batch ids are texts."""
    stored = read_stored(spark, table_path(root, "bronze", table), fmt, mergeSchema="true")
    return stored.withColumn("_batch_id", F.col("_batch_id").cast("string"))


def touched_partitions(target: DataFrame, batch: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """The target's rows in partitions the batch has rows for, and in those named by a null.

    Up to ``MAX_NAMED_PARTITIONS`` of the batch's partition values are put into the query,
    so that only their directories are opened; with several columns a join then leaves the
    touched combinations. Beyond that the join alone does, its right side replicated if
    proven small, since a shuffle would bring a whole partition into one task. Nulls join
    nothing, hence the second part; rewriting those rows unasked changes nothing.
    """
    touched = batch.select(*partition_cols).distinct()
    values = touched.limit(MAX_NAMED_PARTITIONS + 1).collect()
    if len(values) > MAX_NAMED_PARTITIONS:
        named = replicated_join(target, touched, list(partition_cols), "left_semi")
    else:
        named = target
        for c in partition_cols:
            named = named.where(F.col(c).isin([v[c] for v in values if v[c] is not None]))
        if len(partition_cols) > 1:
            named = named.join(F.broadcast(touched), list(partition_cols), "left_semi")
    return named.unionByName(target.where(any_of([F.col(c).isNull() for c in partition_cols])))


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written to the shared folder for the time of a merge.

    A merge reads its batch more than once. Staging runs the plan behind it once, and
    makes all reads see the same rows even if that plan would not give them twice.
    """
    path = scratch_dir(df.sparkSession, "batch")
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete_path(df.sparkSession, path)


def write_silver(
    df: DataFrame, root: str, table: str, *, merge_keys: str | Sequence[str] | None = None,
    partition_cols: Sequence[str] = (), fmt: str = "parquet", batch_id: str | None = None,
    changed_at: dt.datetime | None = None,
) -> None:
    """Overwrite the table, or upsert into it by ``merge_keys`` if it exists.

    An upsert normally rewrites the table. If its partition columns are among the merge
    keys, a row cannot change partition, and only the partitions named in the batch are
    read and rewritten. With a ``batch_id`` the rows also go to the table's change feed
    (:mod:`millrace.sinks.changes`) as of ``changed_at``, now if not given, from which
    :func:`table_as_of` and :func:`table_history` read.
    """
    spark, path, columns = df.sparkSession, table_path(root, "silver", table), list(partition_cols)
    if fmt == "delta" and merge_keys and delta.is_table(spark, path):
        delta.merge(df, path, key_list(merge_keys))
        return
    recover_table(spark, path)
    merging = bool(merge_keys and path_exists(spark, path))
    if batch_id:
        with staged(df) as batch:
            changes.append_changes(batch, root, table, batch_id, changed_at, whole=not merging)
            write_silver(batch, root, table, merge_keys=merge_keys, partition_cols=columns, fmt=fmt)
        return
    if not merging:
        if fmt == "delta":
            writer = balanced(df, columns).write.format(fmt).mode("overwrite")
            (writer.partitionBy(*columns) if columns else writer).save(path)
        else:
            replace_table(balanced(df, columns), path, fmt, columns)
        return

    keys = key_list(merge_keys)
    stored = partition_columns(spark, path)
    columns = columns or stored
    target = read_typed(spark, path, fmt, {c: df.schema[c].dataType for c in stored if c in df.columns})
    with staged(df) as batch:
        if columns and set(columns) <= set(keys):
            merged = upsert(touched_partitions(target, batch, columns), batch, keys)
            balanced(merged, columns).write.format(fmt).mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy(*columns).save(path)
            spark.catalog.refreshByPath(path)
        else:
            replace_table(balanced(upsert(target, batch, keys), columns), path, fmt, columns)


def table_history(
    spark: SparkSession, root: str, table: str, layer: str = "bronze", batch: str = "_batch_id",
    ts: str = "_ingestion_timestamp", keys: Sequence[str] = (),
) -> DataFrame:
    """One row per load of a stored table: version, rows, first and last time.

    Of a silver table with a change feed, whose ``keys`` are given: one row per load and merge.
    """
    if layer == "silver" and keys:
        return changes.silver_history(spark, root, table, keys)
    return batch_history(read_table(spark, root, layer, table), batch, ts)


def table_as_of(
    spark: SparkSession, root: str, table: str, at: Any, *, keys: Sequence[str], layer: str = "bronze",
    ts: str = "_ingestion_timestamp", tie_breakers: Sequence[str] = ("_batch_id",),
) -> DataFrame:
    """A stored change log as it stood at ``at``: the row then in force for each key.

    A silver table is read from its change feed if it has one.
    """
    if layer == "silver" and path_exists(spark, changes.feed_path(root, table)):
        return changes.silver_as_of(spark, root, table, at, keys)
    return as_of(read_table(spark, root, layer, table), keys, ts, at, tie_breakers)


def _bucket_too_heavy(spark: SparkSession, path: str, fmt: str, keys: Sequence[str], parts: int) -> bool:
    """Whether one bucket of the written table holds far more rows than an even share."""
    bucket = F.pmod(F.hash(*keys), F.lit(parts))
    size = (
        spark.read.format(fmt).load(path).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
        .agg(F.max("rows").alias("heaviest"), F.sum("rows").alias("total"))
        .first()
    )
    heaviest, total = size["heaviest"] or 0, size["total"] or 0
    return heaviest > MAX_BUCKET_ROWS and heaviest > MAX_BUCKET_SKEW * total / parts


def write_gold(
    df: DataFrame, root: str, table: str, *, distribution: Distribution = "ROUND_ROBIN",
    keys: Sequence[str] = (), parts: int | None = None, name: str | None = None, fmt: str = "parquet",
) -> str:
    """Overwrite a gold table, lay it out and register it; returns the registered name.

    HASH buckets and sorts by ``keys`` so that joins and aggregates on them need no
    shuffle. The write splits a heavy bucket over tasks; if one turns out too heavy to be
    read by one task, the same files are registered without buckets, with a warning, and joins
    fall back to shuffles whose skew adaptive execution handles. ROUND_ROBIN writes even files:
    ``parts`` of them, or as many as the data needs at the advisory partition size.
    REPLICATE writes one plain copy; joins replicate it after checking its size
    (:func:`millrace.operators.joins.replicated_join`).

    The new files are complete before the old ones go, so ``df`` may read the table it
    replaces, and a write that fails leaves the table as it was. One writer at a time.
    """
    spark, path, name = df.sparkSession, table_path(root, "gold", table), name or table
    if distribution == "HASH":
        if not keys:
            raise ValueError("HASH distribution needs keys")
        parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        in_bucket = F.pmod(F.hash(*keys), F.lit(parts))
        shaped = df.withColumn("_bucket", in_bucket).hint("rebalance", F.col("_bucket")).drop("_bucket")
    elif distribution == "ROUND_ROBIN":
        shaped = df.repartition(parts) if parts else df.hint("rebalance")
    elif distribution == "REPLICATE":
        shaped = df
    else:
        raise ValueError(f"unknown distribution {distribution!r}")
    writer = shaped.write.format(fmt).mode("overwrite")
    if distribution == "HASH":
        writer = writer.bucketBy(parts, *keys).sortBy(*keys)
    if fmt == "delta":
        writer.option("path", path).saveAsTable(name)
    else:
        replace_registered(spark, writer, path, name)
    if distribution == "HASH" and _bucket_too_heavy(spark, path, fmt, keys, parts):
        warnings.warn(f"{name}: one of {parts} buckets is too heavy for one task; registered without buckets", stacklevel=2)
        spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, path=path, source=fmt)
    return name


def write_validated(flagged: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write valid and invalid rows in one pass, as the partitions ``_is_valid=true`` / ``false``.

    The plan behind ``flagged`` runs once, with nothing cached; reading either side
    afterwards opens only its directory.
    """
    replace_table(flagged, path, fmt, ["_is_valid"])


def read_validated(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Both sides of :func:`write_validated`; a filter on ``_is_valid`` opens one directory."""
    return read_typed(spark, path, fmt, {"_is_valid": T.BooleanType()})


def append_quarantine(rejected: DataFrame, path: str, batch_id: str, fmt: str = "parquet") -> None:
    """Add a batch's rejected rows to the quarantine.

    A batch owns its directory, so running it again replaces its rows instead of doubling them.
    """
    rejected.withColumn("_quarantine_batch", F.lit(batch_id)).write.format(fmt).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("_quarantine_batch").save(path)
