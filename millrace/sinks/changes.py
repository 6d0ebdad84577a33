"""The change feed of a silver table: every row that a load or merge wrote, with its time.

The feed lies beside the table, one directory per batch, so a batch that is run again replaces what it wrote.
State and history of any moment are read from it; the table itself holds the newest state only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.columns import all_of, any_of, quoted
from millrace.operators.versions import latest_state
from millrace.sinks.storage import path_exists, read_stored, table_path

CHANGED_AT, BATCH, WHOLE = "_changed_at", "_change_batch", "_whole_table"


def feed_path(root: str, table: str) -> str:
    return table_path(root, "silver", f"{table}__changes")


def append_changes(rows: DataFrame, root: str, table: str, batch_id: str, changed_at: dt.datetime | None, whole: bool) -> None:
    """Add the rows of one write; ``whole`` says that they replaced the table.

    A batch without rows is kept too, by a row that has nothing but the batch's own columns: a table replaced by
    nothing was empty from then on.
    """
    spark = rows.sparkSession
    when = F.lit(changed_at) if changed_at else F.lit(dt.datetime.now(dt.UTC))
    stamps = {CHANGED_AT: when.cast("timestamp"), WHOLE: F.lit(whole), "_is_row": F.lit(True), BATCH: F.lit(batch_id)}
    mark = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]).withColumns(
        stamps | {"_is_row": F.lit(False)}
    )
    feed = rows.withColumns(stamps).unionByName(mark)
    feed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(feed_path(root, table))


def _feed(spark: SparkSession, root: str, table: str) -> DataFrame:
    path = feed_path(root, table)
    if not path_exists(spark, path):
        raise ValueError(f"silver table {table} has no change feed; write it with a batch_id")
    return read_stored(spark, path, mergeSchema="true").withColumn(BATCH, F.col(BATCH).cast("string"))


def _loads(feed: DataFrame) -> DataFrame:
    """One row per batch; the marks alone, which are few."""
    return feed.where("not _is_row").select(BATCH, CHANGED_AT, WHOLE)


def read_changes(spark: SparkSession, root: str, table: str, keys: Sequence[str]) -> DataFrame:
    """All changes with ``_change_type``, ``_changed_at`` and ``_change_batch``.

    ``load`` is a row of a whole-table write, ``insert`` one whose key the table did not have, ``update`` one that
    replaced another; rows with a null in the key match nothing. Rows a whole-table write took away are not listed.
    """
    feed = _feed(spark, root, table)
    # The number of whole-table writes up to each batch: one window over one row per batch.
    upto = Window.orderBy(CHANGED_AT, BATCH)
    era = _loads(feed).select(F.col(BATCH).alias("_batch"), F.count_if(WHOLE).over(upto).alias("_era"))
    rows = feed.where("_is_row").join(era, F.col(BATCH) == F.col("_batch")).drop("_batch", "_is_row")
    order = (CHANGED_AT, BATCH)
    first = F.row_number().over(Window.partitionBy(*keys, "_era").orderBy(*order)) == 1
    is_new = first | any_of([quoted(k).isNull() for k in keys])
    kind = F.when(F.col(WHOLE), "load").when(is_new, "insert").otherwise("update")
    return rows.withColumn("_change_type", kind).drop("_era", WHOLE)


def silver_as_of(spark: SparkSession, root: str, table: str, at: Any, keys: Sequence[str]) -> DataFrame:
    """The table as it stood at ``at``, this moment included: the newest row of every key since the last whole write."""
    moment = F.lit(at).cast("timestamp")
    feed = _feed(spark, root, table).where(F.col(CHANGED_AT) <= moment)
    began = _loads(feed).agg(F.max(F.when(F.col(WHOLE), F.struct(CHANGED_AT, BATCH)))).scalar()
    rows = feed.where("_is_row").withColumn("_began", began).where(
        F.col("_began").isNull() | (F.struct(CHANGED_AT, BATCH) >= F.col("_began"))
    ).drop("_began")
    keyed = all_of([quoted(k).isNotNull() for k in keys])
    state = latest_state(rows.where(keyed), keys, CHANGED_AT, [BATCH]).unionByName(rows.where(~keyed))
    return state.drop(CHANGED_AT, BATCH, WHOLE, "_is_row")


def silver_history(spark: SparkSession, root: str, table: str, keys: Sequence[str]) -> DataFrame:
    """One row per load or merge: version, batch, time, operation, rows inserted and rows updated."""
    changes = read_changes(spark, root, table, keys)
    counts = changes.groupBy(F.col(BATCH).alias("_batch")).agg(
        F.count_if(F.col("_change_type") != "update").alias("rows_inserted"), F.count_if(F.col("_change_type") == "update").alias("rows_updated")
    )
    loads = _loads(_feed(spark, root, table))
    zero = F.lit(0).cast("long")
    return loads.join(counts, F.col(BATCH) == F.col("_batch"), "left").select(
        (F.row_number().over(Window.orderBy(CHANGED_AT, BATCH)) - 1).alias("version"), F.col(BATCH).alias("batch_id"),
        F.col(CHANGED_AT).alias("changed_at"), F.when(F.col(WHOLE), "load").otherwise("merge").alias("operation"),
        F.coalesce("rows_inserted", zero).alias("rows_inserted"), F.coalesce("rows_updated", zero).alias("rows_updated"),
    )
