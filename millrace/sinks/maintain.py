"""Compaction and clustering of stored tables."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import quoted
from millrace.functions.zorder import with_z_rank
from millrace.operators.versions import retain
from millrace.sinks.storage import partition_columns, path_bytes, read_stored, replace_table

TARGET_FILE_BYTES = 512 * 1024 * 1024
# What one task sorts at most: stored bytes, which take a dozen times as much memory.
SORTED_BYTES = 128 * 1024 * 1024
# A partition that shares no task with others is no smaller than this on average.
LEAST_SORTED_BYTES = 4 * 1024 * 1024
RETAIN_HOURS = 168


def compact(
    spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES, partition_cols: Sequence[str] | None = None
) -> None:
    """Rewrite small files into files of about ``target_bytes``, partitioned as before or by ``partition_cols``.

    Unpartitioned tables are not shuffled: the scan itself packs files up to the target
    into one task, and each task writes one file. Partitioned tables are rebalanced by
    their partition columns, so small partitions end in one file and big ones are split.
    """
    session = spark.newSession()  # its own settings, the same context
    session.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    session.conf.set("spark.sql.files.openCostInBytes", str(min(target_bytes // 64, 4 * 1024 * 1024)))
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    table = read_stored(session, path)
    partition_cols = partition_columns(spark, path) if partition_cols is None else partition_cols
    if partition_cols:
        table = table.hint("rebalance", *[F.col(c) for c in partition_cols])
    replace_table(table, path, partition_cols=list(partition_cols))
    spark.catalog.refreshByPath(path)


def cluster_by_z_order(df: DataFrame, columns: Sequence[str], files: int, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Lay rows out so that each of ``files`` files covers a small box of the columns' space.

    The boxes hold about equal numbers of rows, whatever the values are. The range split is on the partition
    columns, then the Z value, then a number drawn per row: a range lies in one partition or few, so
    there are at most as many files as ranges and partitions together, and rows that share
    one Z value, however many and even if they are copies of each other, can be spread over
    several files. The draw is seeded, so a stored table gives the same layout when a task
    is run again.
    """
    parts = [quoted(c) for c in partition_cols]
    return (
        with_z_rank(df, columns)
        .withColumn("_spread", F.rand(0))
        .repartitionByRange(files, *parts, "_z", "_spread")
        .sortWithinPartitions(*parts, "_z")
        .drop("_z", "_spread")
    )


def optimize_table(
    spark: SparkSession, path: str, zorder_cols: Sequence[str] = (), target_bytes: int = TARGET_FILE_BYTES
) -> None:
    """Compact a table, clustering it by ``zorder_cols`` if given; its partitions and their values stay.

    A task sorts the rows of each clustered file in memory, so these have ``SORTED_BYTES`` at most, also
    where ``target_bytes`` is more.
    """
    if not zorder_cols:
        compact(spark, path, target_bytes)
        return
    parts, size = partition_columns(spark, path), path_bytes(spark, path)
    files = max(1, math.ceil(size / min(target_bytes, SORTED_BYTES)))
    table = read_stored(spark, path)
    apart = math.ceil(size / LEAST_SORTED_BYTES)
    if parts and apart > files:
        # The directories part the files anyway, so as many tasks as there are cost few more files.
        files = max(files, min(apart, table.select(*[quoted(c) for c in parts]).distinct().count()))
    replace_table(cluster_by_z_order(table, zorder_cols, files, parts), path, partition_cols=parts)


def prune_log(
    spark: SparkSession, path: str, keys: Sequence[str], ts: str, now: dt.datetime,
    retain_hours: int = RETAIN_HOURS, tie_breakers: Sequence[str] = (),
) -> None:
    """Rewrite a stored change log without the versions superseded before the retention began.

    For a pause of the stream that writes the log, if one does.
    """
    cutoff = now - dt.timedelta(hours=retain_hours)
    stored = partition_columns(spark, path)
    kept = retain(read_stored(spark, path), keys, ts, cutoff, tie_breakers)
    if "stream_batch" in stored:
        # Before the first micro-batch, where the stream's own directories do not hide it.
        kept = kept.withColumn("stream_batch", F.lit(-1))
    replace_table(kept, path, partition_cols=stored)
