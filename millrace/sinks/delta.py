"""Table operations for sessions that have the Delta format; plain SQL, no imports.

Sessions without it use the parquet forms: ``upsert``, ``as_of``, ``batch_history``,
``retain``, ``compact`` and ``cluster_by_z_order``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _name(path: str) -> str:
    return f"delta.`{path}`"


def is_table(spark: SparkSession, path: str) -> bool:
    from millrace.sinks.storage import path_exists

    return path_exists(spark, f"{path}/_delta_log")


def merge_sql(path: str, source: str, keys: Sequence[str]) -> str:
    match = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    return (
        f"MERGE INTO {_name(path)} t USING {source} s ON {match} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def optimize_sql(path: str, zorder_cols: Sequence[str] = ()) -> str:
    by = f" ZORDER BY ({', '.join(zorder_cols)})" if zorder_cols else ""
    return f"OPTIMIZE {_name(path)}{by}"


def vacuum_sql(path: str, retain_hours: int) -> str:
    return f"VACUUM {_name(path)} RETAIN {retain_hours} HOURS"


def merge(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    view = f"merge_source_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        df.sparkSession.sql(merge_sql(path, view, keys))
    finally:
        df.sparkSession.catalog.dropTempView(view)


def optimize(spark: SparkSession, path: str, zorder_cols: Sequence[str] = (), retain_hours: int = 168) -> None:
    """Compact or cluster, then remove versions older than the retention."""
    spark.sql(optimize_sql(path, zorder_cols))
    spark.sql(vacuum_sql(path, retain_hours))


def history(spark: SparkSession, path: str) -> DataFrame:
    return spark.sql(f"DESCRIBE HISTORY {_name(path)}")


def read_as_of(spark: SparkSession, path: str, timestamp: str) -> DataFrame:
    return spark.read.format("delta").option("timestampAsOf", timestamp).load(path)
