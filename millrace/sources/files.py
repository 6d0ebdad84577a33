"""Entity directories and incremental reads."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import all_of, quoted
from millrace.sinks.storage import path_exists, recover_table, replace_table


def read_entity(
    spark: SparkSession, root: str, entity: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Read one exported entity, ``{root}/{entity}``. A given schema saves the footer reads."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(f"{root}/{entity}")


def newer_than(df: DataFrame, watermark_column: str, last_watermark: Any) -> DataFrame:
    """Rows strictly after the last high-water mark; rows without one are left out.

    The mark is cast to the column's own type, so the comparison is a plain literal one
    and reaches the source (parquet row groups, JDBC WHERE clause).
    """
    mark = F.lit(last_watermark).cast(df.schema[watermark_column].dataType)
    return df.where(F.col(watermark_column) > mark)


def next_watermark(df: DataFrame, watermark_column: str) -> DataFrame:
    """One row: the mark to store for the next run (null if there was nothing to read)."""
    return df.agg(F.max(watermark_column).alias("next_watermark"))


def read_increment(df: DataFrame, state: str, watermark_column: str, ids: Sequence[str]) -> DataFrame:
    """The rows of a growing source that no earlier run has stored in ``state`` (:func:`store_watermark`).

    ``state`` has the highest watermark seen and the ids of the rows at exactly that mark. Rows above the mark
    are new, and so are those at it whose ids are not listed: rows that arrive late with the time of the border are
    neither lost nor read twice. The mark goes into the source's own filter; the list is joined with the rows at the
    border only. Rows without a watermark are left out. Without a state, everything else is new.
    """
    spark, mark = df.sparkSession, quoted(watermark_column)
    recover_table(spark, state)
    if not path_exists(spark, state):
        return df.where(mark.isNotNull())
    seen = spark.read.parquet(state)
    last = seen.select(F.max(quoted(watermark_column))).first()[0]
    if last is None:
        return df.where(mark.isNotNull())
    border = F.lit(last).cast(df.schema[watermark_column].dataType)
    listed = seen.select(*[quoted(c).alias(f"_seen_{c}") for c in ids])
    same = all_of([quoted(c).eqNullSafe(quoted(f"_seen_{c}")) for c in ids])
    late = df.where(mark == border).join(listed, same, "left_anti")
    return df.where(mark > border).unionByName(late)


def store_watermark(stored_rows: DataFrame, state: str, watermark_column: str, ids: Sequence[str]) -> None:
    """Move ``state`` on to the highest mark of the rows of a finished run, as they were stored, not as the source now is.

    A run that fails before this is read again by the next one. One writer at a time.
    """
    spark, mark = stored_rows.sparkSession, quoted(watermark_column)
    recover_table(spark, state)
    marks = stored_rows.select(mark, *[quoted(c) for c in ids]).where(mark.isNotNull())
    if path_exists(spark, state):
        marks = marks.unionByName(spark.read.parquet(state))
    highest = marks.select(F.max(mark)).scalar()
    replace_table(marks.where(mark == highest).distinct(), state)
