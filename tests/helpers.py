"""Plan inspection and row comparison."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def plan(df: DataFrame, mode: str = "formatted") -> str:
    modes = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(modes.fromString(mode))


def final_plan(df: DataFrame) -> str:
    """The plan as adaptive execution ran it."""
    df.collect()
    return re.split(r"(?m)^\+- == Initial Plan ==", plan(df, "simple"))[0]


def jobs_started(spark) -> int:
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
