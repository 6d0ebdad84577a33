"""Session settings for jobs and tests that build their own session.

Nothing in the library depends on these: every function takes the session or the
DataFrame it is given.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC as the session zone.

    ``conf`` keys use ``__`` for ``.`` (``spark__sql__shuffle__partitions="8"``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


SHUFFLE_PARTITION_BYTES = 512 * 1024 * 1024


def shuffle_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job that shuffles about ``input_bytes`` on ``cores`` cores.

    Starts with partitions a task can sort in memory, at least two per core; adaptive
    execution merges the small ones to its advisory size and splits skewed ones in joins.
    """
    partitions = max(math.ceil(input_bytes / SHUFFLE_PARTITION_BYTES), 2 * cores)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
    }
