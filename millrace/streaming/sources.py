"""Unbounded sources, read from the earliest record on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def stream_files(
    spark: SparkSession, directory: str, schema: T.StructType, fmt: str = "parquet",
    name_glob: str | None = None, files_per_batch: int | None = None,
) -> DataFrame:
    """Files as they arrive in a directory; ``files_per_batch`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(directory)


def kafka_options(servers: str, topic: str, group: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if group:
        options["kafka.group.id"] = group
    return options


def stream_topic(spark: SparkSession, servers: str, topic: str, group: str | None = None) -> DataFrame:
    """A message topic from its first offset; needs Spark's Kafka package on the cluster."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, group)).load()
