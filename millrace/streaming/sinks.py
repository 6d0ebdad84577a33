"""Streams into bronze and silver tables. Checkpoints make a restarted stream go on where it stopped."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.versions import latest_state
from millrace.sinks.layers import with_batch_metadata
from millrace.sinks.storage import replace_table


def stream_to_bronze(
    stream: DataFrame, path: str, checkpoint: str, *, source: str, batch_id: str,
    ingested_at: dt.datetime | None = None, available_now: bool = True,
) -> StreamingQuery:
    """Append the stream to a bronze table with batch metadata, each record once."""
    writer = (
        with_batch_metadata(stream, source, batch_id, ingested_at)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def stream_upsert(
    stream: DataFrame, path: str, checkpoint: str, *, keys: Sequence[str], ts: str,
    tie_breakers: Sequence[str] = (), available_now: bool = True,
) -> StreamingQuery:
    """Upsert the stream into a silver change log: the newest row per key and micro-batch.

    A micro-batch writes its own rows only, never the table, so its cost does not grow
    with the table. It owns one directory and overwrites it, so a batch that is run again
    after a failure changes nothing. Readers settle the batches by event time
    (:func:`read_upserted`): a late row cannot replace a newer one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = latest_state(batch, keys, ts, tie_breakers)
        newest.write.mode("overwrite").parquet(f"{path}/stream_batch={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_upserted(
    spark: SparkSession, path: str, keys: Sequence[str], ts: str, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """The current row per key of a change log written by :func:`stream_upsert`."""
    log = spark.read.parquet(path).drop("stream_batch")
    return latest_state(log, keys, ts, tie_breakers)


def fold_upserts(
    spark: SparkSession, path: str, keys: Sequence[str], ts: str, tie_breakers: Sequence[str] = ()
) -> None:
    """Replace the change log by its current rows, so that reads stay cheap.

    For a pause of the stream. The folded rows take the place of a batch before the first
    one; a stream that goes on, or repeats its last batch, finds its own directories free.
    """
    current = read_upserted(spark, path, keys, ts, tie_breakers)
    replace_table(current.withColumn("stream_batch", F.lit(-1)), path, partition_cols=["stream_batch"])
