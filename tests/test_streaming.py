import datetime as dt

import pytest

from helpers import rows
from millrace.streaming.sinks import fold_upserts, read_upserted, stream_to_bronze, stream_upsert
from millrace.streaming.sources import kafka_options, stream_files

SCHEMA = "k int, ts timestamp_ntz, v string"
DAY = [dt.datetime(2024, 1, n) for n in range(1, 6)]
ORDER = {"keys": ["k"], "ts": "ts", "tie_breakers": ["v"]}


@pytest.fixture
def inbox(tmp_path):
    return str(tmp_path / "inbox")


def put(spark, inbox, *data):
    spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(inbox)


def stream(spark, inbox, **options):
    return stream_files(spark, inbox, spark.createDataFrame([], SCHEMA).schema, **options)


def test_bronze_takes_each_record_once(spark, inbox, tmp_path):
    path, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")
    put(spark, inbox, (1, DAY[0], "a"))
    for extra in [(2, DAY[1], "b"), (3, DAY[2], "c")]:
        stream_to_bronze(stream(spark, inbox), path, checkpoint, source="hub", batch_id="b").awaitTermination()
        put(spark, inbox, extra)
    stored = spark.read.parquet(path)
    assert sorted(r["k"] for r in stored.collect()) == [1, 2]
    assert {"_ingestion_timestamp", "_source_system", "_batch_id"} <= set(stored.columns)


def test_upsert_over_batches_with_a_late_row(spark, inbox, tmp_path):
    path, checkpoint = str(tmp_path / "silver"), str(tmp_path / "checkpoint")
    batches = [
        [(1, DAY[1], "first"), (1, DAY[2], "second"), (2, DAY[0], "x")],
        [(1, DAY[0], "late"), (2, DAY[3], "y"), (3, DAY[3], "new")],
    ]
    for batch in batches:
        put(spark, inbox, *batch)
        stream_upsert(stream(spark, inbox), path, checkpoint, **ORDER).awaitTermination()
    got = {r["k"]: r["v"] for r in read_upserted(spark, path, **ORDER).collect()}
    assert got == {1: "second", 2: "y", 3: "new"}


def test_running_a_batch_again_changes_nothing(spark, inbox, tmp_path):
    path = str(tmp_path / "silver")
    put(spark, inbox, (1, DAY[1], "a"), (2, DAY[1], "b"))
    for attempt in ("one", "two"):  # a lost checkpoint makes the stream start over with the same batch ids
        stream_upsert(stream(spark, inbox), path, str(tmp_path / attempt), **ORDER).awaitTermination()
    stored = spark.read.parquet(path)
    assert stored.count() == 2 and [r["stream_batch"] for r in stored.select("stream_batch").distinct().collect()] == [0]


def test_many_small_batches_equal_one(spark, inbox, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(6).write.parquet(inbox)
    order = {"keys": ["user_id"], "ts": "ts", "tie_breakers": ["event_id"]}
    results = []
    for label, per_batch in (("many", 1), ("one", None)):
        path = str(tmp_path / label)
        source = stream_files(spark, inbox, events.schema, files_per_batch=per_batch)
        stream_upsert(source, path, str(tmp_path / f"{label}_checkpoint"), **order).awaitTermination()
        results.append(rows(read_upserted(spark, path, **order)))
    assert results[0] == results[1]
    assert len(spark.read.parquet(str(tmp_path / "many")).select("stream_batch").distinct().collect()) == 6


def test_folding_keeps_the_state_and_the_stream_goes_on(spark, inbox, tmp_path):
    path, checkpoint = str(tmp_path / "silver"), str(tmp_path / "checkpoint")

    def run(*batch):
        put(spark, inbox, *batch)
        stream_upsert(stream(spark, inbox), path, checkpoint, **ORDER).awaitTermination()

    run((1, DAY[1], "a"), (2, DAY[1], "b"))
    run((1, DAY[2], "c"))
    before = rows(read_upserted(spark, path, **ORDER))
    fold_upserts(spark, path, **ORDER)
    assert rows(read_upserted(spark, path, **ORDER)) == before
    assert spark.read.parquet(path).count() == 2
    run((2, DAY[0], "late"), (3, DAY[3], "d"))
    assert {r["k"]: r["v"] for r in read_upserted(spark, path, **ORDER).collect()} == {1: "c", 2: "b", 3: "d"}


def test_kafka_starts_at_the_earliest_offset():
    assert kafka_options("h:9092", "t", "g") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest", "kafka.group.id": "g",
    }
