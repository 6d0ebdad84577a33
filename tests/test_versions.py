import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from millrace.operators.versions import as_of, batch_history, latest_per_key, latest_state, retain


@pytest.fixture
def events(spark, sf_dir):
    """Events with a third of all rows moved to one user."""
    frame = spark.read.parquet(f"{sf_dir}/events.parquet").drop("props")
    return frame.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id")))


def brute_force_as_of(log, at):
    state = {}
    for r in sorted(log, key=lambda r: (r["ts"], r["event_id"])):
        if r["ts"] <= at:
            state[r["user_id"]] = r["event_id"]
    return state


@pytest.mark.parametrize("at", [dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 9, 5), dt.datetime(2030, 1, 1)])
def test_as_of(events, at):
    got = as_of(events, ["user_id"], "ts", at, ["event_id"])
    assert {r["user_id"]: r["event_id"] for r in got.collect()} == brute_force_as_of(events.collect(), at)


def test_as_of_includes_its_moment_and_takes_text(spark):
    log = spark.sql("select 1 as k, timestamp_ntz'2024-01-01 10:00:00' as ts")
    assert as_of(log, ["k"], "ts", "2024-01-01 10:00:00").count() == 1
    assert as_of(log, ["k"], "ts", "2024-01-01 09:59:59").count() == 0


def test_as_of_the_end_is_the_latest_state(events):
    latest = latest_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    assert rows(as_of(events, ["user_id"], "ts", "2100-01-01", ["event_id"])) == rows(latest)


def test_both_forms_of_latest_agree(events):
    by_window = latest_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    by_aggregate = latest_state(events, ["user_id"], "ts", ["event_id"])
    assert by_aggregate.columns == by_window.columns
    assert rows(by_aggregate) == rows(by_window)
    two_keys = ["event_type", "user_id"]
    assert rows(latest_state(events, two_keys, "ts", ["event_id"])) == rows(
        latest_per_key(events, two_keys, [F.desc("ts"), F.desc("event_id")])
    )


def test_one_row_per_key_and_task_is_shuffled(events):
    shown = plan(latest_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")]), "simple")
    below_exchange = shown.split("Exchange")[1]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange
    shown = plan(latest_state(events, ["user_id"], "ts", ["event_id"]), "simple")
    assert "partial_max_by" in shown.split("Exchange")[1]


def test_retention_keeps_every_read_since_the_cutoff(events):
    cutoff = dt.datetime(2024, 1, 20)
    kept = retain(events, ["user_id"], "ts", cutoff, ["event_id"])
    assert 0 < kept.count() < events.count()
    for at in (cutoff, cutoff + dt.timedelta(hours=7), dt.datetime(2024, 1, 28), dt.datetime(2100, 1, 1)):
        assert rows(as_of(kept, ["user_id"], "ts", at, ["event_id"])) == rows(
            as_of(events, ["user_id"], "ts", at, ["event_id"])
        )
    assert rows(retain(kept, ["user_id"], "ts", cutoff, ["event_id"])) == rows(kept)


def test_retention_keeps_rows_without_a_time(spark):
    log = spark.sql("select 1 as k, cast(null as timestamp_ntz) as ts union all select 1, timestamp_ntz'2020-01-01'")
    assert retain(log, ["k"], "ts", "2024-01-01").count() == 2


def test_batch_history(spark):
    frame = spark.sql(
        "select * from values ('b', timestamp_ntz'2024-01-02'), ('a', timestamp_ntz'2024-01-01'),"
        " ('b', timestamp_ntz'2024-01-03') as t(_batch_id, ts)"
    )
    got = [tuple(r) for r in batch_history(frame, "_batch_id", "ts").orderBy("version").collect()]
    assert got == [
        ("a", 1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), 0),
        ("b", 2, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3), 1),
    ]
