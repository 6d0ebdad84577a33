"""Type-2 histories against a plain Python walk through each key's rows."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import final_plan, rows
from millrace.operators import slices
from millrace.operators.scd import scd2_history, scd2_merge, scd2_merge_observed, scd2_observed, versions_of
from millrace.sinks import history as history_
from millrace.sinks import storage

SCHEMA = "k string, ts timestamp_ntz, n int, colour string, size int"
ATTRIBUTES = ["colour", "size"]
START = dt.datetime(2024, 1, 1)


def make_log(seed, count=400, hot_share=3):
    """A third of the rows on one key, gaps of days, repeated states, nulls and equal times."""
    pick = random.Random(seed)
    log = []
    for n in range(count):
        key = "hot" if n % hot_share == 0 else pick.choice(["a", "b", "c", None])
        ts = START + dt.timedelta(hours=pick.choice([0, 1, 5, 30, 24 * 40]) * pick.randint(0, 12))
        log.append((key, ts, n, pick.choice(["red", "blue", None]), pick.choice([1, 1, 1, None])))
    return log


def walk(log):
    versions, by_key = [], {}
    for row in sorted(log, key=lambda r: (r[1], r[2])):
        by_key.setdefault(row[0], []).append(row)
    for key, life in by_key.items():
        changes = [r for i, r in enumerate(life) if i == 0 or r[3:] != life[i - 1][3:]]
        for row, following in zip(changes, [*changes[1:], None]):
            until = following[1] if following else None
            versions.append((key, row[3], row[4], row[1], until, until is None))
    return versions


def history(df, hot_rows=50):
    """By default the keys with more than 50 rows are the hot ones."""
    return scd2_history(df, ["k"], "ts", ATTRIBUTES, ["n"], hot_rows)


def as_list(df):
    order = ["k", "colour", "size", "valid_from", "valid_to", "is_current"]
    return sorted((tuple(r) for r in df.select(*order).collect()), key=str)


@pytest.mark.parametrize("hot_rows", [0, 1, 3, 20, 50, 10**6])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_history(spark, seed, hot_rows):
    log = make_log(seed)
    assert as_list(history(spark.createDataFrame(log, SCHEMA), hot_rows)) == sorted(walk(log), key=str)


@pytest.mark.parametrize("kind", ["timestamp", "date", "int"])
def test_other_clocks(spark, kind):
    log = spark.createDataFrame(make_log(9), SCHEMA)
    clock = {"int": "datediff(ts, date'2024-01-01')"}.get(kind, f"cast(ts as {kind})")
    log = log.withColumn("ts", F.expr(clock))
    assert as_list(history(log, 10)) == as_list(history(log, 10**6))


def test_rows_without_a_time_come_first(spark):
    log = [("a", None if n < 8 else START + dt.timedelta(hours=n), n, "red" if n % 5 else "blue", 1) for n in range(40)]
    frame = spark.createDataFrame(log, SCHEMA)
    assert as_list(history(frame, 5)) == as_list(history(frame, 10**6))


def test_one_row_and_no_rows(spark):
    log = [("a", START, 1, None, None)]
    assert as_list(history(spark.createDataFrame(log, SCHEMA))) == [("a", None, None, START, None, True)]
    assert history(spark.createDataFrame([], SCHEMA)).count() == 0


def test_intervals_join_up(spark):
    versions = [r for r in as_list(history(spark.createDataFrame(make_log(7), SCHEMA)))]
    lives = {}
    for key, _, _, start, end, current in versions:
        lives.setdefault(key, []).append((start, end, current))
    for life in lives.values():
        life.sort(key=lambda v: (v[0], v[1] is None, v[1] or v[0]))
        assert [v[1] for v in life[:-1]] == [v[0] for v in life[1:]]
        assert [v[2] for v in life] == [False] * (len(life) - 1) + [True]


def test_hot_keys_are_bounded_by_their_share(spark, monkeypatch):
    monkeypatch.setattr(slices, "MAX_HOT_KEYS", 10)
    frame = spark.range(1000).selectExpr("if(id < 300, 0, id) as k", "id as ts")
    assert [tuple(r) for r in slices.hot_keys(frame, ["k"], 90).collect()] == [(0, 100)]
    assert [tuple(r) for r in slices.hot_keys(frame, ["k"], 0).collect()] == [(0, 100)]
    assert slices.hot_keys(frame, ["k"], 300).count() == 0


def slice_sizes(log, order, hot_rows):
    cut = slices.with_slices(log, ["k"], order, slices.slice_cuts(log, ["k"], order, hot_rows))
    found = cut.groupBy("k", "_slice").agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("lo"), F.max(F.struct(*order)).alias("hi"))
    assert cut.count() == log.count()
    by_key = {}
    for r in found.collect():
        by_key.setdefault(r["k"], []).append((r["_slice"], r["n"], r["lo"], r["hi"]))
    return by_key


@pytest.mark.parametrize("hot_rows", [3, 100, 1000])
def test_slices_hold_about_equal_numbers_of_rows(spark, hot_rows):
    """Two outliers, a burst at one time and rows without a time, on one key with most of the rows."""
    log = spark.range(24_000).selectExpr(
        "if(id % 12 = 0, 'b' || id % 36, 'a') as k",
        "case when id < 2 then timestamp_ntz'1990-01-01' when id < 8000 then timestamp_ntz'2024-01-01'"
        " when id < 10000 then null else timestampadd(SECOND, id, timestamp_ntz'2024-02-01') end as ts",
        "id as n",
    )
    sizes = slice_sizes(log, ["ts", "n"], hot_rows)
    assert len(sizes["a"]) >= 22_000 / (2 * hot_rows)
    for found in sizes.values():
        if found[0][0] is None:
            assert found[0][1] <= hot_rows and len(found) == 1
            continue
        assert max(n for _, n, _, _ in found) <= 2 * hot_rows
        found.sort()
        key = lambda p: (p[0] is not None, p[0] or START, p[1])
        assert all(key(a[3]) < key(b[2]) for a, b in zip(found, found[1:], strict=False))


def test_many_samples_make_even_slices(spark):
    log = spark.range(400_000).selectExpr("0 as k", "timestampadd(SECOND, cast(pow(id, 0.3) as int), timestamp_ntz'2024-01-01') as ts", "id as n")
    found = slice_sizes(log, ["ts", "n"], 20_000)[0]
    assert 15 <= len(found) <= 25 and max(n for _, n, _, _ in found) <= 40_000


@pytest.fixture
def stored_log(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame(make_log(1), SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def window_partitions(shown):
    """What the windows over log rows are partitioned by."""
    lines = [line for line in shown.splitlines() if "+- Window [" in line]
    over_rows = [line for line in lines if "lag(_state" in line or "lead(ts" in line]
    return [line.split("windowspecdefinition(")[1].split(" ASC")[0].split(" DESC")[0] for line in over_rows]


def test_plan_without_hot_keys(stored_log):
    """No key is hot: the sliced branch is dropped at run time, and one shuffle serves both windows."""
    shown = final_plan(history(stored_log, hot_rows=10**6))
    assert window_partitions(shown) and not any("_slice" in p for p in window_partitions(shown))
    assert shown.count("FileScan") == 1 and "_slice#" not in shown


def test_plan_with_hot_keys(stored_log):
    shown = final_plan(history(stored_log, hot_rows=100))  # one key of five
    assert sum("_slice" in p for p in window_partitions(shown)) >= 2
    assert "ReusedExchange" in shown


@pytest.mark.parametrize("seed", [4, 5])
@pytest.mark.parametrize("days", [2, 20, 200])
@pytest.mark.parametrize("hot_rows", [20, 10**6])
def test_merging_in_order_equals_one_pass(spark, seed, days, hot_rows):
    log = make_log(seed)
    border = START + dt.timedelta(days=days, minutes=30)
    first = spark.createDataFrame([r for r in log if r[1] < border], SCHEMA)
    rest = spark.createDataFrame([r for r in log if r[1] >= border], SCHEMA)
    merged = scd2_merge(history(first), rest, ["k"], "ts", ATTRIBUTES, ["n"], hot_rows=hot_rows)
    assert as_list(merged) == sorted(walk(log), key=str)


def test_late_change_splits_the_version_it_falls_into(spark):
    day = lambda n: START + dt.timedelta(days=n)
    stored = history(spark.createDataFrame(
        [("a", day(1), 1, "red", 1), ("a", day(5), 2, "blue", 1), ("b", day(1), 3, "red", 1)], SCHEMA))
    late = spark.createDataFrame([("a", day(3), 4, "green", 1), ("c", day(2), 5, "red", 1)], SCHEMA)
    assert as_list(scd2_merge(stored, late, ["k"], "ts", ATTRIBUTES, ["n"])) == sorted(
        [
            ("a", "red", 1, day(1), day(3), False),
            ("a", "green", 1, day(3), day(5), False),
            ("a", "blue", 1, day(5), None, True),
            ("b", "red", 1, day(1), None, True),
            ("c", "red", 1, day(2), None, True),
        ],
        key=str,
    )


def test_merging_nothing_changes_nothing(spark):
    stored = history(spark.createDataFrame(make_log(6), SCHEMA))
    merged = scd2_merge(stored, spark.createDataFrame([], SCHEMA), ["k"], "ts", ATTRIBUTES, ["n"])
    assert rows(merged) == rows(stored)


def by_name(spark, rows_):
    return spark.createDataFrame(rows_, SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("hot_rows", [20, 10**6])
def test_late_batches_equal_one_load(spark, seed, hot_rows):
    """Rows dealt to batches at random, so most of them come late; a batch is merged again in between."""
    pick = random.Random(seed)
    log = make_log(seed, 240)
    batches = [[], [], []]
    for row in log:
        pick.choice(batches).append(row)
    by = {"keys": ["k"], "ts": "ts", "attributes": ATTRIBUTES, "tie_breakers": ["n"], "hot_rows": hot_rows}
    observed = storage.stage(scd2_observed(by_name(spark, batches[0]), **by), "observed")
    for batch in (batches[1], batches[2], batches[1]):
        observed = storage.stage(scd2_merge_observed(observed, by_name(spark, batch), **by), "observed")
    assert observed.count() == len(log)
    assert as_list(versions_of(observed, ["k"], "ts", ATTRIBUTES)) == sorted(walk(log), key=str)


def test_a_late_row_restores_the_version_it_splits(spark):
    day = lambda n: START + dt.timedelta(days=n)
    by = (["k"], "ts", ATTRIBUTES, ["n"])
    stored = scd2_observed(by_name(spark, [("a", day(1), 1, "red", 1), ("a", day(5), 2, "red", 1), ("a", day(9), 3, "blue", 1)]), *by)
    merged = scd2_merge_observed(stored, by_name(spark, [("a", day(3), 4, "green", 1)]), *by)
    versions = as_list(versions_of(merged, ["k"], "ts", ATTRIBUTES))
    assert [(v[1], v[3], v[4]) for v in sorted(versions, key=lambda v: v[3])] == [
        ("red", day(1), day(3)), ("green", day(3), day(5)), ("red", day(5), day(9)), ("blue", day(9), None)
    ]


def test_stored_merge_rewrites_touched_buckets_only(spark, root):
    log = make_log(3, 200)
    by = {"keys": ["k"], "ts": "ts", "attributes": ATTRIBUTES, "tie_breakers": ["n"]}
    history_.merge_history(by_name(spark, log[:150]), root, "t", buckets=16, **by)
    files = lambda: {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{root}/silver/t/**/*.parquet", recursive=True)}
    before = files()
    history_.merge_history(by_name(spark, [r for r in log[150:] if r[0] == "a"]), root, "t", buckets=16, **by)
    untouched = before.items() & files().items()
    assert 0 < len(untouched) < len(before)
    history_.merge_history(by_name(spark, [r for r in log[150:] if r[0] != "a"]), root, "t", buckets=16, **by)
    stored = history_.read_history(spark, root, "t", keys=["k"], ts="ts", attributes=ATTRIBUTES)
    assert as_list(stored) == sorted(walk(log), key=str)
    history_.merge_history(by_name(spark, []), root, "t", buckets=16, **by)
    assert as_list(stored) == sorted(walk(log), key=str)
