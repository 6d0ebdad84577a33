"""Change feeds of silver tables: state at any moment, history, repeated batches."""

import datetime as dt

import pytest

from millrace.sinks import changes, layers

AT = dt.datetime(2024, 5, 6, 7, 8, 9, tzinfo=dt.UTC)
SCHEMA = "k int, v string"


def day(n):
    return AT + dt.timedelta(days=n)


def load(spark, root, rows, n, keys="k", schema=SCHEMA, **options):
    layers.write_silver(spark.createDataFrame(rows, schema), root, "t", merge_keys=keys, batch_id=f"0{n}", changed_at=day(n), **options)


def state(spark, root, n):
    found = layers.table_as_of(spark, root, "t", day(n), keys=["k"], layer="silver")
    assert found.columns[:2] == ["k", "v"]
    return sorted((tuple(r) for r in found.select("k", "v").collect()), key=str)


def test_state_at_every_moment(spark, root):
    load(spark, root, [(1, "a"), (2, "b"), (None, "n")], 0)
    load(spark, root, [(2, "c"), (3, "d"), (None, "m")], 1)
    load(spark, root, [(1, "e")], 2)
    load(spark, root, [(9, "z")], 3, keys=None)  # replaces the table
    load(spark, root, [(9, "y"), (1, "x")], 4)
    want = [
        [], [(1, "a"), (2, "b"), (None, "n")], [(1, "a"), (2, "c"), (3, "d"), (None, "m"), (None, "n")],
        [(1, "e"), (2, "c"), (3, "d"), (None, "m"), (None, "n")], [(9, "z")], [(1, "x"), (9, "y")],
    ]
    for n, rows in enumerate(want, -1):
        assert state(spark, root, n) == sorted(rows, key=str), n
    stored = layers.read_table(spark, root, "silver", "t")
    assert sorted((tuple(r) for r in stored.collect()), key=str) == want[-1]


def test_types_and_history(spark, root):
    load(spark, root, [(1, "a"), (2, "b")], 0)
    load(spark, root, [(2, "c"), (3, "d"), (None, "n")], 1)
    load(spark, root, [(3, "e"), (None, "n")], 2)
    found = changes.read_changes(spark, root, "t", ["k"])
    assert sorted(((r["_change_batch"], r["k"], r["_change_type"]) for r in found.collect()), key=str) == sorted(
        [("00", 1, "load"), ("00", 2, "load"), ("01", 2, "update"), ("01", 3, "insert"), ("01", None, "insert"),
         ("02", 3, "update"), ("02", None, "insert")], key=str
    )
    history = layers.table_history(spark, root, "t", "silver", keys=["k"]).orderBy("version").collect()
    assert [tuple(r)[1:2] + tuple(r)[3:] for r in history] == [("00", "load", 2, 0), ("01", "merge", 2, 1), ("02", "merge", 1, 1)]


def test_a_batch_that_runs_again_is_listed_once(spark, root):
    load(spark, root, [(1, "a")], 0)
    for _ in range(2):
        load(spark, root, [(1, "b"), (2, "c")], 1)
    assert state(spark, root, 1) == [(1, "b"), (2, "c")]
    assert changes.read_changes(spark, root, "t", ["k"]).count() == 3


def test_empty_writes_and_new_columns(spark, root):
    load(spark, root, [(1, "a")], 0)
    load(spark, root, [], 1, keys=None)
    assert state(spark, root, 0) == [(1, "a")] and state(spark, root, 1) == []
    load(spark, root, [(5, "f", 7)], 2, keys=None, schema="k int, v string, size int")
    now = layers.table_as_of(spark, root, "t", day(2), keys=["k"], layer="silver")
    assert [tuple(r) for r in now.collect()] == [(5, "f", 7)]


def test_partitioned_tables_have_feeds_too(spark, root):
    for n, rows in enumerate([[(1, "01"), (2, "02")], [(2, "02"), (3, "03")]]):
        load(spark, root, rows, n, keys="k,v", partition_cols=["v"])
    assert state(spark, root, 1) == [(1, "01"), (2, "02"), (3, "03")]


def test_tables_without_a_feed(spark, root):
    layers.write_silver(spark.createDataFrame([(1, "a")], SCHEMA), root, "t")
    with pytest.raises(ValueError, match="change feed"):
        changes.read_changes(spark, root, "t", ["k"])
