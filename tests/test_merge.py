import random
from collections import Counter

import pytest

from helpers import final_plan, rows
from millrace.operators.merge import upsert, upsert_newer

SCHEMA = "k int, part string, v string"


def frame(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def test_update_insert_and_keep(spark):
    target = frame(spark, (1, "a", "old"), (2, "a", "old"))
    source = frame(spark, (2, "b", "new"), (3, "c", "new"))
    assert sorted(tuple(r) for r in upsert(target, source, "k").collect()) == [
        (1, "a", "old"), (2, "b", "new"), (3, "c", "new"),
    ]


def test_composite_key_as_text_or_list(spark):
    target = frame(spark, (1, "a", "old"), (1, "b", "old"))
    source = frame(spark, (1, "b", "new"))
    expected = [(1, "a", "old"), (1, "b", "new")]
    assert sorted(tuple(r) for r in upsert(target, source, " k , part ").collect()) == expected
    assert sorted(tuple(r) for r in upsert(target, source, ["k", "part"]).collect()) == expected


@pytest.mark.parametrize("seed", range(4))
def test_against_a_dictionary(spark, seed):
    pick = random.Random(seed)
    key = lambda: (pick.choice([None, *range(12)]), pick.choice(["a", "b", None]))
    target, source = [{key(): f"{side}{i}" for i in range(30)} for side in ("old", "new")]
    as_frame = lambda rows_: frame(spark, *[(*k, v) for k, v in rows_.items()])
    whole = lambda rows_: {k: v for k, v in rows_.items() if None not in k}
    expected = list({**whole(target), **whole(source)}.items())
    expected += [(k, v) for rows_ in (target, source) for k, v in rows_.items() if None in k]
    got = upsert(as_frame(target), as_frame(source), "k, part").collect()
    assert Counter((tuple(r)[:2], r["v"]) for r in got) == Counter(expected)


def test_null_keys_match_nothing(spark):
    target = frame(spark, (None, "a", "old"))
    source = frame(spark, (None, "a", "new"))
    assert sorted(r["v"] for r in upsert(target, source, "k").collect()) == ["new", "old"]


def test_upserting_twice_changes_nothing(spark):
    target = frame(spark, (1, "a", "old"), (2, "a", "old"))
    source = frame(spark, (2, "b", "new"), (3, "c", "new"))
    once = upsert(target, source, "k")
    assert rows(upsert(once, source, "k")) == rows(once)


def test_two_source_rows_for_one_target_row_are_an_error(spark):
    target = frame(spark, (1, "a", "old"))
    merged = upsert(target, frame(spark, (1, "b", "x"), (1, "c", "y")), "k")
    with pytest.raises(Exception, match="several source rows match one target row"):
        merged.collect()


def test_repeated_new_keys_are_all_added(spark):
    target = frame(spark, (1, "a", "old"))
    assert upsert(target, frame(spark, (2, "b", "x"), (2, "c", "y")), "k").count() == 3


def test_source_columns(spark):
    target = frame(spark, (1, "a", "old"))
    with pytest.raises(ValueError, match="part, v"):
        upsert(target, frame(spark, (1,), schema="k int"), "k")
    wider = frame(spark, ("extra", "new", 1, "b"), schema="other string, v string, k int, part string")
    assert [tuple(r) for r in upsert(target, wider, "k").collect()] == [(1, "b", "new")]


def test_small_batch_does_not_shuffle_the_target(spark, sf_dir):
    target = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    batch = target.where("l_orderkey = 5").dropDuplicates(["l_orderkey", "l_linenumber"])
    shown = final_plan(upsert(target, batch, "l_orderkey, l_linenumber"))
    assert "BroadcastHashJoin" in shown and "SortMergeJoin" not in shown


def test_a_hot_target_key_is_split(spark):
    """A third of the target on one key, the batch too big to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "400k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.shuffle.partitions": "16",
    }
    target = spark.range(120_000, numPartitions=8).selectExpr(
        "if(id % 3 = 0, 7, id) as k", "cast(xxhash64(id) as string) as part", "'old' as v"
    )
    source = spark.range(500).selectExpr("id * 2 + 7 as k", "'p' as part", "'new' as v")
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        merged = upsert(target, source, "k")
        assert "SortMergeJoin(skew=true)" in final_plan(merged)
        got = rows(merged)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    keys = {r["k"] for r in source.collect()}
    expected = [tuple(r) for r in target.collect() if r["k"] not in keys] + [tuple(r) for r in source.collect()]
    assert got == Counter((k, part, v) for k, part, v in expected)


def test_many_null_keys_bypass_the_join(spark):
    target = spark.range(300).selectExpr("if(id % 3 = 0, null, cast(id as int)) as k", "'a' as part", "'old' as v")
    merged = upsert(target, frame(spark, (1, "b", "new"), (None, "b", "new")), "k")
    assert merged.where("v = 'old'").count() == 299
    assert merged.where("k is null").count() == 101


def test_newest_row_wins_from_either_side(spark):
    schema = "k int, ts timestamp_ntz, v string"
    import datetime as dt

    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    target = frame(spark, (1, late, "kept"), (2, early, "replaced"), schema=schema)
    source = frame(spark, (1, early, "late arrival"), (2, late, "new"), (3, early, "added"), schema=schema)
    got = upsert_newer(target, source, "k", "ts", ["v"])
    assert {r["k"]: r["v"] for r in got.collect()} == {1: "kept", 2: "new", 3: "added"}
    assert rows(upsert_newer(got, source, "k", "ts", ["v"])) == rows(got)


def test_the_target_is_read_once(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.parquet(f"{tmp_path}/target")
    target = spark.read.parquet(f"{tmp_path}/target")
    batch = spark.createDataFrame(target.limit(3).collect(), target.schema)
    shown = final_plan(upsert(target, batch, "o_orderkey"))
    assert sum("FileScan" in line for line in shown.splitlines()) == 1
