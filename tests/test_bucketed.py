"""Merges into tables that are bucketed on the merge key."""

import glob

import pytest
from pyspark.sql import functions as F

from helpers import final_plan, rows
from millrace.operators.merge import upsert
from millrace.sinks import bucketed, storage


@pytest.fixture
def orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def merged(spark, root, loads, keys, name=None):
    name = name or storage.fresh_name("orders")
    for load in loads:
        bucketed.merge_bucketed(load, root, "t", merge_keys=keys, buckets=4, name=name)
    return name


@pytest.mark.parametrize("keys", ["o_orderkey", "o_custkey, o_orderkey"])
def test_same_rows_as_the_upsert(spark, root, orders, keys):
    early = orders.where("o_orderkey % 3 <> 0")
    late = orders.where("o_orderkey % 3 <> 1").withColumn("o_orderstatus", F.lit("X"))
    name = merged(spark, root, [early, late], keys)
    assert rows(spark.table(name)) == rows(upsert(early, late, keys))
    assert len(glob.glob(f"{root}/silver/t/*.parquet")) == 4
    spark.sql(f"DROP TABLE {name}")


def test_the_table_is_scanned_once_and_not_moved(spark, root, orders):
    name = merged(spark, root, [orders], "o_orderkey")
    batch = orders.where("o_orderkey < 500").withColumn("o_orderstatus", F.lit("X"))
    shown = final_plan(bucketed.upsert_in_buckets(spark.table(name), batch, "o_orderkey", 4))
    scans = [line for line in shown.splitlines() if "FileScan" in line]
    assert len([line for line in scans if "Bucketed: true" in line]) == 1 and len(scans) == 2
    # one exchange, on the batch's side
    assert sum("Exchange hashpartitioning" in line for line in shown.splitlines()) == 1
    assert "Exchange hashpartitioning(_new_o_orderkey" in shown
    spark.sql(f"DROP TABLE {name}")


def test_null_keys_new_keys_and_ambiguous_ones(spark, root):
    schema = "k int, v string"
    first = spark.createDataFrame([(1, "a"), (2, None), (None, "n")], schema)
    second = spark.createDataFrame([(2, "b"), (None, "m"), (7, "x"), (7, "y")], schema)
    name = merged(spark, root, [first, second], "k")
    assert sorted((tuple(r) for r in spark.table(name).collect()), key=str) == sorted(
        [(1, "a"), (2, "b"), (7, "x"), (7, "y"), (None, "n"), (None, "m")], key=str
    )
    with pytest.raises(Exception, match="several source rows"):
        merged(spark, root, [spark.createDataFrame([(1, "p"), (1, "q")], schema)], "k", name)
    with pytest.raises(ValueError, match="v"):
        merged(spark, root, [first.select("k")], "k", name)
    assert spark.table(name).count() == 6
    merged(spark, root, [first.limit(0)], "k", name)
    assert spark.table(name).count() == 6
    spark.sql(f"DROP TABLE {name}")
