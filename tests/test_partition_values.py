"""Partition values and layouts survive reads, merges and maintenance; failed writes leave the old rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from millrace.operators.products import impute_products
from millrace.plans.product import load_products
from millrace.session import shuffle_settings
from millrace.sinks.layers import read_table, write_bronze, write_silver
from millrace.sinks.maintain import optimize_table, prune_log
from millrace.sinks.storage import table_path
from millrace.streaming.sinks import read_upserted


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, part string, v int")


ROWS = [(1, "01", 1), (2, "1", 2), (3, "02", 3), (4, None, 4)]


@pytest.mark.parametrize("zorder", [(), ("id", "v")])
def test_text_partitions_survive_maintenance(spark, root, zorder):
    write_silver(table(spark, ROWS), root, "t", partition_cols=["part"])
    path = table_path(root, "silver", "t")
    before = sorted(d for d in os.listdir(path) if "=" in d)
    optimize_table(spark, path, zorder)
    assert sorted(d for d in os.listdir(path) if "=" in d) == before
    got = read_table(spark, root, "silver", "t").select("id", "part", "v")
    assert sorted(map(tuple, got.collect())) == sorted(ROWS)


def test_merge_without_partition_argument_keeps_layout(spark, root):
    write_silver(table(spark, ROWS), root, "t", partition_cols=["part"])
    write_silver(table(spark, [(1, "07", 9)]), root, "t", merge_keys="id")
    got = read_table(spark, root, "silver", "t").select("id", "part", "v")
    assert sorted(map(tuple, got.collect())) == sorted([(1, "07", 9), *ROWS[1:]])
    assert "part=07" in os.listdir(table_path(root, "silver", "t"))


def test_whole_number_partitions_stay_numbers(spark, root):
    write_silver(spark.createDataFrame([(1, 5), (2, 12)], "id long, part int"), root, "n", partition_cols=["part"])
    assert dict(read_table(spark, root, "silver", "n").dtypes)["part"] == "int"


def test_failed_overwrite_leaves_old_rows(spark, root):
    rows = table(spark, ROWS)
    broken = rows.withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    write_silver(rows, root, "t")
    write_bronze(rows, root, "t", source="s", batch_id="1")
    for write in (lambda: write_silver(broken, root, "t"), lambda: write_bronze(broken, root, "t", source="s", batch_id="2")):
        with pytest.raises(Exception, match="no"):
            write()
    assert read_table(spark, root, "silver", "t").count() == read_table(spark, root, "bronze", "t").count() == 4


def test_pruned_log_keeps_every_key_after_the_next_batch(spark, root):
    log = f"{root}/log"
    rows = lambda *r: spark.createDataFrame(r, "k long, ts timestamp, v int")
    rows((1, dt.datetime(2024, 1, 1), 1), (2, dt.datetime(2024, 1, 1), 2)).write.parquet(f"{log}/stream_batch=0")
    prune_log(spark, log, ["k"], "ts", dt.datetime(2024, 3, 1))
    rows((2, dt.datetime(2024, 2, 2), 3)).write.parquet(f"{log}/stream_batch=1")
    assert {(r["k"], r["v"]) for r in read_upserted(spark, log, ["k"], "ts").collect()} == {(1, 1), (2, 3)}


def test_load_beyond_a_row_range_is_the_callers_choice(spark, root):
    raw = spark.createDataFrame(
        [(f"PROD-00000{i}", "Good name", "food", "10.5", "2024-01-01") for i in range(5)],
        "product_id string, product_name string, category string, price string, created_date string")
    args = dict(source="s", batch_id="1", as_of=dt.date(2024, 12, 31))
    assert load_products(raw, root, gold_table="g_open", **args)["gate_passed"]
    assert not load_products(raw, f"{root}2", gold_table="g_closed", row_range=(1, 3), **args)["gate_passed"]


def test_double_prices_are_imputed(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 3.0), (None, None)], "category string, price double")
    assert sorted(r["price"] for r in impute_products(rows).collect()) == [1.0, 3.0, 3.0, 3.0]


def test_shuffle_partitions_grow_with_the_input():
    assert int(shuffle_settings(100 * 10**12, 4000)["spark.sql.shuffle.partitions"]) > 180_000
