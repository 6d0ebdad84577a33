import datetime as dt
import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from helpers import final_plan, rows
from millrace.operators.joins import fits_in_every_task, replicated_join
from millrace.operators.merge import upsert
from millrace.plans.product import load_products
from millrace.sinks import delta, layers, storage
from test_products import FOUR, PRODUCTS

AT = dt.datetime(2024, 5, 6, 7, 8, 9)


@pytest.fixture
def orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("order_year", F.year("o_orderdate").cast("string"))


def files(path):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_bronze_adds_metadata_and_counts(spark, root, orders):
    written = layers.write_bronze(orders, root, "orders", source="erp", batch_id="b1", ingested_at=AT)
    stored = layers.read_table(spark, root, "bronze", "orders")
    assert written == orders.count() == stored.count()
    meta = stored.select("_ingestion_timestamp", "_source_system", "_batch_id").distinct().collect()
    assert [tuple(r) for r in meta] == [(AT, "erp", "b1")]


def test_bronze_appends_and_evolves(spark, root):
    first = spark.createDataFrame([(1, "a")], "id int, name string")
    second = spark.createDataFrame([(2, 5)], "id int, size int")
    layers.write_bronze(first, root, "t", source="s", batch_id="1")
    layers.write_bronze(second, root, "t", source="s", batch_id="2", mode="append")
    got = layers.read_table(spark, root, "bronze", "t", merge_schema=True)
    assert sorted(tuple(r) for r in got.select("id", "name", "size").collect()) == [(1, "a", None), (2, None, 5)]


def test_partitioned_write_prunes(spark, root, orders):
    layers.write_bronze(orders, root, "orders", source="s", batch_id="1", partition_cols=["o_orderstatus"])
    stored = layers.read_table(spark, root, "bronze", "orders").where("o_orderstatus = 'O'")
    assert stored.count() == orders.where("o_orderstatus = 'O'").count()
    assert "PartitionFilters: [isnotnull(o_orderstatus" in final_plan(stored)
    # rebalanced by the partition column: one file for each of the three small partitions
    assert len(files(f"{root}/bronze/orders")) == 3


def test_silver_overwrites_then_merges(spark, root, orders):
    early, late = orders.where("order_year < '1999'"), orders.where("order_year >= '1998'").withColumn("o_orderstatus", F.lit("X"))
    layers.write_silver(early, root, "orders", merge_keys="o_orderkey")
    assert rows(layers.read_table(spark, root, "silver", "orders")) == rows(early)
    layers.write_silver(late, root, "orders", merge_keys="o_orderkey")
    stored = layers.read_table(spark, root, "silver", "orders")
    assert rows(stored) == rows(upsert(early, late, "o_orderkey"))
    assert sorted(os.listdir(f"{root}/silver")) == ["orders"]
    layers.write_silver(late, root, "orders")
    assert rows(layers.read_table(spark, root, "silver", "orders")) == rows(late)


def test_partitioned_merge_leaves_other_partitions_alone(spark, root, orders):
    keys, parts = ["o_orderkey", "order_year"], ["order_year"]
    early = orders.where("order_year < '1999'")
    late = orders.where("order_year >= '1998'").withColumn("o_orderstatus", F.lit("X"))
    layers.write_silver(early, root, "orders", merge_keys=keys, partition_cols=parts)
    before = files(f"{root}/silver/orders")
    layers.write_silver(late, root, "orders", merge_keys=keys, partition_cols=parts)
    after = files(f"{root}/silver/orders")
    assert {p: t for p, t in before.items() if "=1998" not in p}.items() <= after.items()
    assert not set(before) & {p for p in after if "=1998" in p}
    stored = layers.read_table(spark, root, "silver", "orders").withColumn("order_year", F.col("order_year").cast("string"))
    assert rows(stored) == rows(upsert(early, late, keys))


def test_partitioned_merge_opens_touched_directories_only(spark, root, orders, monkeypatch):
    layers.write_silver(orders, root, "orders", partition_cols=["order_year"])
    stored = spark.read.parquet(f"{root}/silver/orders")
    batch = orders.where("order_year in ('1997', '1998')")
    for most, pruned in ((1000, True), (1, False)):
        monkeypatch.setattr(layers, "MAX_NAMED_PARTITIONS", most)
        read = layers.touched_partitions(stored, batch.selectExpr("cast(order_year as int) as order_year"), ["order_year"])
        assert read.count() == batch.count()
        assert bool(re.search(r"PartitionFilters: \[order_year#\d+ IN", final_plan(read))) is pruned


def test_partitioned_merge_by_two_columns(spark, root):
    schema, parts = "k int, a string, b date, v string", ["a", "b"]
    days = [dt.date(2024, 1, n) for n in (1, 2, 3)]
    first = spark.createDataFrame([(i, a, d, "old") for i, (a, d) in enumerate((a, d) for a in "xyz" for d in days)], schema)
    batch = spark.createDataFrame([(0, "x", days[0], "new"), (8, "z", days[2], "new"), (50, "w", days[1], "new")], schema)
    layers.write_silver(first, root, "t", merge_keys=["k", *parts], partition_cols=parts)
    before = files(f"{root}/silver/t")
    layers.write_silver(batch, root, "t", merge_keys=["k", *parts], partition_cols=parts)
    stored = spark.read.schema(schema).parquet(f"{root}/silver/t")
    assert rows(stored) == rows(upsert(first, batch, ["k", *parts]))
    assert len(before.items() & files(f"{root}/silver/t").items()) == 7  # of nine partitions two were touched


def test_partitioned_merge_with_null_and_text_partitions(spark, root):
    schema, keys = "k int, part string, v string", ["k", "part"]
    first = spark.createDataFrame([(1, "01", "old"), (2, "1", "old"), (3, None, "old")], schema)
    batch = spark.createDataFrame([(1, "01", "new"), (3, None, "new"), (4, "02", "new")], schema)
    for frame in (first, batch):
        layers.write_silver(frame, root, "t", merge_keys=keys, partition_cols=["part"])
    stored = spark.read.schema(schema).parquet(f"{root}/silver/t")
    # a null key matches nothing, so row 3 is there twice
    assert sorted((tuple(r) for r in stored.select("k", "part", "v").collect()), key=str) == sorted(
        [(1, "01", "new"), (2, "1", "old"), (3, None, "old"), (3, None, "new"), (4, "02", "new")], key=str
    )


def test_a_batch_that_gives_other_rows_each_time_is_merged_as_one(spark, root):
    first = spark.range(100).selectExpr("id as k", "'old' as v")
    layers.write_silver(first, root, "t")
    # a different hundred of the keys whenever it is evaluated, were it not staged
    batch = spark.range(200).orderBy(F.rand()).limit(100).selectExpr("id as k", "'new' as v")
    layers.write_silver(batch, root, "t", merge_keys="k")
    stored = layers.read_table(spark, root, "silver", "t")
    assert stored.where("v = 'new'").count() == 100
    assert stored.select("k").distinct().count() == stored.count()


def test_history_and_time_travel_of_a_stored_table(spark, root):
    for day, (batch, data) in enumerate([("b0", [(1, "a"), (2, "b")]), ("b1", [(2, "c"), (3, "d")])]):
        frame = spark.createDataFrame(data, "k int, v string")
        layers.write_bronze(frame, root, "t", source="s", batch_id=batch, mode="append",
                            ingested_at=AT + dt.timedelta(days=day))
    history = layers.table_history(spark, root, "t").orderBy("version").collect()
    assert [(r["_batch_id"], r["row_count"], r["version"]) for r in history] == [("b0", 2, 0), ("b1", 2, 1)]
    states = [
        {r["k"]: r["v"] for r in layers.table_as_of(spark, root, "t", AT + dt.timedelta(days=n), keys=["k"]).collect()}
        for n in (-1, 0, 1)
    ]
    assert states == [{}, {1: "a", 2: "b"}, {1: "a", 2: "c", 3: "d"}]


def test_cut_off_replacement_is_undone(spark, root):
    frame = spark.createDataFrame([(1, "old")], "k int, v string")
    layers.write_silver(frame, root, "t")
    os.rename(f"{root}/silver/t", f"{root}/silver/t__old")
    layers.write_silver(spark.createDataFrame([(2, "new")], "k int, v string"), root, "t", merge_keys="k")
    assert layers.read_table(spark, root, "silver", "t").count() == 2


def test_existence_errors_are_raised(spark, root):
    assert storage.path_exists(spark, root) is False
    with pytest.raises(Exception, match="nosuchscheme"):
        storage.path_exists(spark, "nosuchscheme://host/x")
    with pytest.raises(ValueError, match="platinum"):
        storage.table_path(root, "platinum", "t")


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = storage.scratch_dir(spark, "x"), storage.scratch_dir(spark, "x")
    assert first != second and (not shared or first.startswith(shared))


def test_hash_distribution_joins_without_a_shuffle(spark, root, orders):
    totals = orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    counts = orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    left, right = [
        spark.table(layers.write_gold(df, root, name, distribution="HASH", keys=["o_custkey"], parts=4,
                                      name=storage.fresh_name(name)))
        for df, name in ((totals, "totals"), (counts, "counts"))
    ]
    joined = left.join(right.hint("merge"), "o_custkey")
    assert "Exchange" not in final_plan(joined)
    assert joined.count() == totals.count()


def test_heavy_bucket_falls_back_to_plain_files(spark, root, monkeypatch):
    monkeypatch.setattr(layers, "MAX_BUCKET_ROWS", 10)
    skewed = spark.range(1000).selectExpr("if(id < 900, 1, id) as k", "id")
    name = layers.write_gold(skewed, root, "t", distribution="HASH", keys=["k"], parts=16, name=storage.fresh_name("t"))
    assert rows(spark.table(name)) == rows(skewed)
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe formatted {name}").collect()}
    assert described.get("Num Buckets", "0") == "0"


@pytest.mark.parametrize("parts", [None, 3])
def test_other_distributions(spark, root, orders, parts):
    name = layers.write_gold(orders, root, "rr", parts=parts, name=storage.fresh_name("rr"))
    assert rows(spark.table(name)) == rows(orders)
    assert len(files(f"{root}/gold/rr")) == (parts or 1)
    name = layers.write_gold(orders, root, "rep", distribution="REPLICATE", name=storage.fresh_name("rep"))
    assert rows(spark.table(name)) == rows(orders)
    with pytest.raises(ValueError, match="RANDOM"):
        layers.write_gold(orders, root, "x", distribution="RANDOM")
    with pytest.raises(ValueError, match="keys"):
        layers.write_gold(orders, root, "x", distribution="HASH")


def test_only_measured_dimensions_are_replicated(spark, orders, sf_dir):
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    assert fits_in_every_task(customer) and not fits_in_every_task(customer, max_rows=10)
    assert not fits_in_every_task(customer, max_bytes=100)
    assert fits_in_every_task(customer.where("false"))
    on = orders["o_custkey"] == customer["c_custkey"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = replicated_join(orders, customer, on)
        large = replicated_join(orders, customer, on, max_rows=10)
        assert "BroadcastHashJoin" in final_plan(small)
        assert "SortMergeJoin" in final_plan(large)
        assert rows(small) == rows(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_quarantine_batches_do_not_double(spark, root):
    rejected = spark.createDataFrame([("a", "why")], "product_id string, _reject_reason string")
    path = f"{root}/quarantine"
    for batch in ("b1", "b2", "b2"):
        layers.append_quarantine(rejected, path, batch)
    assert sorted(r["_quarantine_batch"] for r in spark.read.parquet(path).collect()) == ["b1", "b2"]


def test_product_load(spark, root):
    raw = spark.createDataFrame(FOUR, PRODUCTS)
    categories = ["ELECTRONICS", "ACCESSORIES"]
    name = storage.fresh_name("summary")
    got = load_products(raw, root, source="shop", batch_id="b1", as_of=dt.date(2024, 12, 31), categories=categories,
                        gold_table=name)
    assert (got["landed"], got["total_rows"], got["valid_rows"], got["quarantined_rows"]) == (4, 4, 3, 1)
    assert got["gate_passed"] and got["success_percent"] == 100.0
    quarantined = spark.read.parquet(f"{root}/quarantine/products").collect()
    assert [(r["product_id"], r["_reject_reason"]) for r in quarantined] == [("PROD-000004", "name_missing,name_too_short")]
    assert {r["category"]: r["product_count"] for r in spark.table(name).collect()} == {"ELECTRONICS": 2, "ACCESSORIES": 1}


def test_failed_gate_writes_no_gold(spark, root):
    got = load_products(spark.createDataFrame(FOUR, PRODUCTS), root, source="shop", batch_id="b1", gold_table="never")
    assert not got["gate_passed"]
    assert not storage.path_exists(spark, f"{root}/gold")


def test_delta_statements():
    assert delta.merge_sql("/t", "src", ["a", "b"]) == (
        "MERGE INTO delta.`/t` t USING src s ON t.`a` = s.`a` AND t.`b` = s.`b` "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
    assert delta.optimize_sql("/t", ["a", "b"]) == "OPTIMIZE delta.`/t` ZORDER BY (a, b)"
    assert delta.optimize_sql("/t") == "OPTIMIZE delta.`/t`"
    assert delta.vacuum_sql("/t", 168) == "VACUUM delta.`/t` RETAIN 168 HOURS"


@pytest.mark.parametrize("options", [{}, {"distribution": "HASH", "keys": ["k"], "parts": 4}, {"distribution": "REPLICATE"}])
def test_gold_tables_can_be_written_from_themselves_and_survive_a_failed_write(spark, root, options):
    name = storage.fresh_name("gold")
    layers.write_gold(spark.range(10).selectExpr("id % 3 as k", "id as v"), root, "t", name=name, **options)
    more = spark.table(name).union(spark.range(10, 12).selectExpr("id % 3", "id"))
    layers.write_gold(more, root, "t", name=name, **options)
    assert sorted(r["v"] for r in spark.table(name).collect()) == list(range(12))
    with pytest.raises(Exception, match="stop here"):
        broken = spark.range(5).selectExpr("id as k", "if(id = 3, cast(raise_error('stop here') as long), id) as v")
        layers.write_gold(broken, root, "t", name=name, **options)
    assert spark.table(name).count() == 12
    if "keys" in options:
        spec = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        assert spec["Num Buckets"] == "4"
    spark.sql(f"DROP TABLE {name}")
