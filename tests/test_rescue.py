"""Values that do not fit their type stay visible, and lead to quarantine."""

import datetime as dt
import json

import pytest

from helpers import final_plan
from millrace.operators.standardize import cast_columns, enforce_schema
from millrace.plans.product import load_products
from millrace.sinks import layers, storage
from millrace.sources.nested import flatten_json
from pyspark.sql import types as T

AT = dt.datetime(2024, 5, 6, tzinfo=dt.UTC)


def test_lost_texts_are_kept(spark):
    frame = spark.createDataFrame([("1", "x", "2024-01-01"), ("2", "3.5", "never"), (None, None, None)], "product_id string, price string, created_date string")
    found = [r["_kept"] for r in cast_columns(frame, rescue="_kept").collect()]
    assert [f and json.loads(f) for f in found] == [{"price": "x"}, {"created_date": "never"}, None]
    assert cast_columns(frame).columns == frame.columns


def test_contract_keeps_other_columns_as_texts(spark):
    frame = spark.createDataFrame([(1, "a", 'quo"te'), (2, "b", None)], "id int, n string, extra string")
    contract = T.StructType.fromDDL("id bigint, n int, more string")
    rows = enforce_schema(frame, contract, rescue="_kept").collect()
    assert [(r["id"], r["n"], r["more"], r["_cast_failures"], json.loads(r["_kept"])) for r in rows] == [
        (1, None, None, "n", {"n": "a", "extra": 'quo"te'}), (2, None, None, "n", {"n": "b"})
    ]


def test_json_that_does_not_fit(spark):
    texts = ['{"a": 1, "b": {"c": "x"}}', '{"a": "one", "b": {"c": "y"}}', "{broken", None, "", "[]", '{"a": 2, "other": true}']
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, j string")
    flat = flatten_json(frame, "j", "a bigint, b struct<c: string>", ["id"], rescue="_kept")
    assert flat.columns == ["id", "j.a", "j.b.c", "_kept"]
    got = {r["id"]: tuple(r)[1:] for r in flat.collect()}
    assert got[0] == (1, "x", None) and got[3] == (None, None, None) and got[6] == (2, None, None)
    assert got[1][0] is None and got[1][2] == texts[1]
    assert got[2] == (None, None, "{broken")
    assert final_plan(flat).count("Scan") <= 1


PRODUCTS = "product_id string, product_name string, category string, price string, created_date string"


def products(n, bad=0, start=0, price="10.5"):
    return [(f"PROD-{i:06d}", None if k < bad else f"thing {i}", "food", price, "2024-01-05") for k, i in enumerate(range(start, start + n))]


def load(spark, root, rows, batch, day, name, **options):
    raw = spark.createDataFrame(rows, PRODUCTS)
    return load_products(raw, root, source="shop", batch_id=batch, as_of=dt.date(2024, 12, 31), ingested_at=AT + dt.timedelta(days=day), gold_table=name, **options)


def silver(spark, root):
    return {r["product_id"]: (r["_batch_id"], r["_is_valid"]) for r in layers.read_validated(spark, f"{root}/silver/products").collect()}


def test_malformed_price_is_quarantined(spark, root):
    rows = products(9) + [("PROD-000100", "odd thing", "food", "n/a", "2024-01-05"), ("PROD-000101", "no price", "food", None, "2024-01-05")]
    got = load(spark, root, rows, "b1", 0, storage.fresh_name("summary"))
    assert (got["valid_rows"], got["quarantined_rows"]) == (10, 1)
    rejected = spark.read.parquet(f"{root}/quarantine/products").collect()
    assert [(r["product_id"], r["price"], r["_reject_reason"], r["_rescued_data"], r["_has_imputed_values"]) for r in rejected] == [
        ("PROD-000100", None, "price_malformed,price_not_positive", '{"price":"n/a"}', False)
    ]


def test_loads_add_up_and_run_again(spark, root):
    name = storage.fresh_name("summary")
    load(spark, root, products(6), "1", 0, name)
    load(spark, root, products(4, start=4, price="7"), "02", 1, name)
    assert layers.read_batches(spark, root, "products").count() == 10
    assert spark.table(name).first()["product_count"] == 8
    # again, with one product less: bronze and silver hold what the batch now has
    load(spark, root, products(3, start=5, price="8"), "02", 1, name)
    bronze = layers.read_batches(spark, root, "products")
    assert sorted((r["_batch_id"], r["count"]) for r in bronze.groupBy("_batch_id").count().collect()) == [("02", 3), ("1", 6)]
    stored = silver(spark, root)
    assert {p: b for p, (b, _) in stored.items() if b == "02"}.keys() == {f"PROD-{i:06d}" for i in (5, 6, 7)}
    # an old batch that is run again replaces nothing newer
    load(spark, root, products(6, price="1"), "1", 0, name)
    assert {p: b for p, (b, _) in silver(spark, root).items()} == {f"PROD-{i:06d}": "1" if i < 5 else "02" for i in range(8)}
    assert spark.table(name).first()["product_count"] == 8


def test_gate_fails_a_batch_of_mostly_invalid_rows(spark, root):
    name = storage.fresh_name("summary")
    load(spark, root, products(5), "1", 0, name)
    got = load(spark, root, products(20, bad=18, start=50), "2", 1, name)
    assert not got["gate_passed"] and got["valid_percent"] == 10.0 and got["success_percent"] == 100.0
    assert {b for b, _ in silver(spark, root).values()} == {"1"}
    assert spark.table(name).first()["product_count"] == 5
    assert spark.read.parquet(f"{root}/quarantine/products").count() == 18
    assert load(spark, root, products(20, bad=8, start=50), "2", 1, name)["gate_passed"]
    assert len(silver(spark, root)) == 25


def test_products_without_an_id_and_repeated_ones(spark, root):
    name = storage.fresh_name("summary")
    rows = products(5) + [(None, "nameless id", "food", "3", "2024-01-05")] * 2 + products(1)
    for _ in range(2):
        load(spark, root, rows, "1", 0, name, minimum_percent=0)
    stored = layers.read_validated(spark, f"{root}/silver/products")
    assert stored.where("product_id is null").count() == 2 and stored.count() == 7


@pytest.mark.parametrize("n", [0])
def test_an_empty_batch_does_not_pass(spark, root, n):
    got = load(spark, root, products(n), "1", 0, storage.fresh_name("summary"))
    assert not got["gate_passed"] and got["total_rows"] == 0
