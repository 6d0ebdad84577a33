"""Product rules on small fixtures with known results."""

import datetime as dt
from decimal import Decimal

import pytest

from helpers import final_plan, jobs_started, plan
from millrace.operators import products as P
from millrace.operators.standardize import cast_columns, enforce_schema, snake_case_columns, standardize_schema
from millrace.plans.product import flag_products, transform_products
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRODUCTS = "product_id string, product_name string, category string, price double, created_date string, last_updated string"
FOUR = [
    ("PROD-000001", "  wireless mouse  ", "electronics", 29.99, "2024-01-15", "2024-03-01"),
    ("PROD-000002", "Gaming KEYBOARD", "Electronics", 89.50, "2024-02-20", "2024-03-05"),
    ("PROD-000003", "usb-C cable", "Accessories", 15.00, "2024-03-10", "2024-03-08"),
    ("PROD-000004", None, "Electronics", None, "2024-01-05", "2024-03-10"),
]


@pytest.fixture
def four(spark):
    return spark.createDataFrame(FOUR, PRODUCTS)


def by_id(df):
    return {r["product_id"]: r.asDict() for r in df.collect()}


def test_four_products(four):
    got = by_id(flag_products(four, dt.date(2024, 12, 31)))
    shown = {
        k: (r["product_name"], r["category"], r["price"], r["_has_imputed_values"], r["price_tier"], r["season"],
            r["price_competitiveness_score"], r["_is_valid"])
        for k, r in got.items()
    }
    assert shown == {
        "PROD-000001": ("Wireless Mouse", "ELECTRONICS", Decimal("29.99"), False, "Budget", "Winter", 46.11, True),
        "PROD-000002": ("Gaming Keyboard", "ELECTRONICS", Decimal("89.50"), False, "Standard", "Winter", 66.92, True),
        "PROD-000003": ("Usb-c Cable", "ACCESSORIES", Decimal("15.00"), False, "Budget", "Spring", 40.87, True),
        "PROD-000004": (None, "ELECTRONICS", Decimal("29.99"), True, "Budget", "Winter", 46.11, False),
    }
    assert got["PROD-000001"]["product_age_days"] == (dt.date(2024, 12, 31) - dt.date(2024, 1, 15)).days
    assert got["PROD-000001"]["product_embedding"] is None


def test_transform_keeps_valid_rows_only(four):
    assert sorted(by_id(transform_products(four))) == ["PROD-000001", "PROD-000002", "PROD-000003"]


def test_counts_come_with_the_run(four):
    counts = Observation()
    valid = transform_products(four, counts=counts)
    assert valid.count() == 3
    assert counts.get == {"valid_rows": 3, "invalid_rows": 1}


def test_valid_products_can_be_used_more_than_once(four):
    valid = transform_products(four)
    assert valid.unionByName(valid).count() == 6
    assert P.price_score(valid).count() == 3
    assert valid.alias("a").join(valid.alias("b"), "product_id").count() == 3


def test_frames_without_any_known_column(spark):
    frame = spark.createDataFrame([(1,)], "other int")
    assert P.clean_text_fields(frame).columns == cast_columns(frame).columns == ["other"]


def test_texts_are_tidied_once(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(
        "cast(p_partkey as string) as product_id", "p_name as product_name", "p_type as category",
        "p_retailprice as price", "date'2024-01-01' as created_date")
    shown = final_plan(transform_products(parts))
    assert shown.count("initcap(trim(regexp_replace(p_name") == 1


def test_value_match_flag(four):
    frame = P.clean_text_fields(standardize_schema(four))
    flags = {k: r["_has_imputed_values"] for k, r in by_id(P.impute_products(frame, flag_mode="value_match")).items()}
    assert flags == {"PROD-000001": True, "PROD-000002": False, "PROD-000003": False, "PROD-000004": True}


def test_building_the_plan_starts_no_job(spark, four):
    before = jobs_started(spark)
    flagged = flag_products(four)
    P.quarantine_rows(flagged)
    assert jobs_started(spark) == before


def test_two_rule_rows(spark):
    frame = spark.createDataFrame(
        [("PROD-001", "  wireless MOUSE  ", "electronics", 29.99), ("PROD-002", "Gaming KEYBOARD", None, None)],
        "product_id string, product_name string, category string, price double",
    )
    got = by_id(P.impute_products(P.clean_text_fields(standardize_schema(frame))))
    assert [got[k]["product_name"] for k in sorted(got)] == ["Wireless Mouse", "Gaming Keyboard"]
    assert got["PROD-002"]["category"] == "UNCATEGORIZED"
    assert got["PROD-002"]["price"] == Decimal("29.99")
    assert [got[k]["_has_imputed_values"] for k in sorted(got)] == [False, True]


def test_validity_rows(spark):
    frame = spark.createDataFrame(
        [("PROD-001", "Valid Product", 25.0), ("PROD-002", None, 25.0), ("PROD-003", "A", 25.0),
         ("PROD-004", "Valid", -10.0), ("PROD-005", None, None)],
        "product_id string, product_name string, price double",
    )
    flagged = P.flag_valid(frame)
    assert [r["product_id"] for r in P.valid_rows(flagged).collect()] == ["PROD-001"]
    reasons = {r["product_id"]: r["_reject_reason"] for r in P.quarantine_rows(flagged).collect()}
    assert reasons == {
        "PROD-002": "name_missing,name_too_short",
        "PROD-003": "name_too_short",
        "PROD-004": "price_not_positive",
        "PROD-005": "price_not_positive,name_missing,name_too_short",
    }
    assert P.valid_rows(flagged).count() + P.quarantine_rows(flagged).count() == frame.count()


@pytest.mark.parametrize(
    "headers, expected",
    [
        (["Product ID", "Product Name", "Price"], ["product_id", "product_name", "price"]),
        (["product_name", "category"], ["product_name", "category"]),
        (["productName", "A-B C"], ["productname", "a_b_c"]),
    ],
)
def test_headers(spark, headers, expected):
    frame = spark.createDataFrame([tuple("x" for _ in headers)], headers)
    assert snake_case_columns(frame).columns == expected


def test_colliding_headers_are_an_error(spark):
    frame = spark.createDataFrame([("a", "b")], ["Product ID", "product-id"])
    with pytest.raises(ValueError, match="product_id"):
        snake_case_columns(frame)


def test_casts_turn_nan_and_malformed_values_to_null(spark):
    frame = spark.createDataFrame(
        [(1, float("nan"), "2024-13-45"), (2, 1e12, "2024-05-06")], "product_id int, price double, created_date string"
    )
    got = cast_columns(frame)
    assert dict(got.dtypes) == {"product_id": "string", "price": "decimal(10,2)", "created_date": "timestamp"}
    first, second = got.orderBy("product_id").collect()
    assert (first["price"], first["created_date"], second["price"]) == (None, None, None)
    assert second["created_date"] == dt.datetime(2024, 5, 6)


def test_contract(spark):
    contract = T.StructType.fromDDL("product_id string, note string, price decimal(10,2)")
    frame = spark.createDataFrame([("1.5", 7, "x"), ("oops", 8, "y")], "price string, product_id int, extra string")
    got = enforce_schema(frame, contract)
    assert got.columns == ["product_id", "note", "price", "_cast_failures"]
    assert [tuple(r) for r in got.orderBy("product_id").collect()] == [
        ("7", None, Decimal("1.50"), None),
        ("8", None, None, "price"),
    ]


def test_nulls_fall_through_to_the_last_choice(spark):
    frame = spark.createDataFrame([(None, None)], "price decimal(10,2), created_date date")
    row = P.add_derived_columns(frame, dt.date(2024, 1, 1)).first()
    assert (row["price_tier"], row["season"], row["product_age_days"]) == ("Luxury", "Fall", None)


@pytest.mark.parametrize(
    "price, tier",
    [("49.99", "Budget"), ("50", "Standard"), ("99.99", "Standard"), ("100", "Premium"), ("499.99", "Premium"),
     ("500", "Luxury"), ("-1", "Budget")],
)
def test_tier_bounds(spark, price, tier):
    frame = spark.createDataFrame([(Decimal(price), None)], "price decimal(10,2), created_date date")
    assert P.add_derived_columns(frame).first()["price_tier"] == tier


def test_seasons(spark):
    frame = spark.createDataFrame([(None, dt.date(2024, m, 1)) for m in range(1, 13)], "price decimal(10,2), created_date date")
    got = [r["season"] for r in P.add_derived_columns(frame).orderBy("created_date").collect()]
    assert got == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]


def test_score_without_spread_is_the_centre(spark):
    same = spark.createDataFrame([(Decimal("7.10"),)] * 5, "price decimal(10,2)")
    assert {r["price_competitiveness_score"] for r in P.price_score(same).collect()} == {50.0}
    none = spark.createDataFrame([(None,)], "price decimal(10,2)")
    assert P.price_score(none).first()["price_competitiveness_score"] == 50.0
    assert P.price_score(same.where("price < 0")).count() == 0


def test_score_is_held_within_bounds_and_null_without_price(spark):
    frame = spark.createDataFrame([(Decimal(10),)] * 400 + [(Decimal(10_000),), (Decimal(-10_000),), (None,)], "price decimal(10,2)")
    got = {r["price"]: r["price_competitiveness_score"] for r in P.price_score(frame).collect()}
    assert got[Decimal(10_000)] == 100.0 and got[Decimal(-10_000)] == 0.0 and got[None] is None


def test_all_prices_null(spark):
    frame = spark.createDataFrame([("a", None), (None, None)], "category string, price decimal(10,2)")
    got = P.impute_products(frame).collect()
    assert [r["price"] for r in got] == [None, None]
    assert all(r["_has_imputed_values"] for r in got)


def test_white_space_and_missing_text_columns(spark):
    frame = spark.createDataFrame([("\t two \n\n  words ", " a  b ")], "category string, other string")
    got = P.clean_text_fields(frame).first()
    assert (got["category"], got["other"]) == ("TWO WORDS", " a  b ")


def test_approximate_median_is_within_its_error(spark):
    frame = spark.range(1000).selectExpr("cast(id as decimal(10,2)) as price")
    got = P.median_price(frame, "approx").first()["price"]
    assert 489 <= got <= 511


def test_embedding_join(spark):
    frame = spark.createDataFrame([("a",), ("b",)], "product_id string")
    vectors = spark.createDataFrame([("a", [1.0, 2.0])], "product_id string, embedding array<double>")
    got = P.add_embedding(frame, vectors)
    assert dict(got.dtypes)["product_embedding"] == "array<float>"
    assert {r["product_id"]: r["product_embedding"] for r in got.collect()} == {"a": [1.0, 2.0], "b": None}


def test_whole_table_values_read_the_price_alone(spark, sf_dir):
    from millrace.operators.products import impute_products

    frame = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(
        "p_name as product_name", "p_type as category", "cast(p_retailprice as decimal(10,2)) as price"
    )
    shown = plan(impute_products(frame))
    schemas = {line.strip() for line in shown.splitlines() if line.startswith("ReadSchema")}
    assert schemas == {
        "ReadSchema: struct<p_name:string,p_type:string,p_retailprice:double>",
        "ReadSchema: struct<p_retailprice:double>",
    }


def test_filters_reach_the_scan_unless_rows_are_counted(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame(FOUR, PRODUCTS).withColumn("shop", F.lit(7)).write.parquet(path)
    raw = spark.read.parquet(path)
    valid = transform_products(raw).where("product_id > 'PROD-000001' and shop = 7")
    shown = plan(valid)
    assert "GreaterThan(product_id,PROD-000001)" in shown and "EqualTo(shop,7)" in shown
    assert sorted(by_id(valid)) == ["PROD-000002", "PROD-000003"]
    counted = transform_products(raw, counts=Observation()).where("shop = 7")
    assert "EqualTo(shop,7)" not in plan(counted)
    whole = {r["product_id"]: tuple(r) for r in transform_products(raw, counts=Observation()).collect()}
    assert {r["product_id"]: tuple(r) for r in valid.collect()} == {k: v for k, v in whole.items() if k > "PROD-000001"}
