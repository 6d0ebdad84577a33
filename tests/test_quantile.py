"""Exact quantiles against sorted Python lists."""

import math
import random
from decimal import Decimal

import pytest

from millrace.functions.quantile import exact_quantile, merged_sketches, quantile_sketch, sketch_quantiles


def expected(values, q):
    present = sorted(v for v in values if v is not None)
    return present[max(1, math.ceil(q * len(present))) - 1] if present else None


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.75, 1.0])
@pytest.mark.parametrize("seed", [1, 2])
def test_decimals(spark, q, seed):
    pick = random.Random(seed)
    cents = [pick.choice([None, pick.randint(-10**10 + 1, 10**10 - 1), pick.randint(-300, 300)]) for _ in range(301 + seed)]
    values = [None if c is None else Decimal(c).scaleb(-2) for c in cents]
    frame = spark.createDataFrame([(v,) for v in values], "price decimal(10,2)")
    assert exact_quantile(frame, "price", q).first()["price"] == expected(values, q)


@pytest.mark.parametrize("kind, values", [
    ("bigint", [-(2**63), 2**63 - 1, 0, 5, 5, 5, -7]),
    ("int", [3, 1, 2, 2]),
    ("decimal(18,4)", [Decimal("99999999999999.9999"), Decimal("-0.0001"), Decimal("0.0001")]),
])
@pytest.mark.parametrize("q", [0.0, 0.5, 1.0])
def test_other_types(spark, kind, values, q):
    frame = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    assert exact_quantile(frame, "v", q).first()["v"] == expected(values, q)


def test_one_value_holding_most_rows(spark):
    frame = spark.range(9000).selectExpr("cast(if(id % 3 = 0, id, 42) as decimal(10,2)) as v")
    assert exact_quantile(frame, "v").first()["v"] == 42


def test_no_rows(spark):
    got = exact_quantile(spark.createDataFrame([], "v decimal(10,2)"), "v").collect()
    assert [tuple(r) for r in got] == [(None,)]


def test_doubles_are_refused(spark):
    with pytest.raises(TypeError, match="double"):
        exact_quantile(spark.createDataFrame([(1.0,)], "v double"), "v")


def test_sketches_of_loads_merge(spark, tmp_path):
    rows = spark.range(30_000).selectExpr("id % 3 as load", "id % 2 as g", "if(id % 50 = 0, null, cast(pow(id % 9973, 1.5) as decimal(12,2))) as v")
    path = str(tmp_path / "sketches")
    for load in range(3):
        quantile_sketch(rows.where(f"load = {load}"), "v", ["g"]).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 6
    for groups in (["g"], []):
        for r in sketch_quantiles(merged_sketches(stored, groups), [0.1, 0.5, 0.9]).collect():
            values = sorted(float(x["v"]) for x in rows.where("v is not null").collect() if not groups or x["g"] == r["g"])
            assert r["rows"] == len(values)
            for q, found in zip((0.1, 0.5, 0.9), r["quantiles"], strict=True):
                below, upto = sum(v < found for v in values), sum(v <= found for v in values)
                assert below <= (q + 0.01) * len(values) and upto >= (q - 0.01) * len(values)


def test_sketch_of_nothing(spark):
    empty = quantile_sketch(spark.createDataFrame([(None,)], "v double"), "v", ["v"])
    assert empty.count() == 0
