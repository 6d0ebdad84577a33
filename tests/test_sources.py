import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from helpers import final_plan, plan, rows
from millrace.sources import jdbc
from millrace.sources.files import newer_than, next_watermark, read_entity, read_increment, store_watermark
from millrace.sources.nested import explode_records, flatten_json, flatten_structs, infer_json_type
from millrace.sources.paged import http_fetch, read_pages


def test_entity(spark, sf_dir):
    schema = T.StructType.fromDDL("c_custkey bigint, c_name string")
    assert read_entity(spark, sf_dir, "customer.parquet", schema).columns == ["c_custkey", "c_name"]
    whole = read_entity(spark, sf_dir, "customer.parquet")
    assert rows(whole) == rows(spark.read.parquet(f"{sf_dir}/customer.parquet"))


@pytest.mark.parametrize("mark", ["1998-06-30", "1998-06-30 00:00:00", dt.datetime(1998, 6, 30), dt.date(1998, 6, 30)])
def test_incremental_is_strict_and_reaches_the_scan(spark, sf_dir, mark):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    got = newer_than(orders, "o_orderdate", mark)
    assert got.count() == orders.where("o_orderdate > timestamp_ntz'1998-06-30'").count() > 0
    assert "GreaterThan(o_orderdate,1998-06-30T00:00)" in plan(got)


def test_incremental_drops_nulls_and_yields_the_next_mark(spark):
    frame = spark.createDataFrame([(1,), (2,), (3,), (None,)], "v int")
    assert sorted(r["v"] for r in newer_than(frame, "v", 1).collect()) == [2, 3]
    assert next_watermark(frame, "v").first()["next_watermark"] == 3
    assert next_watermark(newer_than(frame, "v", 3), "v").first()["next_watermark"] is None


def test_jdbc_connection_options():
    assert jdbc.connection_options("jdbc:x", token="t", user="u") == {"url": "jdbc:x", "accessToken": "t"}
    assert jdbc.connection_options("jdbc:x", user="u", password="p", extra={"fetchsize": "10"}) == {
        "url": "jdbc:x", "fetchsize": "10", "user": "u", "password": "p",
    }
    assert jdbc.connection_options("jdbc:x") == {"url": "jdbc:x"}


def test_jdbc_ranges_keep_explicit_bounds_of_zero():
    assert jdbc.range_options("select * from t", "id", 4, -10, 0) == {
        "dbtable": "(select * from t) q", "partitionColumn": "id", "numPartitions": "4", "lowerBound": "-10",
        "upperBound": "0",
    }


def test_jdbc_hash_predicates_cover_each_row_once(spark):
    frame = spark.sql("select explode(array(-7, -1, 0, 1, 2, 3, 12, null)) as id")
    counts = [frame.where(p).count() for p in jdbc.hash_predicates("id", 3)]
    assert sum(counts) == 8
    assert all(frame.where(" and ".join([a, b])).count() == 0
               for a in jdbc.hash_predicates("id", 3) for b in jdbc.hash_predicates("id", 3) if a != b)


NESTED = "id int, a struct<b: int, c: struct<d: string>>, tags array<string>"


def test_flatten(spark):
    frame = spark.createDataFrame([('{"id": 1, "a": {"b": 2, "c": {"d": "x"}}, "tags": ["p", "q"]}', 9)], "j string, n int")
    got = flatten_json(frame, "j", NESTED, keep=["n"])
    assert got.columns == ["n", "j.id", "j.a.b", "j.a.c.d", "j.tags"]
    assert tuple(got.first()) == (9, 1, 2, "x", ["p", "q"])


def test_flatten_inferred(spark):
    frame = spark.createDataFrame([('{"k": 1}',), ('{"k": 2.5, "a": {"b": "x"}}',), ("{bad",)], "j string")
    got = flatten_json(frame, "j", infer_json_type(frame, "j"))
    assert sorted(got.columns) == ["j.a.b", "j.k"]
    assert sorted((float(r["j.k"]), r["j.a.b"]) for r in got.collect() if r["j.k"] is not None) == [(1.0, None), (2.5, "x")]


def test_flatten_names_with_dots_inside(spark):
    frame = spark.sql("select named_struct('x.y', 1, 'z', named_struct('w', 2)) as s")
    got = flatten_structs(frame)
    assert got.columns == ["s.x.y", "s.z.w"] and tuple(got.first()) == (1, 2)


def test_pages_as_list_or_under_results(spark):
    record = T.StructType.fromDDL("id int, a struct<b: int>")
    pages = spark.createDataFrame(
        [('{"results": [{"id": 1, "a": {"b": 5}}, {"id": 2}], "next": null}',), (' \n[{"id": 3}]',), ("[]",),
         ('{"results": []}',)], "payload string")
    got = explode_records(pages, "payload", record)
    assert got.columns == ["id", "a.b"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, 5), (2, None), (3, None)]


@pytest.mark.parametrize("payload", ['{"error": "no"}', "not json"])
def test_other_pages_are_an_error(spark, payload):
    pages = spark.createDataFrame([(payload,)], "payload string")
    with pytest.raises(Exception, match="neither a list nor an object"):
        explode_records(pages, "payload", T.StructType.fromDDL("id int")).collect()


def write_pages(folder, chain):
    addresses = []
    for i in range(3):
        page = {"results": [{"id": 10 * i + j} for j in range(2)]}
        if chain and i < 2:
            page["next"] = (folder / f"{i + 1}.json").as_uri()
        (folder / f"{i}.json").write_text(json.dumps(page))
        addresses.append((folder / f"{i}.json").as_uri())
    return addresses


def test_pages_by_address_are_read_in_parallel(spark, tmp_path):
    pages = read_pages(spark, write_pages(tmp_path, chain=False), http_fetch(), name="pages_direct")
    assert pages.rdd.getNumPartitions() == 3
    got = explode_records(pages, "payload", T.StructType.fromDDL("id int"))
    assert sorted(r["id"] for r in got.collect()) == [0, 1, 10, 11, 20, 21]


def test_pages_per_task(spark, tmp_path):
    pages = read_pages(spark, write_pages(tmp_path, chain=False), http_fetch(), pages_per_task=2, name="pages_two")
    assert pages.rdd.getNumPartitions() == 2 and pages.count() == 3


def test_chain_is_followed_to_its_end(spark, tmp_path):
    first = write_pages(tmp_path, chain=True)[0]
    pages = read_pages(spark, [first], http_fetch(), next_key="next", name="pages_chain")
    got = explode_records(pages, "payload", T.StructType.fromDDL("id int"))
    assert sorted(r["id"] for r in got.collect()) == [0, 1, 10, 11, 20, 21]


def test_failing_fetch_fails_the_read(spark, tmp_path):
    pages = read_pages(spark, [(tmp_path / "absent.json").as_uri()], http_fetch(), name="pages_absent")
    with pytest.raises(Exception, match="absent.json"):
        pages.collect()


def test_watermark_with_ties(spark, root):
    """Rows that come late with the border's time are read once, those read before are not."""
    source, state, seen = [], f"{root}/state", []
    arrivals = [[(1, 10), (2, 20), (3, None)], [(4, 20), (5, 20), (6, 5)], [], [(7, 20), (8, 30)], [(9, 30)]]
    for run, rows_ in enumerate(arrivals):
        source += rows_
        frame = spark.createDataFrame(source, "id int, at int")
        found = read_increment(frame, state, "at", ["id"])
        new = [tuple(r) for r in found.collect()]
        if run != 3:  # a run that fails before its state is stored is read again
            store_watermark(spark.createDataFrame(new, "id int, at int"), state, "at", ["id"])
        seen.append(sorted(r[0] for r in new))
    assert seen == [[1, 2], [4, 5], [], [7, 8], [7, 8, 9]]
    stored = sorted(tuple(r) for r in spark.read.parquet(state).select("id", "at").collect())
    assert stored == [(8, 30), (9, 30)]


def test_increment_filter_reaches_the_files(spark, root, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    store_watermark(orders.where("o_orderkey < 100"), f"{root}/state", "o_orderdate", ["o_orderkey"])
    shown = final_plan(read_increment(orders, f"{root}/state", "o_orderdate", ["o_orderkey"]))
    assert "GreaterThan(o_orderdate" in shown and "EqualTo(o_orderdate" in shown
