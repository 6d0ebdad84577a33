"""The registered queries: each runs one operator over whole given tables.

``product`` inputs are derived from the ``part`` table by :func:`product_rows`, since
the given tables hold no product table and no nulls.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import gold, products, quality, scd, star, versions
from millrace.operators.joins import replicated_join
from millrace.operators.merge import upsert, upsert_newer
from millrace.operators.standardize import cast_columns, enforce_schema, snake_case_columns
from millrace.functions.quantile import merged_sketches, quantile_sketch, sketch_quantiles
from millrace.functions.product import age_days, price_tier, season
from millrace.functions.zorder import with_z_value
from millrace.plans.product import RESCUED, load_products, transform_products
from millrace.sinks import bucketed, changes, history, layers, maintain
from millrace.sinks.storage import fresh_name, scratch_dir, table_path
from millrace.sources.files import newer_than, next_watermark, read_entity, read_increment, store_watermark
from millrace.sources.nested import explode_records, flatten_json, infer_json_type
from millrace.streaming.sinks import read_upserted, stream_to_bronze, stream_upsert
from millrace.streaming.sources import stream_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = dt.date(2024, 12, 31)
INGESTED_AT = dt.datetime(2024, 12, 31, 12, 0, 0, tzinfo=dt.UTC)
BATCH_ID = "20241231120000"
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL")  # STANDARD is left out, so the check has misses


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy products with gaps, one per part."""
    return table(spark, sf_dir, "part").selectExpr(
        "'PROD-' || lpad(cast(p_partkey as string), 6, '0') as product_id",
        "case when p_partkey % 29 = 0 then null"
        " else '  ' || p_name || '  ' || lower(p_brand) || ' ' end as product_name",
        "case when p_partkey % 23 = 0 then null else lower(p_type) end as category",
        "case when p_partkey % 17 = 0 then null"
        " else cast(p_retailprice - 900 + (p_partkey % 7) * 100 as decimal(10,2)) end as price",
        "date_add(date'2024-01-01', cast(p_partkey % 365 as int)) as created_date",
    )


def clean_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_rows(spark, sf_dir).transform(products.clean_text_fields)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with headers as a source system would name them."""
    return product_rows(spark, sf_dir).toDF("Product ID", "Product-Name", "CATEGORY", "Price", "Created Date")


def text_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with every value as text, some of it malformed."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey as product_id",
        "p_name as product_name",
        "case when p_partkey % 13 = 0 then 'n/a' else cast(cast(p_retailprice as decimal(10,2)) as string) end as price",
        "case when p_partkey % 19 = 0 then '2024-13-45'"
        " else cast(date_add(date'2024-01-01', cast(p_partkey % 365 as int)) as string) end as created_date",
        "p_brand as brand",
    )


# --- names, types, contracts -------------------------------------------------------------


@query("standardize_names")
def standardize_names(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice", "p_type", "p_size")
    return snake_case_columns(part.toDF("Product ID", "Product-Name", "BrandName", "Retail Price-USD", "TYPE", "Size-"))


@query("standardize_types")
def standardize_types(spark, sf_dir):
    typed = cast_columns(text_products(spark, sf_dir))
    # zone-free for comparison; the operator itself yields a timestamp
    return typed.withColumn("created_date", F.col("created_date").cast("timestamp_ntz"))


@query("schema_enforce")
def schema_enforce(spark, sf_dir):
    contract = T.StructType.fromDDL(
        "product_id string, product_name string, description string, price decimal(10,2), created_date date"
    )
    return enforce_schema(text_products(spark, sf_dir), contract)


@query("schema_rescue")
def schema_rescue(spark, sf_dir):
    """The contract again, with the texts of lost values and of columns outside it."""
    contract = T.StructType.fromDDL("product_id string, product_name string, price decimal(10,2), created_date date")
    return enforce_schema(text_products(spark, sf_dir), contract, rescue="_rescued")


# --- products ----------------------------------------------------------------------------


@query("clean_text")
def clean_text(spark, sf_dir):
    return clean_products(spark, sf_dir).select("product_id", "product_name", "category")


@query("median_price")
def median_price(spark, sf_dir):
    return products.median_price(product_rows(spark, sf_dir)).withColumnRenamed("price", "median_price")


@query("median_sketch")
def median_sketch(spark, sf_dir):
    """The median of three loads from one stored sketch per load: is its rank within one per cent?"""
    path, parts = scratch_dir(spark, "sketches"), table(spark, sf_dir, "part")
    for n in range(3):
        load = parts.where(F.col("p_partkey") % 3 == n)
        quantile_sketch(load, "p_retailprice").write.mode("append").parquet(path)
    merged = sketch_quantiles(merged_sketches(spark.read.parquet(path)), [0.5])
    median = merged.select(F.col("quantiles")[0]).scalar()
    below, upto = (F.count_if(c).alias(n) for n, c in (("below", F.col("p_retailprice") < median), ("upto", F.col("p_retailprice") <= median)))
    found = parts.agg(F.count(F.lit(1)).alias("rows"), below, upto)
    return found.select("rows", F.expr("below <= 0.51 * rows and upto >= 0.49 * rows").alias("within_one_percent"))


@query("impute_products")
def impute_products(spark, sf_dir):
    imputed = products.impute_products(clean_products(spark, sf_dir))
    return imputed.select("product_id", "category", "price", "_has_imputed_values")


@query("impute_flag_value_match")
def impute_flag_value_match(spark, sf_dir):
    imputed = products.impute_products(clean_products(spark, sf_dir), flag_mode="value_match")
    return imputed.select("product_id", "category", "price", "_has_imputed_values")


@query("price_tier")
def price_tiers(spark, sf_dir):
    rows = product_rows(spark, sf_dir)
    return rows.select("product_id", "price", price_tier(F.col("price")).alias("price_tier"))


@query("product_age")
def product_age(spark, sf_dir):
    rows = product_rows(spark, sf_dir)
    return rows.select("product_id", age_days(F.col("created_date"), AS_OF).alias("product_age_days"))


@query("season")
def product_season(spark, sf_dir):
    rows = product_rows(spark, sf_dir)
    return rows.select("product_id", season(F.col("created_date")).alias("season"))


@query("price_stats")
def price_stats(spark, sf_dir):
    stats = products.price_stats(product_rows(spark, sf_dir))
    return stats.select(F.round("mean_price", 6).alias("mean_price"), F.round("std_price", 6).alias("std_price"))


@query("price_score")
def price_score(spark, sf_dir):
    scored = products.price_score(product_rows(spark, sf_dir))
    return scored.select("product_id", "price", "price_competitiveness_score")


@query("embedding_column")
def embedding_column(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "p_partkey")
    joined = products.add_embedding(table(spark, sf_dir, "part"), vectors, "p_partkey")
    # every element as fixed-point text, so that the whole vector is compared
    elements = F.transform("product_embedding", lambda x: x.cast("double").cast("decimal(12,6)").cast("string"))
    return joined.select("p_partkey", F.array_join(elements, ",").alias("product_embedding"))


@query("validate_flag")
def validate_flag(spark, sf_dir):
    return products.flag_valid(clean_products(spark, sf_dir)).select("product_id", "_is_valid")


@query("valid_products")
def valid_products(spark, sf_dir):
    valid = transform_products(raw_products(spark, sf_dir), AS_OF)
    return valid.select("product_id", "product_name", "price", "_is_valid")


@query("quarantine_rows")
def quarantine_rows(spark, sf_dir):
    """Quarantine as it is stored: appended by batch, then read back."""
    path = scratch_dir(spark, "quarantine")
    flagged = products.flag_valid(clean_products(spark, sf_dir))
    layers.append_quarantine(products.quarantine_rows(flagged), path, BATCH_ID)
    stored = spark.read.parquet(path)
    return stored.select("product_id", "product_name", "price", "_is_valid", "_reject_reason")


@query("product_transform")
def product_transform(spark, sf_dir):
    """All product steps, raw headers to validated rows."""
    out = transform_products(raw_products(spark, sf_dir), AS_OF)
    return out.withColumn("created_date", F.col("created_date").cast("timestamp_ntz"))


def _second_batch(raw: DataFrame) -> DataFrame:
    """Every third and every fifth product, a unit dearer."""
    return raw.where("right(`Product ID`, 6) % 3 = 0 or right(`Product ID`, 6) % 5 = 0").withColumn("Price", (F.col("Price") + 1).cast("decimal(10,2)"))


@query("product_load_two_batches")
def product_load_two_batches(spark, sf_dir):
    """Silver after two loads, the first of which is run again after the second; later prices stay."""
    root, raw = scratch_dir(spark, "products"), raw_products(spark, sf_dir)
    first = raw.where("right(`Product ID`, 6) % 3 <> 0")
    for batch, rows, day in (("load0", first, 0), ("load1", _second_batch(raw), 1), ("load0", first, 0)):
        load_products(
            rows, root, source="erp", batch_id=batch, as_of=AS_OF, ingested_at=INGESTED_AT + dt.timedelta(days=day),
            categories=[*PART_TYPES, "STANDARD", "UNCATEGORIZED"], gold_table=fresh_name("summary"),
        )
    silver = layers.read_validated(spark, table_path(root, "silver", "products"))
    stored = silver.drop("_ingestion_timestamp", "_source_system", RESCUED)
    return stored.withColumn("created_date", F.col("created_date").cast("timestamp_ntz"))


@query("quarantine_malformed")
def quarantine_malformed(spark, sf_dir):
    """What a load of text prices rejects: malformed ones among them, with the text that was there."""
    root, raw = scratch_dir(spark, "products"), raw_products(spark, sf_dir)
    text = F.when(F.right("Product ID", F.lit(6)) % 13 == 0, F.lit("n/a")).otherwise(F.col("Price").cast("string"))
    load_products(
        raw.withColumn("Price", text), root, source="erp", batch_id=BATCH_ID, as_of=AS_OF, ingested_at=INGESTED_AT,
        categories=[*PART_TYPES, "STANDARD", "UNCATEGORIZED"], gold_table=fresh_name("summary"),
    )
    rejected = spark.read.parquet(f"{root}/quarantine/products")
    return rejected.select("product_id", "product_name", "price", "_reject_reason", RESCUED)


# --- quality -----------------------------------------------------------------------------


def _checked(spark: SparkSession, sf_dir: str, expectations: list[quality.Expectation]) -> DataFrame:
    return quality.check(clean_products(spark, sf_dir), expectations)


@query("dq_not_null")
def dq_not_null(spark, sf_dir):
    return _checked(spark, sf_dir, [quality.not_null("product_id"), quality.not_null("product_name")])


@query("dq_between")
def dq_between(spark, sf_dir):
    return _checked(spark, sf_dir, [quality.between("price", 0, 600)])


@query("dq_in_set")
def dq_in_set(spark, sf_dir):
    return _checked(spark, sf_dir, [quality.in_set("category", PART_TYPES)])


@query("dq_regex")
def dq_regex(spark, sf_dir):
    return _checked(
        spark, sf_dir,
        [quality.matches("product_id", quality.PRODUCT_ID_PATTERN), quality.matches("product_name", "^[A-Z][a-z]+ R")],
    )


@query("dq_row_count")
def dq_row_count(spark, sf_dir):
    return quality.check(table(spark, sf_dir, "lineitem"), [quality.row_count_between(*quality.ROW_RANGE)])


def _suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir, quality.product_suite([*PART_TYPES, "UNCATEGORIZED"]))


@query("dq_suite")
def dq_suite(spark, sf_dir):
    return _suite(spark, sf_dir)


@query("dq_report")
def dq_report(spark, sf_dir):
    return quality.report(_suite(spark, sf_dir))


@query("dq_gate")
def dq_gate(spark, sf_dir):
    return quality.gate(_suite(spark, sf_dir)).select("success_percent", "gate_passed")


# --- change logs, merges, dimensions over time ---------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


def _latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest_first = [F.col(c).desc() for c in LINE_ORDER]
    return versions.latest_per_key(table(spark, sf_dir, "lineitem"), LINE_KEY, newest_first)


@query("dedup_latest")
def dedup_latest(spark, sf_dir):
    return _latest_lines(spark, sf_dir)


def _order_batch(orders: DataFrame) -> DataFrame:
    """A batch of changes: orders from 1999 on, closed and repriced."""
    return orders.where("o_orderdate >= timestamp_ntz'1999-01-01'").withColumns(
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1}
    )


@query("merge_upsert_single")
def merge_upsert_single(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    stored = orders.where("o_orderdate < timestamp_ntz'2000-01-01'")
    return upsert(stored, _order_batch(orders), "o_orderkey")


@query("merge_upsert_composite")
def merge_upsert_composite(spark, sf_dir):
    lines = _latest_lines(spark, sf_dir)
    stored = lines.where("l_shipdate < timestamp_ntz'2000-01-01'")
    batch = lines.where("l_shipdate >= timestamp_ntz'1999-01-01'").withColumn("l_returnflag", F.lit("X"))
    return upsert(stored, batch, "l_orderkey, l_linenumber")


@query("merge_newest_wins")
def merge_newest_wins(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    early = events.where("ts < timestamp_ntz'2024-01-20'")
    late = events.where("ts >= timestamp_ntz'2024-01-10'")
    return upsert_newer(late, early, "user_id", "ts", ["event_id"])


@query("as_of_state")
def as_of_state(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return versions.as_of(events, ["user_id"], "ts", "2024-01-15 00:00:00", ["event_id"])


@query("batch_history")
def batch_history(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderdate", F.date_format("o_orderdate", "yyyyMM").alias("_batch_id")
    )
    return versions.batch_history(orders, "_batch_id", "o_orderdate")


@query("retention_prune")
def retention_prune(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return versions.retain(events, ["user_id"], "ts", "2024-01-23 00:00:00", ["event_id"])


@query("scd2_history")
def scd2_history(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return scd.scd2_history(events, ["user_id"], "ts", ["event_type"], ["event_id"])


@query("scd2_history_hot_keys")
def scd2_history_hot_keys(spark, sf_dir):
    """The same with a bound low enough that many users count as hot and are worked on in slices."""
    events = table(spark, sf_dir, "events")
    return scd.scd2_history(events, ["user_id"], "ts", ["event_type"], ["event_id"], hot_rows=60)


@query("scd2_merge")
def scd2_merge(spark, sf_dir):
    """The stored history up to mid-January with the rest folded in."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "event_id")
    start = "ts < timestamp_ntz'2024-01-15'"
    by = (["user_id"], "ts", ["event_type"], ["event_id"])
    root = scratch_dir(spark, "scd2")
    layers.write_silver(scd.scd2_history(events.where(start), *by), root, "users")
    return scd.scd2_merge(layers.read_table(spark, root, "silver", "users"), events.where(f"not ({start})"), *by)


@query("scd2_burst_key")
def scd2_burst_key(spark, sf_dir):
    """One user with a third of the events, most of them at the same second, worked on in slices of few rows."""
    events = table(spark, sf_dir, "events")
    burst = F.col("event_id") % 3 == 0
    start = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    moved = events.withColumns(
        {"user_id": F.when(burst, 0).otherwise(F.col("user_id")), "ts": F.when(burst & (F.col("event_id") % 4 != 0), start).otherwise(F.col("ts"))}
    )
    return scd.scd2_history(moved, ["user_id"], "ts", ["event_type"], ["event_id"], hot_rows=200)


USERS = {"keys": ["user_id"], "ts": "ts", "attributes": ["event_type"], "tie_breakers": ["event_id"]}
LATE = "event_id % 5 = 0"


@query("scd2_merge_late")
def scd2_merge_late(spark, sf_dir):
    """A stored observed history, and rows from all over its time that come late."""
    events = table(spark, sf_dir, "events")
    root = scratch_dir(spark, "scd2")
    layers.write_silver(scd.scd2_observed(events.where(f"not ({LATE})"), **USERS), root, "users")
    stored = layers.read_table(spark, root, "silver", "users")
    merged = scd.scd2_merge_observed(stored, events.where(LATE), **USERS)
    return scd.versions_of(merged, ["user_id"], "ts", ["event_type"])


@query("scd2_stored_merge")
def scd2_stored_merge(spark, sf_dir):
    """Three batches merged into the stored form: early rows, later rows (twice, as after a failure), late rows."""
    events = table(spark, sf_dir, "events")
    root, start = scratch_dir(spark, "scd2"), "ts < timestamp_ntz'2024-01-15'"
    later = f"not ({start}) and not ({LATE})"
    for part in (f"{start} and not ({LATE})", later, later, LATE):
        history.merge_history(events.where(part), root, "users", buckets=8, **USERS)
    return history.read_history(spark, root, "users", keys=["user_id"], ts="ts", attributes=["event_type"])


# --- sources -------------------------------------------------------------------------------


@query("entity_scan")
def entity_scan(spark, sf_dir):
    schema = table(spark, sf_dir, "customer").schema
    return read_entity(spark, sf_dir, "customer.parquet", schema)


@query("incremental_orders")
def incremental_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return newer_than(orders, "o_orderdate", "1998-06-30 00:00:00")


@query("next_watermark")
def watermark_events(spark, sf_dir):
    return next_watermark(table(spark, sf_dir, "events"), "ts")


@query("json_flatten")
def json_flatten(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "props")
    flat = flatten_json(events, "props", infer_json_type(events, "props"), keep=["event_id"])
    return flat.withColumnRenamed("props.k", "props_k")


@query("json_flatten_rescue")
def json_flatten_rescue(spark, sf_dir):
    """Events with a type known beforehand, some malformed or of another type; one pass."""
    props = F.expr("case when event_id % 11 = 0 then '{\"k\": ' when event_id % 13 = 0 then '{\"k\": \"x\"}' else props end")
    events = table(spark, sf_dir, "events").select("event_id", props.alias("props"))
    flat = flatten_json(events, "props", "k bigint", keep=["event_id"], rescue="_rescued")
    return flat.withColumnRenamed("props.k", "props_k")


BORDER = "timestamp_ntz'1998-06-30 00:00:00'"


@query("incremental_two_runs")
def incremental_two_runs(spark, sf_dir):
    """Two runs over a growing source; half of the orders of the border's day come after the first run."""
    root, orders = scratch_dir(spark, "increments"), table(spark, sf_dir, "orders")
    state, by = f"{root}/watermark", ("o_orderdate", ["o_orderkey"])
    arrived = f"o_orderdate < {BORDER} or (o_orderdate = {BORDER} and o_orderkey % 2 = 0)"
    for run, source in (("0", orders.where(arrived)), ("1", orders)):
        found = read_increment(source, state, *by)
        layers.write_bronze(found, root, "orders", source="erp", batch_id=run, ingested_at=INGESTED_AT, mode="batch")
        store_watermark(layers.read_batch(spark, root, "orders", run, orders.schema), state, *by)
    return layers.read_batches(spark, root, "orders").drop("_ingestion_timestamp", "_source_system")


@query("paged_orders")
def paged_orders(spark, sf_dir):
    """Orders as the JSON records of an API's pages, unpacked where they lie."""
    detail = F.struct("o_totalprice", "o_orderpriority").alias("detail")
    page = F.to_json(F.struct(F.array(F.struct("o_orderkey", detail)).alias("results"))).alias("payload")
    record = T.StructType.fromDDL("o_orderkey bigint, detail struct<o_totalprice: double, o_orderpriority: string>")
    flat = explode_records(table(spark, sf_dir, "orders").select(page), "payload", record)
    return flat.toDF(*[c.replace(".", "_") for c in flat.columns])


# --- layers ----------------------------------------------------------------------------------


@query("bronze_metadata")
def bronze_metadata(spark, sf_dir):
    root = scratch_dir(spark, "bronze")
    orders = table(spark, sf_dir, "orders")
    layers.write_bronze(orders, root, "orders", source="erp", batch_id=BATCH_ID, ingested_at=INGESTED_AT)
    stored = layers.read_table(spark, root, "bronze", "orders")
    in_utc = F.to_utc_timestamp("_ingestion_timestamp", F.current_timezone())
    return stored.withColumn("_ingestion_timestamp", F.date_format(in_utc, "yyyy-MM-dd HH:mm:ss"))


@query("bronze_rerun")
def bronze_rerun(spark, sf_dir):
    """Two batches landed, the second one twice: it is there once."""
    root, orders = scratch_dir(spark, "bronze"), table(spark, sf_dir, "orders")
    for batch, rows in (("0", orders), ("01", _order_batch(orders)), ("01", _order_batch(orders))):
        layers.write_bronze(rows, root, "orders", source="erp", batch_id=batch, ingested_at=INGESTED_AT, mode="batch")
    return layers.read_batches(spark, root, "orders").drop("_ingestion_timestamp", "_source_system")


@query("schema_evolve_union")
def schema_evolve_union(spark, sf_dir):
    """Two loads with different columns, read back as one table."""
    root = scratch_dir(spark, "evolve")
    part = table(spark, sf_dir, "part")
    loads = [part.select("p_partkey", "p_name"), part.select("p_partkey", "p_brand", "p_size")]
    for i, load in enumerate(loads):
        layers.write_bronze(load, root, "part", source="erp", batch_id=f"load{i}", mode="append")
    return layers.read_table(spark, root, "bronze", "part", merge_schema=True).drop(
        "_ingestion_timestamp", "_source_system"
    )


def _two_loads(spark: SparkSession, sf_dir: str) -> str:
    """Orders landed on the last day of 2024, and those from 1999 on again a day later, repriced."""
    root = scratch_dir(spark, "loads")
    orders = table(spark, sf_dir, "orders")
    layers.write_bronze(orders, root, "orders", source="erp", batch_id="load0", ingested_at=INGESTED_AT)
    layers.write_bronze(
        _order_batch(orders), root, "orders", source="erp", batch_id="load1",
        ingested_at=INGESTED_AT + dt.timedelta(days=1), mode="append",
    )
    return root


@query("table_as_of")
def table_as_of(spark, sf_dir):
    """The stored loads as they stood after the second one."""
    state = layers.table_as_of(
        spark, _two_loads(spark, sf_dir), "orders", INGESTED_AT + dt.timedelta(days=2), keys=["o_orderkey"]
    )
    return state.drop("_ingestion_timestamp", "_source_system")


@query("table_history")
def table_history(spark, sf_dir):
    history = layers.table_history(spark, _two_loads(spark, sf_dir), "orders")
    return history.select("_batch_id", "row_count", "version")


def _merged_silver(spark: SparkSession, sf_dir: str) -> str:
    """Orders up to 1999 loaded on the last day of 2024, those from 1999 on merged a day later, the oldest again after that.

    The last merge runs twice, as after a failure.
    """
    root, orders = scratch_dir(spark, "feed"), table(spark, sf_dir, "orders")
    oldest = orders.where("o_orderdate < timestamp_ntz'1996-01-01'").withColumn("o_orderpriority", F.lit("NONE"))
    loads = [orders.where("o_orderdate < timestamp_ntz'2000-01-01'"), _order_batch(orders), oldest, oldest]
    for load, day in zip(loads, (0, 1, 2, 2), strict=True):
        layers.write_silver(
            load, root, "orders", merge_keys="o_orderkey", batch_id=f"load{day}", changed_at=INGESTED_AT + dt.timedelta(days=day)
        )
    return root


def _in_utc(column: str):
    return F.date_format(F.to_utc_timestamp(column, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")


@query("silver_change_feed")
def silver_change_feed(spark, sf_dir):
    """Every row the load and the merges wrote, and whether it was new."""
    feed = changes.read_changes(spark, _merged_silver(spark, sf_dir), "orders", ["o_orderkey"])
    return feed.withColumn("_changed_at", _in_utc("_changed_at"))


@query("silver_as_of")
def silver_as_of(spark, sf_dir):
    """The merged table between its two merges."""
    at = INGESTED_AT + dt.timedelta(days=1, hours=12)
    return layers.table_as_of(spark, _merged_silver(spark, sf_dir), "orders", at, keys=["o_orderkey"], layer="silver")


@query("silver_history")
def silver_history(spark, sf_dir):
    found = layers.table_history(spark, _merged_silver(spark, sf_dir), "orders", "silver", keys=["o_orderkey"])
    return found.withColumn("changed_at", _in_utc("changed_at"))


@query("partition_roundtrip")
def partition_roundtrip(spark, sf_dir):
    root = scratch_dir(spark, "partitioned")
    orders = table(spark, sf_dir, "orders")
    layers.write_silver(orders, root, "orders", partition_cols=["o_orderstatus"])
    return layers.read_table(spark, root, "silver", "orders")


@query("silver_merge")
def silver_merge(spark, sf_dir):
    """The stored form of the upsert: a first load, then a batch merged into it."""
    root = scratch_dir(spark, "silver")
    orders = table(spark, sf_dir, "orders")
    layers.write_silver(orders.where("o_orderdate < timestamp_ntz'2000-01-01'"), root, "orders")
    layers.write_silver(_order_batch(orders), root, "orders", merge_keys="o_orderkey")
    return layers.read_table(spark, root, "silver", "orders")


@query("silver_merge_bucketed")
def silver_merge_bucketed(spark, sf_dir):
    """The same in buckets on the key: the batch is moved to the table's buckets, the table is read in place."""
    root, orders, name = scratch_dir(spark, "silver"), table(spark, sf_dir, "orders"), fresh_name("orders")
    for load in (orders.where("o_orderdate < timestamp_ntz'2000-01-01'"), _order_batch(orders)):
        bucketed.merge_bucketed(load, root, "orders", merge_keys="o_orderkey", buckets=8, name=name)
    return spark.table(name)


@query("silver_merge_partitioned")
def silver_merge_partitioned(spark, sf_dir):
    """The same with the partition column in the key: only the batch's partitions are rewritten."""
    root = scratch_dir(spark, "silver")
    orders = table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    keys, parts = ["o_orderkey", "order_year"], ["order_year"]
    stored = orders.where("o_orderdate < timestamp_ntz'2000-01-01'")
    layers.write_silver(stored, root, "orders", partition_cols=parts)
    layers.write_silver(_order_batch(orders), root, "orders", merge_keys=keys, partition_cols=parts)
    return layers.read_table(spark, root, "silver", "orders")


def _by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the month as zero-padded text."""
    return table(spark, sf_dir, "orders").withColumn("order_month", F.date_format("o_orderdate", "MM"))


def _stored_by_month(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark, "months")
    layers.write_silver(_by_month(spark, sf_dir), root, "orders", partition_cols=["order_month"])
    return root


@query("partition_text_roundtrip")
def partition_text_roundtrip(spark, sf_dir):
    """Text partition values that look like numbers come back as text."""
    return layers.read_table(spark, _stored_by_month(spark, sf_dir), "silver", "orders")


@query("silver_merge_keeps_layout")
def silver_merge_keeps_layout(spark, sf_dir):
    """A merge that names no partition columns leaves the stored ones in place."""
    root = scratch_dir(spark, "silver")
    orders = _by_month(spark, sf_dir)
    layers.write_silver(orders.where("o_orderdate < timestamp_ntz'2000-01-01'"), root, "orders", partition_cols=["order_month"])
    layers.write_silver(_order_batch(orders), root, "orders", merge_keys="o_orderkey")
    return layers.read_table(spark, root, "silver", "orders")


@query("optimize_partitioned")
def optimize_partitioned(spark, sf_dir):
    root = _stored_by_month(spark, sf_dir)
    maintain.optimize_table(spark, table_path(root, "silver", "orders"))
    return layers.read_table(spark, root, "silver", "orders")


@query("zorder_partitioned")
def zorder_partitioned(spark, sf_dir):
    root = _stored_by_month(spark, sf_dir)
    maintain.optimize_table(spark, table_path(root, "silver", "orders"), ["o_custkey", "o_orderkey"])
    return layers.read_table(spark, root, "silver", "orders")


@query("layer_row_counts")
def layer_row_counts(spark, sf_dir):
    return gold.layer_counts(products.flag_valid(clean_products(spark, sf_dir)))


@query("gold_daily_revenue")
def gold_daily_revenue(spark, sf_dir):
    return gold.daily_revenue(table(spark, sf_dir, "lineitem"))


@query("gold_category_summary")
def gold_category_summary(spark, sf_dir):
    return gold.category_summary(transform_products(raw_products(spark, sf_dir), AS_OF))


@query("gold_roundtrip")
def gold_roundtrip(spark, sf_dir):
    root = scratch_dir(spark, "gold")
    revenue = gold.daily_revenue(table(spark, sf_dir, "lineitem"))
    return spark.table(layers.write_gold(revenue, root, "daily_revenue", name=fresh_name("daily")))


@query("gold_incremental_revenue")
def gold_incremental_revenue(spark, sf_dir):
    """Revenue stored for the first loads, then brought up to date with the later lines."""
    root = scratch_dir(spark, "gold")
    lines = table(spark, sf_dir, "lineitem")
    loaded = "l_returnflag <> 'N'"
    name = layers.write_gold(gold.daily_revenue(lines.where(loaded)), root, "daily", name=fresh_name("daily"))
    layers.write_gold(gold.add_revenue(spark.table(name), lines.where(f"not ({loaded})")), root, "daily", name=name)
    return spark.table(name)


@query("gold_distinct_customers")
def gold_distinct_customers(spark, sf_dir):
    """Distinct customers per month, stored as bitmaps and brought up to date by two more loads, the last one twice."""
    root = scratch_dir(spark, "gold")
    orders = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_custkey", "o_orderkey")
    name, by = fresh_name("customers"), (["month"], "o_custkey")
    layers.write_gold(gold.distinct_bitmaps(orders.where("o_orderkey % 3 = 0"), *by), root, "customers", name=name)
    for part in (1, 2, 2):
        more = gold.add_distinct(spark.table(name), orders.where(f"o_orderkey % 3 = {part}"), *by)
        layers.write_gold(more, root, "customers", name=name)
    return gold.distinct_counts(spark.table(name), ["month"], "customers")


@query("gold_hash_distribution")
def gold_hash_distribution(spark, sf_dir):
    """Two tables hashed on the customer, joined bucket by bucket."""
    root = scratch_dir(spark, "gold")
    revenue = gold.customer_revenue(table(spark, sf_dir, "orders"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"), "c_mktsegment")
    hashed = {"distribution": "HASH", "keys": ["customer_id"], "parts": 8}
    facts = spark.table(layers.write_gold(revenue, root, "revenue", name=fresh_name("revenue"), **hashed))
    dims = spark.table(layers.write_gold(customers, root, "customer", name=fresh_name("customer"), **hashed))
    return (
        facts.join(dims.hint("merge"), "customer_id")
        .groupBy("c_mktsegment")
        .agg(F.sum("order_count").alias("order_count"), F.sum("order_value").alias("order_value"))
    )


@query("gold_broadcast_dim")
def gold_broadcast_dim(spark, sf_dir):
    """Order value per nation and region, over replicated dimensions."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    revenue = gold.customer_revenue(orders)  # one row per customer before any join
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    placed = revenue.join(customer, revenue["customer_id"] == customer["c_custkey"])
    placed = replicated_join(placed, nation, placed["c_nationkey"] == nation["n_nationkey"])
    placed = replicated_join(placed, region, placed["n_regionkey"] == region["r_regionkey"])
    return placed.groupBy("r_name", "n_name").agg(
        F.sum("order_count").alias("order_count"), F.sum("order_value").alias("order_value")
    )


@query("dim_customer")
def dim_customer(spark, sf_dir):
    return star.dim_customer(*[table(spark, sf_dir, t) for t in ("customer", "nation", "region")])


@query("dim_supplier")
def dim_supplier(spark, sf_dir):
    return star.dim_supplier(*[table(spark, sf_dir, t) for t in ("supplier", "nation", "region")])


@query("dim_date")
def dim_date(spark, sf_dir):
    """The dates that sales refer to."""
    ordered = table(spark, sf_dir, "orders").select("o_orderdate")
    return star.dim_date(ordered.union(table(spark, sf_dir, "lineitem").select("l_shipdate")))


@query("dim_part")
def dim_part(spark, sf_dir):
    return star.dim_part(table(spark, sf_dir, "part"))


@query("dim_user_versions")
def dim_user_versions(spark, sf_dir):
    """Users by their latest kind of event, as a type-2 dimension."""
    history = scd.scd2_history(table(spark, sf_dir, "events"), ["user_id"], "ts", ["event_type"], ["event_id"])
    return star.versioned_dimension(history, ["user_id"])


@query("fact_event_versions")
def fact_event_versions(spark, sf_dir):
    """All events with the version of their user in force, where versions are known from the tenth of January on."""
    events = table(spark, sf_dir, "events")
    known = scd.scd2_history(events.where("ts >= timestamp_ntz'2024-01-10'"), ["user_id"], "ts", ["event_type"], ["event_id"])
    return star.fact_with_versions(events, star.versioned_dimension(known, ["user_id"]), ["user_id"], "ts")


@query("fact_sales")
def fact_sales(spark, sf_dir):
    return star.fact_sales(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


# --- maintenance -------------------------------------------------------------------------------


@query("zorder_key")
def zorder_key(spark, sf_dir):
    return with_z_value(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey", "l_shipdate"], "z_value")


@query("zorder_table")
def zorder_table(spark, sf_dir):
    """A stored table, clustered by two columns, read back."""
    path = table_path(scratch_dir(spark, "zorder"), "silver", "lineitem")
    table(spark, sf_dir, "lineitem").write.parquet(path)
    maintain.optimize_table(spark, path, ["l_partkey", "l_suppkey"], target_bytes=1024 * 1024)
    return spark.read.parquet(path)


@query("compact_table")
def compact_table(spark, sf_dir):
    """A stored table of many small files, compacted, read back."""
    path = table_path(scratch_dir(spark, "compact"), "silver", "orders")
    table(spark, sf_dir, "orders").repartition(16).write.parquet(path)
    maintain.optimize_table(spark, path)
    return spark.read.parquet(path)


# --- streams -----------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return stream_files(spark, sf_dir, schema, name_glob="events.parquet")


@query("stream_bronze_events")
def stream_bronze_events(spark, sf_dir):
    root = scratch_dir(spark, "stream")
    path = table_path(root, "bronze", "events")
    stream_to_bronze(
        _event_stream(spark, sf_dir), path, f"{root}/checkpoint", source="hub", batch_id=BATCH_ID, ingested_at=INGESTED_AT
    ).awaitTermination()
    return spark.read.parquet(path).drop("_ingestion_timestamp")


@query("stream_upsert_events")
def stream_upsert_events(spark, sf_dir):
    root = scratch_dir(spark, "stream")
    path = table_path(root, "silver", "events")
    order = {"keys": ["user_id"], "ts": "ts", "tie_breakers": ["event_id"]}
    stream_upsert(_event_stream(spark, sf_dir), path, f"{root}/checkpoint", **order).awaitTermination()
    return read_upserted(spark, path, **order)


@query("stream_upsert_pruned")
def stream_upsert_pruned(spark, sf_dir):
    """A change log pruned between two micro-batches; every key keeps its newest row."""
    root = scratch_dir(spark, "stream")
    path, landing = table_path(root, "silver", "events"), f"{root}/landing"
    order = {"keys": ["user_id"], "ts": "ts", "tie_breakers": ["event_id"]}
    events = table(spark, sf_dir, "events")
    for early in ("event_id % 2 = 0", "event_id % 2 <> 0"):
        events.where(early).write.mode("append").parquet(landing)
        stream = stream_files(spark, landing, events.schema)
        stream_upsert(stream, path, f"{root}/checkpoint", **order).awaitTermination()
        maintain.prune_log(spark, path, order["keys"], "ts", INGESTED_AT, tie_breakers=order["tie_breakers"])
    return read_upserted(spark, path, **order)
