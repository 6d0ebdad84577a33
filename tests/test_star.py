"""Surrogate keys and the star schema."""

from pyspark.sql import functions as F

from helpers import final_plan
from millrace.functions.columns import surrogate_key
from millrace.operators import gold, star


def test_keys_of_several_parts_do_not_run_together(spark):
    frame = spark.createDataFrame(
        [("a", "bc"), ("ab", "c"), (None, "abc"), ("abc", None), ("-", "abc"), ("", "abc")], "x string, y string"
    )
    assert frame.select(surrogate_key("x", "y").alias("sk")).distinct().count() == 6


def test_fact_keys_find_their_dimensions(spark, sf_dir):
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders", "customer", "nation", "region", "part")}
    fact = star.fact_sales(tables["lineitem"], tables["orders"])
    customers = star.dim_customer(tables["customer"], tables["nation"], tables["region"])
    parts = star.dim_part(tables["part"])
    assert fact.count() == tables["lineitem"].count()
    assert fact.join(customers, "customer_sk", "left_anti").count() == 0
    assert fact.join(parts, "part_sk", "left_anti").count() == 0
    assert customers.select("customer_sk").distinct().count() == customers.count()


def test_fact_reads_only_what_it_needs(spark, sf_dir):
    fact = star.fact_sales(*[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders")])
    shown = final_plan(fact.groupBy("ship_date").agg(F.sum("net_amount")))
    assert "l_tax" not in shown and "o_orderpriority" not in shown


def test_revenue_adds_up(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    whole = gold.daily_revenue(lines)
    parts = gold.add_revenue(gold.daily_revenue(lines.where("l_tax < 0.04")), lines.where("l_tax >= 0.04"))
    assert whole.exceptAll(parts).count() == parts.exceptAll(whole).count() == 0
    assert sum(r["line_count"] for r in whole.collect()) == lines.count()


def test_members_without_a_match_stay(spark, sf_dir):
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders", "customer", "nation", "region")}
    customers = star.dim_customer(tables["customer"], tables["nation"].where("n_nationkey > 3"), tables["region"].where("r_regionkey > 1"))
    assert customers.count() == tables["customer"].count()
    assert customers.where("region = 'Unknown'").count() > customers.where("nation = 'Unknown'").count() > 0
    fact = star.fact_sales(tables["lineitem"], tables["orders"].where("o_orderkey % 2 = 0"))
    assert fact.count() == tables["lineitem"].count()
    members = star.with_unknown_member(customers, "customer_sk")
    assert fact.where(F.col("customer_sk") == star.UNKNOWN_KEY).count() > 0
    assert fact.join(members, "customer_sk", "left_anti").count() == 0


def test_distinct_counts_over_loads(spark):
    rows = spark.range(5000).selectExpr("id % 7 as g", "if(id % 11 = 0, null, (id * id) % 90000 - 50) as k", "id")
    bitmaps = gold.distinct_bitmaps(rows.where("id < 1000"), ["g"], "k")
    for part in ("id >= 1000 and id < 3000", "id >= 2500"):  # they overlap
        bitmaps = gold.add_distinct(bitmaps, rows.where(part), ["g"], "k")
    want = {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.countDistinct("k").alias("n")).collect()}
    assert {r["g"]: r["n"] for r in gold.distinct_counts(bitmaps, ["g"], "n").collect()} == want
    assert gold.distinct_counts(bitmaps, [], "n").first()["n"] == rows.select("k").where("k is not null").distinct().count()
