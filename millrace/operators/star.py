"""Star schema: dimensions and the sales fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import as_long, surrogate_key
from millrace.operators.asof import as_of_join
from millrace.operators.joins import replicated_join
from millrace.operators.slices import HOT_ROWS


# What a row without a match in a dimension gets: the dimension's name for it, and its key.
UNKNOWN = "Unknown"
UNKNOWN_KEY = "unknown"


def money(column: str) -> Column:
    """Money as a decimal: sums are exact and the same whatever order they run in."""
    return F.col(column).cast("decimal(15,2)")


def net_amount() -> Column:
    """Line price after discount, exact."""
    return money("l_extendedprice") * (F.lit(1).cast("decimal(1,0)") - F.col("l_discount").cast("decimal(4,2)"))


def _with_geography(members: DataFrame, nation_key: str, nation: DataFrame, region: DataFrame) -> DataFrame:
    """All members, with nation and region names where those are known."""
    geography = replicated_join(nation, region, nation["n_regionkey"] == region["r_regionkey"], "left").select(
        "n_nationkey", "n_name", "r_name"
    )
    joined = replicated_join(members, geography, members[nation_key] == geography["n_nationkey"], "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(UNKNOWN)) for c in ("n_name", "r_name")})


def with_unknown_member(dimension: DataFrame, key: str) -> DataFrame:
    """The dimension and one more row, which facts without a member refer to."""
    unknown = dimension.sparkSession.range(1).select(F.lit(UNKNOWN_KEY).alias(key))
    return dimension.unionByName(unknown, allowMissingColumns=True)


def dim_customer(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Customers with their nation and region names; ``Unknown`` where there is none."""
    return _with_geography(customer, "c_nationkey", nation, region).select(
        surrogate_key("c_custkey").alias("customer_sk"),
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("market_segment"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
    )


def dim_supplier(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Suppliers with their nation and region names; ``Unknown`` where there is none."""
    return _with_geography(supplier, "s_nationkey", nation, region).select(
        surrogate_key("s_suppkey").alias("supplier_sk"),
        F.col("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
    )


def dim_date(dates: DataFrame) -> DataFrame:
    """One row per distinct date of the table's first column; weekdays count from Monday, 1."""
    day = F.col("date")
    return dates.select(F.col(dates.columns[0]).cast("date").alias("date")).where("date is not null").distinct().select(
        "date", F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.day(day).alias("day"), (F.weekday(day) + 1).alias("weekday"),
    )


def dim_part(part: DataFrame) -> DataFrame:
    return part.select(
        surrogate_key("p_partkey").alias("part_sk"),
        F.col("p_partkey").alias("part_id"),
        F.col("p_name").alias("part_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("part_type"),
        F.col("p_size").alias("part_size"),
    )


def versioned_dimension(history: DataFrame, keys: Sequence[str], name: str = "version_sk") -> DataFrame:
    """A type-2 history as a dimension: each version gets a surrogate key of its own."""
    started = as_long(history, "valid_from")
    return history.withColumn("_started", started).withColumn(name, surrogate_key(*keys, "_started")).drop("_started")


def fact_with_versions(
    facts: DataFrame, dimension: DataFrame, keys: Sequence[str], at: str, name: str = "version_sk", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """All facts with the surrogate key of the version of ``dimension`` in force at their time ``at``.

    ``dimension`` is a :func:`versioned_dimension`: versions hold from ``valid_from`` up to, not including, ``valid_to``.
    Facts before the first version, after the end of the last one, without a time or with a null key refer to the
    unknown member.
    """
    in_force = dimension.where("valid_to is null or valid_from is null or valid_to > valid_from")
    versions = in_force.select(*keys, "valid_from", F.struct(F.col(name).alias("sk"), F.col("valid_to").alias("until")).alias("_in_force"))
    joined = as_of_join(facts, versions, keys, at, "valid_from", ["_in_force"], hot_rows=hot_rows)
    until = F.col("_in_force.until")
    found = F.when(until.isNull() | (F.col(at) < until), F.col("_in_force.sk"))
    return joined.withColumn(name, F.coalesce(found, F.lit(UNKNOWN_KEY))).drop("_in_force")


def fact_sales(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order line, with the surrogate keys of its dimensions.

    The one join is line to order. Dimension keys are derived from the natural keys in
    the row, so the fact is never joined to a dimension to be built. Lines without an order
    stay, with the unknown customer and no order date; missing keys become ``UNKNOWN_KEY``.
    """

    def key(column: str) -> Column:
        return F.coalesce(surrogate_key(column), F.lit(UNKNOWN_KEY))

    lines = lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
        money("l_extendedprice").alias("gross_amount"),
        net_amount().alias("net_amount"),
    )
    heads = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        key("o_custkey").alias("customer_sk"),
        key("l_partkey").alias("part_sk"),
        key("l_suppkey").alias("supplier_sk"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        "quantity", "gross_amount", "net_amount",
    )
