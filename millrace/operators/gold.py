"""Business aggregates of the gold layer: map-side combined sums over exact decimals, and bitmaps of ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.star import money, net_amount


def daily_revenue(lineitem: DataFrame) -> DataFrame:
    """Lines, quantity and net revenue per ship date."""
    return lineitem.groupBy(F.col("l_shipdate").cast("date").alias("ship_date")).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(F.col("l_quantity").cast("decimal(12,2)")).alias("quantity"),
        F.sum(net_amount()).alias("net_revenue"),
    )


def add_revenue(stored: DataFrame, new_lines: DataFrame) -> DataFrame:
    """A stored :func:`daily_revenue` brought up to date with new lines.

    The measures add up, so only the new lines are aggregated, then both are summed.
    """
    return (
        stored.unionByName(daily_revenue(new_lines))
        .groupBy("ship_date")
        .agg(*[F.sum(m).alias(m) for m in ("line_count", "quantity", "net_revenue")])
    )


def category_summary(products: DataFrame) -> DataFrame:
    """Products, price range and share of imputed rows per category."""
    return products.groupBy("category").agg(
        F.count(F.lit(1)).alias("product_count"),
        F.sum("price").alias("total_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count_if("_has_imputed_values").alias("imputed_count"),
    )


def customer_revenue(orders: DataFrame) -> DataFrame:
    """Orders and order value per customer: one row per customer, however many orders it has."""
    return orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum(money("o_totalprice")).alias("order_value")
    )


def layer_counts(flagged: DataFrame) -> DataFrame:
    """Rows read, rows valid and rows quarantined, in one pass."""
    return flagged.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if("_is_valid").alias("valid_rows"),
        F.count_if(~F.col("_is_valid")).alias("quarantined_rows"),
    )


def distinct_bitmaps(rows: DataFrame, groups: Sequence[str], id_column: str) -> DataFrame:
    """Which whole-number ids each group has, as bitmaps of 32,768 ids: groups, ``bucket``, ``ids``.

    Distinct counts do not add up over loads, their bitmaps do (:func:`add_distinct`). Bitmaps are combined on the map
    side; their size goes by the span of the ids, so they suit dense keys. Null ids are left out.
    """
    ids = F.col(id_column).cast("long")
    present = rows.where(ids.isNotNull())
    return present.groupBy(*groups, F.bitmap_bucket_number(ids).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias("ids")
    )


def add_distinct(stored: DataFrame, new_rows: DataFrame, groups: Sequence[str], id_column: str) -> DataFrame:
    """Stored :func:`distinct_bitmaps` brought up to date; a load that is added twice changes nothing."""
    both = stored.unionByName(distinct_bitmaps(new_rows, groups, id_column))
    return both.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))


def distinct_counts(bitmaps: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """The exact number of distinct ids of each group, or of each coarser group when fewer are named."""
    merged = bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count("ids")).alias(name))
