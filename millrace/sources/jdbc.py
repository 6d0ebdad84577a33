"""Reads over JDBC: one query, a query split by column ranges, or by key hash."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def connection_options(
    url: str,
    *,
    token: str | None = None,
    user: str | None = None,
    password: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for a connection: a bearer token if given, else user and password."""
    options = {"url": url, **(extra or {})}
    if token:
        options["accessToken"] = token
    elif user is not None:
        options.update(user=user, password=password or "")
    return options


def range_options(query: str, column: str, partitions: int, lower: int, upper: int) -> dict[str, str]:
    """Options for a range-split read.

    The query goes in as a derived table, since Spark allows no partition column next to
    its ``query`` option. Rows outside the bounds are still read, by the edge partitions.
    """
    return {
        "dbtable": f"({query}) q",
        "partitionColumn": column,
        "numPartitions": str(partitions),
        "lowerBound": str(lower),
        "upperBound": str(upper),
    }


def read_query(spark: SparkSession, query: str, connection: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**connection).option("query", query).load()


def read_partitioned(
    spark: SparkSession,
    query: str,
    column: str,
    partitions: int,
    connection: Mapping[str, str],
    lower: int | None = None,
    upper: int | None = None,
) -> DataFrame:
    """Read in parallel over ranges of a numeric column.

    Bounds not given are asked of the database (its min and max), so the ranges cover
    the keys there are instead of a fixed guess.
    """
    if lower is None or upper is None:
        table = spark.read.format("jdbc").options(**connection).option("dbtable", f"({query}) q").load()
        found = table.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
        lower = lower if lower is not None else int(found["lo"] or 0)
        upper = upper if upper is not None else int(found["hi"] or 0) + 1
    options = range_options(query, column, partitions, lower, upper)
    return spark.read.format("jdbc").options(**connection).options(**options).load()


def hash_predicates(column: str, partitions: int) -> list[str]:
    """One WHERE clause per partition; together they cover every row once, nulls in the first.

    For keys whose values cluster, where equal ranges would hold very unequal row counts.
    """
    rest = [f"ABS(MOD({column}, {partitions})) = {i}" for i in range(partitions)]
    return [f"({rest[0]} OR {column} IS NULL)", *rest[1:]]


def read_hashed(
    spark: SparkSession, query: str, column: str, partitions: int, connection: Mapping[str, str]
) -> DataFrame:
    options = dict(connection)
    return spark.read.jdbc(
        url=options.pop("url"), table=f"({query}) q", predicates=hash_predicates(column, partitions), properties=options
    )
