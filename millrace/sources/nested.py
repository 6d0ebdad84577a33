"""Nested JSON to flat columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import quoted


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def _at(path: tuple[str, ...]) -> Column:
    column = quoted(path[0])
    for step in path[1:]:
        column = column.getField(step)
    return column


def flatten_structs(df: DataFrame) -> DataFrame:
    """One column per leaf, named by its dotted path; arrays and maps stay as they are."""
    return df.select(*[_at(path).alias(".".join(path)) for path in _leaves(df.schema)])


def infer_json_type(df: DataFrame, column: str) -> str:
    """The type that holds every JSON value of the column, as DDL, for :func:`flatten_json`.

    One distributed pass; only the merged type comes back.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("type")).first()["type"]
    return found.replace("OBJECT<", "STRUCT<")


def flatten_json(
    df: DataFrame, column: str, schema: T.StructType | str, keep: Sequence[str] = (), rescue: str | None = None
) -> DataFrame:
    """Parse a JSON text column and flatten it to columns ``column.path``, next to ``keep``.

    With ``rescue`` a column of that name keeps the whole text of values that do not fit the schema, malformed ones
    and those of which a field had to become null; it is null where everything was read.
    """
    kept = [quoted(k) for k in keep]
    if rescue is None:
        return flatten_structs(df.select(*kept, F.from_json(column, schema).alias(column)))
    kind = schema if isinstance(schema, T.StructType) else df.select(F.from_json(column, schema).alias("c")).schema["c"].dataType
    fields = T.StructType([*kind.fields, T.StructField(rescue, T.StringType())])
    parsed = F.from_json(column, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": rescue})
    read = df.select(*kept, parsed.alias("_parsed"))
    values = F.struct(*[F.col("_parsed").getField(f.name).alias(f.name) for f in kind.fields]).alias(column)
    return flatten_structs(read.select(*kept, values, F.col("_parsed").getField(rescue).alias(rescue)))


def explode_records(pages: DataFrame, payload: str, record: T.StructType, results: str = "results") -> DataFrame:
    """One row per record of each JSON page, flattened.

    A page is a list of records or an object that holds the list under ``results``;
    any other page is an error, not a silently empty one.
    """
    as_list = F.from_json(payload, T.ArrayType(record))
    wrapped = F.from_json(payload, T.StructType([T.StructField(results, T.ArrayType(record))])).getField(results)
    is_list = F.ltrim(F.regexp_replace(payload, r"^\s+", "")).startswith("[")
    unknown = F.raise_error(F.lit(f"page is neither a list nor an object with '{results}'"))
    records = F.coalesce(F.when(is_list, as_list).otherwise(wrapped), unknown)
    return flatten_structs(pages.select(F.explode(records).alias("_record")).select("_record.*"))
