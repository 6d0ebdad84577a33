"""Column names, declared types and schema contracts."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import quoted

# Fixed values of the product schema.
PRODUCT_TYPES = {
    "product_id": "string",
    "price": "decimal(10,2)",
    "created_date": "timestamp",
    "last_updated": "timestamp",
}


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Lower-case the headers and turn each space and hyphen into an underscore.

    Two headers that become the same name are an error rather than an ambiguous column.
    """
    names = [re.sub("[ -]", "_", header.lower()) for header in df.columns]
    clashes = sorted(name for name, uses in Counter(names).items() if uses > 1)
    if clashes:
        raise ValueError(f"headers collide after renaming: {', '.join(clashes)}")
    return df.toDF(*names)


def _lost(name: str, kind: str | T.DataType) -> Column:
    return quoted(name).isNotNull() & quoted(name).try_cast(kind).isNull()


def rescued(values: Mapping[str, Column]) -> Column:
    """A JSON object of the texts that are not null, or null if there are none."""
    texts = F.to_json(F.struct(*[v.cast("string").alias(c) for c, v in values.items()]))
    return F.nullif(texts, F.lit("{}")) if values else F.lit(None).cast("string")


def cast_columns(df: DataFrame, types: Mapping[str, str] = PRODUCT_TYPES, rescue: str | None = None) -> DataFrame:
    """Cast those of the listed columns that are present; what cannot be cast becomes null.

    With ``rescue`` a column of that name holds the lost texts as a JSON object by column, null if none was lost.
    """
    present = {c: kind for c, kind in types.items() if c in df.columns}
    casts = {c: quoted(c).try_cast(kind) for c, kind in present.items()}
    if rescue:
        casts[rescue] = rescued({c: F.when(_lost(c, kind), quoted(c).cast("string")) for c, kind in present.items()})
    return df.withColumns(casts)


def standardize_schema(df: DataFrame, types: Mapping[str, str] = PRODUCT_TYPES, rescue: str | None = None) -> DataFrame:
    return cast_columns(snake_case_columns(df), types, rescue)


def enforce_schema(
    df: DataFrame, contract: T.StructType, failures: str = "_cast_failures", rescue: str | None = None
) -> DataFrame:
    """Shape ``df`` to ``contract``: its columns, order and types.

    Missing columns come as typed nulls, others are dropped. ``failures`` names the
    columns of the row that held a value the declared type cannot hold (null if none),
    so nothing turns null unseen. With ``rescue`` a column of that name keeps their texts, and
    those of the columns outside the contract, as a JSON object.
    """
    present = set(df.columns)
    shaped = [
        (quoted(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in contract.fields
    ]
    inside = {f.name: f.dataType for f in contract.fields if f.name in present}
    lost = [F.when(_lost(c, kind), F.lit(c)) for c, kind in inside.items()]
    kept = [F.nullif(F.concat_ws(",", *lost), F.lit("")).alias(failures)]
    if rescue:
        texts = {c: F.when(_lost(c, kind), quoted(c).cast("string")) for c, kind in inside.items()}
        kept.append(rescued(texts | {c: quoted(c) for c in df.columns if c not in inside}).alias(rescue))
    return df.select(*shaped, *kept)
