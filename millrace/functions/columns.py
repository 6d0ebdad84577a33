"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """The column called exactly ``name``, even when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def as_long(df: DataFrame, name: str) -> Column:
    """An integer that rises with the column; timestamps as microseconds.

    A timestamp without zone is counted along its own calendar, so the session zone and
    its clock changes play no part.
    """
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.IntegralType):
        return col.cast("long")
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (col * 10**kind.scale).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.TimestampNTZType):
        minutes = F.unix_date(col.cast("date")).cast("long") * 1440 + F.hour(col) * 60 + F.minute(col)
        return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), col) * 1_000_000).cast("long")
    raise TypeError(f"no integer order for {name}: {kind.simpleString()}")


def surrogate_key(*natural_key: str) -> Column:
    """md5 of the natural key.

    A function of the key alone, so facts and dimensions derive it independently: no
    sequence, no global sort and no lookup join. Parts are length-prefixed, so
    ("a", "bc") and ("ab", "c") differ; a one-part key is the md5 of its text.
    """
    texts = [F.col(k).cast("string") for k in natural_key]
    if len(texts) == 1:
        return F.md5(texts[0])
    tagged = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat(*tagged))
