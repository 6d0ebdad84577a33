"""As-of joins: the version in force for each fact, without a range join.

Facts and versions are laid into one line per key, by time, versions before facts of the same time, and the last
version is carried forward along it: one shuffle of either side on the key, and a running window. Keys
with very many rows are cut into slices (:mod:`millrace.operators.slices`); the last version before a slice
is put in front of it, from one row per key and slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import any_of, quoted
from millrace.operators.slices import HOT_ROWS, slice_cuts, with_slices

_ORDER = ("_at", "_is_fact", "_tie", "_spread")


def _line(facts: DataFrame, versions: DataFrame, keys, at, valid_from, columns, tie_breakers) -> DataFrame:
    fact = F.struct(*[quoted(c) for c in facts.columns])
    version = F.struct(*[quoted(c) for c in columns])
    kinds = {c: facts.schema[c].dataType for c in (*keys, at)}
    tie = F.struct(F.lit(0).alias("_"), *[quoted(c) for c in tie_breakers])
    tie_kind, version_kind = (versions.select(c.alias("c")).schema["c"].dataType for c in (tie, version))
    fact_kind = facts.select(fact.alias("c")).schema["c"].dataType
    whole = ~any_of([quoted(k).isNull() for k in keys])
    started = versions.where(whole).select(
        *[quoted(k).cast(kinds[k]).alias(k) for k in keys], quoted(valid_from).cast(kinds[at]).alias("_at"), F.lit(0).alias("_is_fact"),
        tie.alias("_tie"), F.lit(0).cast("long").alias("_spread"), version.alias("_version"), F.lit(None).cast(fact_kind).alias("_fact"),
    )
    # the hash deals facts of one time to several slices
    timed = facts.where(whole & quoted(at).isNotNull()).select(
        *[quoted(k) for k in keys], quoted(at).alias("_at"), F.lit(1).alias("_is_fact"), F.lit(None).cast(tie_kind).alias("_tie"),
        F.xxhash64(*[quoted(c) for c in facts.columns]).alias("_spread"), F.lit(None).cast(version_kind).alias("_version"), fact.alias("_fact"),
    )
    return started.unionByName(timed)


def _carried(line: DataFrame, within: Sequence[str], order: Sequence) -> DataFrame:
    """The facts of a line, each with the last version before it."""
    so_far = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return line.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far)).where("_is_fact = 1").select("_fact", "_version")


def _carried_by_slice(line: DataFrame, keys: Sequence[str]) -> DataFrame:
    began = F.when(F.col("_is_fact") == 0, F.struct(*_ORDER))
    ends = line.groupBy(*keys, "_slice").agg(F.max_by("_version", began).alias("_version"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    heads = ends.withColumn("_version", F.last("_version", ignorenulls=True).over(before)).where("_version is not null")
    marked = line.withColumn("_row", F.lit(1)).unionByName(heads.withColumn("_row", F.lit(0)), allowMissingColumns=True)
    return _carried(marked, [*keys, "_slice"], ["_row", *_ORDER])


def as_of_join(
    facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, valid_from: str, columns: Sequence[str],
    tie_breakers: Sequence[str] = (), hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All facts, each with ``columns`` of the last version of its key that began by its time ``at``.

    Both sides have the ``keys`` under the same names. Of versions that began at the same time the last one by
    ``tie_breakers`` counts; a version without a beginning has always been there. Nulls are added to facts before
    the first version, without a time, or with a null key. Repeated facts stay. Keys with more than
    ``hot_rows`` rows are worked on in slices of about that many; only facts equal in all columns cannot be parted.
    """
    clashes = sorted(set(columns) & set(facts.columns))
    if clashes:
        raise ValueError(f"columns that both sides have: {', '.join(clashes)}")
    line = _line(facts, versions, keys, at, valid_from, columns, tie_breakers)
    cuts = slice_cuts(line.select(*keys, *_ORDER), keys, _ORDER, hot_rows)
    if cuts is None:
        joined = _carried(line, keys, _ORDER)
    else:
        line = with_slices(line, keys, _ORDER, cuts)
        usual = _carried(line.where("_slice is null"), keys, _ORDER)
        joined = usual.unionByName(_carried_by_slice(line.where("_slice is not null"), keys))
    found = joined.select(
        *[F.col("_fact").getField(c).alias(c) for c in facts.columns], *[F.col("_version").getField(c).alias(c) for c in columns]
    )
    untimed = any_of([quoted(c).isNull() for c in (*keys, at)])
    return found.unionByName(facts.where(untimed), allowMissingColumns=True)
