"""Slowly changing dimensions, type 2.

Versions need the previous and the next change of the same key. A window per key gives
both in one shuffle, but sorts a key's whole life in one task, and a single key may hold
a third of the table. So keys with very many rows are found first and go another way:
their life is cut into slices of about equal numbers of rows (:mod:`millrace.operators.slices`),
windows run per (key, slice), and the one value that has to cross a slice border is carried
over as a marker row. Markers come from a map-side combined aggregate, one row per key and
slice in which the key is active.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.slices import HOT_ROWS, same_key, slice_cuts, with_slices

def _carry(summary: DataFrame, keys: Sequence[str], forward: bool) -> DataFrame:
    """Move each (key, slice) summary row to the next (or previous) slice the key is active in."""
    along = Window.partitionBy(*keys).orderBy("_slice")
    target = (F.lead if forward else F.lag)("_slice").over(along)
    return summary.withColumn("_to", target).where("_to is not null").drop("_slice").withColumnRenamed("_to", "_slice")


def _tracked(log: DataFrame, keys: Sequence[str], order: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    # wrapped in a struct, an all-null state still differs from "no previous row"
    return log.select(*keys, *order, F.struct(*[F.col(a).alias(a) for a in attributes]).alias("_state"))


def _with_unchanged(changes: DataFrame, others: DataFrame, keys: Sequence[str], order: Sequence[str], observed: bool) -> DataFrame:
    """The changes, and if ``observed`` the rows that repeat the state before them as well."""
    if not observed:
        return changes.select(*keys, "_state", order[0], "valid_to")
    kept = [*keys, "_state", *order]
    unchanged = others.select(*kept, F.lit(None).cast(changes.schema["valid_to"].dataType).alias("valid_to"), F.lit(False).alias("is_change"))
    return changes.select(*kept, "valid_to", F.lit(True).alias("is_change")).unionByName(unchanged)


def _versions_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str], observed: bool = False) -> DataFrame:
    """Changes with the start of the next one; one shuffle and one sort serve both windows."""
    life = Window.partitionBy(*keys).orderBy(*order)
    followed = rows.withColumn("_previous", F.lag("_state").over(life))
    same = F.col("_state").eqNullSafe(F.col("_previous"))
    changes = followed.where(~same).withColumn("valid_to", F.lead(order[0]).over(life))
    return _with_unchanged(changes, followed.where(same), keys, order, observed)


def _versions_by_slice(rows: DataFrame, keys: Sequence[str], order: Sequence[str], observed: bool = False) -> DataFrame:
    """What :func:`_versions_by_key` gives, with no window over more than one slice of a key."""
    ts, is_marker = order[0], F.lit(True)
    last_states = rows.groupBy(*keys, "_slice").agg(F.max_by("_state", F.struct(*order)).alias("_state"))
    carried = _carry(last_states, keys, forward=True).withColumn("_marker", is_marker)
    markers_first = Window.partitionBy(*keys, "_slice").orderBy(F.col("_marker").desc(), *order)
    followed = (
        rows.withColumn("_marker", F.lit(False))
        .unionByName(carried, allowMissingColumns=True)
        .withColumn("_previous", F.lag("_state").over(markers_first))
        .where(~F.col("_marker"))
    )
    same = F.col("_state").eqNullSafe(F.col("_previous"))
    changes = followed.where(~same).drop("_previous")
    first_changes = changes.groupBy(*keys, "_slice").agg(F.min_by(ts, F.struct(*order)).alias(ts))
    following = _carry(first_changes, keys, forward=False).withColumn("_marker", is_marker)
    markers_last = Window.partitionBy(*keys, "_slice").orderBy("_marker", *order)
    ended = (
        changes.unionByName(following, allowMissingColumns=True)
        .withColumn("valid_to", F.lead(ts).over(markers_last))
        .where(~F.col("_marker"))
    )
    return _with_unchanged(ended, followed.where(same), keys, order, observed)


def _versions(
    log: DataFrame, keys: Sequence[str], order: Sequence[str], attributes: Sequence[str], hot_rows: int, observed: bool = False
) -> DataFrame:
    rows, cuts = _tracked(log, keys, order, attributes), slice_cuts(log, keys, order, hot_rows)
    if cuts is None:
        return _versions_by_key(rows, keys, order, observed)
    rows = with_slices(rows, keys, order, cuts)
    usual = _versions_by_key(rows.where("_slice is null"), keys, order, observed)
    return usual.unionByName(_versions_by_slice(rows.where("_slice is not null"), keys, order, observed))


def scd2_history(
    log: DataFrame, keys: Sequence[str], ts: str, attributes: Sequence[str], tie_breakers: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Versions of each key: keys, attributes, ``valid_from``, ``valid_to``, ``is_current``.

    A version starts at a row that changes an attribute and ends where the next one
    starts (``valid_to`` exclusive, null for the current one). Order within a key is
    (ts, tie_breakers), which must be total. Keys with more than ``hot_rows`` rows are
    worked on in slices of about that many.
    """
    versions = _versions(log, keys, [ts, *tie_breakers], attributes, hot_rows)
    return versions.select(
        *keys,
        *[F.col("_state").getField(a).alias(a) for a in attributes],
        F.col(ts).alias("valid_from"),
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def scd2_merge(
    history: DataFrame, changes: DataFrame, keys: Sequence[str], ts: str, attributes: Sequence[str],
    tie_breakers: Sequence[str] = (), hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Fold a batch of changes into an existing type-2 history.

    Versions that ended by the first change of their key, and keys without changes,
    pass through; only versions a change can touch are rebuilt with the batch. A late
    change is put in at its own time and splits the version it falls into.
    """
    first_change = changes.groupBy(*keys).agg(F.min(ts).alias("_first_change"))
    seen = history.join(
        first_change.withColumnsRenamed({k: f"_{k}" for k in keys}),
        [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys],
        "left",
    )
    open_to_change = F.coalesce(
        F.col("_first_change").isNotNull()
        & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("_first_change"))),
        F.lit(False),
    )
    columns = [*keys, *attributes, "valid_from", "valid_to", "is_current"]
    kept = seen.where(~open_to_change).select(*columns)
    stored = seen.where(open_to_change).select(
        *keys, *attributes, F.col("valid_from").alias(ts), F.lit(0).alias("_arrival")
    )
    arriving = changes.select(*keys, *attributes, ts, *tie_breakers, F.lit(1).alias("_arrival"))
    log = stored.unionByName(arriving, allowMissingColumns=True)
    rebuilt = scd2_history(log, keys, ts, attributes, ["_arrival", *tie_breakers], hot_rows)
    return kept.unionByName(rebuilt)


def scd2_observed(
    log: DataFrame, keys: Sequence[str], ts: str, attributes: Sequence[str], tie_breakers: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All rows of a log with ``is_change`` and, on changes, ``valid_to``: a history that late rows can be merged into.

    :func:`versions_of` gives the type-2 history. Rows that repeat the state before them are kept, since a late
    row put in between makes them changes.
    """
    observed = _versions(log, keys, [ts, *tie_breakers], attributes, hot_rows, observed=True)
    return observed.select(
        *keys, *[F.col("_state").getField(a).alias(a) for a in attributes], ts, *tie_breakers, "valid_to", "is_change"
    )


def versions_of(observed: DataFrame, keys: Sequence[str], ts: str, attributes: Sequence[str]) -> DataFrame:
    """The type-2 history in an observed one, as :func:`scd2_history` gives it; a filter and no shuffle."""
    return observed.where("is_change").select(
        *keys, *attributes, F.col(ts).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current")
    )


def scd2_merge_observed(
    observed: DataFrame, changes: DataFrame, keys: Sequence[str], ts: str, attributes: Sequence[str],
    tie_breakers: Sequence[str] = (), hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """An observed history with a batch merged in: equal to one built from all rows at once, however late they come.

    Of keys in the batch only the rows from the batch's first one on, and the version in force before it,
    are looked at again; all others pass through. A row that has the place (ts, tie_breakers) of a stored one
    replaces it, so a batch may be merged twice.
    """
    order = [ts, *tie_breakers]
    point = F.struct(*order)
    first = changes.groupBy(*keys).agg(F.min(point).alias("_first"))
    seen = observed.join(first.withColumnsRenamed({k: f"_{k}" for k in keys}), same_key(keys, "_"), "left")
    in_force = F.col("is_change") & F.coalesce(F.col("valid_to") >= F.col(f"_first.{ts}"), F.lit(True))
    touched = F.col("_first").isNotNull() & ((point >= F.col("_first")) | in_force)
    columns = [*keys, *attributes, *order]
    kept = seen.where(~F.coalesce(touched, F.lit(False))).select(*observed.columns)
    arrived = seen.where(touched).select(*columns, F.lit(0).alias("_arrival")).unionByName(
        changes.select(*columns, F.lit(1).alias("_arrival"))
    )
    state = F.struct(*[F.col(a).alias(a) for a in attributes])
    settled = arrived.groupBy(*keys, *order).agg(F.max_by(state, "_arrival").alias("_settled"))
    log = settled.select(*keys, *[F.col("_settled").getField(a).alias(a) for a in attributes], *order)
    return kept.unionByName(scd2_observed(log, keys, ts, attributes, tie_breakers, hot_rows).select(*observed.columns))
