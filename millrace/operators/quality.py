"""Data-quality expectations, all evaluated in one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the product suite.
PRODUCT_CATEGORIES = ("ELECTRONICS", "CLOTHING", "FOOD", "HOME", "SPORTS", "UNCATEGORIZED")
PRODUCT_ID_PATTERN = "^PROD-[0-9]{6}$"
PRICE_RANGE = (0, 100_000)
ROW_RANGE = (1, 10_000_000)
GATE_PERCENT = 95.0

RESULT = (
    "expectation string, column_name string, element_count bigint, missing_count bigint, "
    "unexpected_count bigint, unexpected_percent double, success boolean"
)


@dataclass(frozen=True)
class Expectation:
    """One check. ``holds`` is the condition per row (None for a table-level check).

    Rows whose column is null are missing, not unexpected, except for not-null itself.
    """

    name: str
    column: str | None = None
    holds: Column | None = None
    row_range: tuple[int, int | None] | None = None


def not_null(column: str) -> Expectation:
    return Expectation("not_null", column, F.col(column).isNotNull())


def between(column: str, low: float, high: float) -> Expectation:
    return Expectation("between", column, F.col(column).between(low, high))


def in_set(column: str, values: Sequence[str]) -> Expectation:
    return Expectation("in_set", column, F.col(column).isin(*values))


def matches(column: str, pattern: str) -> Expectation:
    return Expectation("regex", column, F.col(column).rlike(pattern))


def row_count_between(low: int, high: int | None) -> Expectation:
    """``high`` None: no upper bound."""
    return Expectation("row_count", row_range=(low, high))


def product_suite(
    categories: Sequence[str] = PRODUCT_CATEGORIES, row_range: tuple[int, int | None] = ROW_RANGE
) -> list[Expectation]:
    return [
        not_null("product_id"),
        not_null("product_name"),
        between("price", *PRICE_RANGE),
        in_set("category", categories),
        matches("product_id", PRODUCT_ID_PATTERN),
        row_count_between(*row_range),
    ]


def _result(i: int, e: Expectation) -> Column:
    rows = F.col("_rows")
    if e.row_range:
        low, high = e.row_range
        none = F.lit(0).cast("long")
        success = rows >= low if high is None else rows.between(low, high)
        return F.struct(
            F.lit(e.name), F.lit(None).cast("string"), rows, none, none, F.lit(0.0), success
        )
    missing, unexpected = F.col(f"_missing{i}"), F.col(f"_unexpected{i}")
    judged = rows if e.name == "not_null" else rows - missing
    percent = F.when(judged > 0, F.lit(100.0) * unexpected / judged).otherwise(F.lit(0.0))
    return F.struct(F.lit(e.name), F.lit(e.column), rows, missing, unexpected, percent, unexpected == 0)


def check(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """One row per expectation, from one scan of the columns the suite names.

    Only counters leave the map side; the single row of counts is then turned into rows.
    """
    counts = [F.count(F.lit(1)).alias("_rows")]
    for i, e in enumerate(suite):
        if e.holds is not None:
            counts.append(F.count_if(F.col(e.column).isNull()).alias(f"_missing{i}"))
            counts.append(F.count_if(~e.holds).alias(f"_unexpected{i}"))
    results = F.array(*[_result(i, e).cast(f"struct<{_as_struct()}>") for i, e in enumerate(suite)])
    return df.agg(*counts).select(F.inline(results))


def _as_struct() -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (c.split(" ") for c in RESULT.split(", ")))


def report(results: DataFrame) -> DataFrame:
    """Totals over the expectations of :func:`check`."""
    ok = F.count_if("success")
    total = F.count(F.lit(1))
    return results.agg(
        total.alias("evaluated_expectations"),
        ok.alias("successful_expectations"),
        (total - ok).alias("unsuccessful_expectations"),
        F.when(total > 0, F.lit(100.0) * ok / total).alias("success_percent"),
        (total == ok).alias("success"),
    )


def gate(results: DataFrame, minimum_percent: float = GATE_PERCENT) -> DataFrame:
    """The report plus the verdict. A suite that evaluated nothing does not pass."""
    passed = F.coalesce(F.col("success_percent") >= minimum_percent, F.lit(False))
    return report(results).withColumn("gate_passed", passed)


class QualityGateFailed(RuntimeError):
    """Raised by :func:`require_gate`."""


def require_gate(results: DataFrame, minimum_percent: float = GATE_PERCENT) -> None:
    """Raise unless the gate passes (reads the one verdict row)."""
    verdict = gate(results, minimum_percent).first()
    if not verdict["gate_passed"]:
        raise QualityGateFailed(f"{verdict['success_percent']}% of expectations hold, {minimum_percent}% needed")
