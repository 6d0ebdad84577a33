"""Product clean-up, imputation, derived columns, scoring and validity.

Every step is a projection; the two values that depend on the whole table (the median
and the mean/deviation pair) enter the plan as scalar subqueries over the price column
alone. Nothing is collected and no step starts a job.
"""

from __future__ import annotations

import datetime as dt
from typing import Literal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import product as rules
from millrace.functions.columns import all_of, quoted
from millrace.functions.quantile import approx_quantile, exact_quantile

TEXT_COLUMNS = ("product_name", "category", "description")
# What the steps work out; other columns pass through them.
MADE_COLUMNS = (
    *TEXT_COLUMNS, "price", "_has_imputed_values", "price_tier", "product_age_days", "season",
    "price_competitiveness_score", "product_embedding", "_is_valid",
)


def clean_text_fields(df: DataFrame) -> DataFrame:
    """Tidy the text columns that are present; categories are upper-cased as well."""
    tidy = {c: rules.tidy_text(F.col(c)) for c in TEXT_COLUMNS if c in df.columns}
    if "category" in tidy:
        tidy["category"] = F.upper(tidy["category"])
    return df.withColumns(tidy)


def median_price(df: DataFrame, method: Literal["exact", "approx"] = "exact") -> DataFrame:
    """The median price as one row; see :mod:`millrace.functions.quantile`.

    The exact one is of integers and decimals; float and double prices always get the approximate one.
    """
    if isinstance(df.schema["price"].dataType, T.FloatType | T.DoubleType):
        method = "approx"
    return exact_quantile(df, "price") if method == "exact" else approx_quantile(df, "price")


def impute_products(
    df: DataFrame,
    median: Literal["exact", "approx"] = "exact",
    flag_mode: Literal["missing", "value_match"] = "missing",
    rescue: str | None = None,
) -> DataFrame:
    """Fill null categories and prices, and flag the rows.

    ``flag_mode="missing"`` flags rows in which a value was in fact filled.
    ``"value_match"`` flags every row whose category or price equals the fill value,
    genuine rows included. Needs the columns ``category`` and ``price``; with no price
    at all there is no median and prices stay null. A price that is null because its text was
    malformed, which the column ``rescue`` tells, is not filled: the row goes to quarantine.
    """
    fill_price, no_price = median_price(df, median).scalar(), F.col("price").isNull()
    if rescue:
        no_price &= F.get_json_object(rescue, "$.price").isNull()
        fill_price = F.when(no_price, fill_price)
    category = F.coalesce("category", F.lit(rules.UNCATEGORIZED))
    price = F.coalesce(F.col("price"), fill_price)
    if flag_mode == "missing":
        flag = F.col("category").isNull() | no_price
    else:
        flag = (category == rules.UNCATEGORIZED) | (price == fill_price)
    return df.withColumns(
        {"category": category, "price": price, "_has_imputed_values": F.coalesce(flag, F.lit(False))}
    )


def add_derived_columns(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Price tier, age in days at ``as_of`` (today if not given) and season."""
    return df.withColumns(
        {
            "price_tier": rules.price_tier(F.col("price")),
            "product_age_days": rules.age_days(F.col("created_date"), as_of),
            "season": rules.season(F.col("created_date")),
        }
    )


def price_stats(df: DataFrame) -> DataFrame:
    """Mean and population standard deviation of the price, as one row."""
    price = F.col("price").cast("double")
    return df.agg(F.avg(price).alias("mean_price"), F.stddev_pop(price).alias("std_price"))


def price_score(df: DataFrame) -> DataFrame:
    """Add ``price_competitiveness_score``."""
    stats = price_stats(df).select(F.struct("mean_price", "std_price")).scalar()
    return (
        df.withColumn("_stats", stats)
        .withColumn(
            "price_competitiveness_score",
            rules.score_of(F.col("price"), F.col("_stats.mean_price"), F.col("_stats.std_price")),
        )
        .drop("_stats")
    )


def add_embedding(df: DataFrame, embeddings: DataFrame | None = None, key: str = "product_id") -> DataFrame:
    """Add ``product_embedding``: a typed null, or the vector found in ``embeddings`` (key, embedding).

    The left join is unhinted: both sides grow with the catalogue, so Spark's own size
    check decides whether one is broadcast.
    """
    if embeddings is None:
        return df.withColumn("product_embedding", F.lit(None).cast("array<float>"))
    vectors = embeddings.select(F.col(key), F.col("embedding").cast("array<float>").alias("product_embedding"))
    return df.join(vectors, key, "left")


def _rules() -> dict[str, Column]:
    return {
        "price_not_positive": F.col("price") > 0,
        "name_missing": F.col("product_name").isNotNull(),
        "name_too_short": F.length("product_name") >= rules.MIN_NAME_LENGTH,
    }


def flag_valid(df: DataFrame) -> DataFrame:
    """Add ``_is_valid``; a rule that cannot be decided (null input) counts as broken."""
    return df.withColumn("_is_valid", F.coalesce(all_of(list(_rules().values())), F.lit(False)))


def valid_rows(flagged: DataFrame, counts: Observation | None = None) -> DataFrame:
    """The valid rows.

    With ``counts`` the same run also counts ``valid_rows`` and ``invalid_rows``. Counting
    sits between the flag and the filter, so Spark does not push the filter below the
    clean-up, where it would tidy every text a second and a third time; no other filter gets past it either.
    """
    if counts is None:
        return flagged.where("_is_valid")
    return flagged.observe(
        counts,
        F.count_if("_is_valid").alias("valid_rows"),
        F.count_if(~F.col("_is_valid")).alias("invalid_rows"),
    ).where("_is_valid")


def valid_rows_once(flagged: DataFrame) -> DataFrame:
    """The valid rows, with what the steps made worked out once per row.

    Those columns come out of a generator that gives one row if the row is valid and none if not: the check is not
    pushed below the clean-up, while filters on columns that the steps leave alone still reach the scan.
    """
    made = [c for c in flagged.columns if c in MADE_COLUMNS]
    passed = [quoted(c) for c in flagged.columns if c not in MADE_COLUMNS]
    rows = F.when(F.col("_is_valid"), F.array(F.struct(*[quoted(c) for c in made])))
    return flagged.select(*passed, F.inline(rows)).select(*[quoted(c) for c in flagged.columns])


def quarantine_rows(flagged: DataFrame, rescue: str | None = None) -> DataFrame:
    """The invalid rows, each with the rules it breaks in ``_reject_reason``.

    With ``rescue``, the column of lost texts, malformed values are named as well.
    """
    broken = [F.when(F.get_json_object(rescue, "$.price").isNotNull(), F.lit("price_malformed"))] if rescue else []
    broken += [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in _rules().items()]
    return flagged.where(~F.col("_is_valid")).withColumn("_reject_reason", F.concat_ws(",", *broken))
