"""The product load: raw rows to validated, scored products, and on to the layers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation

from millrace.operators import gold, quality
from millrace.operators.merge import upsert_batch
from millrace.operators.products import (
    add_derived_columns,
    add_embedding,
    clean_text_fields,
    flag_valid,
    impute_products,
    price_score,
    quarantine_rows,
    valid_rows,
    valid_rows_once,
)
from millrace.operators.standardize import standardize_schema
from millrace.sinks.layers import (
    append_quarantine,
    read_batch,
    read_validated,
    staged,
    write_bronze,
    write_gold,
    write_validated,
)
from millrace.sinks.storage import path_exists, recover_table, table_path

MINIMUM_VALID_PERCENT = 50.0
RESCUED = "_rescued_data"


def flag_products(raw: DataFrame, as_of: dt.date | None = None, rescue: str | None = None) -> DataFrame:
    """All product steps in order, ending with the validity flag; one lazy plan.

    With ``rescue``, values whose text does not fit their type are kept in a column of that name, and malformed
    prices make a row invalid instead of becoming the median.
    """
    return (
        raw.transform(standardize_schema, rescue=rescue)
        .transform(clean_text_fields)
        .transform(impute_products, rescue=rescue)
        .transform(add_derived_columns, as_of)
        .transform(price_score)
        .transform(add_embedding)
        .transform(flag_valid)
    )


def transform_products(
    raw: DataFrame, as_of: dt.date | None = None, counts: Observation | None = None
) -> DataFrame:
    """The valid products; :func:`flag_products` keeps the others as well.

    After an action on the result, ``counts`` holds the numbers of valid and invalid rows. Without ``counts``,
    filters on columns that the steps pass through (ids, dates, extra ones) reach the scan of the result's rows;
    median and score still are those of the whole table.
    """
    flagged = flag_products(raw, as_of)
    return valid_rows_once(flagged) if counts is None else valid_rows(flagged, counts)


def load_products(
    raw: DataFrame, root: str, *, source: str, batch_id: str, as_of: dt.date | None = None,
    ingested_at: dt.datetime | None = None, categories: Sequence[str] = quality.PRODUCT_CATEGORIES,
    quarantine: str | None = None, minimum_percent: float = quality.GATE_PERCENT, gold_table: str | None = None,
    row_range: tuple[int, int | None] = (1, None), minimum_valid_percent: float = MINIMUM_VALID_PERCENT,
) -> dict:
    """Run one product batch through the layers and return what happened.

    bronze: the raw rows, added to those of earlier batches; quarantine: the invalid rows with reasons; silver: the
    flagged rows, valid and invalid, of all batches, the newest of each product; gold: the summary per category of all
    valid rows in silver. The gate stands before silver: a batch passes if enough of its rows are valid and its
    valid rows meet the suite. One that does not stays in bronze and quarantine. A batch that is run again
    replaces what it wrote, and an old one never replaces newer rows, which ``ingested_at`` decides.
    """
    spark = raw.sparkSession
    ingested_at = ingested_at or dt.datetime.now(dt.UTC)
    landed = write_bronze(raw, root, "products", source=source, batch_id=batch_id, ingested_at=ingested_at, mode="batch")
    bronze = read_batch(spark, root, "products", batch_id, raw.schema)

    with staged(flag_products(bronze, as_of, RESCUED)) as batch:
        append_quarantine(quarantine_rows(batch, RESCUED), quarantine or f"{root}/quarantine/products", batch_id)
        results = quality.check(valid_rows(batch), quality.product_suite(categories, row_range))
        verdict = quality.gate(results, minimum_percent).first().asDict()
        counts = gold.layer_counts(batch).first().asDict()
        verdict["valid_percent"] = 100.0 * counts["valid_rows"] / counts["total_rows"] if counts["total_rows"] else 0.0
        verdict["gate_passed"] = verdict["gate_passed"] and verdict["valid_percent"] >= minimum_valid_percent
        if verdict["gate_passed"]:
            silver_path = table_path(root, "silver", "products")
            recover_table(spark, silver_path)
            silver = batch
            if path_exists(spark, silver_path):
                silver = upsert_batch(read_validated(spark, silver_path), batch, "product_id", "_ingestion_timestamp", "_batch_id")
            write_validated(silver, silver_path)
            summary = gold.category_summary(valid_rows(read_validated(spark, silver_path)))
            write_gold(summary, root, gold_table or "category_summary", parts=1)
    return {"landed": landed, **counts, **verdict}
