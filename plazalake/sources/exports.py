"""Export files: governed CSV (IO20, IO21) and JSON payloads (IO22)."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalake.functions.measures import bracket_labels
from plazalake.operators.serving import WEIGHTED_METRICS, require_columns, single_date


def write_export(export: DataFrame, path: str) -> None:
    """IO21: one CSV of one day. An export has a few rows per district."""
    single_date(export)
    (
        export.coalesce(1)
        .write.mode("overwrite")
        .option("header", "true")
        .option("nullValue", "null")
        .csv(path)
    )


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """IO20: all columns as text (``null`` is missing); the serving step types them."""
    raw = spark.read.option("header", "true").option("nullValue", "null").csv(path)
    return require_columns(raw)


def payload_rows(rows: DataFrame, columns: Sequence[str], *keys: str) -> DataFrame:
    """IO22: one compact JSON object per row, after its ``keys``; stays distributed at any size."""
    return rows.select(*keys, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))


def payload_document(
    rows: DataFrame, columns: Sequence[str], order: Sequence[str], scrape_date: str
) -> DataFrame:
    """IO22: the document a page embeds, as text parts (section, ``order``, value).

    ``order`` names a row. Joined by section and ``order`` the parts are one JSON
    document; they stay distributed at any size.
    """
    spark = rows.sparkSession
    kinds = {f.name: f.dataType for f in rows.schema}
    nowhere = [F.lit(None).cast(kinds[c]).alias(c) for c in order]

    def part(section: int, text: str) -> DataFrame:
        return spark.range(1).select(F.lit(section).alias("section"), *nowhere, F.lit(text).alias("value"))

    last = rows.agg(F.max(F.struct(*order)).alias("_last"))  # a single row
    listed = payload_rows(rows, columns, *order).crossJoin(F.broadcast(last))
    comma = F.when(F.struct(*order) == F.col("_last"), "").otherwise(",")
    body = listed.select(F.lit(1).alias("section"), *order, F.concat("value", comma).alias("value"))
    head = part(0, f'{{"scrapeDate":{json.dumps(scrape_date)},"rows":[')
    return head.unionByName(body).unionByName(part(2, "]}"))


def dashboard_document(
    roll_ups: DataFrame, bounds: Sequence[float], scrape_date: str, digits: int = 6
) -> DataFrame:
    """IO22: scrape date, bins, labels, ``market`` and ``bedroomMarket`` as the parts of one document.

    ``roll_ups`` comes from ``serving.dashboard_roll_ups``. Joined by section, district and
    bedrooms the parts are one JSON document; rows stay distributed at any size.
    """
    spark = roll_ups.sparkSession
    shown = roll_ups.withColumns({c: F.round(c, digits) for c in WEIGHTED_METRICS})
    metrics = ["district", "listing_count", *WEIGHTED_METRICS]
    counts = ["new_listing_count", "removed_listing_count", "price_changed_count"]
    order = F.struct("district_key", "bedrooms")
    options = {"ignoreNullFields": "false"}
    market = F.to_json(F.struct("district_key", *metrics), options)
    by_bedrooms = F.to_json(F.struct("district_key", "bedrooms", *metrics, *counts), options)
    # Two rows: the last of each list has no comma.
    last = roll_ups.groupBy("by_bedrooms").agg(F.max(order).alias("_last"))
    rows = shown.join(F.broadcast(last), "by_bedrooms").select(
        F.when(F.col("by_bedrooms"), 3).otherwise(1).alias("section"),
        "district_key",
        "bedrooms",
        F.concat(
            F.when(F.col("by_bedrooms"), by_bedrooms).otherwise(market),
            F.when(order == F.col("_last"), "").otherwise(","),
        ).alias("value"),
    )
    kinds = dict(rows.dtypes)
    nowhere = [F.lit(None).cast(kinds[c]).alias(c) for c in ("district_key", "bedrooms")]

    def part(section: int, value: Column, of: DataFrame) -> DataFrame:
        return of.select(F.lit(section).alias("section"), *nowhere, value.alias("value"))

    head = dashboard_header(bounds, scrape_date, spark)
    opened = F.concat(F.expr("left(value, length(value) - 1)"), F.lit(',"market":['))
    return (
        part(0, opened, head)
        .unionByName(part(2, F.lit('],"bedroomMarket":['), spark.range(1)))
        .unionByName(part(4, F.lit("]}"), spark.range(1)))
        .unionByName(rows)
    )


def write_payload(document: DataFrame, path: str) -> None:
    """IO22: text files that are the document when read one after the other."""
    order = [c for c in document.columns if c != "value"]
    document.orderBy(*order).select("value").write.mode("overwrite").text(path)


def dashboard_header(bounds: Sequence[float], scrape_date: str, spark: SparkSession) -> DataFrame:
    """IO22/SV7: the fixed head of the dashboard payload."""
    return spark.range(1).select(
        F.to_json(
            F.struct(
                F.lit(scrape_date).alias("scrapeDate"),
                F.array(*[F.lit(float(b)) for b in bounds]).alias("bins"),
                F.array(*[F.lit(t) for t in bracket_labels(bounds)]).alias("binLabels"),
            )
        ).alias("value")
    )
