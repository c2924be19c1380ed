"""Operational summaries, ordered for reading (SO1, BR16, BR17, DQ16, DQ17, PX2, CH11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bronze_monitor(bronze: DataFrame) -> DataFrame:
    """BR16: per segment its observations, runs and newest load."""
    per_run = bronze.groupBy(F.col("_partition_bedrooms").alias("bedrooms"), "_run_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.max("_bronze_loaded_at").alias("_loaded")
    )
    return (
        per_run.groupBy("bedrooms")
        .agg(
            F.sum("_rows").alias("raw_observations"),
            F.count("_run_id").alias("runs"),
            F.max("_loaded").alias("latest_bronze_load"),
        )
        .orderBy("bedrooms")
    )


def run_log(runs: DataFrame) -> DataFrame:
    """BR17: manifests, newest completion first."""
    return runs.select(
        F.col("_partition_bedrooms").alias("bedrooms"),
        "status",
        "records_written",
        "pages_scraped",
        "run_id",
        "completed_at",
    ).orderBy(F.col("completed_at").desc(), F.col("run_id"))


def snapshot_summary(snapshots: DataFrame) -> DataFrame:
    """DQ16 per day: listings are unique within a day, so no distinct is needed."""
    return (
        snapshots.groupBy("ingest_date")
        .agg(
            F.count(F.lit(1)).alias("canonical_listings"),
            F.count("listing_id").alias("unique_listing_ids"),
            F.count_if("has_price").alias("listings_with_price"),
            F.count_if("has_area").alias("listings_with_area"),
        )
        .orderBy("ingest_date")
    )


def rule_summary(results: DataFrame) -> DataFrame:
    """DQ17: the text maximum makes one passing run show PASS; kept as published."""
    return (
        results.groupBy("rule_id")
        .agg(F.sum("invalid_records").alias("invalid_records"), F.max("result").alias("result"))
        .orderBy("rule_id")
    )


def options_summary(options: DataFrame) -> DataFrame:
    """PX2: listings per day and bedroom count, newest day first."""
    return (
        options.groupBy("ingest_date", "bedrooms")
        .agg(F.count("listing_id").alias("listing_count"))
        .orderBy(F.col("ingest_date").desc(), "bedrooms")
    )


def change_summary(changes: DataFrame) -> DataFrame:
    """CH11: listings per day and change type."""
    return (
        changes.groupBy("ingest_date", "change_type")
        .agg(F.count(F.lit(1)).alias("listings"))
        .orderBy("ingest_date", "change_type")
    )
