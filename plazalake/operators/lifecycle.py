"""Current state and life span of every listing (CH7-CH10, JN8)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Snapshot column -> published column.
STATE = {
    "listing_type": "listing_type",
    "url": "url",
    "district": "district",
    "city": "city",
    "bedrooms_min": "bedrooms",
    "bathrooms": "bathrooms",
    "area_avg_m2": "area_m2",
    "currency": "currency",
    "price_amount": "price_amount",
    "price_per_m2": "price_per_m2",
    "features": "features",
    "run_id": "last_run_id",
}
LATEST_COLUMNS = (
    "listing_id", "listing_type", "url", "district", "city", "bedrooms", "bathrooms", "area_m2",
    "currency", "price_amount", "price_per_m2", "features", "first_seen_date", "last_seen_date",
    "days_observed", "is_active", "last_run_id",
)


def _state() -> Column:
    return F.struct(*[F.col(source).alias(name) for source, name in STATE.items()])


def life_spans(snapshots: DataFrame) -> DataFrame:
    """CH7-CH8: per listing its last state, first/last day and number of days.

    One aggregation that merges before the shuffle. A listing has one row per
    day, so days are counted without a distinct and the day alone orders rows.
    """
    return snapshots.groupBy("listing_id").agg(
        F.max_by(_state(), "ingest_date").alias("_state"),
        F.min("ingest_date").alias("first_seen_date"),
        F.max("ingest_date").alias("last_seen_date"),
        F.count(F.lit(1)).alias("days_observed"),
    )


def _publish(spans: DataFrame, newest: DataFrame) -> DataFrame:
    """CH9/CH10: flatten the state and mark listings present on the newest day."""
    return (
        spans.crossJoin(F.broadcast(newest))  # a single row: the newest published day
        .select(
            "listing_id",
            "_state.*",
            "first_seen_date",
            "last_seen_date",
            "days_observed",
            (F.col("last_seen_date") == F.col("_newest")).alias("is_active"),
        )
        .select(*LATEST_COLUMNS)
    )


def listing_latest(snapshots: DataFrame) -> DataFrame:
    """CH7-CH10 recomputed from all history."""
    return _publish(life_spans(snapshots), snapshots.agg(F.max("ingest_date").alias("_newest")))


def advance_latest(latest: DataFrame, snapshot: DataFrame, day: date) -> DataFrame:
    """CH7-CH10 carried forward by one day instead of rescanning history.

    ``latest`` must cover every day before ``day`` and none after; both sides
    have one row per listing, so the merge is one co-partitioned outer join.
    """
    kept = [c for c in LATEST_COLUMNS if c not in ("listing_id", "is_active")]
    old = latest.select("listing_id", F.struct(*kept).alias("old"))
    new = snapshot.where(F.col("ingest_date") == F.lit(day)).select(
        "listing_id", _state().alias("new")
    )
    today = F.lit(day)
    here, known = F.col("new").isNotNull(), F.col("old").isNotNull()
    merged = old.join(new, "listing_id", "full_outer").select(
        "listing_id",
        F.when(here, F.col("new"))
        .otherwise(F.struct(*[F.col(f"old.{name}").alias(name) for name in STATE.values()]))
        .alias("_state"),
        F.when(known, F.col("old.first_seen_date")).otherwise(today).alias("first_seen_date"),
        F.when(here, today).otherwise(F.col("old.last_seen_date")).alias("last_seen_date"),
        (F.coalesce("old.days_observed", F.lit(0)) + here.cast("long")).alias("days_observed"),
    )
    flat = merged.select(
        "listing_id",
        "_state.*",
        "first_seen_date",
        "last_seen_date",
        "days_observed",
        (F.col("last_seen_date") == today).alias("is_active"),
    )
    return flat.select(*LATEST_COLUMNS)


def repaired_latest(latest: DataFrame, snapshots: DataFrame, days: Sequence[date]) -> DataFrame:
    """CH7-CH10 after ``days`` were published, republished or emptied since ``latest`` was made.

    A listing whose life span has none of the days and which is on none of them now can't
    have changed; only the others are recomputed from their history. The newest day decides
    for all who is active. ``snapshots`` has every published day and no other.
    """
    chosen = [F.lit(d) for d in days]
    spans = [F.col("first_seen_date").eqNullSafe(d) | ((F.col("first_seen_date") <= d) & (F.col("last_seen_date") >= d)) for d in chosen]
    reached = F.lit(False)
    for span in spans:
        reached = reached | F.coalesce(span, F.lit(False))
    state = latest.select(*LATEST_COLUMNS).withColumn("_reached", reached)
    here = snapshots.where(F.col("ingest_date").isin(chosen)).select("listing_id")
    touched = state.where("_reached").select("listing_id").unionByName(here).distinct()
    recomputed = life_spans(snapshots.join(touched, "listing_id", "left_semi"))
    kept = state.join(touched, "listing_id", "left_anti").select(
        "listing_id",
        F.struct(*[F.col(name) for name in STATE.values()]).alias("_state"),
        "first_seen_date",
        "last_seen_date",
        "days_observed",
    )
    newest = snapshots.agg(F.max("ingest_date").alias("_newest"))
    return _publish(kept.unionByName(recomputed), newest)


def newer_only(latest: DataFrame, incoming: DataFrame, key: str, version: str) -> DataFrame:
    """DX12: replace a stored row only by a strictly newer one; insert unknown keys.

    Both sides are unique on ``key``. A NULL version is older than any other.
    """
    columns = latest.columns
    old = latest.select(key, F.struct(*columns).alias("old"))
    new = incoming.select(key, F.struct(*columns).alias("new"))
    fresher = F.col("old").isNull() | F.coalesce(
        F.col(f"new.{version}") > F.col(f"old.{version}"),
        F.col(f"old.{version}").isNull() & F.col(f"new.{version}").isNotNull(),
    )
    chosen = F.when(F.col("new").isNotNull() & fresher, F.col("new")).otherwise(F.col("old"))
    return old.join(new, key, "full_outer").select(chosen.alias("_row")).select("_row.*")
