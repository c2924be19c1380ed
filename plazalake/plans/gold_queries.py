"""Gold: changes, market cube, listing state, contract."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.operators import calendar, changes, contracts, lifecycle, market, monitors, options
from plazalake.plans.inputs import manifests, stored
from plazalake.plans.registry import query
from plazalake.plans.silver_queries import snapshot_table

def _flat(latest: DataFrame) -> DataFrame:
    """Comparable form: the array as text."""
    return latest.withColumn("features", F.concat_ws("|", "features"))


def linked_snapshots(spark, sf_dir) -> DataFrame:
    """Snapshots of all days with their neighbours on the publication calendar."""
    snap = snapshot_table(spark, sf_dir)
    return changes.with_neighbours(
        snap, calendar.publication_calendar(snap, manifests(spark, sf_dir))
    )


def newest_day(spark, sf_dir):
    """(snapshots, newest day, previous published day)."""
    snap = snapshot_table(spark, sf_dir)
    return snap, *calendar.newest_dates(snap)


def market_table(spark, sf_dir) -> DataFrame:
    """The stored Gold market cube, all days."""
    return stored(spark, sf_dir, "market_daily_by_district", lambda: market_daily(spark, sf_dir))


def market_of_newest_day(spark, sf_dir) -> DataFrame:
    snap, day, before = newest_day(spark, sf_dir)
    complete = calendar.is_complete(manifests(spark, sf_dir), day)
    rows = changes.changes_for_day(snap, day, before, complete)
    return market.market_for_day(snap, rows, day, before)


@query("SELECT * FROM changes")
def listing_changes(spark, sf_dir):
    """CH1-CH6 for every published day in one pass."""
    return changes.neighbour_changes(linked_snapshots(spark, sf_dir))


@query("SELECT * FROM changes WHERE ingest_date = (SELECT MAX(ingest_date) FROM snap)")
def listing_changes_newest_day(spark, sf_dir):
    """CH1-CH6 for one processing day."""
    snap, day, before = newest_day(spark, sf_dir)
    complete = calendar.is_complete(manifests(spark, sf_dir), day)
    return changes.changes_for_day(snap, day, before, complete)


@query("SELECT * FROM changes WHERE ingest_date = (SELECT MAX(ingest_date) FROM snap)")
def listing_changes_by_state(spark, sf_dir):
    """CH2/JN5 as the daily job does it: the stored state says who was known, not all history."""
    snap, day, before = newest_day(spark, sf_dir)
    older = snap.where(F.col("ingest_date") < F.lit(day))
    state = stored(spark, sf_dir, "listing_latest_before", lambda: lifecycle.listing_latest(older))
    complete = calendar.is_complete(manifests(spark, sf_dir), day)
    return changes.changes_for_day(snap, day, before, complete, state)


@query(
    """SELECT ingest_date, change_type, COUNT(*) AS listings FROM changes
    GROUP BY ingest_date, change_type"""
)
def change_summary(spark, sf_dir):
    """CH11."""
    return monitors.change_summary(listing_changes(spark, sf_dir))


@query(
    """SELECT ingest_date, listing_id, change_type, CAST(b AS INTEGER) AS bedrooms, district, currency
    FROM changes, unnest(generate_series(bedrooms_min, bedrooms_max)) AS u(b)"""
)
def change_options(spark, sf_dir):
    """PX3."""
    return options.per_bedroom(listing_changes(spark, sf_dir)).select(
        "ingest_date", "listing_id", "change_type", "bedrooms", "district", "currency"
    )


@query("SELECT * FROM mchg")
def market_change_metrics(spark, sf_dir):
    """AG4."""
    return market.change_metrics(listing_changes(spark, sf_dir))


@query("SELECT * FROM mcur")
def market_current(spark, sf_dir):
    """AG1 + AG2 + PX4."""
    return market.current_market(options.bedroom_options(snapshot_table(spark, sf_dir)))


@query(
    """SELECT district, bedrooms, currency, listing_count AS previous_listing_count FROM mcur
    WHERE ingest_date = (SELECT MAX(ingest_date) FROM snap
      WHERE ingest_date < (SELECT MAX(ingest_date) FROM snap))"""
)
def market_previous_counts(spark, sf_dir):
    """AG3 for the day before the newest one."""
    snap, _, before = newest_day(spark, sf_dir)
    rows = options.bedroom_options(snap.where(F.col("ingest_date") == F.lit(before)))
    return market.previous_counts(rows)


@query("SELECT * FROM market")
def market_daily(spark, sf_dir):
    """AG1-AG6 for every published day in one pass."""
    return market.market_over_time(linked_snapshots(spark, sf_dir))


@query("SELECT * FROM market WHERE ingest_date = (SELECT MAX(ingest_date) FROM snap)")
def market_newest_day(spark, sf_dir):
    """AG1-AG6 for one processing day."""
    return market_of_newest_day(spark, sf_dir)


@query(
    """SELECT bedrooms, currency, CAST(SUM(listing_count) AS BIGINT) AS listings,
      AVG(avg_price) AS avg_segment_price
    FROM market WHERE ingest_date = (SELECT MAX(ingest_date) FROM snap)
    GROUP BY bedrooms, currency"""
)
def market_segment_summary(spark, sf_dir):
    """AG7."""
    stored_market = market_table(spark, sf_dir)
    _, day, _ = newest_day(spark, sf_dir)
    return market.segment_summary(stored_market.where(F.col("ingest_date") == F.lit(day)))


@query("SELECT * FROM latest")
def listing_latest(spark, sf_dir):
    """CH7-CH10 from all history."""
    return _flat(lifecycle.listing_latest(snapshot_table(spark, sf_dir)))


@query("SELECT * FROM latest")
def listing_latest_advanced(spark, sf_dir):
    """CH7-CH10 carried from the state before the newest day; equals the recomputation."""
    snap, day, _ = newest_day(spark, sf_dir)
    before = lifecycle.listing_latest(snap.where(F.col("ingest_date") <= F.lit(day - timedelta(1))))
    return _flat(lifecycle.advance_latest(before, snap, day))


@query(
    """SELECT 'market_rows' AS metric, (SELECT COUNT(*) FROM market) AS value
    UNION ALL SELECT 'change_rows', (SELECT COUNT(*) FROM changes)
    UNION ALL SELECT 'current_active_listings', (SELECT COUNT(*) FROM latest WHERE is_active)
    UNION ALL SELECT 'duplicate_market_keys', 0
    UNION ALL SELECT 'duplicate_change_keys', (SELECT COUNT(*) FROM (SELECT 1 FROM changes
      GROUP BY ingest_date, listing_id, change_type HAVING COUNT(*) > 1))
    UNION ALL SELECT 'duplicate_latest_keys', 0
    UNION ALL SELECT 'invalid_latest_lifecycle', (SELECT COUNT(*) FROM latest
      WHERE first_seen_date > last_seen_date)
    UNION ALL SELECT 'successful_bedroom_segments', (SELECT COUNT(*) FROM runs WHERE ok)
    UNION ALL SELECT 'removed_listings', (SELECT COUNT(*) FROM changes WHERE change_type = 'REMOVED')
    UNION ALL SELECT 'removed_without_complete_snapshot', 0"""
)
def gold_contract(spark, sf_dir):
    """DQ15 over all days; the market is the stored table."""
    return contracts.gold_contract(
        market_table(spark, sf_dir),
        listing_changes(spark, sf_dir),
        lifecycle.listing_latest(snapshot_table(spark, sf_dir)),
        calendar.completeness(manifests(spark, sf_dir)),
    )


@query(
    """SELECT 'market_rows' AS metric, (SELECT COUNT(*) + COUNT_IF(bedrooms = 2) FROM market) AS value
    UNION ALL SELECT 'change_rows', (SELECT COUNT(*) + COUNT_IF(CAST(listing_id AS BIGINT) % 7 = 0) FROM changes)
    UNION ALL SELECT 'current_active_listings', (SELECT COUNT_IF(is_active)
      + COUNT_IF(is_active AND CAST(listing_id AS BIGINT) % 11 = 0) FROM latest)
    UNION ALL SELECT 'duplicate_market_keys', (SELECT COUNT(*) FROM market WHERE bedrooms = 2)
    UNION ALL SELECT 'duplicate_change_keys', (SELECT COUNT(*) FROM changes WHERE CAST(listing_id AS BIGINT) % 7 = 0)
    UNION ALL SELECT 'duplicate_latest_keys', (SELECT COUNT(*) FROM latest WHERE CAST(listing_id AS BIGINT) % 11 = 0)
    UNION ALL SELECT 'invalid_latest_lifecycle', (SELECT COUNT_IF(CAST(listing_id AS BIGINT) % 5 = 0)
      + COUNT_IF(CAST(listing_id AS BIGINT) % 55 = 0) FROM latest)
    UNION ALL SELECT 'successful_bedroom_segments', (SELECT COUNT(*) FROM runs WHERE ok AND seg <> day(run_date) % 4)
    UNION ALL SELECT 'removed_listings', (SELECT COUNT(*) + COUNT_IF(CAST(listing_id AS BIGINT) % 7 = 0)
      FROM changes WHERE change_type = 'REMOVED')
    UNION ALL SELECT 'removed_without_complete_snapshot', (SELECT COUNT(*) FROM (
      SELECT ingest_date FROM changes WHERE change_type = 'REMOVED' GROUP BY ingest_date) d
      WHERE (SELECT COUNT(*) FROM runs WHERE ok AND seg <> day(run_date) % 4 AND run_date = d.ingest_date) < 4)"""
)
def gold_contract_violations(spark, sf_dir):
    """DQ15 on tables with repeated keys, lives that end before they begin and days without a segment."""
    user = F.col("listing_id").cast("bigint")
    cube = market_table(spark, sf_dir)
    moves = listing_changes(spark, sf_dir)
    late = F.when(user % 5 == 0, F.date_add("last_seen_date", 1)).otherwise(F.col("first_seen_date"))
    latest = lifecycle.listing_latest(snapshot_table(spark, sf_dir)).withColumn("first_seen_date", late)
    runs = manifests(spark, sf_dir).where(
        F.col("search_params.bedrooms") != F.day("_partition_ingest_date") % 4
    )
    return contracts.gold_contract(
        cube.unionByName(cube.where(F.col("bedrooms") == 2)),
        moves.unionByName(moves.where(user % 7 == 0)),
        latest.unionByName(latest.where(user % 11 == 0)),
        calendar.completeness(runs),
    )
