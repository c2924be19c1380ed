"""Scheduled jobs over stored tables: bronze ingest, silver, gold, full refresh."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalake.config import EngineConfig
from plazalake.operators import calendar, changes, contracts, lifecycle, market, options, quality
from plazalake.operators import typing as typed_rows
from plazalake.operators.dedup import latest_observation
from plazalake.sources import landed, tables
from plazalake.streaming.ingest import ingest_listings, ingest_manifests

LAYERS = ("bronze", "silver", "gold")


def prepare(spark: SparkSession, config: EngineConfig, base: str) -> None:
    """IO17: the three layer databases below ``base``."""
    for layer in LAYERS:
        tables.create_database(spark, config.database(layer), f"{base.rstrip('/')}/{layer}")


def bronze_job(spark: SparkSession, config: EngineConfig) -> None:
    """Ingest all newly landed listing and manifest files."""
    ingest_listings(spark, config)
    ingest_manifests(spark, config)


def _stamp(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def silver_job(spark: SparkSession, config: EngineConfig, processing_date: str | None = None) -> date:
    """SI1-DQ13, ST2: rebuild quarantine, results and snapshot of one day."""
    runs = spark.table(config.ingestion_runs)
    succeeded = runs.where(F.lower("status") == "success")
    day = calendar.resolve_date(processing_date, succeeded, "_partition_ingest_date")
    gate = typed_rows.successful_runs(runs).where(F.col("_partition_ingest_date") == F.lit(day))
    if gate.isEmpty():
        raise ValueError(f"no successful run for {day}; nothing is published")
    bronze = tables.on_day(spark, config.listings_raw, day, "_partition_ingest_date")
    typed = typed_rows.typed_observations(bronze, tables.on_day(
        spark, config.ingestion_runs, day, "_partition_ingest_date"
    ))
    # Three tables are fed from the typed rows; they are parsed once.
    judged = quality.apply_rules(typed, F.lit(day)).persist()
    try:
        snapshot = typed_rows.snapshot_columns(latest_observation(quality.valid_rows(judged)))
        tables.replace_date(
            _stamp(snapshot, "updated_at"), config.snapshot, day, keys=["ingest_date", "listing_id"]
        )
        tables.replace_date(
            _stamp(quality.quarantine(judged), "quarantined_at"),
            config.quarantine,
            day,
            keys=["ingest_date", "source_observation_key", "rule_id"],
        )
        tables.replace_date(
            _stamp(quality.quality_results(judged), "calculated_at"),
            config.quality_results,
            day,
            keys=["ingest_date", "run_id", "rule_id"],
        )
    finally:
        judged.unpersist()
    return day


def publish_options(spark: SparkSession, config: EngineConfig) -> None:
    """PX1 + IO16 as a stored view."""
    kept = [c for c in options.OPTION_COLUMNS if c != "bedrooms"]
    tables.publish_view(
        spark,
        config.bedroom_options,
        f"SELECT {', '.join(kept)}, explode(sequence(bedrooms_min, bedrooms_max)) AS bedrooms "
        f"FROM {config.snapshot} WHERE bedrooms_min BETWEEN 1 AND 4 "
        "AND bedrooms_max BETWEEN bedrooms_min AND 4",
        "Bedroom options derived from the canonical snapshot.",
    )


def validate_silver(spark: SparkSession, config: EngineConfig, day: date) -> DataFrame:
    """DQ14: the metrics of one day; raises on a violation."""
    metrics = contracts.silver_contract(
        tables.on_day(spark, config.snapshot, day),
        spark.table(config.ingestion_runs),
        tables.on_day(spark, config.bedroom_options, day),
        tables.on_day(spark, config.quarantine, day),
    )
    contracts.enforce(metrics, contracts.SILVER_CHECKS)
    return metrics


def gold_job(
    spark: SparkSession, config: EngineConfig, base: str, processing_date: str | None = None
) -> date:
    """CH1-CH10, AG1-AG6, ST2, ST3: changes and market of one day, state of all listings."""
    snapshots = spark.table(config.snapshot)
    runs = spark.table(config.ingestion_runs)
    published = tables.partition_files(spark, config.snapshot)
    day = calendar.resolve_day(processing_date, published)
    if day not in published or tables.on_day(spark, config.snapshot, day).isEmpty():
        raise ValueError(f"no snapshot for {day}")
    before = calendar.day_before(published, day)
    complete = calendar.is_complete(runs, day)
    state = carried_state(spark, config, day, published)
    tables.replace_date(
        _stamp(changes.changes_for_day(snapshots, day, before, complete, state), "calculated_at"),
        config.listing_changes,
        day,
        keys=["ingest_date", "listing_id"],
    )
    # The stored change rows are read back instead of being compared twice.
    rows = tables.on_day(spark, config.listing_changes, day).drop("calculated_at")
    tables.replace_date(
        _stamp(market.market_for_day(snapshots, rows, day, before), "calculated_at"),
        config.market_daily,
        day,
        keys=["ingest_date", "district", "bedrooms", "currency"],
    )
    publish_latest(spark, config, base, published)
    return day


def _ledger(config: EngineConfig) -> str:
    return f"{config.listing_latest}_days"


def _built_from(spark: SparkSession, config: EngineConfig) -> dict[date, str]:
    """The days the stored state was built from, with their digests; empty if there is no state
    or the ledger is another state's: then a run ended between the two writes."""
    if not (spark.catalog.tableExists(config.listing_latest) and spark.catalog.tableExists(_ledger(config))):
        return {}
    place = tables.table_location(spark, config.listing_latest)
    rows = spark.table(_ledger(config)).where(F.col("state_location") == place).collect()
    return {r["ingest_date"]: r["files_digest"] for r in rows}


def _differing(held: dict[date, str], published: dict[date, str]) -> list[date]:
    """Days that were published, republished or emptied since."""
    return sorted(d for d in held.keys() | published.keys() if held.get(d) != published.get(d))


def carried_state(
    spark: SparkSession, config: EngineConfig, day: date, published: dict[date, str]
) -> DataFrame | None:
    """The state of all listings before ``day``, the newest one, if the stored state is of then.

    Days that changed since it was built are repaired in it. ``published`` has the digest of
    each published day's files, as ``tables.partition_files`` gives them.
    """
    held = _built_from(spark, config)
    before = {d: digest for d, digest in published.items() if d < day}
    if not held or max(held) >= day or max(published) != day or not before:
        return None
    stored = spark.table(config.listing_latest)
    changed = _differing(held, before)
    if not changed:
        return stored
    snapshots = spark.table(config.snapshot).where(F.col("ingest_date") < F.lit(day))
    return lifecycle.repaired_latest(stored, snapshots, changed)


def publish_latest(spark: SparkSession, config: EngineConfig, base: str, published: dict[date, str]) -> None:
    """CH7-CH10: carry the state forward by a new day, repair what changed days reach, or recompute.

    The state covers all history, also when an older day is reprocessed or emptied. Its
    ledger says of each day which files it was built from, and which version of the
    state that is.
    """
    snapshots = spark.table(config.snapshot)
    held = _built_from(spark, config)
    changed = _differing(held, published)
    if not held:
        state = lifecycle.listing_latest(snapshots)
    elif len(changed) == 1 and changed[0] > max(held):
        stored = spark.table(config.listing_latest).drop("updated_at")
        state = lifecycle.advance_latest(stored, snapshots, changed[0])
    else:
        state = lifecycle.repaired_latest(spark.table(config.listing_latest), snapshots, changed)
    _store_latest(spark, config, base, state, published)


def _store_latest(
    spark: SparkSession, config: EngineConfig, base: str, state: DataFrame, published: dict[date, str]
) -> None:
    base = base.rstrip("/")
    tables.replace_all(_stamp(state, "updated_at"), config.listing_latest, f"{base}/gold_listing_latest", ["listing_id"])
    place = tables.table_location(spark, config.listing_latest)
    # A row per published day.
    days = spark.createDataFrame(
        [(d, digest, place) for d, digest in sorted(published.items())],
        "ingest_date date, files_digest string, state_location string",
    )
    tables.replace_all(days.coalesce(1), _ledger(config), f"{base}/gold_listing_latest_days")


def rebuild_from(spark: SparkSession, config: EngineConfig, base: str, first: date) -> None:
    """Reclassify every published day from ``first`` on, after an older day was reprocessed.

    One pass over history replaces the day-by-day runs; only the affected
    partitions are written.
    """
    snapshots = spark.table(config.snapshot)
    days = calendar.publication_calendar(snapshots, spark.table(config.ingestion_runs))
    linked = changes.with_neighbours(snapshots, days)
    late = F.col("ingest_date") >= F.lit(first)
    published = {r[0] for r in days.where(late).select("ingest_date").collect()}
    for rows, table in (
        (changes.neighbour_changes(linked).where(late), config.listing_changes),
        (market.market_over_time(linked).where(late), config.market_daily),
    ):
        tables.replace_dates(_stamp(rows, "calculated_at"), table)
        stored = spark.table(table).where(late).select("ingest_date").distinct()
        for stale in {r[0] for r in stored.collect()} - published:
            tables.replace_date(spark.table(table).limit(0), table, stale)
    state = lifecycle.listing_latest(snapshots)
    _store_latest(spark, config, base, state, tables.partition_files(spark, config.snapshot))


def validate_gold(spark: SparkSession, config: EngineConfig, day: date) -> DataFrame:
    """DQ15: the metrics of one day; raises on a violation."""
    runs = tables.on_day(spark, config.ingestion_runs, day, "_partition_ingest_date")
    metrics = contracts.gold_contract(
        tables.on_day(spark, config.market_daily, day),
        tables.on_day(spark, config.listing_changes, day),
        spark.table(config.listing_latest),
        calendar.completeness(runs),
    )
    contracts.enforce(metrics, contracts.GOLD_CHECKS)
    return metrics


def full_refresh_job(spark: SparkSession, config: EngineConfig, base: str, prefix: str) -> int:
    """The older product: newest file in, everything recomputed (IO10, IO11, BR14, SR6, AG8)."""
    path = landed.newest_file(spark, config.raw_path, config.listing_glob)
    added = tables.append_new_runs(landed.read_inferred(spark, path, "*"), config.table("bronze", prefix))
    recompute(spark, config, base, prefix)
    return added


def recompute(spark: SparkSession, config: EngineConfig, base: str, prefix: str) -> None:
    """SR6: the typed rows and the market of the older product from all stored runs."""
    bronze, silver, gold = (config.table(layer, prefix) for layer in LAYERS)
    typed = typed_rows.refresh_typed(spark.table(bronze))
    tables.replace_all(typed, silver, f"{base.rstrip('/')}/silver_{prefix}")
    summary = market.refresh_market(spark.table(silver))
    tables.replace_all(summary, gold, f"{base.rstrip('/')}/gold_{prefix}")
