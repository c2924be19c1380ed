"""Published-table contracts (DQ14, DQ15) as small metric tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalake.operators.joins import lookup_join

SILVER_CHECKS = (
    "duplicate_snapshot_keys",
    "invalid_bedroom_ranges",
    "rows_without_successful_manifest",
)
GOLD_CHECKS = (
    "duplicate_market_keys",
    "duplicate_change_keys",
    "duplicate_latest_keys",
    "invalid_latest_lifecycle",
    "removed_without_complete_snapshot",
)


class ContractViolation(AssertionError):
    """A published table broke its contract."""


def _metrics(df: DataFrame, **measures: Column) -> DataFrame:
    """One pass over ``df``, one output row per measure."""
    wide = df.agg(*[measure.alias(name) for name, measure in measures.items()])
    pairs = [
        F.struct(F.lit(name).alias("metric"), F.coalesce(name, F.lit(0)).cast("long").alias("value"))
        for name in measures
    ]
    return wide.select(F.inline(F.array(*pairs)))


def _rows(df: DataFrame, name: str) -> DataFrame:
    return _metrics(df, **{name: F.count(F.lit(1))})


def _per_key(df: DataFrame, keys: list[str], **measures: Column) -> DataFrame:
    """Row count (and more) per key: totals and duplicates then come from one pass."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), *[m.alias(name) for name, m in measures.items()]
    )


def silver_contract(
    snapshot: DataFrame, runs: DataFrame, options: DataFrame, rejected: DataFrame
) -> DataFrame:
    """DQ14/JN11: ``metric, value``; any success manifest of the run counts, whatever its day."""
    vouched = (
        runs.where(F.lower("status") == "success")
        .select("run_id")
        .where(F.col("run_id").isNotNull())
        .distinct()
    )
    in_range = F.expr(
        "coalesce(bedrooms_min >= 1 AND bedrooms_max <= 4 AND bedrooms_min <= bedrooms_max, false)"
    )
    per_key = _per_key(snapshot, ["ingest_date", "listing_id"], outside=F.count_if(~in_range))
    parts = [
        _metrics(
            per_key,
            canonical_rows=F.sum("rows"),
            duplicate_snapshot_keys=F.count_if(F.col("rows") > 1),
            invalid_bedroom_ranges=F.sum("outside"),
        ),
        _rows(
            lookup_join(snapshot, vouched, ["run_id"], "left_anti"),
            "rows_without_successful_manifest",
        ),
        _rows(options, "bedroom_option_rows"),
        _rows(rejected, "quarantined_rule_violations"),
    ]
    return reduce(DataFrame.unionByName, parts)


def gold_contract(
    market: DataFrame, changes: DataFrame, latest: DataFrame, day_segments: DataFrame
) -> DataFrame:
    """DQ15 over one or more days; ``day_segments`` is the completeness of the same days."""
    first, last = F.col("first_seen_date"), F.col("last_seen_date")
    twice, removed = F.col("rows") > 1, F.col("change_type") == "REMOVED"
    per_day = (
        _per_key(changes, ["ingest_date", "listing_id", "change_type"])
        .groupBy("ingest_date")
        .agg(
            F.sum("rows").alias("changes"),
            F.count_if(twice).alias("repeated"),
            F.sum(F.when(removed, F.col("rows"))).alias("removed"),
        )
        .join(day_segments, "ingest_date", "full_outer")
    )
    lives = _per_key(
        latest,
        ["listing_id"],
        active=F.count_if("is_active"),
        broken=F.count_if(~F.coalesce(first <= last, F.lit(False))),
    )
    parts = [
        _metrics(
            _per_key(market, ["ingest_date", "district", "bedrooms", "currency"]),
            market_rows=F.sum("rows"),
            duplicate_market_keys=F.count_if(twice),
        ),
        _metrics(
            per_day,
            change_rows=F.sum("changes"),
            duplicate_change_keys=F.sum("repeated"),
            successful_bedroom_segments=F.sum("segments"),
            removed_listings=F.sum("removed"),
            removed_without_complete_snapshot=F.count_if(
                (F.col("removed") > 0) & ~F.coalesce("is_complete", F.lit(False))
            ),
        ),
        _metrics(
            lives,
            current_active_listings=F.sum("active"),
            duplicate_latest_keys=F.count_if(twice),
            invalid_latest_lifecycle=F.sum("broken"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def enforce(metrics: DataFrame, checks: tuple[str, ...]) -> None:
    """Raise when a check is above zero. The table has one row per metric."""
    failed = {
        r["metric"]: r["value"]
        for r in metrics.where(F.col("metric").isin(*checks) & (F.col("value") > 0)).collect()
    }
    if failed:
        raise ContractViolation(f"contract violated: {failed}")
