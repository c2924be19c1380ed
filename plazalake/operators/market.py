"""Market cube by day, district, bedrooms and currency (AG1-AG8, JN6, JN7)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.functions.measures import lower_median, relative_change
from plazalake.operators.options import market_dimensions, per_bedroom

CUBE_KEYS = ("ingest_date", "district", "bedrooms", "currency")
PRICE_CHANGES = ("PRICE_INCREASE", "PRICE_DECREASE")
MARKET_COLUMNS = (
    *CUBE_KEYS, "listing_count", "avg_price", "median_price", "min_price", "max_price",
    "avg_area_m2", "median_price_per_m2", "new_listing_count", "removed_listing_count",
    "price_changed_count", "offer_change_pct",
)

# What one listing adds to one cube cell, and in which role.
_CURRENT, _CHANGE, _PREVIOUS = "current", "change", "previous"


def current_market(options: DataFrame) -> DataFrame:
    """AG1: offer and price metrics of each cell.

    A listing appears once per day and bedroom count, so rows are listings and
    a plain count (mergeable before the shuffle) replaces a distinct one.
    """
    return (
        market_dimensions(options)
        .groupBy(*CUBE_KEYS)
        .agg(
            F.count("listing_id").alias("listing_count"),
            F.avg("price_amount").alias("avg_price"),
            lower_median(F.col("price_amount")).alias("median_price"),
            F.min("price_amount").alias("min_price"),
            F.max("price_amount").alias("max_price"),
            F.avg("area_avg_m2").alias("avg_area_m2"),
            lower_median(F.col("price_per_m2")).alias("median_price_per_m2"),
        )
    )


def previous_counts(options: DataFrame) -> DataFrame:
    """AG3: offer per district, bedrooms and currency of the compared day."""
    return (
        market_dimensions(options)
        .groupBy("district", "bedrooms", "currency")
        .agg(F.count("listing_id").alias("previous_listing_count"))
    )


def change_metrics(changes: DataFrame) -> DataFrame:
    """AG4 over PX3: arrivals, departures and repricings of each cell."""
    kind = F.col("change_type")
    return (
        per_bedroom(changes)
        .groupBy(*CUBE_KEYS)
        .agg(
            F.count_if(kind == "NEW").alias("new_listing_count"),
            F.count_if(kind == "REMOVED").alias("removed_listing_count"),
            F.count_if(kind.isin(*PRICE_CHANGES)).alias("price_changed_count"),
        )
    )


def _contributions(df: DataFrame, role: str) -> DataFrame:
    """Options or changes as cube contributions with one common layout."""
    absent = F.lit(None)
    measured = role == _CURRENT
    return df.select(
        *CUBE_KEYS,
        F.lit(role).alias("role"),
        (F.col("price_amount") if measured else absent.cast("double")).alias("price"),
        (F.col("area_avg_m2") if measured else absent.cast("double")).alias("area"),
        (F.col("price_per_m2") if measured else absent.cast("double")).alias("unit_price"),
        (F.col("change_type") if role == _CHANGE else absent.cast("string")).alias("change_type"),
    )


def fold_market(contributions: DataFrame) -> DataFrame:
    """AG1+AG3+AG4+AG5+AG6 in one aggregation over the cube keys.

    Current offer, change rows and the compared day's offer are added up side
    by side, which replaces a full outer and a left join of three aggregates.
    Cells known from the compared day only are not published.
    """
    role, kind = F.col("role"), F.col("change_type")
    folded = contributions.groupBy(*CUBE_KEYS).agg(
        F.count_if(role == _CURRENT).alias("listing_count"),
        F.avg("price").alias("avg_price"),
        lower_median(F.col("price")).alias("median_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.avg("area").alias("avg_area_m2"),
        lower_median(F.col("unit_price")).alias("median_price_per_m2"),
        F.count_if(kind == "NEW").alias("new_listing_count"),
        F.count_if(kind == "REMOVED").alias("removed_listing_count"),
        F.count_if(kind.isin(*PRICE_CHANGES)).alias("price_changed_count"),
        F.count_if(role == _PREVIOUS).alias("_previous"),
        F.count_if(role != _PREVIOUS).alias("_published"),
    )
    return folded.where(F.col("_published") > 0).select(
        *MARKET_COLUMNS[:-1],
        relative_change(F.col("listing_count"), F.col("_previous")).alias("offer_change_pct"),
    )


def market_for_day(
    snapshots: DataFrame, changes: DataFrame, day: date, previous: date | None
) -> DataFrame:
    """Market cube of one day; ``changes`` are that day's change rows."""
    options = market_dimensions(per_bedroom(snapshots))
    current = options.where(F.col("ingest_date") == F.lit(day))
    compared = options.where(F.col("ingest_date") == F.lit(previous)).withColumn(
        "ingest_date", F.lit(day)
    )
    return fold_market(
        _contributions(current, _CURRENT)
        .unionByName(_contributions(per_bedroom(changes), _CHANGE))
        .unionByName(_contributions(compared, _PREVIOUS))
    )


def market_over_time(linked: DataFrame) -> DataFrame:
    """Market cube of every published day from ``changes.with_neighbours``.

    Each snapshot row states all its contributions itself (its own day, the
    comparison base of the next day, its change rows), so history is read and
    shuffled once before the cells are folded.
    """
    from plazalake.operators.changes import change_type

    bounds = ("bedrooms_min", "bedrooms_max")
    no_number, no_kind = F.lit(None).cast("double"), F.lit(None).cast("string")

    def entry(day, district, currency, role, kind=no_kind, measured=False, *, low, high):
        return F.struct(
            day.alias("ingest_date"),
            F.coalesce(district, F.lit("Unknown")).alias("district"),
            F.coalesce(currency, F.lit("UNKNOWN")).alias("currency"),
            low.alias("bedrooms_min"),
            high.alias("bedrooms_max"),
            F.lit(role).alias("role"),
            (F.col("price_amount") if measured else no_number).alias("price"),
            (F.col("area_avg_m2") if measured else no_number).alias("area"),
            (F.col("price_per_m2") if measured else no_number).alias("unit_price"),
            kind.alias("change_type"),
        )

    own = {"low": F.col(bounds[0]), "high": F.col(bounds[1])}
    today = entry(
        F.col("ingest_date"), F.col("district"), F.col("currency"), _CURRENT, measured=True, **own
    )
    base = entry(F.col("next_date"), F.col("district"), F.col("currency"), _PREVIOUS, **own)
    removal = entry(
        F.col("next_date"), F.col("district"), F.col("currency"), _CHANGE, F.lit("REMOVED"), **own
    )
    # A change row falls back to the compared row where today's value is missing.
    change = entry(
        F.col("ingest_date"),
        F.coalesce("district", "prev.district"),
        F.coalesce("currency", "prev.currency"),
        _CHANGE,
        change_type(F.col("cur"), F.col("prev"), F.col("seen_before"), F.lit(False)),
        low=F.coalesce("bedrooms_min", "prev.bedrooms_min"),
        high=F.coalesce("bedrooms_max", "prev.bedrooms_max"),
    )
    entries = F.array_compact(
        F.array(
            today,
            change,
            F.when(F.col("next_date").isNotNull(), base),
            F.when(F.col("leaves"), removal),
        )
    )
    return fold_market(per_bedroom(linked.select(F.inline(entries))))


def segment_summary(market: DataFrame) -> DataFrame:
    """AG7: offer and mean of the cell averages per bedrooms and currency."""
    return (
        market.groupBy("bedrooms", "currency")
        .agg(
            F.sum("listing_count").alias("listings"),
            F.avg("avg_price").alias("avg_segment_price"),
        )
        .orderBy("bedrooms", "currency")
    )


def refresh_market(typed: DataFrame) -> DataFrame:
    """AG8: the full-refresh profile's district and day metrics."""

    def mean(value):
        return F.round(F.avg(value), 2)

    return (
        typed.groupBy(F.col("district_clean").alias("district"), "ingest_date")
        .agg(
            F.count(F.lit(1)).alias("listing_count"),
            mean("price_amount").alias("avg_price"),
            F.round(F.min("price_amount"), 2).alias("min_price"),
            F.round(F.max("price_amount"), 2).alias("max_price"),
            mean("area_avg_m2").alias("avg_area_m2"),
            mean("price_per_m2").alias("avg_price_per_m2"),
            mean((F.col("bedrooms_min") + F.col("bedrooms_max")) / 2).alias("avg_bedrooms"),
        )
        .orderBy("ingest_date", "district")
    )
