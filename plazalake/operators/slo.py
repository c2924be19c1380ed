"""Service levels and further indicators named in the product plan (DX1-DX11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalake.functions.measures import bracket_index, relative_change


def completeness_share(df: DataFrame, columns: Sequence[str], target: float = 0.99) -> DataFrame:
    """DX1: share of non-null values per column against the target."""
    shares = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("field"), F.col(c).alias("share")) for c in columns]
    return shares.select(F.inline(F.array(*pairs))).withColumn("met", F.col("share") >= target)


def freshness(
    scraped: DataFrame, scraped_at: str, published_at: Column, max_hours: float = 24.0
) -> DataFrame:
    """DX2: hours from the last scrape of a day to its publication."""
    last = scraped.groupBy("ingest_date").agg(F.max(scraped_at).alias("last_scrape"))
    hours = (published_at.cast("timestamp").cast("double")
             - F.col("last_scrape").cast("timestamp").cast("double")) / 3600.0
    return last.withColumn("hours", hours).withColumn("met", F.col("hours") <= max_hours)


def volume_guard(runs: DataFrame, segment: str, order: str, rows: str, share: float = 0.5) -> DataFrame:
    """DX3: flag a run that lost more than ``share`` of the segment's previous run.

    ``runs`` has one row per successful run.
    """
    history = Window.partitionBy(segment).orderBy(order)
    return runs.withColumn("previous_rows", F.lag(rows).over(history)).withColumn(
        "dropped",
        F.coalesce(F.col(rows) < F.col("previous_rows") * (1.0 - share), F.lit(False)),
    )


def inverted_areas(typed: DataFrame) -> DataFrame:
    """DX4: rows whose area range is upside down."""
    return typed.where(F.col("area_max_m2") < F.col("area_min_m2"))


def quality_daily(results: DataFrame) -> DataFrame:
    """DX5: rule results per day; one failing run fails the day."""
    return results.groupBy("ingest_date", "rule_id").agg(
        F.sum("records_evaluated").alias("total_records"),
        F.sum("valid_records").alias("valid_records"),
        F.sum("invalid_records").alias("invalid_records"),
        F.round(F.sum("invalid_records") / F.sum("records_evaluated") * 100.0, 2).alias("error_pct"),
        F.bool_or(F.col("result") == "FAIL").alias("failed"),
    )


def reconcile(manifests: DataFrame, landed: DataFrame) -> DataFrame:
    """DX6: rows a manifest promises against rows that arrived, either side may be missing."""
    arrived = landed.groupBy(F.col("_run_id").alias("run_id")).agg(
        F.count(F.lit(1)).alias("landed_rows")
    )
    promised = manifests.groupBy("run_id").agg(F.sum("records_written").alias("promised_rows"))
    return promised.join(arrived, "run_id", "full_outer").select(
        "run_id",
        F.coalesce("promised_rows", F.lit(0)).alias("promised_rows"),
        F.coalesce("landed_rows", F.lit(0)).alias("landed_rows"),
        (F.coalesce("promised_rows", F.lit(0)) == F.coalesce("landed_rows", F.lit(0))).alias("agrees"),
    )


def checksum(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """DX7: row count and order-independent hash, to compare a table before and after a rerun."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("checksum"),
    )


def portable_checksum(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """DX7: the same for columns whose text is alike in any engine, so that another can repeat it.

    The sum of the first 60 bits of MD5 over each row's values, NULL as empty, joined by
    a bar; rows count as often as they occur.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    bits = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum(bits).cast("string").alias("checksum"))


def rent_premium(by_bedroom: DataFrame) -> DataFrame:
    """DX8: rent of one more bedroom in the same district (at most four rows each)."""
    ladder = Window.partitionBy("district_key").orderBy("bedrooms")
    previous = F.lag(F.struct("bedrooms", "avg_rent_pen")).over(ladder)
    return (
        by_bedroom.withColumn("_p", previous)
        .where(F.col("bedrooms") == F.col("_p.bedrooms") + 1)
        .select(
            "district_key",
            F.col("_p.bedrooms").alias("from_bedrooms"),
            F.col("bedrooms").alias("to_bedrooms"),
            (F.col("avg_rent_pen") - F.col("_p.avg_rent_pen")).alias("premium"),
            relative_change(F.col("avg_rent_pen"), F.col("_p.avg_rent_pen")).alias("premium_pct"),
        )
    )


def supply_extremes(by_bedroom: DataFrame, n: int = 5) -> DataFrame:
    """DX9: districts and bedroom counts with most and with fewest listings."""
    tie = [F.col("district_key"), F.col("bedrooms")]
    shown = by_bedroom.select("district_key", "bedrooms", "listing_count")
    most = shown.orderBy(F.col("listing_count").desc(), *tie).limit(n)
    fewest = shown.orderBy(F.col("listing_count").asc(), *tie).limit(n)
    return most.withColumn("side", F.lit("most")).unionByName(
        fewest.withColumn("side", F.lit("fewest"))
    )


def market_indicators(options: DataFrame, area_bounds: Sequence[float]) -> DataFrame:
    """DX10: mean price per m2 by day, bedrooms and area bracket."""
    bracket = bracket_index(F.col("area_avg_m2"), area_bounds)
    return (
        options.where(F.col("area_avg_m2").isNotNull())
        .groupBy("ingest_date", "bedrooms", bracket.alias("area_bracket"))
        .agg(
            F.count("listing_id").alias("listings"),
            F.avg("price_amount").alias("avg_price"),
            F.max("price_per_m2").alias("max_price_per_m2"),
            F.avg("price_per_m2").alias("avg_price_per_m2"),
        )
    )


def price_variation(market: DataFrame, calendar: DataFrame) -> DataFrame:
    """DX10: percent change of the mean price against the previous published day."""
    keys = ["district", "bedrooms", "currency"]
    before = market.select(
        F.col("ingest_date").alias("prev_date"), *keys, F.col("avg_price").alias("_before")
    )
    dated = market.join(F.broadcast(calendar.select("ingest_date", "prev_date")), "ingest_date")
    return dated.join(before, ["prev_date", *keys], "left").select(
        "ingest_date",
        *keys,
        "avg_price",
        relative_change(F.col("avg_price"), F.col("_before")).alias("price_change_pct"),
    )


def days_on_market(latest: DataFrame) -> DataFrame:
    """DX10: approximate days between first and last sighting."""
    return latest.select(
        "listing_id",
        (F.datediff("last_seen_date", "first_seen_date") + 1).alias("days_on_market"),
        "is_active",
    )


def district_opportunity(market: DataFrame, profile: DataFrame) -> DataFrame:
    """DX11: market metrics beside a district profile (unique on ``district_key``)."""
    return market.join(profile, "district_key", "inner").withColumn(
        "listings_per_1000", F.col("listing_count") * 1000.0 / F.col("population")
    )
