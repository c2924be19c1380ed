"""Snapshot-to-snapshot change classification (CH1-CH6, JN4, JN5, PX5).

Two entry points share one classification:

* ``changes_for_day`` compares one day with the previously published one;
* ``changes_over_time`` classifies every day of history in a single pass: one
  shuffle on the listing, neighbours by window instead of by self join.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalake.functions.measures import relative_change

COMPARED = ("district", "city", "bedrooms_min", "bedrooms_max", "currency", "price_amount")
CHANGE_COLUMNS = (
    "ingest_date", "listing_id", "district", "city", "bedrooms_min", "bedrooms_max", "currency",
    "change_type", "previous_price", "current_price", "price_change_amount", "price_change_pct",
    "previous_seen_date", "current_seen_date",
)


def sighting() -> Column:
    """PX5: what a comparison needs to know about one snapshot row."""
    return F.struct(*COMPARED, F.col("ingest_date").alias("seen_date"))


def change_type(current: Column, previous: Column, seen_before: Column, complete: Column) -> Column:
    """CH4: the first matching class wins; NULL means no change row.

    A listing that is gone is only reported when every segment of the day was
    crawled. Currency switches are not looked at: amounts are compared as they are.
    """
    here, before = current.isNotNull(), previous.isNotNull()
    was, now = previous["price_amount"], current["price_amount"]
    arrived = F.when(seen_before, "REAPPEARED").otherwise("NEW")
    stayed = (
        F.when(now > was, "PRICE_INCREASE").when(now < was, "PRICE_DECREASE").otherwise("UNCHANGED")
    )
    return (
        F.when(here & ~before, arrived)
        .when(here & before, stayed)
        .when(before & complete, "REMOVED")
    )


def change_rows(pairs: DataFrame) -> DataFrame:
    """CH5/CH6: change rows from ``ingest_date, listing_id, cur, prev, change_type``."""

    def either(field: str, *default: Column) -> Column:
        return F.coalesce(F.col(f"cur.{field}"), F.col(f"prev.{field}"), *default).alias(field)

    was, now = F.col("prev.price_amount"), F.col("cur.price_amount")
    return pairs.where(F.col("change_type").isNotNull()).select(
        "ingest_date",
        "listing_id",
        either("district", F.lit("Unknown")),
        either("city", F.lit("Lima")),
        either("bedrooms_min"),
        either("bedrooms_max"),
        either("currency", F.lit("UNKNOWN")),
        "change_type",
        was.alias("previous_price"),
        now.alias("current_price"),
        (now - was).alias("price_change_amount"),
        relative_change(now, was).alias("price_change_pct"),
        F.col("prev.seen_date").alias("previous_seen_date"),
        F.col("cur.seen_date").alias("current_seen_date"),
    )


def changes_for_day(
    snapshots: DataFrame,
    day: date,
    previous: date | None,
    complete: bool,
    known: DataFrame | None = None,
) -> DataFrame:
    """CH2-CH6 for one processing day.

    Only three slices are read: the day, the previous published day, and who was
    ``known`` before, one row per listing (by default the distinct listing ids of all
    earlier days). All three meet on the listing, which is unique per slice, so
    no key can be hot.
    """
    current = snapshots.where(F.col("ingest_date") == F.lit(day)).select(
        "listing_id", sighting().alias("cur")
    )
    earlier = snapshots.where(F.col("ingest_date") < F.lit(day))
    before = earlier.where(F.col("ingest_date") == F.lit(previous)).select(
        "listing_id", sighting().alias("prev")
    )
    known = earlier.select("listing_id").distinct() if known is None else known.select("listing_id")
    known = known.withColumn("_known", F.lit(True))
    pairs = (
        current.join(known, "listing_id", "left")
        .join(before, "listing_id", "full_outer")
        .withColumn("ingest_date", F.lit(day))
    )
    kind = change_type(
        F.col("cur"), F.col("prev"), F.coalesce("_known", F.lit(False)), F.lit(complete)
    )
    return change_rows(pairs.withColumn("change_type", kind))


def with_neighbours(snapshots: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every snapshot row with its comparison outcome on its own and on the next day.

    Adds ``prev_date, next_date``, ``prev`` (the row of the previous published
    day, if any), ``seen_before``, and ``leaves`` (true when the listing is
    missing on the next published day and that day is complete).
    """
    by_listing = Window.partitionBy("listing_id").orderBy("ingest_date")
    # One row per calendar day: 500 years of history stay below the broadcast bound.
    dated = snapshots.join(F.broadcast(calendar), "ingest_date")
    return (
        dated.withColumn("cur", sighting())
        .withColumn("_last", F.lag("cur").over(by_listing))
        .withColumn("_coming", F.lead("ingest_date").over(by_listing))
        .withColumns(
            {
                "prev": F.when(F.col("_last.seen_date") == F.col("prev_date"), F.col("_last")),
                "seen_before": F.col("_last").isNotNull(),
                "leaves": F.col("next_date").isNotNull()
                & ~F.col("_coming").eqNullSafe(F.col("next_date"))
                & F.col("next_complete"),
            }
        )
        .drop("_last", "_coming", "next_complete")
    )


def neighbour_changes(linked: DataFrame) -> DataFrame:
    """Change rows of ``with_neighbours``: arrival or stay today, removal tomorrow."""
    nobody = F.lit(None).cast(linked.schema["cur"].dataType)
    today = F.struct(
        F.col("ingest_date"),
        F.col("cur"),
        F.col("prev"),
        change_type(
            F.col("cur"), F.col("prev"), F.col("seen_before"), F.lit(False)
        ).alias("change_type"),
    )
    tomorrow = F.struct(
        F.col("next_date").alias("ingest_date"),
        nobody.alias("cur"),
        F.col("cur").alias("prev"),
        F.lit("REMOVED").alias("change_type"),
    )
    rows = F.array_compact(F.array(today, F.when(F.col("leaves"), tomorrow)))
    return change_rows(linked.select("listing_id", F.inline(rows)))


def changes_over_time(snapshots: DataFrame, calendar: DataFrame) -> DataFrame:
    """CH1-CH6 for every published day at once."""
    return neighbour_changes(with_neighbours(snapshots, calendar))
