"""Published days: resolution of the processing date and neighbour lookups."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.config import SEGMENTS, strict_date


def resolve_date(requested: str | None, published: DataFrame, column: str = "ingest_date") -> date:
    """SI1: the requested ISO day, else the newest one; ValueError when there is none."""
    if requested and requested.strip():
        return strict_date(requested)
    newest = published.agg(F.max(column)).first()[0]
    if newest is None:
        raise ValueError("nothing has been published yet")
    return newest


def previous_date(published: DataFrame, day: date, column: str = "ingest_date") -> date | None:
    """CH1: newest published day before ``day`` (table-wide, not calendar minus one)."""
    return published.where(F.col(column) < F.lit(day)).agg(F.max(column)).first()[0]


def resolve_day(requested: str | None, published: Collection[date]) -> date:
    """SI1 where the published days are known, as from a listing of partitions."""
    if requested and requested.strip():
        return strict_date(requested)
    if not published:
        raise ValueError("nothing has been published yet")
    return max(published)


def day_before(published: Collection[date], day: date) -> date | None:
    """CH1 where the published days are known."""
    return max((d for d in published if d < day), default=None)


def newest_dates(published: DataFrame, column: str = "ingest_date") -> tuple[date, date | None]:
    """SI1 and CH1 in one job: the newest published day and the one before it."""
    top = published.select(column).where(F.col(column).isNotNull()).distinct()
    days = [row[0] for row in top.orderBy(F.col(column).desc()).limit(2).collect()]
    if not days:
        raise ValueError("nothing has been published yet")
    return days[0], (days[1] if len(days) > 1 else None)


def completeness(runs: DataFrame) -> DataFrame:
    """CH3 for every day: ``ingest_date, segments, is_complete``.

    The set of segments with a successful run is one bit mask per day, so the
    distinct count merges before the shuffle.
    """
    success = F.lower("status") == "success"
    segment = F.col("search_params.bedrooms")
    bits = F.coalesce(*[F.when(success & (segment == s), 1 << s) for s in SEGMENTS])
    return (
        runs.where(F.col("_partition_ingest_date").isNotNull())
        .groupBy(F.col("_partition_ingest_date").alias("ingest_date"))
        .agg(F.bit_count(F.coalesce(F.bit_or(bits), F.lit(0))).alias("segments"))
        .withColumn("is_complete", F.col("segments") == len(SEGMENTS))
    )


def is_complete(runs: DataFrame, day: date) -> bool:
    """CH3 for one day."""
    row = completeness(runs.where(F.col("_partition_ingest_date") == F.lit(day))).first()
    return bool(row and row["is_complete"])


def publication_calendar(snapshots: DataFrame, runs: DataFrame) -> DataFrame:
    """Neighbours of every published day.

    ``snapshots`` may be any frame with the same set of days. One row per day: ``ingest_date, prev_date, next_date, next_complete``. The
    list of distinct days is the only thing gathered in one place: it holds one
    4-byte date per calendar day of history, whatever the number of rows.
    """
    days = snapshots.select("ingest_date").distinct()
    ordered = days.agg(F.sort_array(F.collect_set("ingest_date")).alias("_days"))
    neighbours = ordered.select(F.posexplode("_days").alias("_i", "ingest_date"), "_days").select(
        "ingest_date",
        F.get("_days", F.col("_i") - 1).alias("prev_date"),
        F.get("_days", F.col("_i") + 1).alias("next_date"),
    )
    upcoming = completeness(runs).select(
        F.col("ingest_date").alias("next_date"), F.col("is_complete").alias("next_complete")
    )
    return neighbours.join(upcoming, "next_date", "left").select(
        "ingest_date",
        "prev_date",
        "next_date",
        F.coalesce("next_complete", F.lit(False)).alias("next_complete"),
    )
