"""Keep-one-row-per-key operators and the running totals built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: Sequence, order: Sequence[Column], n: int = 1) -> DataFrame:
    """ST1/WN1: the first ``n`` rows of each key in a total order.

    Spark applies the rank limit before the shuffle as well (WindowGroupLimit),
    so a hot key sends at most ``n`` rows per map task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def latest_observation(valid: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """ST1/WN2: the canonical observation of each listing and day."""
    return top_per_key(
        valid,
        ["ingest_date", "listing_id"],
        [
            F.col("observed_at").desc_nulls_last(),
            F.col("_bronze_loaded_at").desc_nulls_last(),
            F.col("run_id").desc(),
            *[F.col(c).desc() for c in (*tie_breakers, "source_observation_key")],
        ],
    )


def card_identity() -> Column:
    """BR6: id, else address, else the raw card itself; blank values fall through."""
    return F.coalesce(
        F.nullif(F.col("listing_id"), F.lit("")),
        F.nullif(F.col("url"), F.lit("")),
        F.to_json("_raw"),
    )


def first_seen_cards(cards: DataFrame, position: str = "_position") -> DataFrame:
    """BR6: first sighting of each card within its run, by page and position."""
    keyed = cards.withColumn("_card_key", card_identity())
    order = [F.col("_page_num").asc(), F.col(position).asc()]
    return top_per_key(keyed, ["_run_id", "_card_key"], order).drop("_card_key")


def running_sum(
    df: DataFrame, group: str, order: str, value: str, name: str, block: int = 4096
) -> DataFrame:
    """Running total of ``value`` per group along the integer column ``order``.

    Two levels: within blocks of ``block`` consecutive positions, and over the
    block totals. A group with very many positions is therefore never sorted in
    one task; only its block totals are. ``df`` has one row per (group, order).
    """
    blocked = df.withColumn("_block", F.floor(F.col(order) / block))
    inner = Window.partitionBy(group, "_block").orderBy(order)
    outer = Window.partitionBy(group).orderBy("_block")
    offsets = (
        blocked.groupBy(group, "_block")
        .agg(F.sum(value).alias("_total"))
        .withColumn("_offset", F.sum("_total").over(outer) - F.col("_total"))
        .drop("_total")
    )
    local = blocked.withColumn(
        "_local",
        F.sum(value).over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    )
    return (
        local.join(offsets, [group, "_block"])
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .drop("_block", "_local", "_offset")
    )


def page_yield(cards: DataFrame, position: str = "_position") -> DataFrame:
    """BR7: found, new and running total per page, up to the first page without news."""
    found = cards.groupBy("_run_id", "_page_num").agg(F.count(F.lit(1)).alias("found"))
    new = (
        first_seen_cards(cards, position)
        .groupBy("_run_id", "_page_num")
        .agg(F.count(F.lit(1)).alias("new"))
    )
    pages = found.join(new, ["_run_id", "_page_num"], "left").fillna({"new": 0})
    ends = (
        pages.where(F.col("new") == 0)
        .groupBy("_run_id")
        .agg(F.min("_page_num").alias("_end"))
    )
    totals = running_sum(pages, "_run_id", "_page_num", "new", "total")
    return (
        totals.join(ends, "_run_id", "left")
        .where(F.col("_end").isNull() | (F.col("_page_num") <= F.col("_end")))
        .withColumn("is_end", F.coalesce(F.col("_page_num") == F.col("_end"), F.lit(False)))
        .drop("_end")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG9: key values that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ST4: fail before a keyed write whose source repeats a key."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"rows are not unique on {list(keys)}")
    return df
