"""Serving frames built from the published market table (SV, AG10-AG15, TK).

Inputs here are already aggregated: one row per district label, bedrooms and
currency of one day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalake.functions.measures import bracket_index, bracket_label, weighted_mean
from plazalake.functions.text import column_key, district_key, name_key
from plazalake.operators.dedup import top_per_key
from plazalake.operators.joins import lookup_join
from plazalake.schemas import EXPORT_COLUMNS

# Serving defaults and recognised column names.
RENT_BOUNDS = (1500, 2000, 2500, 3000, 4000)
DISTRICT_COLUMNS = (
    "NOMBDIST", "NOMB_DIST", "NOMBRE_DIST", "DISTRITO", "DISTRICT", "DIST_NAME",
)
DEPARTMENT_COLUMNS = ("NOMBDEP", "NOMB_DPTO", "DEPARTAMENTO", "DEPARTAMEN", "DEPARTMENT")
PROVINCE_COLUMNS = ("NOMBPROV", "NOMB_PROV", "PROVINCIA", "PROVINCE")
METROPOLITAN_AREAS = ("LIMA", "CALLAO", "PROVINCIA CONSTITUCIONAL DEL CALLAO")
MATRIX_METRICS = ("listing_count", "median_price", "avg_area_m2", "median_price_per_m2")
WEIGHTED_METRICS = {
    "avg_rent_pen": "avg_price",
    "median_price": "median_price",
    "avg_area_m2": "avg_area_m2",
    "median_price_m2": "median_price_per_m2",
}
ROUNDED = (
    "avg_price", "median_price", "min_price", "max_price", "avg_area_m2",
    "median_price_per_m2", "offer_change_pct",
)


def governed_export(market: DataFrame) -> DataFrame:
    """SV1/JN9: newest day, PEN, 1-4 bedrooms, two decimals, ordered."""
    newest = market.agg(F.max("ingest_date").alias("ingest_date"))  # a single row
    chosen = market.where((F.col("currency") == "PEN") & F.col("bedrooms").between(1, 4)).join(
        F.broadcast(newest), "ingest_date"
    )
    return (
        chosen.withColumns({c: F.round(c, 2) for c in ROUNDED})
        .withColumn("bedrooms", F.col("bedrooms").cast("int"))
        .select(*[c for c in EXPORT_COLUMNS if c in market.columns])
        .orderBy("district", "bedrooms")
    )


def require_columns(df: DataFrame, required: Sequence[str] = EXPORT_COLUMNS) -> DataFrame:
    """IO20: reject an export with missing columns."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"export is missing columns: {', '.join(missing)}")
    return df


def single_date(df: DataFrame, allow_none: bool = False) -> str | None:
    """SV2: the one day of an export; more than one (or none) is an error."""
    days = (
        df.select(F.substring(F.col("ingest_date").cast("string"), 1, 10).alias("day"))
        .where(F.col("day").isNotNull())
        .distinct()
        .limit(2)
        .collect()
    )
    if len(days) > 1 or (not days and not allow_none):
        raise ValueError("the export must contain exactly one ingest_date")
    return days[0]["day"] if days else None


def servable(export: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """SV3-SV5: usable PEN rows with numeric metrics and a district key."""
    numeric = {c: F.col(c).cast("string").try_cast("double") for c in (*metrics, "bedrooms")}
    typed = export.withColumns(numeric).withColumn("district", F.trim("district"))
    return (
        typed.where(
            (F.upper("currency") == "PEN")
            & F.col("bedrooms").between(1, 4)
            & (F.col("listing_count") > 0)
        )
        .dropna(subset=["district", "bedrooms", *metrics])
        .withColumns(
            {
                "bedrooms": F.col("bedrooms").cast("int"),
                "listing_count": F.col("listing_count").cast("bigint"),
                "district_key": district_key(F.col("district")),
            }
        )
    )


def roll_up(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG10: listing-weighted metrics and summed counts per district (and bedrooms).

    The label shown is the first one in name order, so it does not depend on
    row order.
    """
    counts = ("new_listing_count", "removed_listing_count", "price_changed_count")
    extra = [
        F.sum(F.col(c).cast("bigint")).alias(c)
        for c in counts
        if "bedrooms" in keys and c in rows.columns
    ]
    return rows.groupBy(*keys).agg(
        F.min("district").alias("district"),
        F.sum("listing_count").alias("listing_count"),
        *[
            weighted_mean(F.col(source), F.col("listing_count")).alias(name)
            for name, source in WEIGHTED_METRICS.items()
        ],
        *extra,
    )


def dashboard_roll_ups(rows: DataFrame) -> DataFrame:
    """AG10/IO22: districts (``by_bedrooms`` false) and districts by bedrooms from one pass.

    Grouping sets share the scan and the shuffle; change counts are shown by bedrooms alone.
    """
    key, bedrooms = F.col("district_key"), F.col("bedrooms")
    finer = F.grouping(bedrooms) == 0
    counts = [
        F.when(finer, F.sum(F.col(c).cast("bigint"))).alias(c)
        for c in ("new_listing_count", "removed_listing_count", "price_changed_count")
    ]
    return rows.groupingSets([[key], [key, bedrooms]], key, bedrooms).agg(
        finer.alias("by_bedrooms"),
        F.min("district").alias("district"),
        F.sum("listing_count").alias("listing_count"),
        *[
            weighted_mean(F.col(source), F.col("listing_count")).alias(name)
            for name, source in WEIGHTED_METRICS.items()
        ],
        *counts,
    )


def find_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """SV8: first candidate present, ignoring case, accents and underscores."""
    known = {column_key(c): c for c in columns}
    return next((known[column_key(c)] for c in candidates if column_key(c) in known), None)


def official_districts(attributes: DataFrame, district_column: str | None = None) -> DataFrame:
    """SV8: distinct district keys of the metropolitan area.

    A scope (department, then province) that would leave nothing is skipped.
    """
    name = district_column or find_column(attributes.columns, DISTRICT_COLUMNS)
    if name not in attributes.columns:
        raise ValueError(f"no district column among {', '.join(attributes.columns)}")
    scoped = attributes
    for candidates in (DEPARTMENT_COLUMNS, PROVINCE_COLUMNS):
        scope = find_column(attributes.columns, candidates)
        if scope:
            inside = scoped.where(name_key(F.col(f"`{scope}`")).isin(*METROPOLITAN_AREAS))
            if not inside.isEmpty():
                scoped = inside
    keys = scoped.select(name_key(F.col(f"`{name}`")).alias("district_key"))
    return keys.where(F.col("district_key") != "").distinct()


def in_official(rows: DataFrame, districts: DataFrame) -> DataFrame:
    """JN13: rows of official districts; an error when no row has one."""
    matched = lookup_join(rows, districts, ["district_key"], "left_semi")
    if matched.isEmpty():
        raise ValueError("no row belongs to an official district")
    return matched


def unmatched_labels(rows: DataFrame, districts: DataFrame) -> DataFrame:
    """JN15: labels without an official district."""
    return lookup_join(rows, districts, ["district_key"], "left_anti").select("district")


def choropleth(
    districts: DataFrame, rolled: DataFrame, bounds: Sequence[float] = RENT_BOUNDS
) -> DataFrame:
    """SV10/JN14/SV6/SV7: every official district with its metrics and rent bracket."""
    index = bracket_index(F.col("avg_rent_pen"), bounds)
    joined = districts.join(rolled, "district_key", "left")
    return joined.withColumns(
        {
            "rent_bracket": F.when(F.col("avg_rent_pen").isNotNull(), index),
            "rent_label": F.when(F.col("avg_rent_pen").isNotNull(), bracket_label(index, bounds)),
        }
    )


def value_matrix(rows: DataFrame) -> DataFrame:
    """SV9: plotted rows, not aggregated, two decimals."""
    return rows.select(
        "district",
        "district_key",
        "bedrooms",
        "listing_count",
        *[F.round(c, 2).alias(c) for c in MATRIX_METRICS[1:]],
    )


def facet_lines(rows: DataFrame) -> DataFrame:
    """AG11/AG14: weighted reference lines and listing totals per bedrooms."""
    n = F.col("listing_count")
    return rows.groupBy("bedrooms").agg(
        weighted_mean(F.col("avg_area_m2"), n).alias("area_line"),
        weighted_mean(F.col("median_price"), n).alias("rent_line"),
        F.sum(n).alias("listings"),
    )


def mapped_totals(matched: DataFrame) -> DataFrame:
    """AG14: districts and listings on the map."""
    return matched.agg(
        F.count(F.lit(1)).alias("districts"), F.sum("listing_count").alias("listings")
    )


def extents(rows: DataFrame) -> DataFrame:
    """AG13: ranges of the plotted metrics with padded axis domains."""

    def ends(column: str) -> list[Column]:
        return [F.min(column).alias(f"{column}_min"), F.max(column).alias(f"{column}_max")]

    ranges = rows.agg(*[e for c in MATRIX_METRICS for e in ends(c)])
    return ranges.withColumns(
        {
            "area_domain_min": F.greatest(F.lit(1.0), F.col("avg_area_m2_min") * 0.78),
            "area_domain_max": F.col("avg_area_m2_max") * 1.12,
            "rent_domain_min": F.greatest(F.lit(100.0), F.col("median_price_min") * 0.72),
            "rent_domain_max": F.col("median_price_max") * 1.18,
            "area_pad": F.greatest(
                (F.col("avg_area_m2_max") - F.col("avg_area_m2_min")) * 0.08, F.lit(4.0)
            ),
            "rent_pad": F.greatest(
                (F.col("median_price_max") - F.col("median_price_min")) * 0.08, F.lit(150.0)
            ),
        }
    )


def midpoints(rolled: DataFrame) -> DataFrame:
    """AG12: interpolated medians of supply and rent over the mapped districts.

    One row per official district goes in, a list that is fixed by law.
    """
    return rolled.agg(
        F.percentile("listing_count", 0.5).alias("supply_median"),
        F.percentile("avg_rent_pen", 0.5).alias("rent_median"),
    )


def bubble_size(listings: Column) -> Column:
    """SV12: marker area of a supply figure."""
    return F.lit(36.0) + F.sqrt(listings) * 28.0


def bubble_radius(listings: Column, largest: Column) -> Column:
    """SV12: square-root scale from [0, largest] to [4, 14]."""
    return F.lit(4.0) + F.sqrt(listings / largest) * 10.0


def top_supply(rolled: DataFrame, n: int) -> DataFrame:
    """TK1: the ``n`` districts with most listings; ties by key."""
    return rolled.orderBy(F.col("listing_count").desc(), "district_key").limit(n)


def opportunities(rolled: DataFrame, n: int = 5) -> DataFrame:
    """TK2: districts at or above both medians, by supply times rent."""
    return (
        rolled.crossJoin(F.broadcast(midpoints(rolled)))  # a single row
        .where(
            (F.col("listing_count") >= F.col("supply_median"))
            & (F.col("avg_rent_pen") >= F.col("rent_median"))
        )
        .withColumn("commercial_value", F.col("listing_count") * F.col("avg_rent_pen"))
        .orderBy(F.col("commercial_value").desc(), "district_key")
        .limit(n)
        .drop("supply_median", "rent_median")
    )


def facet_labels(rows: DataFrame) -> DataFrame:
    """TK3/SE2: per bedrooms the three largest supplies and the highest rent, each district once."""
    tie = [F.col("district_key"), F.col("district")]
    by_supply = top_per_key(rows, ["bedrooms"], [F.col("listing_count").desc(), *tie], 3)
    by_rent = top_per_key(rows, ["bedrooms"], [F.col("median_price").desc(), *tie], 1)
    both = by_supply.withColumn("_source", F.lit(1)).unionByName(
        by_rent.withColumn("_source", F.lit(2))
    )
    order = [F.col("_source"), F.col("listing_count").desc(), F.col("district")]
    return top_per_key(both, ["bedrooms", "district_key"], order).drop("_source")


def default_row(rows: DataFrame) -> DataFrame:
    """TK4: the row shown first, the one with most listings."""
    return rows.orderBy(F.col("listing_count").desc(), "district_key", "bedrooms", "district").limit(1)


def bedroom_mix(by_bedroom: DataFrame, ranking: DataFrame) -> DataFrame:
    """AG15/JN16: listings of the ranked districts, one column per bedroom count."""
    ranked = by_bedroom.join(F.broadcast(ranking.select("district_key")), "district_key", "left_semi")
    mixed = (
        ranked.groupBy("district_key")
        .pivot("bedrooms", [1, 2, 3, 4])
        .agg(F.sum("listing_count"))
        .fillna(0)
    )
    return mixed.withColumnsRenamed({str(b): f"bedrooms_{b}" for b in (1, 2, 3, 4)})
