"""Bedroom options: one row per bedroom count a listing offers (PX1, PX3, PX4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of the published view.
OPTION_COLUMNS = (
    "ingest_date", "listing_id", "bedrooms", "listing_type", "url", "district", "city",
    "bathrooms", "area_min_m2", "area_max_m2", "area_avg_m2", "currency", "price_amount",
    "price_per_m2", "features", "publisher", "run_id", "source_file",
    "source_observation_key", "observed_at", "updated_at",
)


def per_bedroom(df: DataFrame) -> DataFrame:
    """PX1/PX3: expand valid ranges within 1..4; other rows have no option.

    The range test comes first: an inverted range would count downwards. A row
    yields at most four rows, so nothing is multiplied without bound.
    """
    inside = df.where("bedrooms_min BETWEEN 1 AND 4 AND bedrooms_max BETWEEN bedrooms_min AND 4")
    return inside.withColumn("bedrooms", F.explode(F.sequence("bedrooms_min", "bedrooms_max")))


def bedroom_options(snapshots: DataFrame) -> DataFrame:
    """PX1 with the columns of the published view that the input carries."""
    expanded = per_bedroom(snapshots)
    return expanded.select(*[c for c in OPTION_COLUMNS if c in expanded.columns])


def market_dimensions(df: DataFrame) -> DataFrame:
    """PX4: names under which rows without district or currency are published."""
    return df.fillna({"district": "Unknown", "currency": "UNKNOWN"})
