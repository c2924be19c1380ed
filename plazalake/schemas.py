"""Landing record schemas (IO3, IO4) and the serving contract (IO20)."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, StringType, StructType



def _struct(**fields: str | DataType) -> StructType:
    """Nullable struct from names and type names; needs no running session."""
    schema = StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind, True)
    return schema


_TEXTS = ArrayType(StringType())

# Field names and types of the landed files.
SEARCH_SCHEMA = _struct(
    operation="string", property_type="string", location="string", bedrooms="integer"
)
CARD_SCHEMA = _struct(
    id="string", posting_type="string", url="string", price="string", maintenance="string",
    features_text="string", street="string", location="string", description="string",
    publisher="string", amenities=_TEXTS, image="string",
)
LISTING_SCHEMA = _struct(
    listing_id="string", listing_type="string", url="string", price_raw="string",
    maintenance_raw="string", currency="string", price_min="double", area_raw="string",
    bedrooms_raw="string", bathrooms_raw="string", units_raw="string", address_raw="string",
    street="string", district="string", city="string", features=_TEXTS, description="string",
    image_url="string", publisher="string", _ingested_at="string", _source_url="string",
    _page_num="integer", _run_id="string", _search_params=SEARCH_SCHEMA,
    _extraction_method="string", _raw=CARD_SCHEMA,
)
MANIFEST_SCHEMA = _struct(
    run_id="string", status="string", records_written="long", record_count="long",
    pages_scraped="integer", started_at="string", completed_at="string", finished_at="string",
    search_params=SEARCH_SCHEMA, data_file="string", data_path="string", partition="string",
    error="string",
)

# Columns of the governed export.
EXPORT_COLUMNS = (
    "ingest_date", "district", "bedrooms", "currency", "listing_count", "avg_price",
    "median_price", "min_price", "max_price", "avg_area_m2", "median_price_per_m2",
    "new_listing_count", "removed_listing_count", "price_changed_count",
    "offer_change_pct", "calculated_at",
)
