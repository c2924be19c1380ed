"""Technical keys and values derived from landing paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The digests must stay stable across engines.
KEY_SEPARATOR = "||"
MISSING_RUN = "missing_run_id"
MISSING_LISTING = "missing_listing_id"
MISSING_FILE = "missing_source_file"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def observation_key(run_id: Column, listing_id: Column, url: Column) -> Column:
    """BR10: one key per run and listing."""
    return digest(
        F.coalesce(run_id, F.lit(MISSING_RUN)),
        F.coalesce(listing_id, url, F.lit(MISSING_LISTING)),
    )


def manifest_key(run_id: Column, source_file: Column) -> Column:
    """BR11: one key per run and manifest file."""
    return digest(
        F.coalesce(run_id, F.lit(MISSING_RUN)),
        F.coalesce(source_file, F.lit(MISSING_FILE)),
    )


def path_date(path: Column) -> Column:
    """IO7: ``ingest_date=`` directory value, NULL when absent or not a date."""
    return F.regexp_extract(path, r"ingest_date=([^/]+)", 1).try_cast("date")


def path_bedrooms(path: Column) -> Column:
    """IO7: ``bedrooms=`` directory value, NULL when absent or not a number."""
    return F.regexp_extract(path, r"bedrooms=(\d+)", 1).try_cast("int")


def stable_run_id(external_id: Column, segment: Column) -> Column:
    """BR9: file-name-safe run id with its segment suffix."""
    safe = F.regexp_replace(external_id, "[^A-Za-z0-9_.-]+", "_")
    return F.concat(F.regexp_replace(safe, "^_+|_+$", ""), F.lit("_b"), segment.cast("string"))
