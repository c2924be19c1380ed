"""Run parameters (IO9, IO23) and search-domain checks (BR18)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SEGMENTS = (1, 2, 3, 4)


@dataclass(frozen=True)
class EngineConfig:
    """Object names and locations of one data product.

    ``namespace`` prefixes the three layer databases, so a Hive-style catalog
    (two-level names) and a multi-catalog setup (``"cat."``) both work.
    """

    namespace: str
    raw_path: str
    checkpoint_root: str
    # Files of the crawler, and those that landed.write_landing and write_manifests make.
    listing_glob: str = "{listings_*.jsonl,part-*.json}"
    manifest_glob: str = "{manifest_*.json,part-*.txt}"
    max_files_per_batch: int = 1000  # a backlog is worked off in bounded micro-batches
    key_buckets: int = 16  # of the index of stored keys; a bucket's keys should fit a task

    def __post_init__(self) -> None:
        if not self.namespace.strip():
            raise ValueError("namespace must not be empty")
        object.__setattr__(self, "namespace", self.namespace.strip())
        object.__setattr__(self, "raw_path", self.raw_path.rstrip("/") + "/")
        object.__setattr__(self, "checkpoint_root", self.checkpoint_root.rstrip("/") + "/")

    def database(self, layer: str) -> str:
        joint = "" if self.namespace.endswith(".") else "_"
        return f"{self.namespace}{joint}{layer}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

    @property
    def listings_raw(self) -> str:
        return self.table("bronze", "listings_raw")

    @property
    def ingestion_runs(self) -> str:
        return self.table("bronze", "ingestion_runs")

    @property
    def snapshot(self) -> str:
        return self.table("silver", "listings_snapshot")

    @property
    def quarantine(self) -> str:
        return self.table("silver", "listings_quarantine")

    @property
    def quality_results(self) -> str:
        return self.table("silver", "data_quality_results")

    @property
    def bedroom_options(self) -> str:
        return self.table("silver", "vw_listing_bedroom_options")

    @property
    def market_daily(self) -> str:
        return self.table("gold", "market_daily_by_district")

    @property
    def listing_latest(self) -> str:
        return self.table("gold", "listing_latest")

    @property
    def listing_changes(self) -> str:
        return self.table("gold", "listing_change_daily")

    def checkpoint(self, stream: str) -> str:
        """One checkpoint directory per stream."""
        return f"{self.checkpoint_root}bronze/{stream}/"


@dataclass(frozen=True)
class SearchSpec:
    """Parameters of one landing run."""

    operation: str = "alquiler"
    property_type: str = "departamentos"
    location: str = "lima"
    bedrooms: int = 2

    def __post_init__(self) -> None:
        if self.bedrooms not in SEGMENTS:
            raise ValueError(f"bedrooms must be one of {SEGMENTS}")

    def page_url(self, base_url: str, page: Column) -> Column:
        """BR8: search address of a 1-based page number."""
        slug = f"{self.operation}-de-{self.property_type}-en-{self.location}"
        head = f"{base_url}/buscar/{slug}?bedroomsNumber={self.bedrooms}&page="
        return F.concat(F.lit(head), page.cast("string"))


def known_segment(bedrooms: Column) -> Column:
    """BR18 as a predicate over manifests."""
    return bedrooms.isin(*SEGMENTS)


def strict_date(text: str) -> date:
    """SI1/SV11: ISO ``YYYY-MM-DD`` or ValueError."""
    parsed = date.fromisoformat(text.strip())
    if parsed.isoformat() != text.strip():
        raise ValueError(f"expected YYYY-MM-DD, got {text!r}")
    return parsed


def build_session(app: str = "plazalake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs are written for."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Percentile sketches need object buffers; the default of 128 groups
        # would send almost every market cube through a sort.
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
        # The JVM never compiles a method above 8000 bytes of bytecode; stages
        # full of parsing expressions run faster as separate operators then.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
