"""IO1, IO2, IO8: finite incremental runs over newly landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalake.config import EngineConfig
from plazalake.sources.landed import bronze_listings, bronze_manifests
from plazalake.sources.tables import insert_only


def _files(spark: SparkSession, path: str, glob: str, whole: bool, max_files: int) -> DataFrame:
    # The recursive lookup keeps folder names out of the schema; partition
    # values are read from the path instead.
    return (
        spark.readStream.format("text")
        .option("wholetext", str(whole).lower())
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", str(max_files))
        .load(path)
    )


def listings_stream(
    spark: SparkSession, path: str, glob: str, max_files: int = 1000
) -> DataFrame:
    """IO1: one row per landed line."""
    return bronze_listings(_files(spark, path, glob, False, max_files))


def manifests_stream(
    spark: SparkSession, path: str, glob: str, max_files: int = 1000
) -> DataFrame:
    """IO2: one row per file; manifests may be pretty-printed over many lines."""
    return bronze_manifests(_files(spark, path, glob, True, max_files))


def _run_once(stream: DataFrame, table: str, key: str, checkpoint: str, buckets: int) -> None:
    # Newest file first, then a hash of the record: the kept duplicate does not
    # depend on task timing.
    order = [
        F.col("_bronze_file_modification_time").desc(),
        F.col("_bronze_source_file").asc(),
        F.xxhash64(F.to_json(F.struct("*"))).asc(),
    ]

    def add(batch: DataFrame, batch_id: int) -> None:
        parsed = batch.persist()  # read twice below, parsed once
        insert_only(parsed, table, key, order, ["_partition_ingest_date"], buckets)
        parsed.unpersist()

    (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def ingest_listings(spark: SparkSession, config: EngineConfig) -> None:
    """IO8: ingest every listing file not seen by the checkpoint, then stop."""
    _run_once(
        listings_stream(
            spark, config.raw_path, config.listing_glob, config.max_files_per_batch
        ),
        config.listings_raw,
        "_bronze_observation_key",
        config.checkpoint("listings"),
        config.key_buckets,
    )


def ingest_manifests(spark: SparkSession, config: EngineConfig) -> None:
    """IO8 for the run manifests."""
    _run_once(
        manifests_stream(
            spark, config.raw_path, config.manifest_glob, config.max_files_per_batch
        ),
        config.ingestion_runs,
        "_bronze_manifest_key",
        config.checkpoint("manifests"),
        config.key_buckets,
    )
