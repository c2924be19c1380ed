"""Landed JSON files: readers with rescue, and the landing and manifest sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from plazalake.operators.typing import key_manifests, key_observations, stamp_paths
from plazalake.schemas import LISTING_SCHEMA, MANIFEST_SCHEMA


_ENTRIES = "map<string,string>"


def _lost(entries: Column, parsed: Column, schema: StructType, path: str) -> Column:
    """Map of dotted path to text of those ``entries`` of a JSON object that ``parsed`` doesn't hold."""
    holds = {f.name: parsed[f.name].isNotNull() for f in schema}
    for f in schema:
        if isinstance(f.dataType, ArrayType):  # elements that became texts differ from the source
            same = F.to_json(parsed[f.name]) == F.try_element_at(entries, F.lit(f.name))
            holds[f.name] = holds[f.name] & F.coalesce(same, F.lit(False))
    held = F.array_compact(F.array(*[F.when(ok, F.lit(name)) for name, ok in holds.items()]))
    known = F.array(*[F.lit(name) for name in holds])
    lost = F.map_filter(
        entries,
        lambda key, value: ~F.array_contains(held, key)
        & (value.isNotNull() | ~F.array_contains(known, key)),
    )
    return F.transform_keys(lost, lambda key, _: F.concat(F.lit(path), key))


def _objects(schema: StructType, path: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], StructType]]:
    """Every object of a schema, by the names that lead to it, outer ones first."""
    inner = [_objects(f.dataType, (*path, f.name)) for f in schema if isinstance(f.dataType, StructType)]
    return [(path, schema), *(found for part in inner for found in part)]


def _computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add ``columns`` so that what reads them later doesn't compute them again."""
    return df.withColumns(columns).select(F.inline(F.array(F.struct("*"))))


def parse_landed(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Typed columns plus ``_rescued_data`` from a JSON text column (IO5).

    ``_rescued_data`` is JSON of every entry the schema did not take, at any depth, by dotted
    path. That is unknown keys, and known keys whose value did not fit the declared type. A line
    that is no JSON object is kept whole.

    A line is parsed twice, as the schema and as entries, and each object inside once more.
    """
    others = [c for c in df.columns if c != value]
    line, objects = F.col(value), _objects(schema)
    names = {path: f"_entries{i}" for i, (path, _) in enumerate(objects)}
    rows = _computed(df, {"_parsed": F.from_json(line, schema), names[()]: F.from_json(line, _ENTRIES)})

    def typed(path: tuple[str, ...]) -> Column:
        column = F.col("_parsed")
        for name in path:
            column = column[name]
        return column

    for depth in range(1, max(len(path) for path, _ in objects) + 1):
        inside = {}
        for path in (p for p, _ in objects if len(p) == depth):
            text = F.try_element_at(F.col(names[path[:-1]]), F.lit(path[-1]))
            inside[names[path]] = F.when(typed(path).isNotNull(), F.from_json(text, _ENTRIES))
        rows = _computed(rows, inside)
    nothing = F.create_map().cast(_ENTRIES)
    lost = F.map_concat(
        *[
            F.coalesce(_lost(F.col(names[p]), typed(p), fields, "".join(f"{n}." for n in p)), nothing)
            for p, fields in objects
        ]
    )
    rows = _computed(rows, {"_lost": lost})
    broken = F.to_json(F.create_map(F.lit("_corrupt_record"), line))
    rescued = F.when(F.col(names[()]).isNull(), broken).when(F.size("_lost") > 0, F.to_json("_lost"))
    return rows.select("_parsed.*", rescued.alias("_rescued_data"), *others)


def _with_lineage(df: DataFrame) -> DataFrame:
    """IO6: file path, modification time and load time."""
    return df.withColumns(
        {
            "_bronze_source_file": F.col("_metadata.file_path"),
            "_bronze_file_modification_time": F.col("_metadata.file_modification_time"),
            "_bronze_loaded_at": F.current_timestamp(),
        }
    )


def bronze_listings(lines: DataFrame) -> DataFrame:
    """IO3, IO5-IO7, BR10 over landed text lines (batch or stream)."""
    kept = _with_lineage(lines).select(
        "value",
        "_bronze_source_file",
        "_bronze_file_modification_time",
        "_bronze_loaded_at",
    )
    return key_observations(stamp_paths(parse_landed(kept, LISTING_SCHEMA)))


def bronze_manifests(documents: DataFrame) -> DataFrame:
    """IO4, IO5-IO7, BR11, BR12 over whole manifest documents (batch or stream)."""
    kept = _with_lineage(documents).select(
        "value",
        "_bronze_source_file",
        "_bronze_file_modification_time",
        "_bronze_loaded_at",
    )
    return key_manifests(stamp_paths(parse_landed(kept, MANIFEST_SCHEMA)))


def read_inferred(spark: SparkSession, path: str, glob: str = "*.json*") -> DataFrame:
    """IO10 + BR15: schema inferred from the files, day taken from the scrape time."""
    raw = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).json(path)
    )
    return raw.withColumns(
        {
            "_bronze_source_file": F.col("_metadata.file_path"),
            "_bronze_loaded_at": F.current_timestamp(),
            "ingest_date": F.col("_ingested_at").try_cast("timestamp").cast("date"),
        }
    )


def newest_file(spark: SparkSession, path: str, glob: str = "*.jsonl") -> str:
    """IO11: most recently modified matching file; FileNotFoundError when there is none.

    File metadata only: contents are never opened.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "modificationTime")
    )
    newest = files.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no {glob} below {path}")
    return newest


# --- sinks ------------------------------------------------------------------


def landing_folders(df: DataFrame, source: str) -> DataFrame:
    """IO18: Hive-style folder values; the property key is singular."""
    return df.withColumns(
        {
            "source": F.lit(source),
            "operation": F.col("_search_params.operation"),
            "property": F.expr("trim(TRAILING 's' FROM _search_params.property_type)"),
            "bedrooms": F.col("_search_params.bedrooms"),
            "run": F.col("_run_id"),
        }
    )


def write_landing(df: DataFrame, root: str, source: str) -> None:
    """IO18: NDJSON below ``source/operation/property/bedrooms/ingest_date/run``.

    ``df`` holds landing-schema columns plus ``ingest_date``. Rewriting a run
    replaces its folder, other runs stay. The rebalance keeps files even when
    one run is much larger than the others.
    """
    folders = ["source", "operation", "property", "bedrooms", "ingest_date", "run"]
    landed = landing_folders(df, source).select(*LISTING_SCHEMA.fieldNames(), *folders)
    (
        landed.hint("rebalance", *[F.col(c) for c in folders[3:]])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy(*folders)
        .json(root)
    )


def manifests_of(landed: DataFrame, source: str, runs: DataFrame | None = None) -> DataFrame:
    """IO19: one manifest record per run, with the legacy field names.

    ``runs`` (run_id, ingest_date, search_params, pages_scraped, started_at, completed_at,
    status, error) names the runs, those that landed nothing included; without it the
    landed rows do, as successful ones.
    """
    keys = ["_run_id", "ingest_date"]
    if runs is None:
        pages = landed.groupBy(*keys, "_page_num").agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min("_ingested_at").alias("_first"),
            F.max("_ingested_at").alias("_last"),
            F.any_value("_search_params").alias("_search"),
        )
        per_run = pages.groupBy(*keys).agg(
            F.sum("_rows").alias("records_written"),
            F.count("_page_num").cast("int").alias("pages_scraped"),
            F.min("_first").alias("started_at"),
            F.max("_last").alias("completed_at"),
            F.any_value("_search").alias("search_params"),
            F.lit("success").alias("status"),
            F.lit(None).cast("string").alias("error"),
        )
    else:
        counts = landed.groupBy(*keys).agg(F.count(F.lit(1)).alias("records_written"))
        per_run = runs.withColumnRenamed("run_id", "_run_id").join(counts, keys, "left")
        per_run = per_run.withColumn("records_written", F.coalesce("records_written", F.lit(0)))
    folder = F.concat_ws(
        "/",
        F.concat(F.lit("source="), F.lit(source)),
        F.concat(F.lit("operation="), F.col("search_params.operation")),
        F.concat(
            F.lit("property="), F.expr("trim(TRAILING 's' FROM search_params.property_type)")
        ),
        F.concat(F.lit("bedrooms="), F.col("search_params.bedrooms").cast("string")),
        F.concat(F.lit("ingest_date="), F.col("ingest_date").cast("string")),
    )
    data_file = F.concat(F.lit("run="), F.col("_run_id"))  # the run's folder of part files
    return per_run.select(
        F.col("_run_id").alias("run_id"),
        "status",
        "records_written",
        F.col("records_written").alias("record_count"),
        "pages_scraped",
        "started_at",
        "completed_at",
        F.col("completed_at").alias("finished_at"),
        "search_params",
        data_file.alias("data_file"),
        F.concat_ws("/", folder, data_file).alias("data_path"),
        folder.alias("partition"),
        "error",
        "ingest_date",
    )


def write_manifests(manifests: DataFrame, root: str, source: str) -> None:
    """IO19: one JSON document per run below the run's folder."""
    folders = ["source", "operation", "property", "bedrooms", "ingest_date", "run"]
    documents = manifests.select(
        F.to_json(F.struct(*MANIFEST_SCHEMA.fieldNames())).alias("value"),
        F.lit(source).alias("source"),
        F.col("search_params.operation").alias("operation"),
        F.expr("trim(TRAILING 's' FROM search_params.property_type)").alias("property"),
        F.col("search_params.bedrooms").alias("bedrooms"),
        "ingest_date",
        F.col("run_id").alias("run"),
    )
    (
        documents.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .text(root)
    )
