"""Keyed table maintenance on plain Parquet tables (JN12).

Plain tables have no MERGE. Each keyed write of the data product has an exact
equivalent: insert-only is an anti join plus append, a date sync is a partition
replacement, a full sync is a staged rewrite behind a location switch.
"""

from __future__ import annotations

import hashlib
import tempfile
import threading
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plazalake.operators.dedup import require_unique, top_per_key
from plazalake.operators.joins import lookup_join
from plazalake.operators.lifecycle import newer_only
from plazalake.sources.key_index import BUCKETS, KeyIndex
from plazalake.sources.widening import check_kept, fitted_frame, merged_type

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
READER_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
#: Fixed value: the JVM never compiles a method of more bytes of bytecode, it interprets it.
COMPILED_BYTES = 8000
#: Fixed value: the folder of rows without a partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_LOCAL_SCRATCH: dict[str, str] = {}
#: How many threads hold a setting of a session, and the value that the first one met.
_HOLDERS: dict[tuple[SparkSession, str], tuple[int, str | None]] = {}
_SETTINGS = threading.Lock()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_SCRATCH[app]


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """IO17."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def ensure_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """IO12/SO2: create an empty table with the frame's schema when it is missing."""
    if not df.sparkSession.catalog.tableExists(table):
        df.limit(0).write.format("parquet").partitionBy(*partition_by).saveAsTable(table)


def _in_table_order(df: DataFrame, table: str) -> DataFrame:
    return df.select(*df.sparkSession.table(table).columns)


def _balanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Even output files: merges small and splits oversized write partitions."""
    return df.hint("rebalance", *[F.col(c) for c in columns]) if columns else df.hint("rebalance")


@contextmanager
def _held(spark: SparkSession, setting: str, value: str) -> Iterator[None]:
    """A setting of the session for the time of a write.

    While any thread holds it, it stays; the last one to end puts back what the first one met.
    """
    slot = spark, setting
    with _SETTINGS:
        holders, before = _HOLDERS.get(slot, (0, None))
        before = before if holders else spark.conf.get(setting)
        _HOLDERS[slot] = holders + 1, before
        spark.conf.set(setting, value)
    try:
        yield
    finally:
        with _SETTINGS:
            holders, before = _HOLDERS[slot]
            _HOLDERS[slot] = holders - 1, before
            if holders == 1:
                spark.conf.set(setting, before)


def _only_written_partitions(spark: SparkSession) -> AbstractContextManager[None]:
    """Overwrite the partitions a frame holds and no others, whatever the session says.

    Inserts into a catalog table obey the session setting, not a writer option.
    """
    return _held(spark, OVERWRITE_MODE, "dynamic")


def compiled(spark: SparkSession) -> AbstractContextManager[None]:
    """Run stages whose generated method the JVM wouldn't compile as separate operators.

    Composing and parsing an observation's texts makes one method of more than
    COMPILED_BYTES, and interpreted it takes twice the time.
    """
    return _held(spark, METHOD_LIMIT, str(COMPILED_BYTES))


def reading(spark: SparkSession, rows: int) -> AbstractContextManager[None]:
    """Let Spark's Parquet reader hold so many rows at a time."""
    return _held(spark, READER_ROWS, str(rows))


def _written(df: DataFrame, table: str, overwrite: bool) -> int:
    """Write once and report the number of rows written, without a second pass."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    with _only_written_partitions(df.sparkSession), compiled(df.sparkSession):
        counted.write.insertInto(table, overwrite=overwrite)
    return seen.get["rows"]


def insert_only(
    batch: DataFrame,
    table: str,
    key: str,
    order: Sequence[Column],
    partition_by: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> int:
    """BR13: add the rows whose key is not stored yet; returns how many were added.

    Replaying a batch adds nothing, so a crash between append and checkpoint
    is harmless. Stored keys come from the table's key index, the touched buckets alone.
    """
    if batch.isEmpty():
        return 0
    made = not batch.sparkSession.catalog.tableExists(table)
    ensure_table(batch, table, partition_by)
    index = KeyIndex(batch.sparkSession, table, key, buckets)
    if made or not index.catch_up():
        rows = _append(batch, table, key, order, partition_by)
    else:
        absent = index.absent(batch).withColumnRenamed(key, "_absent").persist()
        try:
            if absent.isEmpty():
                return 0
            new = batch.join(absent, F.col(key).eqNullSafe(F.col("_absent")), "left_semi")
            rows = _append(new, table, key, order, partition_by)
        finally:
            absent.unpersist()
    index.catch_up()
    return rows


def _append(df: DataFrame, table: str, key: str, order: Sequence[Column], partition_by: Sequence[str]) -> int:
    fresh = _in_table_order(top_per_key(df, [key], order), table)
    return _written(_balanced(fresh, partition_by), table, overwrite=False)


def append_new_runs(df: DataFrame, table: str, run_column: str = "_run_id") -> int:
    """BR14/JN10/IO14: append runs the table does not hold.

    New columns are added; names that differ in case alone are one column, as in queries. New
    fields inside structs and wider types rewrite the table in a new folder. Types
    without a common one raise, and so do values a common type would change, before
    anything is written. A NULL run never matches, so such rows are appended every time.
    """
    spark = df.sparkSession
    ensure_table(df, table)
    stored = spark.table(table)
    fresh = lookup_join(df, stored.select(run_column).distinct(), [run_column], "left_anti")
    wanted = merged_type(stored.schema, df.schema)
    wanted = check_kept(wanted, stored, fresh)
    held = {f.name: f.dataType for f in stored.schema}
    if any(held.get(f.name, f.dataType) != f.dataType for f in wanted):
        seen = Observation()
        counted = fitted_frame(fresh, wanted).observe(seen, F.count(F.lit(1)).alias("rows"))
        both = fitted_frame(stored, wanted).unionByName(counted)
        replace_all(both, table, f"{table_location(spark, table)}_versions")
        return seen.get["rows"]
    added = [f for f in wanted if f.name not in held]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return _written(fitted_frame(fresh, spark.table(table).schema), table, overwrite=False)


def replace_date(
    df: DataFrame, table: str, day: date, keys: Sequence[str] = (), column: str = "ingest_date"
) -> int:
    """ST2: make the table's rows of ``day`` equal ``df`` (all of that day).

    The partition is staged and swapped. An empty source writes no partition,
    so the old one is then cleared explicitly.
    """
    if keys:
        require_unique(df, keys)
    ensure_table(df, table, [column])
    ordered = _in_table_order(df, table)
    rows = _written(_balanced(ordered, ()), table, overwrite=True)
    if rows == 0:
        _clear_partition(df.sparkSession, table, f"{column}={day.isoformat()}")
    return rows


def _clear_partition(spark: SparkSession, table: str, folder: str) -> None:
    """Remove a partition's files, so that a listing of the table shows the day is gone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table_location(spark, table)}/{folder}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark.catalog.refreshTable(table)


def partition_files(spark: SparkSession, table: str, column: str = "ingest_date") -> dict[date, str]:
    """CH1/SI1: the days of a table partitioned by ``column``, with a digest of each one's files.

    Known from the listing of files alone; no data is read. Files are never changed in place
    and their names are unique, so an equal digest means equal rows.
    """
    spark.catalog.refreshTable(table)
    found: dict[date, list[str]] = {}
    for file in spark.table(table).inputFiles():
        folder, name = file.rsplit("/", 1)
        day = folder.rsplit(f"/{column}=", 1)[-1].split("/")[0]
        if day != NO_VALUE:
            found.setdefault(date.fromisoformat(day), []).append(name)
    return {day: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest() for day, names in found.items()}


def replace_dates(df: DataFrame, table: str, column: str = "ingest_date") -> int:
    """ST2 for many days at once: every day present in ``df`` is replaced."""
    ensure_table(df, table, [column])
    return _written(_balanced(_in_table_order(df, table), [column]), table, overwrite=True)


def upsert_newer(df: DataFrame, table: str, key: str, version: str, buckets: int = BUCKETS) -> int:
    """DX12: rows of ``df`` replace stored ones of an older version and join those unknown;
    returns how many rows the rewritten buckets hold.

    The table is partitioned by its keys' buckets; those that ``df`` has no key of are neither
    read nor written. The merged rows are staged, since they are read from what they replace.
    """
    spark = df.sparkSession
    require_unique(df, [key])
    dealt = df.withColumn("bucket", F.pmod(F.hash(key), F.lit(buckets)))
    ensure_table(dealt, table, ["bucket"])
    touched = [r[0] for r in dealt.select("bucket").distinct().collect()]
    if not touched:
        return 0
    stored = spark.table(table).where(F.col("bucket").isin(touched))
    merged = newer_only(stored, dealt.select(*stored.columns), key, version)
    stage = f"{scratch_root(spark)}/upsert-{uuid.uuid4().hex}"
    merged.write.parquet(stage)
    return _written(_balanced(spark.read.schema(merged.schema).parquet(stage), ["bucket"]), table, overwrite=True)


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {table}")
    return described.where(F.col("col_name") == "Location").first()["data_type"].rstrip("/")


def replace_all(df: DataFrame, table: str, base: str, keys: Sequence[str] = ()) -> None:
    """ST3/IO15: full rewrite, new schema included.

    Every version is written to a new folder below ``base`` before the table is pointed
    at it, so readers find a whole version, ``df`` may read the table it replaces, and a failed
    run leaves the old state in place. Only a new schema needs two renames, with a moment
    without a table in between. Old folders stay for readers that still scan them and
    may be removed later.
    """
    if keys:
        require_unique(df, keys)
    spark = df.sparkSession
    target = f"{base.rstrip('/')}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    with compiled(spark):
        df.write.parquet(target)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{target}'")
    elif _plain(spark.table(table).schema) == _plain(df.schema):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{target}'")
    else:
        # The schema of a path table can't be altered freely; a view can't be either, so
        # the new table is complete under its own name first and the swap is two renames.
        fresh, old = f"{table}_next", f"{table}_old"
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        spark.sql(f"CREATE TABLE {fresh} ({columns}) USING parquet LOCATION '{target}'")
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    spark.catalog.refreshTable(table)


def _plain(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def publish_view(spark: SparkSession, view: str, statement: str, comment: str) -> None:
    """IO16."""
    text = comment.replace("'", "''")
    spark.sql(f"CREATE OR REPLACE VIEW {view} COMMENT '{text}' AS {statement}")


def on_day(spark: SparkSession, table: str, day: date, column: str = "ingest_date") -> DataFrame:
    """IO13: one partition of a table."""
    return spark.table(table).where(F.col(column) == F.lit(day))
