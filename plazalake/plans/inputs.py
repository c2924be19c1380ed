"""Listing-like Bronze inputs derived from the benchmark tables.

``events`` are read as crawled observations: the user is the listing, the day
and ``1 + user % 4`` give the run. Text fields are composed the way the landing
files spell them, and some ids carry a defect (missing id, wrong segment, zero
area, unreadable timestamp ...) so that every parser branch and rule is hit.
All rows of the table are used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalake.operators.joins import lookup_join
from plazalake.operators.typing import key_manifests, key_observations, stamp_paths
from plazalake.sources.tables import compiled, scratch_root

BASE_URL = "https://listings.example"


_FRAMES: dict[tuple[str, ...], DataFrame] = {}


def _once(spark: SparkSession, key: tuple[str, ...], build: Callable[[], DataFrame]) -> DataFrame:
    """Build a frame once per application: files are listed and schemas read once."""
    slot = (spark.sparkContext.applicationId, *key)
    if slot not in _FRAMES:
        _FRAMES[slot] = build()
    return _FRAMES[slot]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return _once(spark, ("table", path), lambda: spark.read.parquet(path))


def stored(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    build: Callable[[], DataFrame],
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """A layer table derived from ``sf_dir``, written once per application and read back.

    Later layers read the tables of earlier ones, as scheduled jobs do, instead
    of repeating their parsing in every branch of a plan.
    """

    def write_and_read() -> DataFrame:
        app = spark.sparkContext.applicationId
        tag = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
        path = f"{scratch_root(spark)}/{app}/{tag}/{name}"
        rows = build()
        if partition_by:
            rows = rows.hint("rebalance", *[F.col(c) for c in partition_by])
        with compiled(spark):
            rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return spark.read.parquet(path)

    return _once(spark, ("stored", sf_dir, name), write_and_read)


#: Rows that a task behind ``spread`` gets on average at most: of tables whose texts are parsed,
#: and of those that are only sorted and joined.
SPREAD_ROWS, SORTED_ROWS = 50_000, 500_000


def spread(df: DataFrame, key: str, task_rows: int | None = None) -> DataFrame:
    """Deal the rows to tasks evenly, at least one for each core, more as the table grows.

    Files are split by bytes, but a split gets the row groups that begin in it: of a file of few
    row groups most splits are empty, and all work before a shuffle would run in a few tasks. So the
    rows of each split are counted, from the files' footers alone; a table that
    its files deal evenly passes unchanged.
    """
    tasks, even = _tasks(df, task_rows)
    return df if even else df.repartition(tasks, key)


def _tasks(df: DataFrame, task_rows: int | None = None) -> tuple[int, bool]:
    """How many tasks the rows of files ask for, and whether the splits deal them evenly to as many."""
    splits = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n"))
    rows, most = splits.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // (task_rows or SPREAD_ROWS)))
    return tasks, most * tasks <= 2 * rows


def spread_table(
    spark: SparkSession, sf_dir: str, name: str, key: str, task_rows: int | None = None
) -> DataFrame:
    return _once(
        spark,
        ("spread", sf_dir, name, str(task_rows)),
        lambda: spread(table(spark, sf_dir, name), key, task_rows),
    )


def crawl_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _crawled(spread_table(spark, sf_dir, "events", "event_id"))


def _crawled(events: DataFrame, *more: str) -> DataFrame:
    return events.selectExpr(
        *more, "event_id", "ts", "user_id", "event_type", "value", "props",
        "cast(ts AS date) AS day",
        "cast(1 + user_id % 4 AS int) AS seg",
        "cast(floor(value * 10) AS bigint) AS amount",
        "20 + user_id % 60 AS area",
        "cast(1 + hour(ts) AS int) AS page",
    )


RUN = "concat(cast(day AS string), '_b', seg)"
FOLDER = (
    "concat('s3://landing/source=web/operation=alquiler/property=departamento/bedrooms=', seg, "
    "'/ingest_date=', cast(day AS string), '/')"
)
PRICE_TEXT = (
    "CASE WHEN amount >= 1000 THEN concat(amount div 1000, ',', lpad(amount % 1000, 3, '0')) "
    "ELSE cast(amount AS string) END"
)


def _iso(column: str) -> str:
    return f"concat(replace(cast({column} AS string), ' ', 'T'), '+00:00')"


def placed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawled events with the district of their user, dealt to tasks by their number.

    They are dealt behind the joins: a join with more users than are broadcast shuffles the
    narrow events, and its tasks are cut by bytes, too coarsely for texts that are composed
    and parsed afterwards. Dealt to more than 200 tasks, the rows of a split are held in memory
    until they are written, so columns that derive from others are added behind that.
    """

    def dealt() -> DataFrame:
        events = table(spark, sf_dir, "events")
        customer = table(spark, sf_dir, "customer").selectExpr(
            "c_custkey AS user_id", "c_nationkey AS n_nationkey"
        )
        nation = table(spark, sf_dir, "nation").selectExpr(
            "n_nationkey", "concat(' ', translate(n_name, 'AO', 'ÁÓ')) AS district"
        )
        placed = lookup_join(lookup_join(events, customer, ["user_id"]), nation, ["n_nationkey"])
        dealt_rows = placed.drop("n_nationkey").repartition(_tasks(events)[0], "event_id")
        return _crawled(dealt_rows, "district")

    return _once(spark, ("placed", sf_dir), dealt)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing records (landing schema) plus ``event_id``, ``seg`` and ``day``."""
    return placed_events(spark, sf_dir).selectExpr(
        "event_id", "seg", "day",
        """CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 7 = 0 THEN concat(' ', user_id, ' ')
           ELSE cast(user_id AS string) END AS listing_id""",
        "CASE WHEN event_id % 2 = 0 THEN ' PROPERTY ' ELSE 'DEVELOPMENT' END AS listing_type",
        f"concat('{BASE_URL}/aviso/', user_id) AS url",
        f"""CASE event_type WHEN 'error' THEN 'Consultar precio'
            WHEN 'purchase' THEN concat('US$ ', {PRICE_TEXT})
            WHEN 'signup' THEN concat('Departamentos desde S/ ', {PRICE_TEXT})
            ELSE concat('S/ ', {PRICE_TEXT}) END AS price_raw""",
        "CASE WHEN event_id % 4 = 0 THEN concat('S/ ', amount, ' Mantenimiento') END AS maintenance_raw",
        "CASE WHEN event_id % 2 = 0 THEN ' usd ' WHEN event_id % 3 = 0 THEN 'pen' END AS currency",
        "CASE WHEN event_id % 29 = 0 THEN amount + 0.5D END AS price_min",
        """CASE WHEN event_id % 83 = 0 THEN '0 a 50'
           WHEN event_id % 3 = 0 THEN concat(area, ' a ', area + event_id % 30)
           WHEN event_id % 11 = 0 THEN concat(area, ',5') WHEN event_id % 17 = 0 THEN NULL
           ELSE cast(area AS string) END AS area_raw""",
        """CASE WHEN event_id % 5 = 0 THEN concat(seg, ' a ', seg + 1)
           WHEN event_id % 13 = 0 THEN NULL ELSE cast(seg AS string) END AS bedrooms_raw""",
        "CASE WHEN event_id % 19 <> 0 THEN cast(1 + user_id % 3 AS string) END AS bathrooms_raw",
        "CASE WHEN event_id % 23 = 0 THEN cast(10 + event_id % 90 AS string) END AS units_raw",
        "cast(NULL AS string) AS address_raw", "cast(NULL AS string) AS street",
        "district",
        """CASE WHEN event_id % 7 = 0 THEN NULL WHEN user_id % 5 = 0 THEN 'CALLAO'
           ELSE 'lima ' END AS city""",
        "array(event_type, props) AS features", "props AS description",
        "cast(NULL AS string) AS image_url", "concat('pub_', user_id % 10) AS publisher",
        f"CASE WHEN event_id % 211 = 0 THEN 'n/a' ELSE {_iso('ts')} END AS _ingested_at",
        f"concat('{BASE_URL}/buscar/?page=', page) AS _source_url",
        "page AS _page_num",
        f"CASE WHEN event_id % 101 <> 0 THEN {RUN} END AS _run_id",
        """named_struct('operation', 'alquiler', 'property_type', 'departamentos',
           'location', 'lima', 'bedrooms',
           CASE WHEN event_id % 89 = 0 THEN seg % 4 + 1 ELSE seg END) AS _search_params""",
        "'dom' AS _extraction_method",
        """named_struct('id', cast(user_id AS string), 'posting_type', event_type,
           'url', cast(NULL AS string), 'price', cast(amount AS string),
           'maintenance', cast(NULL AS string), 'features_text', cast(NULL AS string),
           'street', cast(NULL AS string), 'location', cast(NULL AS string),
           'description', cast(NULL AS string), 'publisher', cast(NULL AS string),
           'amenities', cast(NULL AS array<string>), 'image', cast(NULL AS string)) AS _raw""",
        f"concat({FOLDER}, 'listings_', {RUN}, '.jsonl') AS _bronze_source_file",
        "cast(day AS timestamp) AS _bronze_loaded_at",
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze observations: path partitions and technical key added."""
    return key_observations(stamp_paths(listings(spark, sf_dir)))


def raw_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest per (day, segment) of the events; segment 3 uses the legacy names."""
    per_run = (
        crawl_events(spark, sf_dir)
        .groupBy("day", "seg")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("page").alias("pages_scraped"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
    )
    return per_run.selectExpr(
        f"{RUN} AS run_id",
        """CASE WHEN (day(day) + seg) % 11 = 0 THEN 'failed' WHEN seg % 2 = 0 THEN 'Success'
           ELSE 'success' END AS status""",
        "CASE WHEN seg <> 3 THEN n END AS records_written",
        "CASE WHEN seg = 3 THEN n END AS record_count",
        "pages_scraped",
        f"{_iso('first_ts')} AS started_at",
        f"CASE WHEN seg <> 3 THEN {_iso('last_ts')} END AS completed_at",
        f"CASE WHEN seg = 3 THEN {_iso('last_ts')} END AS finished_at",
        """named_struct('operation', 'alquiler', 'property_type', 'departamentos',
           'location', 'lima', 'bedrooms', seg) AS search_params""",
        f"concat('listings_', {RUN}, '.jsonl') AS data_file",
        "cast(NULL AS string) AS error",
        f"concat({FOLDER}, 'manifest_', {RUN}, '.json') AS _bronze_source_file",
        "cast(day AS timestamp) AS _bronze_loaded_at",
    )


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze manifests. Cached: a few rows per day, read by several branches of a job.

    They are counted at once: a cached frame's size is only known when it is filled, and a join
    that doesn't know it shuffles all observations to their runs before it does.
    """

    def filled() -> DataFrame:
        rows = key_manifests(stamp_paths(raw_manifests(spark, sf_dir))).persist()
        rows.count()
        return rows

    return _once(spark, ("manifests", sf_dir), filled)
