"""Keyed table writes, views and file readers, run on whole tables and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plazalake.operators import dedup, monitors
from plazalake.operators.calendar import newest_dates
from plazalake.plans import jobs
from plazalake.plans.bronze_queries import scratch_product
from plazalake.plans.inputs import SORTED_ROWS, listings, observations, spread_table, table
from plazalake.plans.registry import query
from plazalake.plans.silver_queries import REFRESH_MARKET, snapshot_table
from plazalake.sources import landed, tables
from plazalake.streaming.ingest import ingest_manifests


def _database(spark) -> tuple[str, str]:
    """A new database below the shared scratch folder, and that folder."""
    root = f"{tables.scratch_root(spark)}/{uuid.uuid4().hex}"
    name = f"plaza_{uuid.uuid4().hex[:12]}"
    tables.create_database(spark, name, f"{root}/db")
    return name, root


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate < TIMESTAMP '1998-01-01' DESC, l_shipdate DESC, l_extendedprice DESC,
          l_partkey DESC) AS rn FROM lineitem) WHERE rn = 1"""
)
def table_insert_only(spark, sf_dir):
    """BR13/JN12: early lines first, then all lines, then all again (adds nothing)."""
    name, _ = _database(spark)
    lines = spread_table(spark, sf_dir, "lineitem", "l_orderkey", SORTED_ROWS).withColumn(
        "line_key", F.concat_ws("||", "l_orderkey", "l_linenumber")
    )
    order = [F.col(c).desc() for c in ("l_shipdate", "l_extendedprice", "l_partkey")]
    early = lines.where("l_shipdate < timestamp_ntz'1998-01-01 00:00:00'")
    for batch in (early, lines, lines):
        tables.insert_only(batch, f"{name}.lines", "line_key", order)
    return spark.table(f"{name}.lines").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    """SELECT ingest_date, COUNT(*) AS listings FROM snap
    WHERE ingest_date < (SELECT MAX(ingest_date) FROM days WHERE prev_date IS NOT NULL
        AND ingest_date < (SELECT MAX(ingest_date) FROM snap))
      OR (ingest_date = (SELECT MAX(ingest_date) FROM snap) AND price_amount IS NOT NULL)
    GROUP BY ingest_date"""
)
def table_replace_days(spark, sf_dir):
    """ST2/ST4: publish all days, republish the newest without unpriced rows, empty the one before."""
    name, _ = _database(spark)
    target = f"{name}.snapshot"
    snap = snapshot_table(spark, sf_dir).select("listing_id", "price_amount", "ingest_date")
    newest, before = newest_dates(snap)
    tables.replace_dates(snap, target)
    priced = snap.where((F.col("ingest_date") == F.lit(newest)) & F.col("price_amount").isNotNull())
    tables.replace_date(priced, target, newest, keys=["ingest_date", "listing_id"])
    tables.replace_date(snap.limit(0), target, before)
    return spark.table(target).groupBy("ingest_date").agg(F.count(F.lit(1)).alias("listings"))


@query(
    """SELECT c_custkey, c_acctbal * 4 AS c_acctbal, c_mktsegment FROM customer
    WHERE c_mktsegment <> 'BUILDING'"""
)
def table_full_sync(spark, sf_dir):
    """ST3/IO15: rewrite a table from itself twice, dropping rows and changing values."""
    name, root = _database(spark)
    target, base = f"{name}.customers", f"{root}/customers"
    columns = ["c_custkey", "c_acctbal", "c_mktsegment"]
    tables.replace_all(table(spark, sf_dir, "customer").select(*columns), target, base, ["c_custkey"])
    for kept in ("true", "c_mktsegment <> 'BUILDING'"):
        doubled = spark.table(target).where(kept).withColumn("c_acctbal", F.col("c_acctbal") * 2)
        tables.replace_all(doubled, target, base)
    return spark.table(target)


@query(
    """SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders
    GROUP BY o_custkey"""
)
def table_insert_only_across_runs(spark, sf_dir):
    """BR13: years arrive one by one in daily runs; a customer stored under one run stays so."""
    name, _ = _database(spark)
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey", "o_orderkey", "cast(o_orderdate AS string) AS run", "o_orderdate"
    )
    order = [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()]
    for years in ("< 1994", "BETWEEN 1994 AND 1996", "> 1996", "> 0"):
        batch = orders.where(f"year(o_orderdate) {years}")
        tables.insert_only(batch, f"{name}.first_orders", "o_custkey", order)
    return spark.table(f"{name}.first_orders").select("o_custkey", "o_orderkey")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN floor(o_totalprice)
        ELSE o_totalprice END AS amount,
      CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' THEN o_orderpriority END AS priority
    FROM orders"""
)
def table_append_widening(spark, sf_dir):
    """IO14: whole prices first; later runs bring fractions and a field inside a struct."""
    name, _ = _database(spark)
    rows = table(spark, sf_dir, "orders")
    early = rows.where("o_orderdate < timestamp_ntz'1996-01-01 00:00:00'").selectExpr(
        "o_orderkey", "cast(floor(o_totalprice) AS bigint) AS amount",
        "named_struct('clerk', o_orderstatus) AS detail", "cast(o_orderdate AS string) AS run",
    )
    late = rows.where("o_orderdate >= timestamp_ntz'1996-01-01 00:00:00'").selectExpr(
        "o_orderkey", "cast(o_totalprice AS double) AS amount",
        "named_struct('clerk', o_orderstatus, 'priority', o_orderpriority) AS detail",
        "cast(o_orderdate AS string) AS run",
    )
    target = f"{name}.orders"
    for batch in (early, late, late):
        tables.append_new_runs(batch, target, "run")
    return spark.table(target).select("o_orderkey", "amount", F.col("detail.priority").alias("priority"))


@query(
    """SELECT o_orderkey, CAST(CASE WHEN o_orderdate < TIMESTAMP '1996-01-01'
        THEN CAST(o_orderkey + 9007199254740993 AS DECIMAL(38, 18))
        ELSE CAST(o_orderkey % 3 AS DECIMAL(37, 18)) + 0.5 END AS VARCHAR) AS amount,
      CAST(CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN o_custkey ELSE o_custkey / 4 END
        AS DECIMAL(14, 2)) AS share
    FROM orders"""
)
def table_append_exact(spark, sf_dir):
    """IO14: 64-bit numbers beyond a double's beside fractions, whole numbers beside decimals."""
    name, _ = _database(spark)
    rows = table(spark, sf_dir, "orders")
    early = rows.where("o_orderdate < timestamp_ntz'1996-01-01 00:00:00'").selectExpr(
        "o_orderkey", "CAST(o_orderkey + 9007199254740993 AS bigint) AS amount", "CAST(o_custkey AS int) AS share",
        "cast(o_orderdate AS string) AS run",
    )
    late = rows.where("o_orderdate >= timestamp_ntz'1996-01-01 00:00:00'").selectExpr(
        "o_orderkey", "CAST(o_orderkey % 3 AS double) + 0.5D AS AMOUNT", "CAST(o_custkey / 4 AS decimal(12,2)) AS share",
        "cast(o_orderdate AS string) AS run",
    )
    target = f"{name}.orders"
    for batch in (early, late, late):
        tables.append_new_runs(batch, target, "run")
    shown = F.col("amount").cast("string").alias("amount")
    return spark.table(target).select("o_orderkey", shown, F.col("share").cast("decimal(14,2)").alias("share"))


@query("SELECT * FROM latest_changed")
def listing_latest_repaired(spark, sf_dir):
    """CH7-CH10: the state carried over a new day, and repaired after days were emptied and republished."""
    config = scratch_product(spark)
    root = f"{tables.scratch_root(spark)}/{uuid.uuid4().hex}"
    snap = snapshot_table(spark, sf_dir)
    days = sorted(r[0] for r in snap.select("ingest_date").distinct().collect())

    def publish_state():
        jobs.publish_latest(spark, config, root, tables.partition_files(spark, config.snapshot))

    tables.replace_dates(snap.where(F.col("ingest_date") < F.lit(days[-1])), config.snapshot)
    publish_state()
    tables.replace_dates(snap.where(F.col("ingest_date") == F.lit(days[-1])), config.snapshot)
    publish_state()
    second = snap.where((F.col("ingest_date") == F.lit(days[1])) & ~F.col("bedrooms_min").eqNullSafe(1))
    tables.replace_date(snap.limit(0), config.snapshot, days[0])
    tables.replace_date(second, config.snapshot, days[1])
    publish_state()
    return spark.table(config.listing_latest).withColumn("features", F.concat_ws("|", "features")).drop("updated_at")


@query(
    """SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
      MAX(o_orderdate)::DATE AS order_day FROM orders GROUP BY o_custkey"""
)
def table_upsert_newer(spark, sf_dir):
    """DX12: years of orders arrive late and twice; the table keeps each customer's newest."""
    name, _ = _database(spark)
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey", "o_orderkey", "cast(o_orderdate AS date) AS order_day",
        "struct(o_orderdate, o_orderkey) AS version",
    )
    for years in ("BETWEEN 1994 AND 1995", "< 1994", "> 1995", "BETWEEN 1994 AND 1995"):
        batch = orders.where(f"year(order_day) {years}").groupBy("o_custkey").agg(
            F.max_by(F.struct(*orders.columns), "version").alias("r")
        )
        tables.upsert_newer(batch.select("r.*"), f"{name}.newest", "o_custkey", "version")
    return spark.table(f"{name}.newest").select("o_custkey", "o_orderkey", "order_day")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN CAST(date_trunc('month', o_orderdate)
        AS DATE) END AS run_month, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01'
        THEN o_orderpriority END AS o_orderpriority FROM orders
    UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders
    WHERE o_orderkey % 50 = 0 AND o_orderdate < TIMESTAMP '1998-01-01'"""
)
def table_append_runs(spark, sf_dir):
    """BR14/IO14: months as runs; later runs bring a column, rows without a run come again."""
    name, _ = _database(spark)
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderkey % 50 <> 0 THEN trunc(cast(o_orderdate AS date), 'MM') END AS run_month",
        "o_orderdate",
        "o_orderpriority",
    )
    early = rows.where("o_orderdate < timestamp_ntz'1998-01-01 00:00:00'")
    target = f"{name}.orders"
    tables.append_new_runs(early.drop("o_orderpriority"), target, "run_month")
    tables.append_new_runs(rows, target, "run_month")
    return spark.table(target).select("o_orderkey", "run_month", "o_orderpriority")


@query(REFRESH_MARKET)
def table_full_refresh(spark, sf_dir):
    """SR6/IO15: new runs arrive in two batches, the second repeating the first; everything behind
    them is recomputed and overwritten after each."""
    config = scratch_product(spark)
    root = f"{tables.scratch_root(spark)}/{uuid.uuid4().hex}"
    rows = observations(spark, sf_dir).withColumn("ingest_date", F.col("_partition_ingest_date"))
    for batch in (rows.where("seg <= 2"), rows.where("seg > 2 OR _run_id IS NOT NULL")):
        tables.append_new_runs(batch, config.table("bronze", "refreshed"))
        jobs.recompute(spark, config, root, "refreshed")
    return spark.table(config.table("gold", "refreshed")).drop("avg_price_per_m2")


@query(
    """SELECT ingest_date, bedrooms, COUNT(DISTINCT listing_id) AS listing_count
    FROM opts GROUP BY ingest_date, bedrooms"""
)
def table_published_view(spark, sf_dir):
    """IO12/IO16/IO17: the stored options view over a stored snapshot."""
    config = scratch_product(spark)
    root = f"{tables.scratch_root(spark)}/{uuid.uuid4().hex}"
    stamped = snapshot_table(spark, sf_dir).withColumn(
        "updated_at", F.col("ingest_date").cast("timestamp")
    )
    tables.replace_all(stamped, config.snapshot, root)
    jobs.publish_options(spark, config)
    return monitors.options_summary(spark.table(config.bedroom_options))


@query(
    """SELECT event_id, CAST(user_id AS VARCHAR) AS listing_id, day AS ingest_date,
      CAST(page AS BIGINT) AS page_num, CAST(seg AS BIGINT) AS searched_bedrooms FROM ev"""
)
def table_inferred_json(spark, sf_dir):
    """IO10/IO11/BR15: newest landed file(s) read with an inferred schema."""
    path = f"{tables.scratch_root(spark)}/{uuid.uuid4().hex}"
    rows = listings(spark, sf_dir).selectExpr(
        "event_id",
        "regexp_extract(url, '([0-9]+)$', 1) AS listing_id",
        "_page_num",
        "named_struct('bedrooms', seg) AS _search_params",
        "concat(cast(day AS string), 'T12:00:00+00:00') AS _ingested_at",
    )
    rows.limit(0).write.json(f"{path}/older")
    rows.write.json(f"{path}/newer")
    newest = landed.newest_file(spark, path, "*.json")
    folder = newest.rsplit("/", 1)[0]
    return landed.read_inferred(spark, folder).select(
        "event_id",
        "listing_id",
        "ingest_date",
        F.col("_page_num").alias("page_num"),
        F.col("_search_params.bedrooms").alias("searched_bedrooms"),
    )


@query(
    """SELECT CAST(day AS VARCHAR) || '_b' || seg AS run_id,
      COUNT(*) AS records_written, CAST(COUNT(DISTINCT page) AS INTEGER) AS pages_scraped,
      day AS partition_date, seg AS partition_bedrooms
    FROM ev GROUP BY ALL"""
)
def bronze_stream_manifests(spark, sf_dir):
    """IO2/IO8/IO19/BR11/BR12: daily manifests landed as documents and streamed twice."""
    config = scratch_product(spark)
    rows = listings(spark, sf_dir).withColumns(
        {
            "ingest_date": F.col("day"),
            "_run_id": F.expr("concat(cast(day AS string), '_b', seg)"),
            "_search_params": F.struct(
                F.lit("alquiler").alias("operation"),
                F.lit("departamentos").alias("property_type"),
                F.lit("lima").alias("location"),
                F.col("seg").alias("bedrooms"),
            ),
        }
    )
    landed.write_manifests(landed.manifests_of(rows, "web"), f"{config.raw_path}manifests", "web")
    ingest_manifests(spark, config)
    ingest_manifests(spark, config)
    held = spark.table(config.ingestion_runs)
    return dedup.top_per_key(held, ["run_id"], [F.col("_bronze_manifest_key")]).select(
        "run_id",
        "records_written",
        "pages_scraped",
        F.col("_partition_ingest_date").alias("partition_date"),
        F.col("_partition_bedrooms").alias("partition_bedrooms"),
    )
