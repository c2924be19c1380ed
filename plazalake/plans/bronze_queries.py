"""Bronze: landing, cards, keys, rescue, dedup, keyed appends, monitors."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plazalake.config import EngineConfig, SearchSpec, known_segment
from plazalake.functions.keys import stable_run_id
from plazalake.operators import cards, dedup, monitors
from plazalake.operators.joins import lookup_join
from plazalake.plans.inputs import (
    BASE_URL,
    crawl_events,
    listings,
    manifests,
    observations,
    spread_table,
    table,
)
from plazalake.plans.registry import query
from plazalake.schemas import LISTING_SCHEMA
from plazalake.sources import landed, tables
from plazalake.streaming.ingest import ingest_listings


@query(
    """SELECT event_id, day AS partition_date, seg AS partition_bedrooms, sha256(
      COALESCE(CASE WHEN event_id % 101 <> 0 THEN CAST(day AS VARCHAR) || '_b' || seg END,
        'missing_run_id') || '||' || CASE
        WHEN event_id % 97 = 0 THEN 'https://listings.example/aviso/' || user_id
        WHEN event_id % 7 = 0 THEN ' ' || user_id || ' ' ELSE CAST(user_id AS VARCHAR) END)
      AS observation_key FROM ev"""
)
def bronze_keyed_observations(spark, sf_dir):
    """IO7 + BR10."""
    return observations(spark, sf_dir).select(
        "event_id",
        F.col("_partition_ingest_date").alias("partition_date"),
        F.col("_partition_bedrooms").alias("partition_bedrooms"),
        F.col("_bronze_observation_key").alias("observation_key"),
    )


@query(
    """SELECT run_id, n AS records_written, strftime(last_ts, '%Y-%m-%dT%H:%M:%S') AS completed_second,
      sha256(run_id || '||s3://landing/source=web/operation=alquiler/property=departamento/bedrooms='
        || seg || '/ingest_date=' || CAST(run_date AS VARCHAR) || '/manifest_' || run_id || '.json')
        AS manifest_key, run_date AS partition_date FROM runs"""
)
def bronze_keyed_manifests(spark, sf_dir):
    """BR11 + BR12 + IO7."""
    return manifests(spark, sf_dir).select(
        "run_id",
        "records_written",
        F.substring("completed_at", 1, 19).alias("completed_second"),
        F.col("_bronze_manifest_key").alias("manifest_key"),
        F.col("_partition_ingest_date").alias("partition_date"),
    )


@query(
    """SELECT seg AS bedrooms, COUNT(*) AS raw_observations,
      COUNT(DISTINCT CASE WHEN event_id % 101 <> 0 THEN day END) AS runs, MAX(day) AS latest_load_day
    FROM ev GROUP BY seg"""
)
def bronze_monitor(spark, sf_dir):
    """BR16."""
    watched = monitors.bronze_monitor(observations(spark, sf_dir))
    return watched.withColumn("latest_load_day", F.to_date("latest_bronze_load")).drop(
        "latest_bronze_load"
    )


@query(
    """SELECT seg AS bedrooms, status, n AS records_written, pages AS pages_scraped, run_id,
      epoch_us(last_ts) AS completed_us FROM runs"""
)
def bronze_run_log(spark, sf_dir):
    """BR17."""
    log = monitors.run_log(manifests(spark, sf_dir))
    completed = F.unix_micros(F.col("completed_at").cast("timestamp"))
    return log.withColumn("completed_us", completed).drop("completed_at")


@query(
    """SELECT seg AS bedrooms, COUNT(*) AS manifests, seg IN (1, 2, 3, 4) AS in_domain
    FROM (SELECT CASE WHEN day(run_date) % 7 = 0 THEN NULL ELSE seg + day(run_date) % 3 - 1 END AS seg FROM runs)
    GROUP BY seg"""
)
def bronze_search_domain(spark, sf_dir):
    """BR18 as a check over manifests, some of which searched beyond the segments or for none."""
    searched = F.expr(
        """CASE WHEN day(_partition_ingest_date) % 7 <> 0
        THEN search_params.bedrooms + day(_partition_ingest_date) % 3 - 1 END"""
    )
    return (
        manifests(spark, sf_dir)
        .groupBy(searched.cast("int").alias("bedrooms"))
        .agg(F.count(F.lit(1)).alias("manifests"))
        .withColumn("in_domain", known_segment(F.col("bedrooms")))
    )


@query(
    """SELECT event_id, 'https://listings.example/buscar/alquiler-de-departamentos-en-lima?bedroomsNumber=2&page='
      || page AS source_url, page AS page_num, 'scheduled__' || CAST(day AS VARCHAR) || 'T05_00_00_00_00_b'
      || seg AS run_id, 2 AS searched_bedrooms FROM ev"""
)
def bronze_search_stamp(spark, sf_dir):
    """BR8 + BR9: search metadata with a run id made from a scheduler's id."""
    ev = crawl_events(spark, sf_dir)
    external = F.concat(F.lit("_scheduled__"), F.col("day").cast("string"), F.lit("T05:00:00+00:00"))
    stamped = cards.stamp_search(
        ev,
        SearchSpec(bedrooms=2),
        BASE_URL,
        stable_run_id(external, F.col("seg")),
        F.col("page"),
        F.col("ts").cast("string"),
    )
    return stamped.select(
        "event_id",
        F.col("_source_url").alias("source_url"),
        F.col("_page_num").alias("page_num"),
        F.col("_run_id").alias("run_id"),
        F.col("_search_params.bedrooms").alias("searched_bedrooms"),
    )


CARD_HTML = """concat('<div data-qa="posting PROPERTY" data-id="', user_id,
  '" data-posting-type="PROPERTY" data-to-posting="', CASE WHEN event_id % 3 = 0
  THEN 'https://other.example' ELSE '' END, '/aviso/', user_id, '"><div data-qa="POSTING_CARD_PRICE">
  S/ ', amount, '<br> </div><span data-qa="expensas"> </span><div>Av. ', area, ' &amp; Cia</div>
  <h2 data-qa="POSTING_CARD_LOCATION">Zona ', seg, CASE WHEN event_id % 5 = 0 THEN ''
  WHEN event_id % 7 = 0 THEN ', , Norte, <b>Lima</b>' ELSE ', <b>Lima</b>' END,
  '</h2><h3 data-qa="POSTING_CARD_FEATURES"><span>', CASE WHEN event_id % 4 = 0
  THEN concat(10 + event_id % 90, ' un.') ELSE '' END, '</span><span>', area, ' a ', area + 5,
  ' m² tot.</span><span>', seg, ' dorm.</span><span>1 baño</span></h3>
  <p data-qa="POSTING_CARD_DESCRIPTION">', props, '</p><i class="pill pill-item-feature">', event_type,
  '</i><i class="pill-item-feature-x"> </i><img src="/img/', event_id, '.jpg"></div>')"""


def card_pages(spark, sf_dir):
    """Result pages in the crawled markup, one or two cards each, one page per event."""
    second = CARD_HTML.replace('data-id="\', user_id', 'data-id="\', user_id + 1')
    return crawl_events(spark, sf_dir).selectExpr(
        "event_id",
        "day",
        "seg",
        "page",
        "concat('https://listings.example/buscar/', event_id) AS url",
        f"""concat('<!DOCTYPE html><html><body><div><p>avisos</p>', {CARD_HTML}, '<p>',
          CASE WHEN event_id % 6 = 0 THEN {second} ELSE '' END, '</div></body></html>') AS html""",
    )


@query(
    """SELECT event_id, CAST(k AS INTEGER) AS position, CAST(user_id + k AS VARCHAR) AS listing_id,
      'PROPERTY' AS listing_type, CASE WHEN event_id % 3 = 0 THEN 'https://other.example'
        ELSE 'https://listings.example' END || '/aviso/' || user_id AS url,
      'S/ ' || amount AS price_raw, CAST(NULL AS VARCHAR) AS maintenance_raw,
      area || ' a ' || (area + 5) AS area_raw, CAST(seg AS VARCHAR) AS bedrooms_raw,
      '1' AS bathrooms_raw,
      CASE WHEN event_id % 4 = 0 THEN CAST(10 + event_id % 90 AS VARCHAR) END AS units_raw,
      'Av. ' || area || ' & Cia' AS street, 'Zona ' || seg AS district,
      CASE WHEN event_id % 5 <> 0 THEN 'Lima' END AS city,
      'Zona ' || seg || CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 7 = 0
        THEN ', , Norte, Lima' ELSE ', Lima' END AS address_raw,
      event_type AS features, props AS description,
      'https://listings.example/img/' || event_id || '.jpg' AS image_url
    FROM ev, (VALUES (0), (1)) AS t(k) WHERE k = 0 OR event_id % 6 = 0"""
)
def bronze_page_cards(spark, sf_dir):
    """BR1-BR5: cards of crawled pages as listing records."""
    found = cards.card_listings(cards.extract_cards(card_pages(spark, sf_dir)), BASE_URL)
    return found.select(
        "event_id", F.col("_position").alias("position"), "listing_id", "listing_type", "url",
        "price_raw", "maintenance_raw", "area_raw", "bedrooms_raw", "bathrooms_raw", "units_raw",
        "street", "district", "city", "address_raw", F.concat_ws("|", "features").alias("features"),
        "description", "image_url",
    )


@query(
    """SELECT page_id, CAST(page_id AS VARCHAR) AS listing_id, 'https://listings.example/p/' || page_id
      AS url, 'article' AS listing_type, COUNT(*) AS cards FROM pages
    WHERE html LIKE '%<article>%' GROUP BY ALL"""
)
def bronze_marked_pages(spark, sf_dir):
    """BR5 on the raw web pages: each article is marked up as a card and found again."""
    marked = spread_table(spark, sf_dir, "pages", "page_id").selectExpr(
        "page_id",
        "url AS page_url",
        "url",
        """replace(html, '<article>', concat('<article data-qa="posting WEB" data-id="', page_id,
           '" data-posting-type="article" data-to-posting="/p/', page_id, '">')) AS html""",
    )
    found = cards.card_listings(cards.extract_cards(marked), BASE_URL)
    return found.groupBy("page_id", "listing_id", "url", "listing_type").agg(
        F.count(F.lit(1)).alias("cards")
    )


def crawl(spark, sf_dir):
    """Events as the cards of a crawl: run by day and segment, page by hour."""
    return listings(spark, sf_dir).selectExpr(
        "event_id AS _position",
        "concat(cast(day AS string), '_b', seg) AS _run_id",
        "_page_num",
        "CASE WHEN _position % 97 = 0 THEN '' ELSE trim(listing_id) END AS listing_id",
        "CASE WHEN _position % 194 = 0 THEN NULL ELSE url END AS url",
        "_raw",
    )


CRAWL = """(SELECT event_id, CAST(day AS VARCHAR) || '_b' || seg AS run_id, page,
    CASE WHEN event_id % 97 <> 0 THEN CAST(user_id AS VARCHAR)
      WHEN event_id % 194 <> 0 THEN 'https://listings.example/aviso/' || user_id
      ELSE 'raw ' || user_id || event_type || amount END AS card_key FROM ev)"""


@query(
    f"""SELECT run_id, page AS page_num, event_id FROM {CRAWL}
    QUALIFY row_number() OVER (PARTITION BY run_id, card_key ORDER BY page, event_id) = 1"""
)
def bronze_first_seen_cards(spark, sf_dir):
    """BR6."""
    return dedup.first_seen_cards(crawl(spark, sf_dir)).select(
        F.col("_run_id").alias("run_id"),
        F.col("_page_num").alias("page_num"),
        F.col("_position").alias("event_id"),
    )


@query(
    f"""SELECT run_id, page_num, found, new, CAST(SUM(new) OVER (PARTITION BY run_id ORDER BY page_num)
        AS BIGINT) AS total, new = 0 AS is_end
    FROM (SELECT *, MIN(CASE WHEN new = 0 THEN page_num END) OVER (PARTITION BY run_id) AS last_page
      FROM (SELECT run_id, page AS page_num, COUNT(*) AS found,
          COUNT(*) FILTER (WHERE rn = 1) AS new
        FROM (SELECT *, row_number() OVER (PARTITION BY run_id, card_key ORDER BY page, event_id) AS rn
          FROM {CRAWL}) GROUP BY run_id, page))
    WHERE last_page IS NULL OR page_num <= last_page"""
)
def bronze_page_yield(spark, sf_dir):
    """BR7."""
    return dedup.page_yield(crawl(spark, sf_dir)).withColumnsRenamed(
        {"_run_id": "run_id", "_page_num": "page_num"}
    )


@query(
    """SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN CAST(user_id AS VARCHAR) END AS listing_id,
      CASE WHEN event_id % 6 <> 0 AND event_id % 5 <> 0 THEN CAST(amount AS DOUBLE) END AS price_min,
      CASE WHEN event_id % 6 <> 0 THEN page END AS page_num,
      CASE WHEN event_id % 6 <> 0 AND event_id % 7 <> 0 THEN seg END AS searched,
      CASE WHEN event_id % 6 = 0 THEN '{"_corrupt_record":"not json ' || event_id || '"}'
        WHEN len(lost) > 0 THEN '{' || array_to_string(lost, ',') || '}' END AS rescued
    FROM (SELECT *, list_filter([
        CASE WHEN event_id % 5 = 0 THEN '"price_min":"cheap' || amount || '"' END,
        CASE WHEN event_id % 9 = 0 THEN '"features":"[\\"a\\",{\\"b\\":' || seg || '}]"' END,
        CASE WHEN event_id % 4 = 0 THEN '"floor":"' || seg || '"' END,
        CASE WHEN event_id % 7 = 0 THEN '"_search_params.bedrooms":"two"' END,
        CASE WHEN event_id % 11 = 0 THEN '"_search_params.newkey":"5"' END,
        CASE WHEN event_id % 13 = 0 THEN '"_raw.floor":"' || page || '"' END],
        lambda x: x IS NOT NULL) AS lost FROM ev)"""
)
def bronze_rescued_lines(spark, sf_dir):
    """IO5: unknown keys, mistyped values and broken lines are kept as rescued data."""
    lines = crawl_events(spark, sf_dir).selectExpr(
        "event_id",
        """CASE WHEN event_id % 6 = 0 THEN concat('not json ', event_id) ELSE concat(
          '{"listing_id":"', user_id, '","price_min":',
          CASE WHEN event_id % 5 = 0 THEN concat('"cheap', amount, '"') ELSE cast(amount AS string) END,
          ',"_page_num":', page, ',"currency":null',
          CASE WHEN event_id % 9 = 0 THEN concat(',"features":["a",{"b":', seg, '}]')
            ELSE ',"features":["a","b \\\\"c\\\\""]' END,
          CASE WHEN event_id % 4 = 0 THEN concat(',"floor":', seg) ELSE '' END,
          ',"_search_params":{"bedrooms":', CASE WHEN event_id % 7 = 0 THEN '"two"' ELSE cast(seg AS string) END,
          CASE WHEN event_id % 11 = 0 THEN ',"newkey":5' ELSE '' END, '}',
          CASE WHEN event_id % 13 = 0 THEN concat(',"_raw":{"price":"1","floor":', page, '}') ELSE '' END,
          '}') END AS value""",
    )
    return landed.parse_landed(lines, LISTING_SCHEMA).select(
        "event_id",
        "listing_id",
        "price_min",
        F.col("_page_num").alias("page_num"),
        F.col("_search_params.bedrooms").alias("searched"),
        F.col("_rescued_data").alias("rescued"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, arg_max(l_extendedprice, (l_shipdate, l_extendedprice,
      l_partkey)) AS l_extendedprice FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM lineitem t WHERE t.l_orderkey = l.l_orderkey
      AND t.l_linenumber = l.l_linenumber AND t.l_shipdate < TIMESTAMP '1998-01-01')
    GROUP BY l_orderkey, l_linenumber"""
)
def bronze_insert_only_rows(spark, sf_dir):
    """BR13 as a relation: rows a keyed insert would add to the lines already shipped."""
    lines = table(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    stored = lines.where("l_shipdate < timestamp_ntz'1998-01-01 00:00:00'").select(*key)
    order = [F.col(c).desc() for c in ("l_shipdate", "l_extendedprice", "l_partkey")]
    fresh = dedup.top_per_key(lines, key, order).join(stored, key, "left_anti")
    return fresh.select(*key, "l_extendedprice")


@query(
    """SELECT event_id, CASE WHEN event_id % 101 <> 0 THEN CAST(day AS VARCHAR) || '_b' || seg END AS run_id
    FROM ev e WHERE event_id % 101 = 0 OR NOT EXISTS (SELECT 1 FROM runs r
      WHERE r.run_date = e.day AND r.seg = e.seg AND day(r.run_date) <= 15)"""
)
def bronze_unseen_runs(spark, sf_dir):
    """BR14/JN10: rows of runs not stored yet; rows without a run always qualify."""
    stored = (
        manifests(spark, sf_dir)
        .where("day(_partition_ingest_date) <= 15")
        .select(F.col("run_id").alias("_run_id"))
    )
    fresh = lookup_join(
        observations(spark, sf_dir), stored, ["_run_id"], "left_anti"
    )
    return fresh.select("event_id", F.col("_run_id").alias("run_id"))


def scratch_product(spark) -> EngineConfig:
    """Empty data product below the shared scratch folder."""
    root = f"{tables.scratch_root(spark)}/{uuid.uuid4().hex}"
    config = EngineConfig(
        namespace=f"plaza_{uuid.uuid4().hex[:12]}",
        raw_path=f"{root}/raw",
        checkpoint_root=f"{root}/checkpoints",
    )
    for layer in ("bronze", "silver", "gold"):
        tables.create_database(spark, config.database(layer), f"{root}/{layer}")
    return config


@query(
    """SELECT day AS partition_date, COUNT(DISTINCT seg) AS runs,
      COUNT(DISTINCT seg || '|' || CASE
        WHEN event_id % 97 = 0 THEN 'https://listings.example/aviso/' || user_id
        WHEN event_id % 7 = 0 THEN ' ' || user_id || ' ' ELSE CAST(user_id AS VARCHAR) END)
      AS observations FROM ev GROUP BY 1"""
)
def bronze_stream_ingest(spark, sf_dir):
    """IO1, IO8, IO18, BR13: land daily runs as files, stream them twice, read the table."""
    config = scratch_product(spark)
    rows = listings(spark, sf_dir).withColumns(
        {
            "ingest_date": F.col("day"),
            "_run_id": F.expr("concat(cast(day AS string), '_b', seg)"),
        }
    )
    landed.write_landing(rows, f"{config.raw_path}listings", "web")
    ingest_listings(spark, config)
    ingest_listings(spark, config)  # nothing new: adds nothing
    held = spark.table(config.listings_raw)
    return held.groupBy(F.col("_partition_ingest_date").alias("partition_date")).agg(
        F.countDistinct("_run_id").alias("runs"), F.count(F.lit(1)).alias("observations")
    )


@query(
    """SELECT run_id, n AS records_written, pages AS pages_scraped, 'source=web/operation=alquiler/'
      || 'property=departamento/bedrooms=' || seg || '/ingest_date=' || CAST(run_date AS VARCHAR)
      || '/run=' || run_id AS data_path
    FROM (SELECT CAST(day AS VARCHAR) || '_b' || seg AS run_id, day AS run_date, seg, COUNT(*) AS n,
      CAST(COUNT(DISTINCT page) AS INTEGER) AS pages FROM ev GROUP BY day, seg)"""
)
def bronze_manifests_of_landing(spark, sf_dir):
    """IO19: manifests computed from the landed rows."""
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
    return landed.manifests_of(rows, "web").select(
        "run_id", "records_written", "pages_scraped", "data_path"
    )


@query(
    """SELECT CAST(run_date AS VARCHAR) || '_b' || seg AS run_id, CASE WHEN seg <> 4 THEN n ELSE 0 END AS records_written,
      CAST(pages + 1 AS INTEGER) AS pages_scraped,
      CASE WHEN (day(run_date) + seg) % 11 = 0 THEN 'failed' ELSE 'success' END AS status,
      CASE WHEN (day(run_date) + seg) % 11 = 0 THEN 'timeout' END AS error
    FROM (SELECT day AS run_date, seg, COUNT(*) AS n, MAX(page) AS pages FROM ev GROUP BY day, seg)"""
)
def bronze_manifests_of_runs(spark, sf_dir):
    """IO19: every run closes with a manifest, failed runs and those that found nothing too."""
    run = "concat(cast(day AS string), '_b', seg)"
    search = "named_struct('operation', 'alquiler', 'property_type', 'departamentos', 'location', 'lima', 'bedrooms', seg)"
    rows = listings(spark, sf_dir).withColumns(
        {"ingest_date": F.col("day"), "_run_id": F.expr(run), "_search_params": F.expr(search)}
    )
    failed = "(day(day) + seg) % 11 = 0"
    runs = (
        crawl_events(spark, sf_dir)
        .groupBy("day", "seg")
        .agg(F.max("page").alias("pages"))
        .selectExpr(
            f"{run} AS run_id", "day AS ingest_date", f"{search} AS search_params", "pages + 1 AS pages_scraped",
            "cast(NULL AS string) AS started_at", "cast(NULL AS string) AS completed_at",
            f"CASE WHEN {failed} THEN 'failed' ELSE 'success' END AS status",
            f"CASE WHEN {failed} THEN 'timeout' END AS error",
        )
    )
    return landed.manifests_of(rows.where("seg <> 4"), "web", runs=runs).select(
        "run_id", "records_written", "pages_scraped", "status", "error"
    )
