"""Service levels and further indicators (DX1-DX12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plazalake.operators import calendar, lifecycle, options, quality, slo, typing
from plazalake.plans.gold_queries import market_table
from plazalake.plans.inputs import manifests, observations, table
from plazalake.plans.registry import query
from plazalake.plans.serving_queries import by_district, by_district_bedrooms
from plazalake.plans.silver_queries import judged, snapshot_table, snapshots


@query(
    """SELECT field, round(share, 9) AS share, share >= 0.99 AS met FROM (
      SELECT 'listing_id' AS field, AVG(CASE WHEN listing_id IS NOT NULL THEN 1.0 ELSE 0 END) AS share FROM cand
      UNION ALL SELECT 'price_amount', AVG(CASE WHEN price_amount IS NOT NULL THEN 1.0 ELSE 0 END) FROM cand
      UNION ALL SELECT 'area_avg_m2', AVG(CASE WHEN area_avg_m2 IS NOT NULL THEN 1.0 ELSE 0 END) FROM cand
      UNION ALL SELECT 'bedrooms_min', AVG(CASE WHEN bedrooms_min IS NOT NULL THEN 1.0 ELSE 0 END) FROM cand)"""
)
def slo_completeness(spark, sf_dir):
    """DX1."""
    fields = ["listing_id", "price_amount", "area_avg_m2", "bedrooms_min"]
    shares = slo.completeness_share(judged(spark, sf_dir), fields)
    return shares.withColumn("share", F.round("share", 9))


@query(
    """SELECT ingest_date, round(us / 3600000000.0, 6) AS hours, us / 3600000000.0 <= 24 AS met
    FROM (SELECT day AS ingest_date, epoch_us(CAST(day AS TIMESTAMP) + INTERVAL 33 HOUR
      + CASE WHEN day(day) % 4 = 0 THEN INTERVAL 24 HOUR ELSE INTERVAL 0 HOUR END) - epoch_us(MAX(ts)) AS us
      FROM ev WHERE event_id % 211 <> 0 GROUP BY day)"""
)
def slo_freshness(spark, sf_dir):
    """DX2: published at nine on the following morning (UTC), every fourth day one more day late."""
    scraped = judged(spark, sf_dir).where(F.col("observed_at").isNotNull())
    nine = F.expr(
        """to_timestamp(concat(cast(date_add(ingest_date, if(day(ingest_date) % 4 = 0, 2, 1)) AS string),
        'T09:00:00+00:00'))"""
    )
    checked = slo.freshness(scraped, "observed_at", nine)
    return checked.select("ingest_date", F.round("hours", 6).alias("hours"), "met")


@query(
    """SELECT run_date AS ingest_date, seg AS bedrooms, n AS records_written,
      lag(n) OVER w AS previous_rows, COALESCE(n < lag(n) OVER w * 0.5, FALSE) AS dropped
    FROM (SELECT * REPLACE (CASE WHEN day(run_date) % 5 = 0 THEN n // 3 ELSE n END AS n) FROM runs)
    WHERE ok WINDOW w AS (PARTITION BY seg ORDER BY run_date)"""
)
def slo_volume_guard(spark, sf_dir):
    """DX3: crawls of every fifth day break off after a third."""
    runs = manifests(spark, sf_dir).where(F.lower("status") == "success")
    day = F.col("_partition_ingest_date")
    flat = runs.select(
        day.alias("ingest_date"),
        F.col("search_params.bedrooms").alias("bedrooms"),
        F.when(F.day(day) % 5 == 0, F.expr("records_written div 3"))
        .otherwise(F.col("records_written"))
        .alias("records_written"),
    )
    return slo.volume_guard(flat, "bedrooms", "ingest_date", "records_written")


@query(
    """SELECT event_id, CAST(CASE WHEN event_id % 83 = 0 THEN 50 ELSE area + event_id % 30 END AS DOUBLE)
        AS area_min_m2, CAST(CASE WHEN event_id % 83 = 0 THEN 0 ELSE area END AS DOUBLE) AS area_max_m2
    FROM ev WHERE event_id % 2 = 0 AND (event_id % 83 = 0 OR (event_id % 3 = 0 AND event_id % 30 > 0))"""
)
def slo_inverted_areas(spark, sf_dir):
    """DX4: every second listing writes its range from the larger end."""
    raw = F.col("area_raw")
    turned = F.when(F.col("event_id") % 2 == 0, F.regexp_replace(raw, "^([0-9]+) a ([0-9]+)$", "$2 a $1"))
    bronze = observations(spark, sf_dir).withColumn("area_raw", turned.otherwise(raw))
    rows = slo.inverted_areas(typing.typed_observations(bronze, manifests(spark, sf_dir)))
    return rows.select("event_id", "area_min_m2", "area_max_m2")


@query(
    """SELECT ingest_date, rule_id, CAST(SUM(records_evaluated) AS BIGINT) AS total_records,
      CAST(SUM(valid_records) AS BIGINT) AS valid_records,
      CAST(SUM(invalid_records) AS BIGINT) AS invalid_records,
      CAST(round(CAST(SUM(invalid_records) / SUM(records_evaluated) * 100.0 AS DECIMAL(38, 9)), 2)
        AS DOUBLE) AS error_pct, bool_or(result = 'FAIL') AS failed
    FROM quality GROUP BY ingest_date, rule_id"""
)
def slo_quality_daily(spark, sf_dir):
    """DX5."""
    return slo.quality_daily(quality.quality_results(judged(spark, sf_dir)))


@query(
    """SELECT COALESCE(r.run_id, c.run_raw) AS run_id, COALESCE(r.n, 0) AS promised_rows,
      COALESCE(c.n, 0) AS landed_rows, COALESCE(r.n, 0) = COALESCE(c.n, 0) AS agrees
    FROM runs r FULL JOIN (SELECT run_raw, COUNT(*) AS n FROM cand GROUP BY run_raw) c
      ON c.run_raw = r.run_id"""
)
def slo_manifest_reconciliation(spark, sf_dir):
    """DX6."""
    return slo.reconcile(manifests(spark, sf_dir), observations(spark, sf_dir))


@query(
    """SELECT ingest_date, COUNT(*) AS rows, CAST(SUM(CAST('0x' || substr(md5(concat_ws('|',
      COALESCE(CAST(listing_id AS VARCHAR), ''), COALESCE(run_id, ''), COALESCE(district, ''),
      COALESCE(CAST(bedrooms_min AS VARCHAR), ''))), 1, 15) AS BIGINT)) AS VARCHAR) AS checksum
    FROM snap GROUP BY ingest_date"""
)
def slo_portable_checksum(spark, sf_dir):
    """DX7: a hash per day that another engine computes as well."""
    columns = ["listing_id", "run_id", "district", "bedrooms_min"]
    return slo.portable_checksum(snapshot_table(spark, sf_dir), columns, ["ingest_date"])


@query(
    """SELECT ingest_date, COUNT(*) AS rows, ingest_date <> (SELECT MAX(ingest_date) FROM snap) AS same
    FROM snap GROUP BY ingest_date"""
)
def slo_rerun_checksum(spark, sf_dir):
    """DX7: the snapshot built twice has the same rows and hashes per day, but for the newest one,
    where the second run wrote another price."""
    stored_rows = snapshot_table(spark, sf_dir)
    newest = F.lit(calendar.newest_dates(stored_rows)[0])
    dearer = F.when(F.col("ingest_date") == newest, F.coalesce("price_amount", F.lit(0.0)) + 1.0)
    again = snapshots(spark, sf_dir).withColumn("price_amount", dearer.otherwise(F.col("price_amount")))
    again = again.select(*stored_rows.columns)
    first = slo.checksum(stored_rows, ["ingest_date"])
    second = slo.checksum(again, ["ingest_date"]).withColumnsRenamed(
        {"rows": "_rows", "checksum": "_checksum"}
    )
    same = (F.col("rows") == F.col("_rows")) & (F.col("checksum") == F.col("_checksum"))
    return first.join(second, "ingest_date", "full_outer").select(
        "ingest_date", "rows", F.coalesce(same, F.lit(False)).alias("same")
    )


@query(
    """SELECT a.district_key, a.bedrooms AS from_bedrooms, b.bedrooms AS to_bedrooms,
      round(b.avg_rent_pen - a.avg_rent_pen, 6) AS premium,
      CASE WHEN a.avg_rent_pen > 0 THEN round((b.avg_rent_pen - a.avg_rent_pen) / a.avg_rent_pen * 100, 2)
        END AS premium_pct
    FROM rolled_bed a JOIN rolled_bed b
      ON b.district_key = a.district_key AND b.bedrooms = a.bedrooms + 1"""
)
def market_rent_premium(spark, sf_dir):
    """DX8."""
    premium = slo.rent_premium(by_district_bedrooms(spark, sf_dir))
    return premium.withColumn("premium", F.round("premium", 6))


@query(
    """(SELECT district_key, bedrooms, listing_count, 'most' AS side FROM rolled_bed
      ORDER BY listing_count DESC, district_key, bedrooms LIMIT 5)
    UNION ALL (SELECT district_key, bedrooms, listing_count, 'fewest' FROM rolled_bed
      ORDER BY listing_count, district_key, bedrooms LIMIT 5)"""
)
def market_supply_extremes(spark, sf_dir):
    """DX9."""
    return slo.supply_extremes(by_district_bedrooms(spark, sf_dir))


@query(
    """SELECT ingest_date, bedrooms, CASE WHEN area_avg_m2 < 40 THEN 0 WHEN area_avg_m2 < 60 THEN 1
        WHEN area_avg_m2 < 80 THEN 2 ELSE 3 END AS area_bracket, COUNT(*) AS listings,
      AVG(price_amount) AS avg_price, MAX(price_per_m2) AS max_price_per_m2,
      round(AVG(price_per_m2), 6) AS avg_price_per_m2
    FROM opts WHERE area_avg_m2 IS NOT NULL GROUP BY 1, 2, 3"""
)
def market_indicators(spark, sf_dir):
    """DX10: area brackets."""
    rows = options.bedroom_options(snapshot_table(spark, sf_dir))
    brackets = slo.market_indicators(rows, [40, 60, 80])
    return brackets.withColumn("avg_price_per_m2", F.round("avg_price_per_m2", 6))


@query(
    """SELECT m.ingest_date, m.district, m.bedrooms, m.currency, m.avg_price,
      CASE WHEN p.avg_price > 0 THEN CAST(round(CAST((m.avg_price - p.avg_price) / p.avg_price * 100.0
        AS DECIMAL(38, 9)), 2) AS DOUBLE) END AS price_change_pct
    FROM market m JOIN days d ON d.ingest_date = m.ingest_date
    LEFT JOIN market p ON p.ingest_date = d.prev_date AND p.district = m.district
      AND p.bedrooms = m.bedrooms AND p.currency = m.currency"""
)
def market_price_variation(spark, sf_dir):
    """DX10: price movement of each cell."""
    days = calendar.publication_calendar(snapshot_table(spark, sf_dir), manifests(spark, sf_dir))
    return slo.price_variation(market_table(spark, sf_dir), days)


@query(
    """SELECT listing_id, CAST(last_seen_date - first_seen_date + 1 AS INTEGER) AS days_on_market,
      is_active FROM latest"""
)
def listing_days_on_market(spark, sf_dir):
    """DX10: time on market."""
    return slo.days_on_market(lifecycle.listing_latest(snapshot_table(spark, sf_dir)))


@query(
    """SELECT r.district_key, listing_count, p.population,
      listing_count * 1000.0::DOUBLE / p.population AS listings_per_1000
    FROM rolled r JOIN (SELECT upper(n_name) AS district_key, COUNT(*) AS population
      FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1) p USING (district_key)"""
)
def market_district_opportunity(spark, sf_dir):
    """DX11: customers per nation play the district profile."""
    nation = table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS c_nationkey", "upper(n_name) AS district_key"
    )
    per_nation = (
        table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    )
    profile = (
        per_nation.join(nation, "c_nationkey")
        .groupBy("district_key")
        .agg(F.sum("n").alias("population"))
    )
    joined = slo.district_opportunity(by_district(spark, sf_dir), profile)
    return joined.select("district_key", "listing_count", "population", "listings_per_1000")


@query(
    """SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
      MAX(o_orderdate)::DATE AS order_day FROM orders GROUP BY o_custkey"""
)
def orders_newer_only(spark, sf_dir):
    """DX12: last order per customer, later orders merged onto earlier ones by version."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey", "o_orderkey", "cast(o_orderdate AS date) AS order_day",
        "struct(o_orderdate, o_orderkey) AS version",
    )
    last = F.max_by(F.struct(*orders.columns), "version").alias("r")
    old = orders.where("order_day < date'1998-01-01'").groupBy("o_custkey").agg(last)
    new = orders.where("order_day >= date'1997-06-01'").groupBy("o_custkey").agg(last)
    merged = lifecycle.newer_only(
        old.select("r.*"), new.select("r.*"), "o_custkey", "version"
    )
    return merged.drop("version")
