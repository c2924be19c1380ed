"""Silver: typing, rules, canonical snapshot, bedroom options, contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.operators import contracts, monitors, options, quality, typing
from plazalake.operators.calendar import resolve_date
from plazalake.operators.dedup import latest_observation
from plazalake.operators.market import refresh_market
from plazalake.plans.inputs import manifests, observations, stored
from plazalake.plans.registry import query


def judged(spark, sf_dir) -> DataFrame:
    """Typed observations of all days with their rule outcomes."""
    bronze = observations(spark, sf_dir)
    return quality.apply_rules(typing.typed_observations(bronze, manifests(spark, sf_dir)))


def snapshots(spark, sf_dir) -> DataFrame:
    """Canonical snapshot of every day."""
    valid = quality.valid_rows(judged(spark, sf_dir))
    return typing.snapshot_columns(latest_observation(valid, tie_breakers=["event_id"]))


def snapshot_table(spark, sf_dir) -> DataFrame:
    """The stored Silver snapshot, one partition per day."""
    return stored(
        spark, sf_dir, "listings_snapshot", lambda: snapshots(spark, sf_dir), ["ingest_date"]
    )


def published_dates(spark, sf_dir) -> DataFrame:
    runs = manifests(spark, sf_dir)
    return runs.where(F.lower("status") == "success").select("_partition_ingest_date")


SNAPSHOT_SQL_COLUMNS = """ingest_date, listing_id, listing_type, url, district, city, bedrooms_min,
  bedrooms_max, bathrooms, area_min_m2, area_max_m2, area_avg_m2, currency, price_amount,
  price_per_m2, event_type || '|' || props AS features, props AS description,
  'pub_' || user_id % 10 AS publisher, run_id,
  's3://landing/source=web/operation=alquiler/property=departamento/bedrooms=' || seg
    || '/ingest_date=' || CAST(ingest_date AS VARCHAR) || '/listings_' || CAST(ingest_date AS VARCHAR)
    || '_b' || seg || '.jsonl' AS source_file,
  source_observation_key, epoch_us(observed) AS observed_us, price_amount IS NOT NULL AS has_price,
  area_avg_m2 IS NOT NULL AS has_area"""


def _flat(df: DataFrame) -> DataFrame:
    """Comparable form: arrays as text, instants as microseconds, no load time."""
    return df.withColumns(
        {"features": F.concat_ws("|", "features"), "observed_us": F.unix_micros("observed_at")}
    ).drop("observed_at", "bronze_loaded_at")


@query(
    """SELECT event_id, ingest_date, listing_id, run_id, source_observation_key, district, city,
      listing_type, currency, price_amount, area_min_m2, area_max_m2, area_avg_m2, bedrooms_min,
      bedrooms_max, bathrooms, epoch_us(observed) AS observed_us, price_per_m2,
      has_success_manifest,
      '{"id":"' || user_id || '","posting_type":"' || event_type || '","price":"' || amount || '"}'
        AS raw_payload
    FROM cand"""
)
def silver_typed_observations(spark, sf_dir):
    """SI3-SI15 on every observation."""
    typed = typing.typed_observations(observations(spark, sf_dir), manifests(spark, sf_dir))
    return typed.select(
        "event_id", "ingest_date", "listing_id", "run_id", "source_observation_key", "district",
        "city", "listing_type", "currency", "price_amount", "area_min_m2", "area_max_m2",
        "area_avg_m2", "bedrooms_min", "bedrooms_max", "bathrooms",
        F.unix_micros("observed_at").alias("observed_us"), "price_per_m2",
        "has_success_manifest", "raw_payload",
    )


@query(
    """SELECT c.event_id, COALESCE(string_agg(f.rule_id, ',' ORDER BY f.rule_id), '') AS failed_rules,
      COUNT(f.rule_id) = 0 AS is_valid
    FROM cand c LEFT JOIN failures f USING (event_id) GROUP BY c.event_id"""
)
def silver_rule_outcomes(spark, sf_dir):
    """DQ1-DQ11: failed rules and the valid/invalid split of every observation."""
    return judged(spark, sf_dir).select(
        "event_id",
        F.concat_ws(",", F.sort_array("_failed_rules")).alias("failed_rules"),
        (F.col("_failed_mask") == 0).alias("is_valid"),
    )


@query(
    """SELECT c.event_id, list_contains(list(f.rule_id), 'INGEST_DATE_INVALID') AS other_day,
      COUNT(f.rule_id) AS violations
    FROM cand c LEFT JOIN (SELECT event_id, rule_id FROM failures UNION ALL
      SELECT event_id, 'INGEST_DATE_INVALID' FROM cand
      WHERE ingest_date <> (SELECT MAX(run_date) FROM runs WHERE ok)) f USING (event_id)
    GROUP BY c.event_id"""
)
def silver_rules_of_one_day(spark, sf_dir):
    """DQ5: all observations judged as rows of the newest day; those of other days are refused."""
    runs = manifests(spark, sf_dir)
    day = resolve_date(None, published_dates(spark, sf_dir), "_partition_ingest_date")
    rows = quality.apply_rules(typing.typed_observations(observations(spark, sf_dir), runs), F.lit(day))
    return rows.select(
        "event_id",
        F.array_contains("_failed_rules", "INGEST_DATE_INVALID").alias("other_day"),
        F.size("_failed_rules").cast("bigint").alias("violations"),
    )


@query(f"SELECT {SNAPSHOT_SQL_COLUMNS} FROM snap")
def silver_snapshot(spark, sf_dir):
    """ST1 + SI16: canonical snapshot of every day."""
    return _flat(snapshots(spark, sf_dir))


@query(
    f"""SELECT {SNAPSHOT_SQL_COLUMNS} FROM snap
    WHERE ingest_date = (SELECT MAX(run_date) FROM runs WHERE ok)"""
)
def silver_snapshot_latest_day(spark, sf_dir):
    """SI1 + SI2: only the newest day with a successful manifest."""
    runs = manifests(spark, sf_dir)
    day = resolve_date(None, published_dates(spark, sf_dir), "_partition_ingest_date")
    bronze = observations(spark, sf_dir).where(F.col("_partition_ingest_date") == F.lit(day))
    typed = quality.apply_rules(typing.typed_observations(bronze, runs), F.lit(day))
    return _flat(
        typing.snapshot_columns(
            latest_observation(quality.valid_rows(typed), tie_breakers=["event_id"])
        )
    )


@query(
    """SELECT f.ingest_date, f.listing_id, f.run_id, f.source_observation_key, f.rule_id,
      r.rule_description,
      's3://landing/source=web/operation=alquiler/property=departamento/bedrooms=' || seg
        || '/ingest_date=' || CAST(ingest_date AS VARCHAR) || '/listings_'
        || CAST(ingest_date AS VARCHAR) || '_b' || seg || '.jsonl' AS source_file,
      '{"id":"' || user_id || '","posting_type":"' || event_type || '","price":"' || amount || '"}'
        AS raw_payload
    FROM failures f JOIN rules r USING (rule_id)"""
)
def silver_quarantine(spark, sf_dir):
    """DQ12: one row per rejected observation and rule."""
    return quality.quarantine(judged(spark, sf_dir))


@query("SELECT * FROM quality")
def silver_quality_results(spark, sf_dir):
    """DQ13: every run against every rule."""
    return quality.quality_results(judged(spark, sf_dir))


@query(
    """SELECT rule_id, CAST(SUM(invalid_records) AS BIGINT) AS invalid_records,
      MAX(result) AS result FROM quality GROUP BY rule_id"""
)
def silver_rule_summary(spark, sf_dir):
    """DQ17."""
    return monitors.rule_summary(quality.quality_results(judged(spark, sf_dir)))


@query(
    """SELECT ingest_date, COUNT(*) AS canonical_listings,
      COUNT(DISTINCT listing_id) AS unique_listing_ids,
      CAST(SUM(CASE WHEN price_amount IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS listings_with_price,
      CAST(SUM(CASE WHEN area_avg_m2 IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS listings_with_area
    FROM snap GROUP BY ingest_date"""
)
def silver_snapshot_summary(spark, sf_dir):
    """DQ16 for every day."""
    return monitors.snapshot_summary(snapshots(spark, sf_dir))


@query(
    """SELECT ingest_date, listing_id, bedrooms, listing_type, url, district, city, bathrooms,
      area_min_m2, area_max_m2, area_avg_m2, currency, price_amount, price_per_m2,
      run_id, source_observation_key, event_type || '|' || props AS features,
      'pub_' || user_id % 10 AS publisher, epoch_us(observed) AS observed_us,
      's3://landing/source=web/operation=alquiler/property=departamento/bedrooms=' || seg
        || '/ingest_date=' || CAST(ingest_date AS VARCHAR) || '/listings_'
        || CAST(ingest_date AS VARCHAR) || '_b' || seg || '.jsonl' AS source_file FROM opts"""
)
def silver_bedroom_options(spark, sf_dir):
    """PX1: one row per listing, day and bedroom count."""
    return _flat(options.bedroom_options(snapshots(spark, sf_dir)))


@query(
    """SELECT ingest_date, bedrooms, COUNT(DISTINCT listing_id) AS listing_count
    FROM opts GROUP BY ingest_date, bedrooms"""
)
def silver_options_summary(spark, sf_dir):
    """PX2."""
    return monitors.options_summary(options.bedroom_options(snapshots(spark, sf_dir)))


@query(
    """SELECT 'canonical_rows' AS metric, (SELECT COUNT(*) FROM snap) AS value
    UNION ALL SELECT 'duplicate_snapshot_keys', (SELECT COUNT(*) FROM (SELECT 1 FROM snap
      GROUP BY ingest_date, listing_id HAVING COUNT(*) > 1))
    UNION ALL SELECT 'invalid_bedroom_ranges', (SELECT COUNT(*) FROM snap
      WHERE bedrooms_min < 1 OR bedrooms_max > 4 OR bedrooms_min > bedrooms_max)
    UNION ALL SELECT 'rows_without_successful_manifest', (SELECT COUNT(*) FROM snap
      WHERE run_id NOT IN (SELECT run_id FROM runs WHERE ok))
    UNION ALL SELECT 'bedroom_option_rows', (SELECT COUNT(*) FROM opts)
    UNION ALL SELECT 'quarantined_rule_violations', (SELECT COUNT(*) FROM failures)"""
)
def silver_contract(spark, sf_dir):
    """DQ14 over all days of the stored snapshot."""
    snap = snapshot_table(spark, sf_dir)
    rejected = quality.quarantine(judged(spark, sf_dir))
    return contracts.silver_contract(
        snap, manifests(spark, sf_dir), options.bedroom_options(snap), rejected
    )


# A snapshot that breaks each rule of its contract.
BROKEN = """(SELECT * FROM (SELECT ingest_date, listing_id, bedrooms_min,
      bedrooms_max + CASE WHEN user_id % 11 = 0 THEN 4 ELSE 0 END AS bedrooms_max,
      CASE WHEN user_id % 13 = 0 THEN 'unknown' ELSE run_id END AS run_id, user_id FROM snap)
    CROSS JOIN (VALUES (1), (2)) AS t(time) WHERE time = 1 OR user_id % 7 = 0)"""


@query(
    f"""SELECT 'canonical_rows' AS metric, (SELECT COUNT(*) FROM {BROKEN}) AS value
    UNION ALL SELECT 'duplicate_snapshot_keys', (SELECT COUNT(*) FROM snap WHERE user_id % 7 = 0)
    UNION ALL SELECT 'invalid_bedroom_ranges', (SELECT COUNT(*) FROM {BROKEN}
      WHERE bedrooms_min < 1 OR bedrooms_max > 4 OR bedrooms_min > bedrooms_max)
    UNION ALL SELECT 'rows_without_successful_manifest', (SELECT COUNT(*) FROM {BROKEN}
      WHERE run_id NOT IN (SELECT run_id FROM runs WHERE ok))
    UNION ALL SELECT 'bedroom_option_rows', (SELECT CAST(SUM(bedrooms_max - bedrooms_min + 1) AS BIGINT)
      FROM {BROKEN} WHERE bedrooms_max <= 4)
    UNION ALL SELECT 'quarantined_rule_violations', (SELECT COUNT(*) FROM failures)"""
)
def silver_contract_violations(spark, sf_dir):
    """DQ14 on a snapshot with repeated keys, ranges beyond four bedrooms and unknown runs."""
    snap = snapshot_table(spark, sf_dir)
    user = F.col("listing_id").cast("bigint")
    broken = snap.withColumns(
        {
            "bedrooms_max": F.col("bedrooms_max") + F.when(user % 11 == 0, 4).otherwise(0),
            "run_id": F.when(user % 13 == 0, "unknown").otherwise(F.col("run_id")),
        }
    )
    broken = broken.unionByName(broken.where(user % 7 == 0))
    rejected = quality.quarantine(judged(spark, sf_dir))
    return contracts.silver_contract(
        broken, manifests(spark, sf_dir), options.bedroom_options(broken), rejected
    )


# The full-refresh profile reads the same raw fields by other rules.
REFRESH = """(SELECT event_id, day AS ingest_date,
    CASE WHEN event_type = 'purchase' THEN 'USD' WHEN event_type <> 'error' THEN 'PEN'
      WHEN event_id % 2 = 0 THEN ' usd ' WHEN event_id % 3 = 0 THEN 'pen' ELSE 'PEN' END AS currency_clean,
    CASE WHEN event_id % 29 = 0 THEN amount + 0.5 WHEN event_type <> 'error'
      THEN CAST(amount AS DOUBLE) END AS price_amount,
    CASE WHEN event_id % 4 = 0 THEN CAST(amount AS DOUBLE) END AS maintenance_amount,
    CAST(CASE WHEN event_id % 83 = 0 THEN 0 WHEN event_id % 3 = 0 THEN area
      WHEN event_id % 11 = 0 THEN area * 10 + 5 WHEN event_id % 17 = 0 THEN NULL ELSE area END AS DOUBLE)
      AS area_min_m2,
    CAST(CASE WHEN event_id % 83 = 0 THEN 50 WHEN event_id % 3 = 0 THEN area + event_id % 30
      WHEN event_id % 11 = 0 THEN area * 10 + 5 WHEN event_id % 17 = 0 THEN NULL ELSE area END AS DOUBLE)
      AS area_max_m2,
    CASE WHEN event_id % 5 = 0 OR event_id % 13 <> 0 THEN seg END AS bedrooms_min,
    CASE WHEN event_id % 5 = 0 THEN seg + 1 WHEN event_id % 13 <> 0 THEN seg END AS bedrooms_max,
    CAST(CASE WHEN event_id % 19 <> 0 THEN 1 + user_id % 3 END AS INTEGER) AS bathrooms_min,
    CAST(CASE WHEN event_id % 23 = 0 THEN 10 + event_id % 90 END AS INTEGER) AS units,
    upper(translate(n_name, 'AO', 'ÁÓ')[1]) || lower(translate(n_name, 'AO', 'ÁÓ')[2:]) AS district_clean,
    CASE WHEN event_id % 7 = 0 THEN NULL WHEN user_id % 5 = 0 THEN 'Callao' ELSE 'Lima' END AS city_clean
  FROM ev LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = c_nationkey)"""


def refresh_rows(spark, sf_dir) -> DataFrame:
    bronze = observations(spark, sf_dir).withColumn("ingest_date", F.col("_partition_ingest_date"))
    return typing.refresh_typed(bronze)


@query(
    f"""SELECT event_id, currency_clean, price_amount, maintenance_amount, area_min_m2, area_max_m2,
      CAST(bedrooms_min AS INTEGER) AS bedrooms_min, CAST(bedrooms_max AS INTEGER) AS bedrooms_max,
      bathrooms_min, bathrooms_min AS bathrooms_max, units, district_clean, city_clean,
      (area_min_m2 + area_max_m2) / 2 AS area_avg_m2,
      CASE WHEN area_min_m2 + area_max_m2 > 0
        THEN price_amount / ((area_min_m2 + area_max_m2) / 2) END AS price_per_m2
    FROM {REFRESH}"""
)
def refresh_typed_observations(spark, sf_dir):
    """SR1-SR5."""
    return refresh_rows(spark, sf_dir).select(
        "event_id", "currency_clean", "price_amount", "maintenance_amount", "area_min_m2",
        "area_max_m2", "bedrooms_min", "bedrooms_max", "bathrooms_min", "bathrooms_max", "units",
        "district_clean", "city_clean", "area_avg_m2", "price_per_m2",
    )


def _rounded(expression: str) -> str:
    """Half-up rounding of the decimal form, as Spark rounds doubles."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38, 8)), 2) AS DOUBLE)"


REFRESH_MARKET = (
    f"""SELECT district_clean AS district, ingest_date, COUNT(*) AS listing_count,
      {_rounded("AVG(price_amount)")} AS avg_price, MIN(price_amount) AS min_price,
      MAX(price_amount) AS max_price,
      {_rounded("AVG((area_min_m2 + area_max_m2) / 2)")} AS avg_area_m2,
      {_rounded("AVG((bedrooms_min + bedrooms_max) / 2)")} AS avg_bedrooms
    FROM {REFRESH} GROUP BY district_clean, ingest_date"""
)


@query(REFRESH_MARKET)
def refresh_market_by_district(spark, sf_dir):
    """AG8; the mean of price ratios is checked on its own below."""
    return refresh_market(refresh_rows(spark, sf_dir)).drop("avg_price_per_m2")


@query(
    f"""SELECT district_clean AS district, ingest_date, round(AVG(CASE WHEN area_min_m2 + area_max_m2 > 0
      THEN price_amount / ((area_min_m2 + area_max_m2) / 2) END), 6) AS avg_price_per_m2
    FROM {REFRESH} GROUP BY district_clean, ingest_date"""
)
def refresh_unit_price_by_district(spark, sf_dir):
    """AG8 before its rounding: a sum of ratios has no exact order-free half."""
    return (
        refresh_rows(spark, sf_dir)
        .groupBy(F.col("district_clean").alias("district"), "ingest_date")
        .agg(F.round(F.avg("price_per_m2"), 6).alias("avg_price_per_m2"))
    )
