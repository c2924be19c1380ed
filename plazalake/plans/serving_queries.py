"""Serving: export, roll-ups, brackets, rankings, payloads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.functions.measures import bracket_index, bracket_label
from plazalake.functions.text import district_key, name_key
from plazalake.operators import serving
from plazalake.plans.gold_queries import market_table
from plazalake.plans.inputs import spread_table, table
from plazalake.plans.oracle_sql import CTES
from plazalake.plans.registry import query
from plazalake.sources import exports, tables


def _r2(expression: str) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38, 8)), 2) AS DOUBLE)"


CTES["export"] = f"""
SELECT ingest_date, district, bedrooms, currency, listing_count, {_r2("avg_price")} AS avg_price,
  {_r2("median_price")} AS median_price, {_r2("min_price")} AS min_price,
  {_r2("max_price")} AS max_price, {_r2("avg_area_m2")} AS avg_area_m2,
  {_r2("median_price_per_m2")} AS median_price_per_m2, new_listing_count, removed_listing_count,
  price_changed_count, offer_change_pct
FROM market WHERE ingest_date = (SELECT MAX(ingest_date) FROM snap) AND currency = 'PEN'"""
CTES["served"] = """
SELECT *, strip_accents(upper(district)) AS district_key FROM export
WHERE listing_count > 0 AND avg_price IS NOT NULL AND median_price IS NOT NULL
  AND avg_area_m2 IS NOT NULL AND median_price_per_m2 IS NOT NULL"""
# The nations of two regions play the official district list.
CTES["official"] = """
SELECT DISTINCT upper(n_name) AS district_key FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN ('AMERICA', 'ASIA', 'EUROPE')"""
CTES["rolled_bed"] = """
SELECT district_key, bedrooms, MIN(district) AS district, CAST(SUM(listing_count) AS BIGINT) AS listing_count,
  SUM(avg_price * listing_count) / SUM(listing_count) AS avg_rent_pen,
  SUM(median_price * listing_count) / SUM(listing_count) AS median_price,
  SUM(avg_area_m2 * listing_count) / SUM(listing_count) AS avg_area_m2,
  SUM(median_price_per_m2 * listing_count) / SUM(listing_count) AS median_price_m2,
  CAST(SUM(new_listing_count) AS BIGINT) AS new_listing_count,
  CAST(SUM(removed_listing_count) AS BIGINT) AS removed_listing_count,
  CAST(SUM(price_changed_count) AS BIGINT) AS price_changed_count
FROM served GROUP BY district_key, bedrooms"""
CTES["rolled"] = """
SELECT district_key, MIN(district) AS district, CAST(SUM(listing_count) AS BIGINT) AS listing_count,
  SUM(avg_price * listing_count) / SUM(listing_count) AS avg_rent_pen,
  SUM(median_price * listing_count) / SUM(listing_count) AS median_price,
  SUM(avg_area_m2 * listing_count) / SUM(listing_count) AS avg_area_m2,
  SUM(median_price_per_m2 * listing_count) / SUM(listing_count) AS median_price_m2
FROM served GROUP BY district_key"""
CTES["mapped"] = "SELECT * FROM rolled WHERE district_key IN (SELECT district_key FROM official)"
CTES["matrix"] = "SELECT * FROM served WHERE district_key IN (SELECT district_key FROM official)"

METRICS = ("listing_count", "avg_price", "median_price", "avg_area_m2", "median_price_per_m2")


def exported(spark, sf_dir) -> DataFrame:
    return serving.governed_export(market_table(spark, sf_dir))


def served(spark, sf_dir) -> DataFrame:
    return serving.servable(exported(spark, sf_dir), METRICS)


def district_layer(spark, sf_dir) -> DataFrame:
    """Attribute table of the district layer: nations as districts, regions as scopes."""
    region = table(spark, sf_dir, "region").selectExpr(
        "r_regionkey",
        "CASE WHEN r_name IN ('AMERICA', 'ASIA', 'EUROPE') THEN 'Lima' ELSE 'Cusco' END AS Departamento",
    )
    nation = table(spark, sf_dir, "nation").selectExpr(
        "n_name AS nombre_dist", "n_regionkey AS r_regionkey"
    )
    return nation.join(region, "r_regionkey").withColumn("PROVINCIA", F.lit("Sin dato"))


def official(spark, sf_dir) -> DataFrame:
    return serving.official_districts(district_layer(spark, sf_dir))


def matrix_rows(spark, sf_dir) -> DataFrame:
    return serving.in_official(served(spark, sf_dir), official(spark, sf_dir))


def by_district(spark, sf_dir) -> DataFrame:
    return serving.roll_up(served(spark, sf_dir), ["district_key"])


def by_district_bedrooms(spark, sf_dir) -> DataFrame:
    return serving.roll_up(served(spark, sf_dir), ["district_key", "bedrooms"])


def mapped(spark, sf_dir) -> DataFrame:
    return serving.in_official(by_district(spark, sf_dir), official(spark, sf_dir))


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Ratios of sums are compared to six places: addition order is not fixed."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


_RATIOS = ("avg_rent_pen", "median_price", "avg_area_m2", "median_price_m2")


def _ratios_sql(source: str) -> str:
    shown = ", ".join(f"round({c}, 6) AS {c}" for c in _RATIOS)
    return f"(SELECT * REPLACE ({shown}) FROM {source})"


@query("SELECT * FROM export")
def serving_export(spark, sf_dir):
    """SV1."""
    return exported(spark, sf_dir)


@query("SELECT * FROM served")
def serving_rows(spark, sf_dir):
    """SV3-SV5."""
    return served(spark, sf_dir)


@query("SELECT * FROM export")
def serving_csv_round_trip(spark, sf_dir):
    """IO20 + IO21 + SV2: write the export as CSV and read it back under its contract."""
    path = f"{tables.scratch_root(spark)}/{uuid.uuid4().hex}/export"
    stamped = exported(spark, sf_dir).withColumn(
        "calculated_at", F.col("ingest_date").cast("timestamp")
    )
    exports.write_export(stamped, path)
    text = exports.read_export(spark, path)
    return text.select(
        *[F.col(f.name).cast(f.dataType) for f in stamped.schema if f.name != "calculated_at"]
    )


@query(f"SELECT * FROM {_ratios_sql('rolled_bed')}")
def serving_rollup_bedrooms(spark, sf_dir):
    """AG10 by district and bedrooms."""
    return _rounded(by_district_bedrooms(spark, sf_dir), *_RATIOS)


@query(f"SELECT * FROM {_ratios_sql('rolled')}")
def serving_rollup_district(spark, sf_dir):
    """AG10 by district."""
    return _rounded(by_district(spark, sf_dir), *_RATIOS)


@query("SELECT * FROM official")
def serving_official_districts(spark, sf_dir):
    """SV8: the province scope matches nothing and is skipped."""
    return official(spark, sf_dir)


@query("SELECT district FROM rolled WHERE district_key NOT IN (SELECT district_key FROM official)")
def serving_unmatched_labels(spark, sf_dir):
    """JN15."""
    return serving.unmatched_labels(by_district(spark, sf_dir), official(spark, sf_dir))


@query(
    f"""SELECT o.district_key, r.* EXCLUDE (district_key),
      CASE WHEN avg_rent_pen < 1500 THEN 0 WHEN avg_rent_pen < 2000 THEN 1 WHEN avg_rent_pen < 2500
        THEN 2 WHEN avg_rent_pen < 3000 THEN 3 WHEN avg_rent_pen < 4000 THEN 4
        WHEN avg_rent_pen >= 4000 THEN 5 END AS rent_bracket,
      CASE WHEN avg_rent_pen < 1500 THEN 'Menos de S/ 1,500'
        WHEN avg_rent_pen < 2000 THEN 'S/ 1,500 – 1,999' WHEN avg_rent_pen < 2500
        THEN 'S/ 2,000 – 2,499' WHEN avg_rent_pen < 3000 THEN 'S/ 2,500 – 2,999'
        WHEN avg_rent_pen < 4000 THEN 'S/ 3,000 – 3,999' WHEN avg_rent_pen >= 4000
        THEN 'S/ 4,000 o más' END AS rent_label
    FROM official o LEFT JOIN {_ratios_sql('rolled')} r ON r.district_key = o.district_key"""
)
def serving_choropleth(spark, sf_dir):
    """SV10 + JN14 + SV6 + SV7."""
    frame = serving.choropleth(official(spark, sf_dir), by_district(spark, sf_dir))
    return _rounded(frame, *_RATIOS)


@query(
    """SELECT district, district_key, bedrooms, listing_count, median_price, avg_area_m2,
      median_price_per_m2 FROM matrix"""
)
def serving_value_matrix(spark, sf_dir):
    """SV9 + JN13."""
    return serving.value_matrix(matrix_rows(spark, sf_dir))


@query(
    """SELECT bedrooms, round(SUM(avg_area_m2 * listing_count) / SUM(listing_count), 6) AS area_line,
      round(SUM(median_price * listing_count) / SUM(listing_count), 6) AS rent_line,
      CAST(SUM(listing_count) AS BIGINT) AS listings FROM matrix GROUP BY bedrooms"""
)
def serving_facet_lines(spark, sf_dir):
    """AG11 + AG14."""
    return _rounded(serving.facet_lines(matrix_rows(spark, sf_dir)), "area_line", "rent_line")


@query("SELECT COUNT(*) AS districts, CAST(SUM(listing_count) AS BIGINT) AS listings FROM mapped")
def serving_mapped_totals(spark, sf_dir):
    """AG14."""
    return serving.mapped_totals(mapped(spark, sf_dir))


@query(
    """SELECT MIN(listing_count) AS listing_count_min, MAX(listing_count) AS listing_count_max,
      MIN(median_price) AS median_price_min, MAX(median_price) AS median_price_max,
      MIN(avg_area_m2) AS avg_area_m2_min, MAX(avg_area_m2) AS avg_area_m2_max,
      MIN(median_price_per_m2) AS median_price_per_m2_min,
      MAX(median_price_per_m2) AS median_price_per_m2_max,
      greatest(1.0::DOUBLE, MIN(avg_area_m2) * 0.78::DOUBLE) AS area_domain_min,
      MAX(avg_area_m2) * 1.12::DOUBLE AS area_domain_max,
      greatest(100.0::DOUBLE, MIN(median_price) * 0.72::DOUBLE) AS rent_domain_min,
      MAX(median_price) * 1.18::DOUBLE AS rent_domain_max,
      greatest((MAX(avg_area_m2) - MIN(avg_area_m2)) * 0.08::DOUBLE, 4.0::DOUBLE) AS area_pad,
      greatest((MAX(median_price) - MIN(median_price)) * 0.08::DOUBLE, 150.0::DOUBLE) AS rent_pad
    FROM matrix"""
)
def serving_extents(spark, sf_dir):
    """AG13."""
    return serving.extents(matrix_rows(spark, sf_dir))


@query(
    """SELECT quantile_cont(CAST(listing_count AS DOUBLE), 0.5) AS supply_median,
      round(quantile_cont(avg_rent_pen, 0.5), 6) AS rent_median FROM mapped"""
)
def serving_midpoints(spark, sf_dir):
    """AG12."""
    return _rounded(serving.midpoints(mapped(spark, sf_dir)), "rent_median")


@query(
    """SELECT district_key, listing_count FROM rolled
    ORDER BY listing_count DESC, district_key LIMIT 10"""
)
def serving_top_supply(spark, sf_dir):
    """TK1."""
    return serving.top_supply(by_district(spark, sf_dir), 10).select("district_key", "listing_count")


@query(
    """SELECT district_key, listing_count, round(listing_count * avg_rent_pen, 4) AS commercial_value
    FROM mapped WHERE listing_count >= (SELECT quantile_cont(CAST(listing_count AS DOUBLE), 0.5) FROM mapped)
      AND avg_rent_pen >= (SELECT quantile_cont(avg_rent_pen, 0.5) FROM mapped)
    ORDER BY listing_count * avg_rent_pen DESC, district_key LIMIT 5"""
)
def serving_opportunities(spark, sf_dir):
    """TK2."""
    best = serving.opportunities(mapped(spark, sf_dir))
    return _rounded(
        best.select("district_key", "listing_count", "commercial_value"),
        "commercial_value",
        digits=4,
    )


@query(
    """SELECT DISTINCT bedrooms, district_key FROM (
      (SELECT bedrooms, district_key FROM matrix QUALIFY row_number() OVER (PARTITION BY bedrooms
        ORDER BY listing_count DESC, district_key, district) <= 3)
      UNION ALL (SELECT bedrooms, district_key FROM matrix QUALIFY row_number() OVER (
        PARTITION BY bedrooms ORDER BY median_price DESC, district_key, district) = 1))"""
)
def serving_facet_labels(spark, sf_dir):
    """TK3 + SE2."""
    return serving.facet_labels(matrix_rows(spark, sf_dir)).select("bedrooms", "district_key")


@query(
    """SELECT district_key, bedrooms, listing_count FROM matrix
    ORDER BY listing_count DESC, district_key, bedrooms, district LIMIT 1"""
)
def serving_default_row(spark, sf_dir):
    """TK4."""
    return serving.default_row(matrix_rows(spark, sf_dir)).select(
        "district_key", "bedrooms", "listing_count"
    )


@query(
    """SELECT district_key,
      CAST(SUM(CASE WHEN bedrooms = 1 THEN listing_count ELSE 0 END) AS BIGINT) AS bedrooms_1,
      CAST(SUM(CASE WHEN bedrooms = 2 THEN listing_count ELSE 0 END) AS BIGINT) AS bedrooms_2,
      CAST(SUM(CASE WHEN bedrooms = 3 THEN listing_count ELSE 0 END) AS BIGINT) AS bedrooms_3,
      CAST(SUM(CASE WHEN bedrooms = 4 THEN listing_count ELSE 0 END) AS BIGINT) AS bedrooms_4
    FROM rolled_bed WHERE district_key IN (SELECT district_key FROM rolled
      ORDER BY listing_count DESC, district_key LIMIT 10) GROUP BY district_key"""
)
def serving_bedroom_mix(spark, sf_dir):
    """AG15 + JN16."""
    rows = served(spark, sf_dir)
    ranking = serving.top_supply(serving.roll_up(rows, ["district_key"]), 10)
    return serving.bedroom_mix(serving.roll_up(rows, ["district_key", "bedrooms"]), ranking)


@query(
    """SELECT district, bedrooms, round(36 + sqrt(listing_count) * 28, 6) AS bubble_size,
      round(4 + sqrt(listing_count / (SELECT MAX(listing_count) FROM matrix)) * 10, 6) AS radius
    FROM matrix"""
)
def serving_bubbles(spark, sf_dir):
    """SV12."""
    rows = matrix_rows(spark, sf_dir)
    largest = rows.agg(F.max("listing_count").alias("_largest"))  # a single row
    sized = rows.crossJoin(F.broadcast(largest)).select(
        "district",
        "bedrooms",
        serving.bubble_size(F.col("listing_count")).alias("bubble_size"),
        serving.bubble_radius(F.col("listing_count"), F.col("_largest")).alias("radius"),
    )
    return _rounded(sized, "bubble_size", "radius")


@query(
    """SELECT '{"district":"' || district || '","district_key":"' || district_key || '","bedrooms":'
      || bedrooms || ',"listing_count":' || listing_count || '}' AS value FROM matrix"""
)
def serving_payload_rows(spark, sf_dir):
    """IO22 as distributed rows."""
    columns = ["district", "district_key", "bedrooms", "listing_count"]
    return exports.payload_rows(matrix_rows(spark, sf_dir), columns)


@query(
    """SELECT 0 AS section, NULL AS district, NULL AS bedrooms,
      '{"scrapeDate":"' || CAST((SELECT MAX(ingest_date) FROM snap) AS VARCHAR) || '","rows":[' AS value
    UNION ALL SELECT 1, district, bedrooms, '{"district_key":"' || district_key || '","bedrooms":' || bedrooms
      || ',"listing_count":' || listing_count
      || ',"median_price":' || coalesce(CAST(median_price AS VARCHAR), 'null')
      || ',"avg_area_m2":' || coalesce(CAST(avg_area_m2 AS VARCHAR), 'null')
      || ',"median_price_per_m2":' || coalesce(CAST(median_price_per_m2 AS VARCHAR), 'null') || '}'
      || CASE WHEN row_number() OVER (ORDER BY district DESC, bedrooms DESC) = 1 THEN '' ELSE ',' END
    FROM matrix
    UNION ALL SELECT 2, NULL, NULL, ']}'"""
)
def serving_payload_document(spark, sf_dir):
    """IO22 as the parts of one document, all rounded metrics included."""
    day = serving.single_date(exported(spark, sf_dir))
    rows = serving.value_matrix(matrix_rows(spark, sf_dir))
    columns = ["district_key", "bedrooms", *serving.MATRIX_METRICS]
    return exports.payload_document(rows, columns, ["district", "bedrooms"], day)


_METRICS_JSON = """',"district":"' || district || '","listing_count":' || listing_count
      || ',"avg_rent_pen":' || round(avg_rent_pen, 6) || ',"median_price":' || round(median_price, 6)
      || ',"avg_area_m2":' || round(avg_area_m2, 6) || ',"median_price_m2":' || round(median_price_m2, 6)"""


@query(
    f"""SELECT 0 AS section, NULL AS district_key, NULL AS bedrooms, '{{"scrapeDate":"'
      || CAST((SELECT MAX(ingest_date) FROM snap) AS VARCHAR)
      || '","bins":[1500.0,2000.0,2500.0,3000.0,4000.0],"binLabels":["Menos de S/ 1,500",'
      || '"S/ 1,500 – 1,999","S/ 2,000 – 2,499","S/ 2,500 – 2,999","S/ 3,000 – 3,999","S/ 4,000 o más"],"market":[' AS value
    UNION ALL SELECT 1, district_key, NULL, '{{"district_key":"' || district_key || '"' || {_METRICS_JSON} || '}}'
      || CASE WHEN row_number() OVER (ORDER BY district_key DESC) = 1 THEN '' ELSE ',' END FROM mapped
    UNION ALL SELECT 2, NULL, NULL, '],"bedroomMarket":['
    UNION ALL SELECT 3, district_key, bedrooms, '{{"district_key":"' || district_key || '","bedrooms":' || bedrooms
      || {_METRICS_JSON} || ',"new_listing_count":' || coalesce(CAST(new_listing_count AS VARCHAR), 'null')
      || ',"removed_listing_count":' || coalesce(CAST(removed_listing_count AS VARCHAR), 'null')
      || ',"price_changed_count":' || coalesce(CAST(price_changed_count AS VARCHAR), 'null') || '}}'
      || CASE WHEN row_number() OVER (ORDER BY district_key DESC, bedrooms DESC) = 1 THEN '' ELSE ',' END
    FROM rolled_bed WHERE district_key IN (SELECT district_key FROM official)
    UNION ALL SELECT 4, NULL, NULL, ']}}'"""
)
def serving_dashboard_document(spark, sf_dir):
    """IO22: the dashboard's document; both roll-ups by grouping sets from one pass."""
    day = serving.single_date(exported(spark, sf_dir))
    rolled = serving.dashboard_roll_ups(matrix_rows(spark, sf_dir))
    return exports.dashboard_document(rolled, serving.RENT_BOUNDS, day)


@query(
    r"""SELECT doc_id, upper(trim(regexp_replace(replace(strip_accents(text), 'ß', 'ss'), '\s+', ' ', 'g')))
      AS text_key
    FROM documents"""
)
def text_name_keys(spark, sf_dir):
    """SV4 over the whole document texts."""
    documents = spread_table(spark, sf_dir, "documents", "doc_id")
    return documents.select("doc_id", name_key(F.col("text")).alias("text_key"))


@query(
    """SELECT o_orderkey, 'CASA E ' || chr(CAST(4352 + i // 588 AS INTEGER))
      || chr(CAST(4449 + i % 588 // 28 AS INTEGER))
      || CASE WHEN i % 28 > 0 THEN chr(CAST(4519 + i % 28 AS INTEGER)) ELSE '' END
      || chr(119127) || chr(119141) AS name_key
    FROM (SELECT o_orderkey, o_orderkey % 11172 AS i FROM orders)"""
)
def text_keys_of_several_letters(spark, sf_dir):
    """SV4: names with a Hangul syllable and a character beyond the basic plane."""
    syllable = "decode(unhex(hex(44032 + o_orderkey % 11172)), 'UTF-16BE')"
    name = F.expr(f"concat(' casa  é\t', {syllable}, decode(unhex('F09D859E'), 'UTF-8'))")
    return table(spark, sf_dir, "orders").select("o_orderkey", name_key(name).alias("name_key"))


@query(
    """SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'ATE' WHEN 1 THEN 'LIMA'
      WHEN 2 THEN 'MAGDALENA DEL MAR' ELSE upper(n_name) END AS district_key FROM nation"""
)
def text_district_aliases(spark, sf_dir):
    """SV5."""
    label = F.expr(
        """CASE n_nationkey % 5 WHEN 0 THEN 'Áte  Vitarte' WHEN 1 THEN ' lima cercado'
        WHEN 2 THEN 'Magdalena' ELSE n_name END"""
    )
    nation = table(spark, sf_dir, "nation")
    return nation.select("n_nationkey", district_key(label).alias("district_key"))


@query(
    """SELECT o_orderkey, CASE WHEN o_totalprice < 1500 THEN 0 WHEN o_totalprice < 100000 THEN 1
        WHEN o_totalprice < 250000.5 THEN 2 ELSE 3 END AS bracket,
      CASE WHEN o_totalprice < 1500 THEN 'Menos de S/ 1,500' WHEN o_totalprice < 100000
        THEN 'S/ 1,500 – 99,999' WHEN o_totalprice < 250000.5 THEN 'S/ 100,000 – 250,000'
        ELSE 'S/ 250,000 o más' END AS label FROM orders"""
)
def order_price_brackets(spark, sf_dir):
    """SV6 + SV7 over the orders."""
    bounds = [1500, 100000, 250000.5]
    index = bracket_index(F.col("o_totalprice"), bounds)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", index.alias("bracket"), bracket_label(index, bounds).alias("label")
    )
