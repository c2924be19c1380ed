"""Independent ANSI SQL for the registered queries.

Shared sub-queries are common table expressions; ``with_ctes`` prepends the
ones a statement needs. Values are computed from the base columns directly,
not by parsing the composed texts, so the parsers are checked as well.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}

CTES["ev"] = """
SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS day,
  CAST(1 + user_id % 4 AS INTEGER) AS seg, CAST(floor(value * 10) AS BIGINT) AS amount,
  20 + user_id % 60 AS area, CAST(1 + hour(ts) AS INTEGER) AS page
FROM events"""

CTES["runs"] = """
SELECT CAST(day AS VARCHAR) || '_b' || seg AS run_id, day AS run_date, seg,
  CASE WHEN (day(day) + seg) % 11 = 0 THEN 'failed' WHEN seg % 2 = 0 THEN 'Success'
    ELSE 'success' END AS status,
  (day(day) + seg) % 11 <> 0 AS ok, COUNT(*) AS n, MAX(page) AS pages, MIN(ts) AS first_ts,
  MAX(ts) AS last_ts
FROM ev GROUP BY day, seg"""

# Typed candidates, one per event.
CTES["cand0"] = """
SELECT e.event_id, e.ts, e.day AS ingest_date, e.seg, e.user_id, e.event_type, e.props,
  CASE WHEN event_id % 97 <> 0 THEN CAST(e.user_id AS VARCHAR) END AS listing_id,
  CASE WHEN event_id % 97 = 0 THEN 'https://listings.example/aviso/' || e.user_id
    WHEN event_id % 7 = 0 THEN ' ' || e.user_id || ' ' ELSE CAST(e.user_id AS VARCHAR) END AS key_id,
  CASE WHEN event_id % 101 <> 0 THEN CAST(e.day AS VARCHAR) || '_b' || e.seg END AS run_raw,
  CASE WHEN event_id % 2 = 0 THEN 'property' ELSE 'development' END AS listing_type,
  'https://listings.example/aviso/' || e.user_id AS url,
  CASE WHEN n_name IS NULL THEN 'Unknown'
    ELSE upper(translate(n_name, 'AO', 'ÁÓ')[1]) || lower(translate(n_name, 'AO', 'ÁÓ')[2:]) END AS district,
  CASE WHEN event_id % 7 = 0 THEN 'Lima' WHEN e.user_id % 5 = 0 THEN 'Callao' ELSE 'Lima' END AS city,
  CASE event_type WHEN 'purchase' THEN 'USD'
    WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'USD' WHEN event_id % 3 = 0 THEN 'PEN' END
    ELSE 'PEN' END AS currency,
  CASE WHEN event_id % 29 = 0 THEN CAST(amount AS DOUBLE) + 0.5
    WHEN event_type <> 'error' THEN CAST(amount AS DOUBLE) END AS price_amount,
  CAST(CASE WHEN event_id % 83 = 0 THEN 0 WHEN event_id % 3 = 0 THEN area
    WHEN event_id % 11 = 0 THEN area + 0.5 WHEN event_id % 17 = 0 THEN NULL ELSE area END AS DOUBLE) AS area_min_m2,
  CAST(CASE WHEN event_id % 83 = 0 THEN 50 WHEN event_id % 3 = 0 THEN area + event_id % 30
    WHEN event_id % 11 = 0 THEN area + 0.5 WHEN event_id % 17 = 0 THEN NULL ELSE area END AS DOUBLE) AS area_max_m2,
  CAST(CASE WHEN event_id % 5 = 0 THEN e.seg
    WHEN event_id % 13 = 0 AND event_id % 89 = 0 THEN e.seg % 4 + 1 ELSE e.seg END AS INTEGER) AS bedrooms_min,
  CAST(CASE WHEN event_id % 5 = 0 THEN e.seg + 1
    WHEN event_id % 13 = 0 AND event_id % 89 = 0 THEN e.seg % 4 + 1 ELSE e.seg END AS INTEGER) AS bedrooms_max,
  CAST(CASE WHEN event_id % 19 <> 0 THEN 1 + e.user_id % 3 END AS INTEGER) AS bathrooms,
  CASE WHEN event_id % 211 <> 0 THEN e.ts END AS observed,
  amount, page, COALESCE(r.ok, FALSE) AS has_success_manifest
FROM ev e
LEFT JOIN customer c ON c.c_custkey = e.user_id
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN runs r ON r.run_date = e.day AND r.seg = e.seg AND e.event_id % 101 <> 0"""

CTES["cand"] = """
SELECT *, COALESCE(run_raw, 'missing_run_id') AS run_id,
  sha256(COALESCE(run_raw, 'missing_run_id') || '||' || key_id) AS source_observation_key,
  (area_min_m2 + area_max_m2) / 2 AS area_avg_m2,
  CASE WHEN price_amount > 0 AND (area_min_m2 + area_max_m2) > 0
    THEN price_amount / ((area_min_m2 + area_max_m2) / 2) END AS price_per_m2
FROM cand0"""

CTES["failures"] = """
SELECT *, 'MANIFEST_NOT_SUCCESS' AS rule_id FROM cand WHERE NOT has_success_manifest
UNION ALL SELECT *, 'LISTING_ID_REQUIRED' FROM cand WHERE listing_id IS NULL
UNION ALL SELECT *, 'RUN_ID_REQUIRED' FROM cand WHERE run_raw IS NULL
UNION ALL SELECT *, 'BEDROOMS_OUT_OF_RANGE' FROM cand WHERE bedrooms_max > 4
UNION ALL SELECT *, 'PATH_SEARCH_BEDROOM_MISMATCH' FROM cand WHERE event_id % 89 = 0
UNION ALL SELECT *, 'PRICE_NON_POSITIVE' FROM cand WHERE price_amount <= 0
UNION ALL SELECT *, 'AREA_NON_POSITIVE' FROM cand WHERE area_min_m2 <= 0 OR area_max_m2 <= 0"""

CTES["rules"] = """
SELECT * FROM (VALUES
 ('MANIFEST_NOT_SUCCESS', 'El anuncio no tiene un manifest exitoso para el run.'),
 ('LISTING_ID_REQUIRED', 'listing_id es obligatorio para publicar un snapshot.'),
 ('RUN_ID_REQUIRED', '_run_id es obligatorio para mantener trazabilidad.'),
 ('INGEST_DATE_INVALID', 'La fecha de partición no coincide con la fecha procesada.'),
 ('BEDROOMS_OUT_OF_RANGE', 'El rango de dormitorios debe estar entre 1 y 4.'),
 ('PATH_SEARCH_BEDROOM_MISMATCH', 'El dormitorio de la partición no coincide con el parámetro de búsqueda.'),
 ('PRICE_NON_POSITIVE', 'El precio interpretado debe ser mayor que cero cuando exista.'),
 ('AREA_NON_POSITIVE', 'El área interpretada debe ser mayor que cero cuando exista.')
) AS t(rule_id, rule_description)"""

CTES["snap"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY ingest_date, listing_id
    ORDER BY observed DESC NULLS LAST, run_id DESC, event_id DESC) AS rn
  FROM cand WHERE event_id NOT IN (SELECT event_id FROM failures)) WHERE rn = 1"""

CTES["quality"] = """
SELECT t.ingest_date, t.run_id, r.rule_id, r.rule_description, t.n AS records_evaluated,
  t.n - COALESCE(f.bad, 0) AS valid_records, COALESCE(f.bad, 0) AS invalid_records,
  CAST(round(CAST(COALESCE(f.bad, 0) / t.n * 100.0 AS DECIMAL(38, 9)), 2) AS DOUBLE) AS error_pct,
  CASE WHEN COALESCE(f.bad, 0) > 0 THEN 'FAIL' ELSE 'PASS' END AS result
FROM (SELECT ingest_date, run_id, COUNT(*) AS n FROM cand GROUP BY ALL) t
CROSS JOIN rules r
LEFT JOIN (SELECT ingest_date, run_id, rule_id, COUNT(DISTINCT source_observation_key) AS bad
  FROM failures GROUP BY ALL) f
  ON f.ingest_date = t.ingest_date AND f.run_id = t.run_id AND f.rule_id = r.rule_id"""

CTES["opts"] = """
SELECT s.*, CAST(b AS INTEGER) AS bedrooms
FROM snap s, unnest(generate_series(bedrooms_min, bedrooms_max)) AS u(b)"""

CTES["days"] = """
SELECT ingest_date, lag(ingest_date) OVER (ORDER BY ingest_date) AS prev_date,
  (SELECT COUNT(DISTINCT seg) FROM runs r WHERE r.run_date = d.ingest_date AND ok) = 4 AS complete
FROM (SELECT DISTINCT ingest_date FROM snap) d"""

CTES["pairs"] = """
SELECT d.ingest_date, d.complete, c.listing_id AS cur_id, p.listing_id AS prev_id,
  COALESCE(c.listing_id, p.listing_id) AS listing_id,
  COALESCE(c.district, p.district) AS district, COALESCE(c.city, p.city) AS city,
  COALESCE(c.bedrooms_min, p.bedrooms_min) AS bedrooms_min,
  COALESCE(c.bedrooms_max, p.bedrooms_max) AS bedrooms_max,
  COALESCE(c.currency, p.currency, 'UNKNOWN') AS currency,
  p.price_amount AS previous_price, c.price_amount AS current_price,
  p.ingest_date AS previous_seen_date, c.ingest_date AS current_seen_date
FROM days d
JOIN (SELECT d.ingest_date AS on_date, s.listing_id FROM days d JOIN snap s
      ON s.ingest_date = d.ingest_date OR s.ingest_date = d.prev_date GROUP BY ALL) k
  ON k.on_date = d.ingest_date
LEFT JOIN snap c ON c.ingest_date = d.ingest_date AND c.listing_id = k.listing_id
LEFT JOIN snap p ON p.ingest_date = d.prev_date AND p.listing_id = k.listing_id"""

CTES["seen"] = "SELECT listing_id, MIN(ingest_date) AS first_seen FROM snap GROUP BY listing_id"

CTES["changes"] = """
SELECT ingest_date, listing_id, district, city, bedrooms_min, bedrooms_max, currency, change_type,
  previous_price, current_price, current_price - previous_price AS price_change_amount,
  CASE WHEN previous_price > 0 THEN CAST(round(CAST((current_price - previous_price)
    / previous_price * 100.0 AS DECIMAL(38, 9)), 2) AS DOUBLE) END AS price_change_pct,
  previous_seen_date, current_seen_date
FROM (SELECT p.*, CASE
    WHEN cur_id IS NOT NULL AND prev_id IS NULL AND s.first_seen < p.ingest_date THEN 'REAPPEARED'
    WHEN cur_id IS NOT NULL AND prev_id IS NULL THEN 'NEW'
    WHEN cur_id IS NOT NULL AND current_price > previous_price THEN 'PRICE_INCREASE'
    WHEN cur_id IS NOT NULL AND current_price < previous_price THEN 'PRICE_DECREASE'
    WHEN cur_id IS NOT NULL THEN 'UNCHANGED'
    WHEN complete THEN 'REMOVED' END AS change_type
  FROM pairs p JOIN seen s USING (listing_id)) WHERE change_type IS NOT NULL"""

CTES["mcur"] = """
SELECT ingest_date, district, bedrooms, COALESCE(currency, 'UNKNOWN') AS currency,
  COUNT(DISTINCT listing_id) AS listing_count, AVG(price_amount) AS avg_price,
  quantile_disc(price_amount, 0.5) AS median_price, MIN(price_amount) AS min_price,
  MAX(price_amount) AS max_price, AVG(area_avg_m2) AS avg_area_m2,
  quantile_disc(price_per_m2, 0.5) AS median_price_per_m2
FROM opts GROUP BY ALL"""

CTES["mchg"] = """
SELECT ingest_date, district, CAST(b AS INTEGER) AS bedrooms, currency,
  COUNT(DISTINCT CASE WHEN change_type = 'NEW' THEN listing_id END) AS new_listing_count,
  COUNT(DISTINCT CASE WHEN change_type = 'REMOVED' THEN listing_id END) AS removed_listing_count,
  COUNT(DISTINCT CASE WHEN change_type LIKE 'PRICE%' THEN listing_id END) AS price_changed_count
FROM changes, unnest(generate_series(bedrooms_min, bedrooms_max)) AS u(b)
GROUP BY ALL"""

CTES["market"] = """
SELECT m.ingest_date, m.district, m.bedrooms, m.currency, m.listing_count, m.avg_price, m.median_price,
  m.min_price, m.max_price, m.avg_area_m2, m.median_price_per_m2, new_listing_count,
  removed_listing_count, price_changed_count,
  CASE WHEN p.listing_count > 0 THEN CAST(round(CAST((m.listing_count - p.listing_count)
    / p.listing_count * 100.0 AS DECIMAL(38, 9)), 2) AS DOUBLE) END AS offer_change_pct
FROM (SELECT ingest_date, district, bedrooms, currency, COALESCE(listing_count, 0) AS listing_count,
    avg_price, median_price, min_price, max_price, avg_area_m2, median_price_per_m2,
    COALESCE(new_listing_count, 0) AS new_listing_count,
    COALESCE(removed_listing_count, 0) AS removed_listing_count,
    COALESCE(price_changed_count, 0) AS price_changed_count
  FROM mcur FULL JOIN mchg USING (ingest_date, district, bedrooms, currency)) m
JOIN days d ON d.ingest_date = m.ingest_date
LEFT JOIN mcur p ON p.ingest_date = d.prev_date AND p.district = m.district
  AND p.bedrooms = m.bedrooms AND p.currency = m.currency"""

CTES["latest"] = """
SELECT listing_id, arg_max(listing_type, ingest_date) AS listing_type,
  arg_max(url, ingest_date) AS url, arg_max(district, ingest_date) AS district,
  arg_max(city, ingest_date) AS city, arg_max(bedrooms_min, ingest_date) AS bedrooms,
  CAST(MAX(CASE WHEN rk = 1 THEN bathrooms END) AS INTEGER) AS bathrooms,
  MAX(CASE WHEN rk = 1 THEN area_avg_m2 END) AS area_m2,
  MAX(CASE WHEN rk = 1 THEN currency END) AS currency,
  MAX(CASE WHEN rk = 1 THEN price_amount END) AS price_amount,
  MAX(CASE WHEN rk = 1 THEN price_per_m2 END) AS price_per_m2,
  MIN(ingest_date) AS first_seen_date, MAX(ingest_date) AS last_seen_date,
  COUNT(DISTINCT ingest_date) AS days_observed,
  MAX(ingest_date) = (SELECT MAX(ingest_date) FROM snap) AS is_active,
  arg_max(run_id, ingest_date) AS last_run_id,
  arg_max(event_type || '|' || props, ingest_date) AS features
FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY ingest_date DESC) AS rk FROM snap)
GROUP BY listing_id"""


# The snapshot after its oldest day was emptied and the second republished without one-bedroom listings.
CTES["snap_changed"] = """
SELECT * FROM snap WHERE ingest_date <> (SELECT MIN(ingest_date) FROM snap)
  AND NOT (bedrooms_min = 1 AND ingest_date = (SELECT MIN(ingest_date) FROM snap
    WHERE ingest_date > (SELECT MIN(ingest_date) FROM snap)))"""
CTES["latest_changed"] = re.sub(r"\bsnap\b", "snap_changed", CTES["latest"])


def with_ctes(statement: str) -> str:
    """Prepend the shared sub-queries the statement refers to, directly or not."""
    needed: set[str] = set()
    todo = [statement]
    while todo:
        words = set(re.findall(r"\b[a-z_0-9]+\b", todo.pop()))
        for name in (words & CTES.keys()) - needed:
            needed.add(name)
            todo.append(CTES[name])
    parts = [f"{name} AS ({CTES[name].strip()})" for name in CTES if name in needed]
    return f"WITH {', '.join(parts)} {statement.strip()}" if parts else statement.strip()
