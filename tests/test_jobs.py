"""Files in, tables out: incremental ingest, daily jobs, reruns and rebuilds."""

import json
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from plazalake.config import EngineConfig
from plazalake.operators import calendar, changes, contracts, market
from plazalake.plans import jobs
from plazalake.sources import landed, tables

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def listing(run, listing_id, price, segment=1, **other):
    record = {
        "listing_id": listing_id, "listing_type": "PROPERTY", "url": f"/{listing_id}",
        "price_raw": price, "area_raw": "50", "bedrooms_raw": str(segment), "district": "RÍMAC",
        "city": "Lima", "features": ["x"], "_ingested_at": "2024-01-01T05:00:00+00:00",
        "_page_num": 1, "_run_id": run,
        "_search_params": {"operation": "alquiler", "property_type": "departamentos",
                           "location": "lima", "bedrooms": segment},
        "_raw": {"id": listing_id},
    }
    return {**record, **other}


def land(root, day, segment, records, status="success", run=None):
    run = run or f"{day}_b{segment}"
    folder = root / f"source=web/bedrooms={segment}/ingest_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in records)
    (folder / f"listings_{run}.jsonl").write_text(lines, encoding="utf-8")
    manifest = {
        "run_id": run, "status": status, "record_count": len(records), "pages_scraped": 1,
        "finished_at": f"{day}T06:00:00+00:00", "search_params": {"bedrooms": segment},
    }
    (folder / f"manifest_{run}.json").write_text(json.dumps(manifest, indent=2), encoding="utf-8")


def as_set(df, columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture
def product(spark, tmp_path):
    config = EngineConfig(f"p{abs(hash(str(tmp_path))) % 10**9}", f"{tmp_path}/raw", f"{tmp_path}/ck")
    jobs.prepare(spark, config, f"{tmp_path}/tables")
    return config, tmp_path / "raw", f"{tmp_path}/tables"


def test_daily_jobs(spark, product):
    config, raw, base = product
    for segment in (1, 2, 3, 4):
        land(raw, D1, segment, [listing(f"{D1}_b{segment}", f"L{segment}", "S/ 1,000", segment)])
    land(raw, D1, 1, [listing("bad", "L9", "S/ 5")], status="failed", run="bad")
    jobs.bronze_job(spark, config)
    bronze, log = spark.table(config.listings_raw), spark.table(config.ingestion_runs)
    assert (bronze.count(), log.count()) == (5, 5)
    assert log.where("records_written = 1 AND completed_at IS NOT NULL").count() == 5
    jobs.bronze_job(spark, config)
    assert spark.table(config.listings_raw).count() == 5

    assert jobs.silver_job(spark, config) == D1
    jobs.publish_options(spark, config)
    assert spark.table(config.snapshot).count() == 4
    assert spark.table(config.quarantine).select("rule_id").first()[0] == "MANIFEST_NOT_SUCCESS"
    assert spark.table(config.quality_results).count() == 5 * 8
    jobs.validate_silver(spark, config, D1)
    assert jobs.gold_job(spark, config, base) == D1
    jobs.validate_gold(spark, config, D1)

    # Next day: one repriced, one gone, one new; a zero price is rejected.
    for segment in (1, 2, 3, 4):
        rows = [] if segment == 2 else [listing(f"{D2}_b{segment}", f"L{segment}", "S/ 1,500", segment)]
        if segment == 4:
            rows += [listing(f"{D2}_b4", "N", "S/ 900", 4), listing(f"{D2}_b4", "Z", "S/ 0", 4)]
        land(raw, D2, segment, rows)
    jobs.bronze_job(spark, config)
    assert spark.table(config.listings_raw).count() == 10
    for _ in range(2):  # a rerun changes nothing
        jobs.silver_job(spark, config)
        jobs.gold_job(spark, config, base, str(D2))
        kinds = tables.on_day(spark, config.listing_changes, D2).groupBy("change_type").count()
        assert dict(map(tuple, kinds.collect())) == {"PRICE_INCREASE": 3, "REMOVED": 1, "NEW": 1}
        assert spark.table(config.listing_latest).where("is_active").count() == 4
        assert spark.table(config.listing_latest).agg(F.sum("days_observed")).first()[0] == 8
    jobs.validate_gold(spark, config, D2)

    # Day-by-day replay equals the one-pass rebuild.
    stored = {
        config.listing_changes: changes.CHANGE_COLUMNS,
        config.market_daily: market.MARKET_COLUMNS,
    }
    before = {t: as_set(spark.table(t), c) for t, c in stored.items()}
    jobs.rebuild_from(spark, config, base, D1)
    assert {t: as_set(spark.table(t), c) for t, c in stored.items()} == before

    # All defects repaired: the day's quarantine becomes empty, other days stay.
    spark.sql(f"INSERT OVERWRITE {config.listings_raw} SELECT * FROM {config.listings_raw} WHERE 1=0")
    assert spark.table(config.quarantine).where(F.col("ingest_date") == F.lit(D1)).count() == 1
    with pytest.raises(ValueError):
        jobs.silver_job(spark, config, "2024-02-01")


def test_removed_needs_a_complete_day(spark, product):
    config, raw, base = product
    for segment in (1, 2, 3, 4):
        land(raw, D1, segment, [listing(f"{D1}_b{segment}", f"L{segment}", "S/ 1,000", segment)])
    land(raw, D2, 1, [listing(f"{D2}_b1", "L1", "S/ 1,000")])
    jobs.bronze_job(spark, config)
    for day in (D1, D2):
        jobs.silver_job(spark, config, str(day))
    snap, log = spark.table(config.snapshot), spark.table(config.ingestion_runs)
    assert not calendar.is_complete(log, D2)
    kinds = changes.changes_for_day(snap, D2, D1, False).select("change_type").collect()
    assert [r[0] for r in kinds] == ["UNCHANGED"]
    with pytest.raises(contracts.ContractViolation):
        metrics = contracts.gold_contract(
            spark.createDataFrame([], "ingest_date date, district string, bedrooms int, currency string"),
            changes.changes_for_day(snap, D2, D1, True),
            spark.createDataFrame(
                [], "listing_id string, first_seen_date date, last_seen_date date, is_active boolean"
            ),
            calendar.completeness(log.where(F.col("_partition_ingest_date") == F.lit(D2))),
        )
        contracts.enforce(metrics, contracts.GOLD_CHECKS)


def test_state_follows_a_reprocessed_day(spark, product):
    config, raw, base = product
    for segment, ids in ((1, "A"), (2, "B"), (3, ""), (4, "")):
        land(raw, D1, segment, [listing(f"{D1}_b{segment}", i, "S/ 1,000", segment) for i in ids])
    jobs.bronze_job(spark, config)
    jobs.silver_job(spark, config, str(D1))
    jobs.gold_job(spark, config, base, str(D1))
    # Day 1 is published again as {B, C}; day 2 is the same.
    day1 = spark.table(config.snapshot).where("listing_id = 'B'")
    day1 = spark.createDataFrame(day1.collect(), day1.schema)
    both = day1.unionByName(day1.withColumn("listing_id", F.lit("C")))
    tables.replace_date(both, config.snapshot, D1)
    for segment, ids in ((1, ""), (2, "BC"), (3, ""), (4, "")):
        land(raw, D2, segment, [listing(f"{D2}_b{segment}", i, "S/ 1,000", segment) for i in ids])
    jobs.bronze_job(spark, config)
    jobs.silver_job(spark, config, str(D2))
    jobs.gold_job(spark, config, base, str(D2))
    got = {r["listing_id"]: (r["first_seen_date"], r["days_observed"]) for r in spark.table(config.listing_latest).collect()}
    assert got == {"B": (D1, 2), "C": (D1, 2)}


def spans_of(frame):
    columns = ("listing_id", "first_seen_date", "last_seen_date", "days_observed", "is_active", "price_amount")
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_state_follows_emptied_and_republished_days(spark, product, monkeypatch):
    """Older days are emptied, published anew and added; the state equals a recomputation."""
    config, raw, base = product
    days = [date(2024, 1, d) for d in range(1, 8)]
    land(raw, days[1], 1, [listing("r", "A", "S/ 1,000")], run="r")
    jobs.bronze_job(spark, config)
    jobs.silver_job(spark, config, str(days[1]))
    row = spark.createDataFrame(spark.table(config.snapshot).collect(), spark.table(config.snapshot).schema)

    def publish(day, ids):
        made = [row.withColumns({"listing_id": F.lit(i), "ingest_date": F.lit(day), "price_amount": F.lit(p)}) for i, p in ids.items()]
        frame = made[0] if made else row.limit(0)
        for more in made[1:]:
            frame = frame.unionByName(more)
        tables.replace_date(frame.select(row.columns), config.snapshot, day, ["ingest_date", "listing_id"])

    def run():
        published = tables.partition_files(spark, config.snapshot)
        jobs.publish_latest(spark, config, base, published)
        whole = jobs.lifecycle.listing_latest(spark.table(config.snapshot))
        assert spans_of(spark.table(config.listing_latest)) == spans_of(whole)

    publish(days[1], {"A": 1.0, "B": 2.0, "C": 3.0})
    publish(days[2], {"A": 1.0, "C": 3.0})
    publish(days[3], {"A": 5.0, "D": 4.0})
    run()
    whole = jobs.lifecycle.listing_latest
    monkeypatch.setattr(jobs.lifecycle, "listing_latest", lambda _: pytest.fail("history was read"))
    monkeypatch.setattr(jobs.lifecycle, "repaired_latest", lambda *_: pytest.fail("nothing had changed"))
    publish(days[4], {"A": 5.0, "E": 1.0})
    jobs.publish_latest(spark, config, base, tables.partition_files(spark, config.snapshot))
    monkeypatch.undo()
    assert spans_of(spark.table(config.listing_latest)) == spans_of(whole(spark.table(config.snapshot)))
    publish(days[1], {})  # emptied: B is gone, A and C were seen later
    publish(days[5], {"A": 6.0, "F": 1.0})
    before = jobs.carried_state(spark, config, days[5], tables.partition_files(spark, config.snapshot))
    assert spans_of(before) == spans_of(whole(spark.table(config.snapshot).where(F.col("ingest_date") < F.lit(days[5]))))
    run()
    publish(days[2], {"B": 9.0, "C": 8.0})  # republished
    publish(days[0], {"G": 1.0, "A": 1.0})  # older than all
    run()
    publish(days[5], {})  # the newest day is emptied
    run()
    # A state without its ledger, as a run leaves it that ends between the two, isn't trusted.
    tables.replace_all(spark.table(config.listing_latest).where("listing_id = 'A'"), config.listing_latest, f"{base}/other")
    publish(days[6], {"A": 1.0})
    assert jobs.carried_state(spark, config, days[6], tables.partition_files(spark, config.snapshot)) is None
    run()


def test_full_refresh(spark, product):
    config, raw, base = product
    land(raw, D1, 1, [listing("r1", "a", "S/ 2,750.50"), listing("r1", "b", "US$ 10")], run="r1")
    assert jobs.full_refresh_job(spark, config, base, "older") == 2
    assert jobs.full_refresh_job(spark, config, base, "older") == 0
    row = spark.table(config.table("gold", "older")).first()
    assert (row["district"], row["listing_count"], row["max_price"]) == ("Rímac", 2, 2750.5)
    with pytest.raises(FileNotFoundError):
        landed.newest_file(spark, str(raw), "*.nothing")
