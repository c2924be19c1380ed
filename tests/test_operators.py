import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from plazalake.operators import changes, contracts, dedup, lifecycle, market, options, quality
from plazalake.operators import calendar as cal
from plazalake.operators.joins import lookup_join

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 3), date(2024, 1, 4)
SNAP = (
    "ingest_date date, listing_id string, district string, city string, bedrooms_min int, "
    "bedrooms_max int, currency string, price_amount double, area_avg_m2 double, price_per_m2 double"
)


def snap_row(day, listing, price, **other):
    base = dict(
        ingest_date=day, listing_id=listing, district="D", city="C", bedrooms_min=1,
        bedrooms_max=2, currency="PEN", price_amount=price, area_avg_m2=50.0,
        price_per_m2=None if price is None else price / 50.0,
    )
    base.update(other)
    return tuple(base.values())


def scenario(spark):
    p = {
        "a": (None, None, 100.0), "b": (100.0, None, 100.0), "c": (None, 100.0, 120.0),
        "e": (None, 100.0, 80.0), "f": (None, 100.0, 100.0), "h": (None, 100.0, None),
        "j": (None, 0.0, 50.0),
    }
    rows = [
        snap_row(day, k, v)
        for k, prices in p.items()
        for day, v in zip((D1, D2, D3), prices)
        if v is not None
    ]
    rows += [snap_row(D2, "g", 100.0), snap_row(D3, "g", None)]
    return spark.createDataFrame(rows, SNAP)


def runs(spark, complete):
    rows = [
        (day, s, "Success" if complete or s < 4 else "failed")
        for day in (D1, D2, D3)
        for s in (1, 2, 3, 4)
    ]
    return spark.createDataFrame(
        rows, "_partition_ingest_date date, bedrooms int, status string"
    ).withColumn("search_params", F.struct("bedrooms"))


def as_set(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("complete", [True, False])
def test_change_classes(spark, complete):
    snap = scenario(spark)
    rows = changes.changes_for_day(snap, D3, D2, complete)
    got = {r["listing_id"]: r for r in rows.collect()}
    kinds = {k: r["change_type"] for k, r in got.items()}
    expected = {
        "a": "NEW", "b": "REAPPEARED", "c": "PRICE_INCREASE", "e": "PRICE_DECREASE",
        "f": "UNCHANGED", "g": "UNCHANGED", "j": "PRICE_INCREASE",
    }
    if complete:
        expected["h"] = "REMOVED"
    assert kinds == expected
    assert (got["c"]["price_change_amount"], got["c"]["price_change_pct"]) == (20.0, 20.0)
    assert (got["e"]["price_change_amount"], got["e"]["price_change_pct"]) == (-20.0, -20.0)
    assert got["g"]["price_change_amount"] is None and got["j"]["price_change_pct"] is None


@pytest.mark.parametrize("complete", [True, False])
def test_backfill_equals_daily_runs(spark, complete):
    snap, log = scenario(spark), runs(spark, complete)
    days = cal.publication_calendar(snap, log)
    linked = changes.with_neighbours(snap, days)
    all_changes = changes.neighbour_changes(linked)
    all_markets = market.market_over_time(linked)
    daily_changes, daily_markets = Counter(), Counter()
    for day, before in ((D1, None), (D2, D1), (D3, D2)):
        assert cal.previous_date(snap, day) == before
        assert cal.is_complete(log, day) is complete
        rows = changes.changes_for_day(snap, day, before, complete)
        daily_changes += as_set(rows.select(*changes.CHANGE_COLUMNS))
        cube = market.market_for_day(snap, rows, day, before)
        daily_markets += as_set(cube.select(*market.MARKET_COLUMNS))
    assert as_set(all_changes.select(*changes.CHANGE_COLUMNS)) == daily_changes
    assert as_set(all_markets.select(*market.MARKET_COLUMNS)) == daily_markets


def test_first_snapshot_is_all_new(spark):
    snap = scenario(spark).where(F.col("ingest_date") == F.lit(D2))
    kinds = changes.changes_for_day(snap, D2, None, True).select("change_type").distinct()
    assert [r[0] for r in kinds.collect()] == ["NEW"]


def test_market_against_joined_aggregates(spark):
    """The folded cube equals aggregates joined the long way."""
    snap = scenario(spark).unionByName(
        spark.createDataFrame(
            [snap_row(D2, "k", 70.0, currency="PEN"), snap_row(D3, "k", None, currency=None)], SNAP
        )
    )
    rows = changes.changes_for_day(snap, D3, D2, True)
    cube = market.market_for_day(snap, rows, D3, D2)
    opts = options.per_bedroom(snap)
    now = market.current_market(opts.where(F.col("ingest_date") == F.lit(D3)))
    then = market.previous_counts(opts.where(F.col("ingest_date") == F.lit(D2)))
    joined = (
        now.join(market.change_metrics(rows), list(market.CUBE_KEYS), "full_outer")
        .join(then, ["district", "bedrooms", "currency"], "left")
        .fillna(0, ["listing_count", "new_listing_count", "removed_listing_count", "price_changed_count"])
        .withColumn(
            "offer_change_pct",
            F.when(
                F.col("previous_listing_count") > 0,
                F.round(
                    (F.col("listing_count") - F.col("previous_listing_count"))
                    / F.col("previous_listing_count") * 100.0, 2),
            ),
        )
    )
    columns = list(market.MARKET_COLUMNS)
    assert as_set(cube.select(*columns)) == as_set(joined.select(*columns))
    assert cube.where("currency = 'UNKNOWN' AND listing_count = 1").count() == 2


def test_latest_state_carried_forward(spark):
    snap = scenario(spark).withColumns(
        {c: F.lit(None).cast("string") for c in ("listing_type", "url", "run_id")}
    ).withColumns({"bathrooms": F.lit(1), "features": F.array(F.lit("x"))})
    state = lifecycle.listing_latest(snap.where(F.col("ingest_date") == F.lit(D1)))
    for day in (D2, D3):
        state = lifecycle.advance_latest(state, snap, day)
    full = lifecycle.listing_latest(snap)
    flat = [F.concat_ws(",", c).alias(c) if c == "features" else c for c in full.columns]
    assert as_set(state.select(*flat)) == as_set(full.select(*flat))
    b = full.where("listing_id = 'b'").first()
    assert (b["first_seen_date"], b["last_seen_date"], b["days_observed"]) == (D1, D3, 2)
    assert not full.where("listing_id = 'h'").first()["is_active"]


def test_newer_only(spark):
    schema = "k int, version int, v string"
    old = spark.createDataFrame([(1, 5, "old"), (2, 5, "old"), (3, None, "old")], schema)
    new = spark.createDataFrame([(1, 4, "new"), (2, 6, "new"), (3, 1, "new"), (4, 1, "new")], schema)
    got = {r["k"]: r["v"] for r in lifecycle.newer_only(old, new, "k", "version").collect()}
    assert got == {1: "old", 2: "new", 3: "new", 4: "new"}


def typed_rows(spark):
    base = dict(
        ingest_date=D1, listing_id="1", _run_id="r", run_id="r", source_observation_key="k",
        has_success_manifest=True, bedrooms_min=1, bedrooms_max=2, _partition_bedrooms=1,
        searched=1, price_amount=10.0, area_min_m2=5.0, area_max_m2=6.0, source_file="f",
        raw_payload="{}",
    )
    bad = {
        "MANIFEST_NOT_SUCCESS": dict(has_success_manifest=False),
        "LISTING_ID_REQUIRED": dict(listing_id=""),
        "RUN_ID_REQUIRED": dict(_run_id=None, run_id="missing_run_id"),
        "INGEST_DATE_INVALID": dict(ingest_date=D2),
        "BEDROOMS_OUT_OF_RANGE": dict(bedrooms_min=3, bedrooms_max=2, _partition_bedrooms=1),
        "PATH_SEARCH_BEDROOM_MISMATCH": dict(searched=2),
        "PRICE_NON_POSITIVE": dict(price_amount=0.0),
        "AREA_NON_POSITIVE": dict(area_min_m2=0.0, area_max_m2=None),
    }
    rows = [dict(base, **change, source_observation_key=rule) for rule, change in bad.items()]
    rows.append(dict(base, source_observation_key="two", price_amount=-1.0, bedrooms_max=5))
    rows.append(dict(base, source_observation_key="two", price_amount=-1.0))
    rows.append(dict(base, source_observation_key="ok", searched=None, price_amount=None,
                     area_min_m2=None, area_max_m2=None))
    schema = (
        "ingest_date date, listing_id string, _run_id string, run_id string, "
        "source_observation_key string, has_success_manifest boolean, bedrooms_min int, "
        "bedrooms_max int, _partition_bedrooms int, searched int, price_amount double, "
        "area_min_m2 double, area_max_m2 double, source_file string, raw_payload string"
    )
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    return df.withColumn("_search_params", F.struct(F.col("searched").alias("bedrooms")))


def test_rules_and_quarantine(spark):
    judged = quality.apply_rules(typed_rows(spark), F.lit(D1))
    failed = {
        r["source_observation_key"]: r["_failed_rules"]
        for r in judged.where("source_observation_key <> 'two'").collect()
    }
    assert failed.pop("ok") == []
    assert failed == {rule.rule_id: [rule.rule_id] for rule in quality.RULES}
    rejected = quality.quarantine(judged)
    assert rejected.count() == 8 + 3
    texts = {r.rule_id: r.description for r in quality.RULES}
    assert all(r["rule_description"] == texts[r["rule_id"]] for r in rejected.collect())
    valid, invalid = quality.valid_rows(judged).count(), quality.invalid_rows(judged).count()
    assert valid + invalid == judged.count() and valid == 1


def test_quality_results_against_distinct_counts(spark):
    judged = quality.apply_rules(typed_rows(spark), F.lit(D1))
    results = quality.quality_results(judged)
    want = Counter()
    for r in quality.quarantine(judged).select(
        "ingest_date", "run_id", "rule_id", "source_observation_key"
    ).distinct().collect():
        want[(r[0], r[1], r[2])] += 1
    got = {(r[0], r[1], r[2]): r["invalid_records"] for r in results.collect()}
    assert {k: v for k, v in got.items() if v} == dict(want)
    assert len(got) == 8 * judged.select("ingest_date", "run_id").distinct().count()
    price = results.where("rule_id = 'PRICE_NON_POSITIVE' AND run_id = 'r'").where(
        F.col("ingest_date") == F.lit(D1)
    ).first()
    assert (price["invalid_records"], price["result"]) == (2, "FAIL")
    row = spark.range(1).select(quality.rule_description(F.lit("OTHER"))).first()
    assert row[0] == "Regla de calidad no documentada."


def test_inverted_ranges_have_no_options(spark):
    rows = [snap_row(D1, "x", 1.0, bedrooms_min=3, bedrooms_max=1), snap_row(D1, "y", 1.0, bedrooms_max=4)]
    got = options.per_bedroom(spark.createDataFrame(rows, SNAP)).collect()
    assert sorted((r["listing_id"], r["bedrooms"]) for r in got) == [("y", b) for b in (1, 2, 3, 4)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_with_a_hot_key(spark, how):
    # One key holds a third of the rows, some keys are NULL or unknown.
    fact = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 400 END AS k"
    )
    lookup = spark.range(300).selectExpr("id AS k", "id * 2 AS v")
    rows = [(r["id"], r["k"]) for r in fact.collect()]
    hit = {i for i, k in rows if k is not None and k < 300}
    kept = {"inner": hit, "left_semi": hit, "left": {i for i, _ in rows}, "left_anti": {i for i, _ in rows} - hit}
    got = lookup_join(fact, lookup, ["k"], how).collect()
    assert sorted(r["id"] for r in got) == sorted(kept[how])
    if how in ("inner", "left"):
        assert all(r["v"] == (r["k"] * 2 if r["id"] in hit else None) for r in got)
    with pytest.raises(ValueError):
        lookup_join(fact, lookup, ["k"], "full")


def test_running_sum_over_blocks(spark):
    rng = random.Random(1)
    rows = [(g, i, rng.randint(0, 9)) for g in ("a", "b") for i in range(-5, 200) if rng.random() < 0.7]
    df = spark.createDataFrame(rows, "g string, i int, v int")
    got = {(r["g"], r["i"]): r["t"] for r in dedup.running_sum(df, "g", "i", "v", "t", block=7).collect()}
    for g, i, _ in rows:
        assert got[(g, i)] == sum(v for h, j, v in rows if h == g and j <= i)


def test_page_yield_stops_at_first_page_without_news(spark):
    rows = [("r", 1, 0, "a"), ("r", 1, 1, "b"), ("r", 2, 2, "b"), ("r", 2, 3, "a"), ("r", 3, 4, "c")]
    df = spark.createDataFrame(rows, "_run_id string, _page_num int, _position int, listing_id string")
    df = df.withColumns({"url": F.lit(None).cast("string"), "_raw": F.struct("listing_id")})
    got = [tuple(r) for r in dedup.page_yield(df).select(
        "_page_num", "found", "new", "total", "is_end").orderBy("_page_num").collect()]
    assert got == [(1, 2, 2, 2, False), (2, 2, 0, 2, True)]


def test_latest_observation_order(spark):
    rows = [
        ("l", 1, "2024-01-01 10:00:00", "a", "k1"),
        ("l", 2, "2024-01-01 11:00:00", "a", "k2"),
        ("l", 3, None, "z", "k3"),
        ("m", 4, None, "a", "k4"),
        ("m", 5, None, "b", "k5"),
    ]
    df = spark.createDataFrame(
        rows, "listing_id string, n int, observed_at string, run_id string, source_observation_key string"
    ).withColumns({"ingest_date": F.lit(D1), "_bronze_loaded_at": F.lit(None).cast("timestamp")})
    assert sorted(r["n"] for r in dedup.latest_observation(df).collect()) == [2, 5]


def test_contracts_raise(spark):
    snap = spark.createDataFrame([snap_row(D1, "x", 1.0), snap_row(D1, "x", 2.0)], SNAP)
    snap = snap.withColumn("run_id", F.lit("r"))
    log = spark.createDataFrame([("other", "success")], "run_id string, status string")
    metrics = contracts.silver_contract(snap, log, options.per_bedroom(snap), snap.limit(0))
    values = {r["metric"]: r["value"] for r in metrics.collect()}
    assert values["duplicate_snapshot_keys"] == 1
    assert values["rows_without_successful_manifest"] == 2
    assert values["bedroom_option_rows"] == 4
    with pytest.raises(contracts.ContractViolation):
        contracts.enforce(metrics, contracts.SILVER_CHECKS)


def test_resolve_dates(spark):
    snap = scenario(spark)
    assert cal.resolve_date(None, snap) == D3
    assert cal.resolve_date("2024-01-02", snap) == date(2024, 1, 2)
    assert cal.newest_dates(snap) == (D3, D2)
    with pytest.raises(ValueError):
        cal.resolve_date("", snap.limit(0))
