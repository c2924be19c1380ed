from concurrent.futures import ThreadPoolExecutor
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plazalake.schemas import LISTING_SCHEMA, MANIFEST_SCHEMA
from plazalake.sources import landed, tables
from plazalake.sources.key_index import KeyIndex

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def rows_of(spark, table, *columns):
    return sorted(tuple(r) for r in spark.table(table).select(*columns).collect())


def test_insert_only_adds_each_key_once(spark, database):
    table = f"{database}.raw"
    schema = "run string, key string, v int"
    order = [F.col("v").desc()]
    first = spark.createDataFrame([("r1", "a", 1), ("r1", "a", 2), (None, "n", 1)], schema)
    assert tables.insert_only(first.limit(0), table, "key", order) == 0
    assert tables.insert_only(first, table, "key", order) == 2
    assert tables.insert_only(first, table, "key", order) == 0
    more = spark.createDataFrame([("r1", "a", 9), ("r2", "b", 1), (None, "n", 5)], schema)
    assert tables.insert_only(more, table, "key", order) == 1
    other_run = spark.createDataFrame([("r9", "a", 5), ("r9", "c", 5)], schema)
    assert tables.insert_only(other_run, table, "key", order) == 1
    assert rows_of(spark, table, "key", "v") == [("a", 2), ("b", 1), ("c", 5), ("n", 1)]


def test_insert_only_reads_touched_buckets_and_shuffles_no_stored_key(spark, database):
    table, order = f"{database}.raw", [F.col("v").desc()]
    rows = spark.range(500).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("v"))
    assert tables.insert_only(rows, table, "key", order, buckets=8) == 500
    index = KeyIndex(spark, table, "key")
    assert index.buckets == 8
    few = spark.createDataFrame([("k7", 1), ("new", 2)], "key string, v long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        absent = index.absent(few)
        plan = absent._jdf.queryExecution().executedPlan().toString()
        assert [r["key"] for r in absent.collect()] == ["new"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    stored = plan[plan.rindex("FileScan") :]
    assert "Bucketed: true" in stored and "bucket" in stored.split("PartitionFilters")[1].split("]")[0]
    # Above the stored side's scan stand a filter and a sort, no exchange.
    right = plan[: plan.rindex("FileScan")].splitlines()[-4:]
    assert not any("Exchange" in line for line in right), plan
    assert tables.insert_only(few, table, "key", order) == 1
    assert spark.table(index.name).count() == 501


def test_insert_only_indexes_what_an_ended_run_left(spark, database):
    """Rows that were stored without their keys are known to the next insert."""
    table, order = f"{database}.raw", [F.col("v").desc()]
    schema = "key string, v int, day date"
    first = spark.createDataFrame([("a", 1, D1), ("b", 1, D2)], schema)
    tables.ensure_table(first, table, ["day"])
    first.write.insertInto(table)
    again = spark.createDataFrame([("a", 5, D2), ("b", 5, D1), ("c", 5, None), (None, 5, D1)], schema)
    assert tables.insert_only(again, table, "key", order, ["day"]) == 2
    assert tables.insert_only(again.where("key IS NOT NULL"), table, "key", order, ["day"]) == 0
    got = {(r["key"], r["v"]) for r in spark.table(table).collect()}
    assert got == {("a", 1), ("b", 1), ("c", 5), (None, 5)}


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_replace_date_swaps_only_that_day(spark, database, mode):
    spark.conf.set(tables.OVERWRITE_MODE, mode)
    table = f"{database}.snap"
    schema = "k string, ingest_date date, v int"
    tables.replace_date(spark.createDataFrame([("a", D1, 1), ("b", D1, 1)], schema), table, D1)
    tables.replace_date(spark.createDataFrame([("a", D2, 1)], schema), table, D2)
    tables.replace_date(spark.createDataFrame([("a", D1, 7)], schema), table, D1, keys=["k"])
    assert rows_of(spark, table, "k", "ingest_date", "v") == [("a", D1, 7), ("a", D2, 1)]
    assert tables.replace_date(spark.createDataFrame([], schema), table, D1) == 0
    assert rows_of(spark, table, "k", "ingest_date", "v") == [("a", D2, 1)]
    with pytest.raises(ValueError):
        twice = spark.createDataFrame([("a", D1, 1), ("a", D1, 2)], schema)
        tables.replace_date(twice, table, D1, keys=["k"])
    assert spark.conf.get(tables.OVERWRITE_MODE) == mode
    spark.conf.set(tables.OVERWRITE_MODE, "dynamic")


def test_replace_all_may_read_its_own_table(spark, database, tmp_path):
    table, base = f"{database}.latest", str(tmp_path / "latest")
    tables.replace_all(spark.createDataFrame([(1, "x")], "k int, v string"), table, base, ["k"])
    for expected in ("xx", "xxxx", "xxxxxxxx"):
        tables.replace_all(spark.table(table).withColumn("v", F.concat("v", "v")), table, base)
        assert rows_of(spark, table, "k", "v") == [(1, expected)]
    tables.replace_all(spark.createDataFrame([(2, 3.0)], "k int, w double"), table, base)
    assert spark.table(table).columns == ["k", "w"] and rows_of(spark, table, "k", "w") == [(2, 3.0)]


def test_append_new_runs_widens_and_refuses(spark, database):
    table = f"{database}.wide"
    whole = spark.createDataFrame([("r1", 5, (1,))], "_run_id string, price bigint, raw struct<a:int>")
    assert tables.append_new_runs(whole, table) == 1
    more = spark.createDataFrame([("r2", 5.5, (2, "z"))], "_run_id string, price double, raw struct<a:int,b:string>")
    assert tables.append_new_runs(more, table) == 1
    assert tables.append_new_runs(more, table) == 0
    got = sorted((r["price"], r["raw"]["a"], r["raw"]["b"]) for r in spark.table(table).collect())
    assert got == [(5.0, 1, None), (5.5, 2, "z")]
    assert tables.append_new_runs(whole.withColumn("_run_id", F.lit("r3")), table) == 1
    with pytest.raises(TypeError, match="price"):
        tables.append_new_runs(spark.createDataFrame([("r4", "x")], "_run_id string, price string"), table)
    assert spark.table(table).count() == 3


def appended(spark, table, *frames):
    for run, (values, kind) in enumerate(frames):
        rows = [(f"r{run}-{i}", v) for i, v in enumerate(values)]
        tables.append_new_runs(spark.createDataFrame(rows, f"_run_id string, v {kind}"), table)
    field = spark.table(table).schema["v"].dataType.simpleString()
    return field, [r["v"] for r in spark.table(table).orderBy("_run_id").collect()]


BIG = 2**53 + 1


@pytest.mark.parametrize(
    ("frames", "kind", "values"),
    [
        ([([BIG], "bigint"), ([1.5], "double")], "decimal(38,18)", [Decimal(BIG), Decimal("1.5")]),
        ([([1.5], "double"), ([BIG], "bigint")], "decimal(38,18)", [Decimal("1.5"), Decimal(BIG)]),
        ([([7], "bigint"), ([1e300], "double")], "double", [7.0, 1e300]),
        ([([7], "int"), ([Decimal("1.25")], "decimal(4,2)")], "decimal(12,2)", [Decimal(7), Decimal("1.25")]),
        ([([Decimal("1.25")], "decimal(4,2)"), ([7], "bigint")], "decimal(21,2)", [Decimal("1.25"), Decimal(7)]),
        ([([Decimal("1.25")], "decimal(4,2)"), ([Decimal("123.4")], "decimal(4,1)")], "decimal(5,2)", [Decimal("1.25"), Decimal("123.4")]),
        ([([0.5], "float"), ([Decimal("1.25")], "decimal(4,2)")], "decimal(38,18)", [Decimal("0.5"), Decimal("1.25")]),
        ([([1], "tinyint"), ([300], "smallint"), ([None], "bigint")], "bigint", [1, 300, None]),
        ([([[1, None]], "array<bigint>"), ([[0.5]], "array<double>")], "array<double>", [[1.0, None], [0.5]]),
        ([([[BIG]], "array<bigint>"), ([[0.5], None], "array<double>")], "array<decimal(38,18)>", [[Decimal(BIG)], [Decimal("0.5")], None]),
        ([([(BIG,)], "struct<x:bigint>"), ([(0.5,)], "struct<X:double>")], "struct<x:decimal(38,18)>", [(Decimal(BIG),), (Decimal("0.5"),)]),
        ([([{"k": BIG}], "map<string,bigint>"), ([{"k": 0.5}], "map<string,double>")], "map<string,decimal(38,18)>", [{"k": Decimal(BIG)}, {"k": Decimal("0.5")}]),
    ],
)
def test_widening_keeps_every_value(spark, database, frames, kind, values):
    assert appended(spark, f"{database}.t", *frames) == (kind, values)


@pytest.mark.parametrize(
    "frames",
    [
        [([BIG], "bigint"), ([1e300], "double")],
        [([[BIG]], "array<bigint>"), ([[1e300]], "array<double>")],
        [([Decimal("0." + "1" * 38)], "decimal(38,38)"), ([10**15], "bigint")],
    ],
)
def test_widening_that_would_change_a_value_raises(spark, database, frames):
    with pytest.raises(ValueError, match="change a value"):
        appended(spark, f"{database}.t", *frames)
    assert spark.table(f"{database}.t").count() == 1


def test_names_that_differ_in_case_are_one_column(spark, database):
    table = f"{database}.t"
    tables.append_new_runs(spark.createDataFrame([("r1", 1)], "_run_id string, x int"), table)
    tables.append_new_runs(spark.createDataFrame([("r2", 2, "n")], "_run_id string, X int, Y string"), table)
    assert spark.table(table).columns == ["_run_id", "x", "Y"]
    assert rows_of(spark, table, "x") == [(1,), (2,)]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_two_days_written_by_two_threads(spark, database, mode):
    table, schema = f"{database}.snap", "k string, ingest_date date"
    days = [date(2024, 1, d) for d in range(1, 9)]
    spark.conf.set(tables.OVERWRITE_MODE, mode)
    tables.replace_dates(spark.createDataFrame([("old", d) for d in days], schema), table)

    def write(day):
        return tables.replace_date(spark.createDataFrame([("a", day), ("b", day)], schema), table, day, ["k"])

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(write, days[1:])) == [2] * 7
    assert spark.conf.get(tables.OVERWRITE_MODE) == mode
    spark.conf.set(tables.OVERWRITE_MODE, "dynamic")
    spark.catalog.refreshTable(table)
    got = spark.table(table).groupBy("ingest_date").count().collect()
    assert {r[0]: r[1] for r in got} == {days[0]: 1, **dict.fromkeys(days[1:], 2)}


def test_upsert_newer_rewrites_touched_buckets_only(spark, database):
    table, schema = f"{database}.newest", "k string, v int, x string"
    rows = [(f"k{i}", 1, "old") for i in range(200)] + [("none", None, "old")]
    assert tables.upsert_newer(spark.createDataFrame(rows, schema), table, "k", "v") == 201
    files = set(spark.table(table).inputFiles())
    late = [("k3", 0, "late"), ("k3x", 5, "new")]
    assert tables.upsert_newer(spark.createDataFrame(late[:1], schema), table, "k", "v") > 0
    spark.catalog.refreshTable(table)
    assert len(files - set(spark.table(table).inputFiles())) <= 1
    more = spark.createDataFrame([("k7", 2, "new"), ("none", 1, "new"), ("added", None, "new")], schema)
    tables.upsert_newer(more, table, "k", "v")
    got = {r["k"]: r["x"] for r in spark.table(table).collect()}
    assert len(got) == 202 and [k for k, x in sorted(got.items()) if x == "new"] == ["added", "k7", "none"]
    assert got["k3"] == "old" and tables.upsert_newer(more.limit(0), table, "k", "v") == 0
    with pytest.raises(ValueError):
        tables.upsert_newer(more.unionByName(more), table, "k", "v")


def test_days_of_a_listing(spark, database):
    table, schema = f"{database}.snap", "k string, ingest_date date"
    tables.replace_dates(spark.createDataFrame([("a", D1), ("b", D2), ("c", None)], schema), table)
    first = tables.partition_files(spark, table)
    assert sorted(first) == [D1, D2]
    tables.replace_date(spark.createDataFrame([("a", D1)], schema), table, D1)
    second = tables.partition_files(spark, table)
    assert second[D1] != first[D1] and second[D2] == first[D2]
    tables.replace_date(spark.createDataFrame([], schema), table, D1)
    assert tables.partition_files(spark, table) == {D2: first[D2]}


def test_append_new_runs_evolves_schema(spark, database):
    table = f"{database}.full"
    first = spark.createDataFrame([("r1", 1), (None, 2)], "_run_id string, a int")
    assert tables.append_new_runs(first, table) == 2
    more = spark.createDataFrame(
        [("r1", 5, "x"), ("r2", 6, "y"), (None, 7, "z")], "_run_id string, a int, b string"
    )
    assert tables.append_new_runs(more, table) == 2  # r2, and the row without a run
    key = lambda t: str(t)
    got = sorted([tuple(r) for r in spark.table(table).select("_run_id", "a", "b").collect()], key=key)
    assert got == sorted([("r1", 1, None), (None, 2, None), ("r2", 6, "y"), (None, 7, "z")], key=key)


def test_rescued_data(spark):
    lines = [
        '{"listing_id": "1", "price_min": 5}',
        '{"listing_id": "2", "price_min": "cheap", "extra": {"k": [1]}}',
        "broken {",
    ]
    df = spark.createDataFrame([(text,) for text in lines], "value string")
    rows = landed.parse_landed(df, LISTING_SCHEMA).select("listing_id", "price_min", "_rescued_data")
    assert [tuple(r) for r in rows.collect()] == [
        ("1", 5.0, None),
        ("2", None, '{"price_min":"cheap","extra":"{\\"k\\":[1]}"}'),
        (None, None, '{"_corrupt_record":"broken {"}'),
    ]


def test_each_object_of_a_line_is_parsed_once_for_its_entries(spark):
    df = spark.createDataFrame([('{"_raw": {"id": "1", "floor": 2}, "_search_params": {"bedrooms": "x"}}',)], "value string")
    rows = landed.parse_landed(df.where("value <> ''"), LISTING_SCHEMA)
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("from_json(") == 4  # the line by its schema, and entries of it and two objects
    assert rows.first()["_rescued_data"] == '{"_search_params.bedrooms":"x","_raw.floor":"2"}'


def test_manifest_contract(spark):
    rows = spark.createDataFrame(
        [("scheduled_20260713_b3", date(2026, 7, 13), p, "2026-07-13T05:00:00+00:00") for p in (1, 1, 2)],
        "_run_id string, ingest_date date, _page_num int, _ingested_at string",
    ).withColumn(
        "_search_params",
        F.expr("named_struct('operation','alquiler','property_type','departamentos','location','lima','bedrooms',3)"),
    )
    row = landed.manifests_of(rows, "web").first()
    assert (row["records_written"], row["record_count"], row["pages_scraped"]) == (3, 3, 2)
    assert row["status"] == "success" and row["error"] is None
    assert row["data_path"] == (
        "source=web/operation=alquiler/property=departamento/bedrooms=3/"
        "ingest_date=2026-07-13/run=scheduled_20260713_b3"  # the folder write_landing makes
    )
    assert set(MANIFEST_SCHEMA.fieldNames()) <= set(row.asDict())


def test_scratch_root_prefers_the_shared_folder(spark):
    assert tables.scratch_root(spark) == tables.scratch_root(spark)


def test_rewriting_a_run_keeps_the_others(spark, tmp_path):
    def landed_rows(run, n):
        rows = spark.range(n).selectExpr("cast(id AS string) AS listing_id", f"'{run}' AS _run_id")
        given = {f.name: F.lit(None).cast(f.dataType) for f in LISTING_SCHEMA if f.name not in rows.columns}
        search = F.expr(
            "named_struct('operation','alquiler','property_type','casas','location','lima','bedrooms',1)"
        )
        return rows.withColumns({**given, "_search_params": search, "ingest_date": F.lit(D1)})

    root = str(tmp_path / "raw")
    spark.conf.set(tables.OVERWRITE_MODE, "static")
    for run, n in (("r1", 3), ("r2", 2), ("r1", 1)):
        landed.write_landing(landed_rows(run, n), root, "web")
    spark.conf.set(tables.OVERWRITE_MODE, "dynamic")
    files = spark.read.option("recursiveFileLookup", "true").text(root)
    bronze = landed.bronze_listings(files)
    counts = dict(map(tuple, bronze.groupBy("_run_id").count().collect()))
    assert counts == {"r1": 1, "r2": 2}
    assert bronze.select("_partition_bedrooms", F.col("_partition_ingest_date")).distinct().collect() == [(1, D1)]
    assert "/property=casa/" in bronze.first()["_bronze_source_file"]
