"""How the rows of the given tables are dealt to tasks."""

import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from plazalake.plans import inputs, silver_queries, table_queries


def task_rows(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64k")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("group", [100_000, 1_000])
def test_rows_are_spread_whatever_the_row_groups(spark, tmp_path, small_splits, monkeypatch, group):
    monkeypatch.setattr(inputs, "SPREAD_ROWS", 5_000, raising=False)
    rows = pa.table({"event_id": range(100_000), "text": [f"{i * 7919 % 1_000_003}" * 3 for i in range(100_000)]})
    pq.write_table(rows, f"{tmp_path}/t.parquet", row_group_size=group)
    df = spark.read.parquet(f"{tmp_path}/t.parquet")
    assert df.rdd.getNumPartitions() >= 8
    even = inputs.spread(df, "event_id")
    counts = task_rows(even)
    assert sum(counts) == 100_000 and max(counts) <= 2 * 100_000 / 20
    assert (even is df) == (group == 1_000)
    assert even.agg(F.countDistinct("event_id")).first()[0] == 100_000


def test_an_empty_table_is_spread_over_nothing(spark, tmp_path):
    spark.range(0).write.parquet(f"{tmp_path}/t.parquet")
    assert inputs.spread(spark.read.parquet(f"{tmp_path}/t.parquet"), "id").count() == 0


@pytest.fixture
def broadcast_at_most(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, size)
    spark.conf.set(name, before)


@pytest.fixture
def fresh_tables(tmp_path):
    """Tables that no other test has read."""
    for name in ("events", "customer", "nation"):
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", tmp_path)
    return str(tmp_path)


def test_listings_are_dealt_evenly_behind_joins_that_shuffle(spark, fresh_tables, broadcast_at_most, monkeypatch):
    monkeypatch.setattr(inputs, "SPREAD_ROWS", 50)
    broadcast_at_most("-1")
    rows = inputs.listings(spark, fresh_tables)
    counts = task_rows(rows)
    total = pq.ParquetFile(f"{fresh_tables}/events.parquet").metadata.num_rows
    assert sum(counts) == total and len(counts) == -(-total // 50) and max(counts) <= 2 * 50
    assert rows.agg(F.countDistinct("event_id")).first()[0] == total


def test_only_given_columns_are_dealt(spark, fresh_tables):
    columns = "event_id seg day user_id event_type props amount area page ts district".split()
    rows = inputs.placed_events(spark, fresh_tables).select(*columns)
    plan = rows._jdf.queryExecution().optimizedPlan()
    while "RepartitionByExpression" not in plan.nodeName():
        plan = plan.children().apply(0)
    dealt = {plan.output().apply(i).name() for i in range(plan.output().size())}
    assert dealt == {"event_id", "ts", "user_id", "event_type", "value", "props", "district"}


def test_observations_meet_their_runs_without_a_shuffle(spark, fresh_tables, broadcast_at_most):
    broadcast_at_most("8k")
    typed = silver_queries.silver_typed_observations(spark, fresh_tables)
    plan = typed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_long_expressions_are_written_by_methods_that_the_jvm_compiles(spark, fresh_tables, monkeypatch):
    name, met, seen = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit"), []

    def noting(write):
        return lambda *args, **options: (seen.append(spark.conf.get(name)), write(*args, **options))[1]

    for method in ("parquet", "insertInto"):
        monkeypatch.setattr(DataFrameWriter, method, noting(getattr(DataFrameWriter, method)))
    spark.conf.set(name, "65535")
    try:
        table_queries.table_full_refresh(spark, fresh_tables)
        silver_queries.snapshot_table(spark, fresh_tables)
        assert len(seen) >= 7 and set(seen) == {"8000"}
        assert spark.conf.get(name) == "65535"
    finally:
        spark.conf.set(name, met)
