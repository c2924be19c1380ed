"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalake.sources.tables import scratch_root

#: The six ASCII white-space characters, as a regular-expression class body.
SPACES = r"\x20\x09-\x0D"


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Installed packages and ``--py-files`` need no such help; a path that a worker
    doesn't have does no harm.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder that ``spark.checkpoint.dir`` names."""
    reachable(spark)
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: object) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what follows reads files that outlive any executor, and
    values such as row numbers are fixed once.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def empty_if_null(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def nulls_last(column: str) -> tuple[Column, Column]:
    """Two sort keys that put nulls behind every value, usable inside a struct."""
    return F.col(column).isNull(), F.col(column)
