"""Which keys a table holds, as a narrow table bucketed by the keys' hash (BR13, JN12).

An insert-only write has to know the keys of all history. The index holds nothing else:
one column, in BUCKETS buckets that are also its partitions. The keys of a micro-batch are dealt
to the same buckets and joined to those they touch, so stored keys are never shuffled,
other buckets are not read, and the wide table is not read at all.

The index is derived: a ledger names the data files whose keys it holds. Files beyond the ledger,
left by a first use or by a run that ended between two writes, are indexed before the
next insert, so a key that is stored is never taken for a new one. Keys indexed twice
do no harm.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Buckets of an index that is made without saying how many. One bucket's keys should fit a task;
#: the number is fixed when the index is made.
BUCKETS = 16


class KeyIndex:
    """The keys of column ``key`` of ``table``; made when first used."""

    def __init__(self, spark: SparkSession, table: str, key: str, buckets: int = BUCKETS):
        self.spark, self.table, self.key = spark, table, key
        self.name, self.ledger = f"{table}__keys", f"{table}__keyed_files"
        self.field = spark.table(table).schema[key]
        if spark.catalog.tableExists(self.name):
            described = spark.sql(f"DESCRIBE EXTENDED {self.name}").where("col_name = 'Num Buckets'")
            self.buckets = int(described.first()["data_type"])
            return
        self.buckets = buckets
        spark.sql(
            f"CREATE TABLE {self.name} (`{key}` {self.field.dataType.simpleString()}, bucket INT) USING parquet "
            f"PARTITIONED BY (bucket) CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS"
        )
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.ledger} (file STRING) USING parquet")

    def bucket(self) -> Column:
        """The number of the bucket that Spark itself puts a key into."""
        return F.pmod(F.hash(self.key), F.lit(self.buckets))

    def dealt(self, keys: DataFrame) -> DataFrame:
        """A frame of keys with each bucket's in one task, as the stored ones are."""
        return keys.select(F.col(self.key).cast(self.field.dataType).alias(self.key)).repartition(self.buckets, self.key)

    def catch_up(self) -> bool:
        """Index the data files the ledger doesn't name; returns whether any keys are held."""
        self.spark.catalog.refreshTable(self.table)
        held = {r["file"] for r in self.spark.table(self.ledger).collect()}
        new = sorted(set(self.spark.table(self.table).inputFiles()) - held)
        if new:
            files = self.spark.read.schema(StructType([self.field])).option("recursiveFileLookup", "true")
            keys = self.dealt(files.parquet(*map(unquote, new)))
            keys.select(self.key, self.bucket().alias("bucket")).write.insertInto(self.name)
            self.spark.createDataFrame([(f,) for f in new], "file string").coalesce(1).write.insertInto(self.ledger)
        return bool(held or new)

    def absent(self, df: DataFrame) -> DataFrame:
        """The distinct keys of ``df`` that aren't stored; NULL never is."""
        keys = self.dealt(df.select(self.key).distinct())
        # A number for each bucket at most.
        touched = [r[0] for r in df.select(self.bucket()).distinct().collect()]
        stored = self.spark.table(self.name).where(F.col("bucket").isin(touched)).select(self.key)
        return keys.join(stored, self.key, "left_anti")
