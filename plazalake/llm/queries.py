"""The registered queries of the training-data operators, with SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalake.llm import (
    archives,
    benchmark_seeds,
    chat_format,
    chunk_recipes,
    fair_mix,
    pii,
    prefix_trie,
    repeated_bytes,
    simhash,
    source_divergence,
    token_counts,
    token_files,
    toxicity,
)
from plazalake.llm.common import fresh_path, table, written
from plazalake.llm.sql import CHAT_FORMAT, CHUNK_RECIPES, FAIR_MIX, PREFIX_TRIE, SOURCE_DIVERGENCE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


@_query()
def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, warc = fresh_path(spark, "arc"), fresh_path(spark, "warc")
    archives.write_arc(table(spark, sf_dir, "pages"), arc)
    archives.convert(spark, arc, warc)
    read = written(archives.read_warc(spark, warc), "warc-records")
    first = read.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    return read.join(first, "refers_to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@_query()
def op2_benchmark_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_seeds.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id"
    )


@_query()
def op3_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query(CHUNK_RECIPES)
def op4_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_recipes.deduplicate(table(spark, sf_dir, "documents"))


@_query()
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_documents(table(spark, sf_dir, "documents"))


@_query()
def op6_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.remove_repeated(table(spark, sf_dir, "documents"))


@_query(FAIR_MIX)
def op7_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mix.mix(table(spark, sf_dir, "documents"))


@_query()
def op8_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.annotate(table(spark, sf_dir, "documents"))

    def listed(spans):
        names = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(names, ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    base = F.filter("spans", lambda s: s["base"])
    counts = [count(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed("spans").alias("spans")
    )


@_query()
def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query(CHAT_FORMAT)
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn int, role string, text string",
    )
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    records = chat_format.records_of(given.unionByName(own))
    made = written(chat_format.format_records(records), "formatted")
    turns = chat_format.read_turns(F.col("formatted"))
    learned = chat_format.learned_text(F.col("formatted"), F.col("loss"))
    read = made.select("conv_id", "formatted", turns.alias("turns"), learned.alias("learned"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", lines), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@_query()
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), "doc_id")


@_query(PREFIX_TRIE)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.with_shared_heads(written(turns, "turns")))


@_query(SOURCE_DIVERGENCE)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


CONTROL_TEXT = "</s>[INST] ok [/INST]"
