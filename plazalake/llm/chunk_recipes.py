"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

Each text is cut where its content says so, each chunk gets an identifier that is
verified to stand for one chunk text, and documents are compared by their ordered
identifier lists. A text is moved once at most, as deduplicated chunks; everything
after that moves lists of 32-byte identifiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import SPACES, empty_if_null, nulls_last, written

CHUNK_MIN, CHUNK_MAX = 256, 2048
#: A chunk ends behind a sentence mark or one of a few word endings, before a space.
BOUNDARY = r"(?:[.!?]|[dgklmp]) "


def normalised(text: str | Column) -> Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(empty_if_null(text), f"[{SPACES}]+", " ")


def chunks_of(text: Column, least: int = CHUNK_MIN, most: int = CHUNK_MAX) -> Column:
    """Consecutive chunks whose concatenation is ``text``: the first boundary from
    ``least`` characters on ends a chunk, else ``most`` characters do."""
    cut = rf"(?s).{{{least},{most}}}?(?:{BOUNDARY}|\z)|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def identifier(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def chunk_store(chunks: DataFrame) -> DataFrame:
    """Distinct (identifier, chunk) of a frame with an array column ``chunks``."""
    exploded = chunks.select(F.explode("chunks").alias("chunk"))
    return exploded.select(identifier(F.col("chunk")).alias("id"), "chunk").distinct()


def verify(store: DataFrame) -> None:
    """Raise if one identifier stands for two different chunk texts."""
    doubtful = store.groupBy("id").count().where("count > 1")
    if not doubtful.isEmpty():
        raise ValueError("one chunk identifier stands for two texts")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are equal when their normalised texts are. The row with the smallest
    doc_id of a group is kept; of repeated rows with that doc_id exactly one is.
    Null texts count as empty, null doc_ids come behind all others, other columns
    of ``docs`` are not read, an empty table gives an empty result.
    """
    texts = docs.select("doc_id", normalised("text").alias("text"))
    chunked = texts.withColumn("chunks", chunks_of(F.col("text")))
    verify(chunk_store(chunked))
    recipes = written(
        chunked.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            F.transform("chunks", identifier).alias("recipe"),
            F.sha2("text", 256).alias("text_sha256"),
        ),
        "recipes",
    )
    groups = recipes.groupBy("recipe").agg(
        F.min(F.struct(*nulls_last("doc_id"), "row")).alias("first"),
        F.count("*").alias("group_size"),
    )
    groups = groups.select(
        "recipe",
        F.col("first.doc_id").alias("keep_id"),
        F.col("first.row").alias("keep_row"),
        "group_size",
    )
    return recipes.join(groups, "recipe").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        "text_sha256",
    )
