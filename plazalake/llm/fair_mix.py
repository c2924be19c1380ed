"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Every document waits in its source's queue, in a shuffled order that only its key
decides. Its virtual finish time is the words its source has served with it,
divided by the source's target. The mix serves by finish time until the budget is
spent; a second turn of each queue serves repeats.

Running sums are made in blocks: block totals first, then sums inside a block. The
number of blocks is the square root of the number of rows, so neither the totals
nor a block ever hold more than about that many rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalake.llm.common import SPACES, empty_if_null, written

#: Weights by the rank of the source's name, repeating.
WEIGHTS = (5, 2, 1)
#: The mix holds BUDGET[0] / BUDGET[1] of all words; a source gives its words twice at most.
BUDGET = (3, 2)
TURNS = 2
SEED = "mix"
HASH_BITS = 60

UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)
BEFORE = (Window.unboundedPreceding, -1)


def words_in(text: str | Column) -> Column:
    return F.regexp_count(empty_if_null(text), F.lit(f"[^{SPACES}]+")).cast("long")


def place_in_queue(doc_id: Column, seed: str = SEED) -> Column:
    """A pseudo-random 60-bit number that depends on the key alone."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """Adds rank, weight and target to (source, source_size).

    Shares of the budget by weight, each capped at TURNS times the source's size;
    what a cap sets free is shared again. Sources are filled up in the order of
    cap / weight, so the water level is that of the first one that isn't full.
    Sums are exact decimals; the windows hold one row per source.
    """
    number = "decimal(38,0)"
    names = Window.orderBy(F.col("source").isNull(), "source")
    ranked = (
        sources.withColumn("rank", F.row_number().over(names) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("rank") % len(WEIGHTS) + 1))
        .withColumn("cap", (F.col("source_size") * TURNS).cast(number))
    )
    fill = Window.orderBy(F.col("cap").cast("double") / F.col("weight"), "rank")
    filled = (
        ranked.withColumn("at", F.row_number().over(fill))
        .withColumn("budget", F.sum(F.col("source_size").cast(number)).over(Window.partitionBy()) * BUDGET[0])
        .withColumn(
            "left_over",
            (
                F.col("budget")
                - BUDGET[1] * F.coalesce(F.sum("cap").over(fill.rowsBetween(*BEFORE)), F.lit(0))
            ).cast(number),
        )
        .withColumn(
            "weights_left",
            F.sum("weight").over(Window.partitionBy())
            - F.coalesce(F.sum("weight").over(fill.rowsBetween(*BEFORE)), F.lit(0)),
        )
        .withColumn(
            "open",
            F.col("cap") * (F.col("weights_left") * BUDGET[1]).cast("decimal(18,0)")
            > F.col("left_over") * F.col("weight").cast("decimal(9,0)"),
        )
    )
    first_open = F.min_by(
        F.struct("at", "left_over", "weights_left"), F.when(F.col("open"), F.col("at"))
    ).over(Window.partitionBy())
    return (
        filled.withColumn("level", first_open)
        .withColumn(
            "target",
            F.when(F.col("at") < F.coalesce(F.col("level.at"), F.lit(2**31 - 1)), F.col("cap").cast("double"))
            .otherwise(
                (F.col("level.left_over") * F.col("weight").cast("decimal(9,0)")).cast("double")
                / (F.col("level.weights_left") * BUDGET[1]).cast("double")
            ),
        )
        .select("source", "source_size", "rank", "weight", "target")
    )


def _queued(rows: DataFrame, blocks: int) -> DataFrame:
    """Adds source_size, rank, target and ``served``, the words of the queue up to each row."""
    keys = ["no_source", "source_key", "block"]
    rows = (
        rows.withColumn("no_source", F.col("source").isNull())
        .withColumn("source_key", empty_if_null("source"))
        .withColumn("block", F.floor(F.col("place") / F.lit(2.0**HASH_BITS) * blocks).cast("long"))
    )
    totals = rows.groupBy(*keys).agg(F.sum("size").alias("block_size"))
    per_source = totals.groupBy("no_source", "source_key").agg(F.sum("block_size").alias("source_size"))
    per_source = targets(
        per_source.withColumn("source", F.when(~F.col("no_source"), F.col("source_key")))
    ).select(
        F.col("source").isNull().alias("no_source"),
        empty_if_null("source").alias("source_key"),
        "source_size",
        "rank",
        "target",
    )
    earlier = Window.partitionBy("no_source", "source_key").orderBy("block").rowsBetween(*BEFORE)
    offsets = totals.withColumn("before", F.coalesce(F.sum("block_size").over(earlier), F.lit(0)))
    offsets = offsets.join(per_source, ["no_source", "source_key"]).drop("block_size")
    inside = Window.partitionBy(*keys).orderBy("place", "no_id", "id", "size").rowsBetween(*UP_TO_HERE)
    return rows.join(offsets, keys).withColumn("served", F.col("before") + F.sum("size").over(inside))


def mix(docs: DataFrame, *key_columns: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, ``key_columns``.

    ``taken`` is the number of words the mix takes of the document, 0, 1 or 2 times
    its size: documents are taken whole. Null text: size 0. Null source: a source of
    its own, ranked last. Rows with equal keys stand side by side in the queue and
    are counted each. Documents without words and an empty table give 0 words. Other
    columns of ``docs`` are not read.
    """
    rows = written(
        docs.select(
            "doc_id",
            *key_columns,
            F.col("source").cast("string").alias("source"),
            words_in("text").alias("size"),
            place_in_queue(F.col("doc_id")).alias("place"),
            F.col("doc_id").isNull().alias("no_id"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        ),
        "sizes",
    )
    blocks = max(1, math.isqrt(rows.count() * TURNS))
    queued = written(_queued(rows, blocks), "queued")

    order = ("finish", "place", "rank", "no_id", "id", "size", "turn")
    turns = F.explode(F.array(*map(F.lit, range(TURNS)))).alias("turn")
    finish = (F.col("served") + F.col("turn") * F.col("source_size")).cast("double") / F.col("target")
    items = (
        queued.where("size > 0")
        .select("place", "rank", "no_id", "id", "size", "served", "source_size", "target", turns)
        .withColumn("finish", finish)
        .withColumn("slot", _slot(F.col("finish"), blocks))
    )
    budget = queued.agg((F.coalesce(F.sum("size"), F.lit(0)) * BUDGET[0]).alias("budget"))
    slots = items.groupBy("slot").agg(F.sum("size").alias("slot_size"))
    run = Window.orderBy("slot").rowsBetween(*UP_TO_HERE)
    # The slot in which the budget runs out, and the last item that it still pays for.
    spent = (
        slots.withColumn("upto", F.sum("slot_size").over(run))
        .crossJoin(F.broadcast(budget))
        .where(F.col("upto") * BUDGET[1] > F.col("budget"))
        .agg(F.min_by(F.struct("slot", F.expr("upto - slot_size").alias("before"), "budget"), "slot").alias("at"))
    )
    inside = Window.partitionBy("slot").orderBy(*order).rowsBetween(*UP_TO_HERE)
    last = (
        items.join(F.broadcast(spent), F.col("slot") == F.col("at.slot"))
        .withColumn("upto", F.col("at.before") + F.sum("size").over(inside))
        .where(F.col("upto") * BUDGET[1] <= F.col("at.budget"))
        .agg(F.max(F.struct(*order)).alias("last"))
    )
    limits = spent.crossJoin(last).select(
        F.coalesce(F.col("at.slot"), F.lit(2**62)).alias("last_slot"), "last"
    )

    def taken(turn: int) -> Column:
        time = (F.col("served") + turn * F.col("source_size")).cast("double") / F.when(
            F.col("target") > 0, F.col("target")
        )
        slot = _slot(time, blocks)
        item = F.struct(
            time.alias("finish"), "place", "rank", "no_id", "id", "size", F.lit(turn).alias("turn")
        )
        paid = (slot < F.col("last_slot")) | (
            (slot == F.col("last_slot")) & F.coalesce(item <= F.col("last"), F.lit(False))
        )
        return F.when((F.col("size") > 0) & paid, F.col("size")).otherwise(F.lit(0))

    total = taken(0)
    for turn in range(1, TURNS):
        total = total + taken(turn)
    # limits is one row.
    return queued.crossJoin(F.broadcast(limits)).select(
        "doc_id", "size", "source_size", "target", total.cast("long").alias("taken"), *key_columns
    )


def _slot(finish: Column, blocks: int) -> Column:
    """Equal ranges of finish / (1 + finish), which maps all times into [0, 1)."""
    return F.floor(finish / (1 + finish) * (2 * blocks)).cast("long")
