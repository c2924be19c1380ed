"""The trie of conversation prefixes by ROLLUP over positional turn columns.

A turn's id is a digest of its role and text. A conversation becomes rows of WIDTH turn
ids, its blocks; a block's key is the node that its previous block ends in, so
rolling up (key, turn 1, .., turn WIDTH) gives every prefix of every length with its
aggregates at once, and a long conversation goes on in further rows. A node's own digest
chains its parent's with the last turn's id, so each block's key is known from its conversation
alone and all blocks are rolled up together, whatever the longest conversation is.

Sums over subtrees need no walk down the levels: a node is owned by its smallest member.
What a conversation owns is the end of its path, so a second ROLLUP that adds up what each
member owns in all gives the subtree of a node and what its owner owns above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalake.llm.common import empty_if_null, written

#: Turns of a block, and bytes of a node's digest.
WIDTH = 8
DIGEST_BYTES = 16
#: Ids of one piece of a list that is hashed.
LISTED = 4096
#: Rows of a batch that a worker gives back.
BATCH_ROWS = 4096

ROOT = b""
_TURNS = [f"t{i + 1}" for i in range(WIDTH)]
_BLOCKS = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int32()), ("key", pa.binary())]
    + [(t, pa.string()) for t in _TURNS]
    + [("end", pa.binary())]
)
_BLOCK_TYPES = "conv_id bigint, block int, key binary, " + ", ".join(f"{t} string" for t in _TURNS) + ", end binary"


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text): turns from 0 by turn, null first, then by role and text."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", empty_if_null("role").alias("role"), empty_if_null("text").alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.withColumn("pos", F.row_number().over(order) - 1).select("conv_id", "pos", "role", "text")


def with_shared_heads(turns: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Conversations that branch off: the first turns of conversation c - c % ``every``, then
    c's own; how many comes from c's checksum. Turnless ones have a row at position -1.
    """
    ids = turns.select("conv_id").distinct().select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"),
    )
    heads = turns.where(F.col("pos") < most - 1).withColumnRenamed("conv_id", "base")
    head = ids.join(heads, "base").where("pos < h").select("conv_id", "pos", "role", "text")
    tail = turns.join(ids, "conv_id").where("pos >= h").select("conv_id", "pos", "role", "text")
    none = ids.select("conv_id", F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    return head.unionByName(tail).unionByName(none)


def turn_id() -> Column:
    """Digest of role and text, and the text's bytes; null for a row without a turn."""
    said = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return F.concat(F.substring(F.sha2(said, 256), 1, 2 * DIGEST_BYTES), F.lit(":"), F.octet_length("text").cast("string"))


def _next_node(node: bytes, turn: str) -> bytes:
    return hashlib.sha256(node + turn.encode()).digest()[:DIGEST_BYTES]


def _node_after(turns: Column) -> Column:
    """The same from the columns of a rolled-up row."""
    digest = F.aggregate(
        turns,
        F.col("key"),
        lambda node, t: F.unhex(F.substring(F.sha2(F.concat(node, t.cast("binary")), 256), 1, 2 * DIGEST_BYTES)),
    )
    return digest


class _Conversation:
    def __init__(self, conv_id: int):
        self.conv_id, self.block, self.key, self.node, self.turns = conv_id, 0, ROOT, ROOT, []

    def row(self, end: bytes | None) -> tuple:
        return (self.conv_id, self.block, self.key, *self.turns, *[None] * (WIDTH - len(self.turns)), end)

    def add(self, turn: str) -> tuple | None:
        """A block that is full, now that another turn follows."""
        full = None
        if len(self.turns) == WIDTH:
            full = self.row(None)
            self.block, self.key, self.turns = self.block + 1, self.node, []
        self.turns.append(turn)
        self.node = _next_node(self.node, turn)
        return full


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of conversations whose turns come one after the other; holds one block each."""

    def rows() -> Iterator[tuple]:
        held = None
        for batch in batches:
            for conv_id, turn in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held is None or held.conv_id != conv_id:
                    if held is not None:
                        yield held.row(held.node)
                    held = _Conversation(conv_id)
                full = held.add(turn) if turn is not None else None
                if full is not None:
                    yield full
        if held is not None:
            yield held.row(held.node)

    yield from _batched(rows(), _BLOCKS)


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(values, f.type) for values, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, block, key, t1.., end) of (conv_id, pos, role, text); end is the node of the
    conversation's last turn, in its last block."""
    rows = turns.select("conv_id", "pos", turn_id().alias("turn"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return dealt.select("conv_id", "turn").mapInArrow(_to_blocks, _BLOCK_TYPES)


def _rolled_up(blocked: DataFrame, aggregates: str) -> DataFrame:
    """One row per node: block, key, level, the turns within its block, ``aggregates``.

    Groups that would end in a turn a conversation hasn't are dropped, and so is level 0 of
    later blocks, which the block before has as its last level.
    """
    turns = ", ".join(_TURNS)
    rolled = blocked.sparkSession.sql(
        f"SELECT block, key, {turns}, {WIDTH} - bit_count(grouping_id()) AS level, {aggregates} "
        f"FROM {{blocked}} GROUP BY block, key, ROLLUP({turns})",
        blocked=blocked,
    )
    path = F.slice(F.array(*_TURNS), 1, F.col("level"))
    there = F.when(F.col("level") == 0, F.col("block") == 0).otherwise(F.element_at(path, -1).isNotNull())
    return rolled.withColumn("path", path).where(there)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id, part) rows as pieces of comma-joined ids."""
    schema = pa.schema([("node", pa.binary()), ("part", pa.int32()), ("seq", pa.int64()), ("ids", pa.string())])

    def rows() -> Iterator[tuple]:
        last, held, part, seq = None, [], 0, 0
        for batch in batches:
            for node, conv_id, part in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if held and (node != last or len(held) == LISTED):
                    yield last, part, seq, ",".join(held)
                    held, seq = [], seq + 1
                last = node
                held.append(str(conv_id))
        if held:
            yield last, part, seq, ",".join(held)

    yield from _batched(rows(), schema)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, which come in order."""

    def rows() -> Iterator[tuple]:
        last = digest = None
        for batch in batches:
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if digest is None or node != last:
                    if digest is not None:
                        yield last, digest.hexdigest()
                    last, digest = node, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
        if digest is not None:
            yield last, digest.hexdigest()

    yield from _batched(rows(), pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())]))


def _ends(blocked: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the conversations that end in each node.

    Ids are sorted over all tasks and joined into pieces there, so that the task that
    hashes a node in which very many end reads few rows and holds one piece.
    """
    ends = blocked.where("end IS NOT NULL").select(F.col("end").alias("node"), "conv_id")
    dealt = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = dealt.select("node", "conv_id", F.spark_partition_id().alias("part")).mapInArrow(
        _listed, "node binary, part int, seq bigint, ids string"
    )
    sorted_ = pieces.repartition("node").sortWithinPartitions("node", "part", "seq")
    return sorted_.select("node", "ids").mapInArrow(_digested, "node binary, ends_sha256 string")


def trie(turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations (conv_id, pos, role, text).

    conv_id is the smallest member, parent_conv_id that of the prefix one turn shorter, and
    depth its turns; n_convs counts members, n_children and n_leaves nodes, n_leaves the
    childless ones in the subtree. saved_tokens adds up (n_convs - 1) times the bytes of the
    last text over the subtree; ends_sha256 is the digest of the members that end here.
    Null roles and texts come as empty from ``ordered_turns``, which leaves out rows without
    conv_id; a row with null role is a conversation's mark and no turn. No conversations
    give no rows, not even a root. One conversation's turns are sorted and read in one
    task, a block at a time.
    """
    blocked = written(blocks(turns), "trie-blocks")
    rolled = _rolled_up(blocked, "min(conv_id) AS conv_id, count(*) AS n_convs")
    above = F.slice("path", 1, F.greatest(F.col("level") - 1, F.lit(0)))
    nodes = rolled.select(
        _node_after(F.col("path")).alias("node"),
        F.when(F.col("level") > 0, _node_after(above)).alias("parent"),
        (F.col("block").cast("long") * WIDTH + F.col("level")).alias("depth"),
        "conv_id",
        "n_convs",
        F.when(F.col("level") > 0, F.substring_index(F.element_at("path", -1), ":", -1).cast("long")).otherwise(0).alias("bytes"),
    )
    nodes = written(nodes, "trie-nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    along = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    owned = (
        nodes.join(children, "node", "left")
        .join(parents, "parent", "left")
        .withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "worth": (F.col("n_convs") - 1) * F.col("bytes")})
        .withColumn("above", F.coalesce(F.sum("worth").over(along), F.lit(0)))
        .drop("parent", "bytes")
    )
    owned = written(owned, "trie-owned")
    owners = owned.groupBy("conv_id").agg(
        F.sum("worth").alias("worth"), F.count(F.when(F.col("n_children") == 0, 1)).alias("leaves")
    )
    summed = _rolled_up(blocked.join(owners, "conv_id"), "sum(worth) AS below, sum(leaves) AS n_leaves")
    subtrees = summed.select(_node_after(F.col("path")).alias("node"), "below", "n_leaves")
    nothing = hashlib.sha256().hexdigest()
    return (
        owned.join(subtrees, "node")
        .join(_ends(blocked), "node", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("below") - F.col("above")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )
