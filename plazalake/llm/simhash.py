"""SimHash near-duplicate groups with pigeonring filtering.

Fingerprints are compared once each, however many documents carry them. A
fingerprint is a ring of eight segments; of two that differ in at most three bits,
some start on the ring has all its chains within their proportional share:
chains of two segments 0 differences, of five at most 1, of seven at most 2, of
eight at most 3. So two segments are equal there, and of the twelve-bit halves of
the next three one is equal: sixteen keys of 28 bits for each fingerprint, of which
two linked fingerprints share one. Chains are checked before the whole distance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.llm import near_texts
from plazalake.llm.common import empty_if_null, written
from plazalake.llm.components import component_roots
from plazalake.llm.near_texts import shingle_hashes, tokens_of

SHINGLE_WORDS = 3
BITS = 64
SEGMENTS, SEGMENT_BITS = 8, 8
DISTANCE = 3
#: Members of a key group that one task compares with each other.
TILE = 2048

#: Bits of one batch of shingle hashes that are held unpacked at a time.
_UNPACKED = 1 << 15


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64 majority bits of the hashes of a text's word shingles; 0 without words."""
    hashes = shingle_hashes(tokens_of(text), words)
    n = len(hashes)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, _UNPACKED):
        part = hashes[i : i + _UNPACKED].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [fingerprint(x.as_py()) for x in batch.column("text")]
        signed = pa.array(np.array(made, np.uint64).view(np.int64))
        keep = [i for i, name in enumerate(batch.schema.names) if name != "text"]
        names = [batch.schema.names[i] for i in keep]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), signed], [*names, "bits"])


def fingerprints(docs: DataFrame, *keys: str) -> DataFrame:
    """(``keys``, bits): the fingerprint of each row's text as a signed long."""
    rows = docs.select(*keys, "text")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"), "bits bigint"])
    return rows.mapInArrow(_fingerprints, schema)


def _ring(bits: np.ndarray) -> np.ndarray:
    """Segments of each fingerprint, n x 8, in ring order."""
    return bits.view(np.uint64).astype(">u8").view(np.uint8).reshape(-1, SEGMENTS)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = batch.column("bits").to_numpy(zero_copy_only=False)
        ring = _ring(bits).astype(np.int64)
        for start in range(SEGMENTS):
            at = [ring[:, (start + k) % SEGMENTS] for k in range(5)]
            head = (at[0] << 8) | at[1]
            tail = (at[2] << 16) | (at[3] << 8) | at[4]
            for half, twelve in ((0, tail >> 12), (1, tail & 0xFFF)):
                key = (np.int64(start * 2 + half) << 28) | (head << 12) | twelve
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(bits)], ["key", "bits"])


_COUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _linked(bits: np.ndarray, others: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two groups with a common key that pass the chains and the distance."""
    order = [(start + k) % SEGMENTS for k in range(SEGMENTS)]
    ring, other = _ring(bits)[:, order], _ring(others)[:, order]
    far = np.zeros((len(bits), len(others)), np.uint8)
    for length in range(1, SEGMENTS + 1):
        far += _COUNT[ring[:, length - 1, None] ^ other[None, :, length - 1]]
        far[far > length * DISTANCE // SEGMENTS] = 100
    return np.nonzero(far <= DISTANCE)


def _forest(pairs: Iterable[tuple[int, int]]) -> dict[int, int]:
    """Parent of each node that isn't a root; roots are the smallest of their tree."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = parent.get(p, p)
            x = p
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent) if root(x) != x}


def _group_links(bits: np.ndarray, side: np.ndarray, start: int) -> dict[int, int]:
    """Links of one pair of tiles of a key group, as a forest: at most a link a member."""
    left, right = bits[side != 1], bits[side != 0]
    found: dict[int, int] = {}
    for i in range(0, len(left), 512):
        a, b = _linked(left[i : i + 512], right, start)
        more = zip(left[i + a].tolist(), right[b].tolist(), strict=True)
        found = _forest(chain(found.items(), more))
    return found


def _tile_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of sorted (key, low, high, side, bits) rows, one pair of tiles after the other."""
    rest = None
    for batch in chain(batches, [None]):
        if batch is None:
            if rest is None:
                return
            rows, rest = rest, None
        else:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)])
            rows = rows if rest is None else np.concatenate([rest, rows], axis=1)
            if not rows.shape[1]:
                continue
        cuts = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(0)) + 1
        bounds = [0, *cuts.tolist(), rows.shape[1]]
        if batch is not None:
            rest = rows[:, bounds[-2] :]
            bounds.pop()
        found = []
        for i, j in zip(bounds[:-1], bounds[1:], strict=True):
            found += _group_links(rows[4, i:j], rows[3, i:j], int(rows[0, i]) >> 29).items()
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"]
        )


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between different fingerprints of at most DISTANCE differing bits that
    connect all that are so linked.

    ``distinct`` holds each fingerprint once. A key group of more than TILE members is cut
    into tiles by a hash and every pair of tiles is compared in a task of its own, so no
    task holds more than about two tiles, however large a group is.
    """
    keyed = written(distinct.mapInArrow(_keys, "key bigint, bits bigint"), "simhash-keys")
    sizes = keyed.groupBy("key").count().where("count > 1")
    sizes = sizes.select("key", F.ceil(F.col("count") / TILE).cast("int").alias("tiles"))
    tiled = keyed.join(sizes, "key").withColumn("tile", F.pmod(F.xxhash64("bits"), "tiles").cast("int"))
    # A member of tile t takes part in the pairs (t, u) for all u >= t and (u, t) for all u < t.
    paired = tiled.select(
        "key",
        "bits",
        "tile",
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"),
    ).select(
        "key",
        F.least("tile", "other").alias("low"),
        F.greatest("tile", "other").alias("high"),
        F.when(F.col("tile") == F.col("other"), 2)
        .when(F.col("tile") < F.col("other"), 0)
        .otherwise(1)
        .alias("side"),
        "bits",
    )
    pairs = ["key", "low", "high"]
    dealt = paired.repartition(*pairs).sortWithinPartitions(*pairs)
    return dealt.select(*pairs, "side", "bits").mapInArrow(_tile_links, "a bigint, b bigint").distinct()


def roots_of(prints: DataFrame) -> DataFrame:
    """(bits, root) for each fingerprint of ``prints``; linked ones have one root."""
    distinct = prints.select("bits").distinct()
    roots = component_roots(links(distinct)).withColumnRenamed("node", "bits")
    return distinct.join(roots, "bits", "left").select("bits", F.coalesce("root", "bits").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id.

    component_id is the smallest doc_id of the component; nulls don't count. Null and
    empty texts and those of white space alone have fingerprint 0, linked like any
    other. Other columns of ``docs`` are not read; an empty table gives no rows.
    """
    prints = written(fingerprints(docs, "doc_id"), "fingerprints")
    least = prints.groupBy("bits").agg(F.min("doc_id").alias("least")).join(roots_of(prints), "bits")
    smallest = least.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(least.join(smallest, "root"), "bits").select(
        "doc_id",
        F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that have the smallest (doc_id, text hash)
    of their group; of rows repeated in both exactly one. Groups are those of ``near_texts``.

    Null doc_ids come behind all others; null texts count as empty.
    """
    identity = ["__no_id", "__id", "__sha"]
    rows = docs.withColumns(
        {
            "__no_id": F.col("doc_id").isNull(),
            "__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
            "__sha": F.sha2(empty_if_null("text"), 256),
        }
    )
    sketched = written(near_texts.sketches(rows, *identity), "sketches")
    roots = near_texts.roots_of(sketched, rows, *identity)
    least = sketched.groupBy("copy").agg(F.min(F.struct(*identity)).alias("least")).join(roots, "copy", "left")
    least = least.withColumn("root", F.coalesce("root", "copy"))
    kept = written(least.groupBy("root").agg(F.min("least").alias("kept")).select("kept.*"), "kept")
    return rows.join(kept, identity, "left_semi").dropDuplicates(identity).select(*docs.columns)
