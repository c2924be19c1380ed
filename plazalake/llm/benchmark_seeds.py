"""Benchmark decontamination with spaced seeds.

A seed is a mask over a span of tokens; positions where the mask has a 0 are ignored, so
substituted tokens there don't matter. The seeds' hashes of documents and benchmark items
are joined, and around each common hash the aligned tokens are compared: a document is
contaminated by an item if some stretch of SPAN aligned tokens has at least LEAST_EQUAL
equal ones. Items of fewer tokens than SPAN, down to SHORTEST, are one seed without ignored
positions: a document has to hold the whole item, token by token.

Before the join a Bloom filter of fixed size, made from the items' hashes, drops almost
all hashes of the documents; it can't drop a common one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import empty_if_null, written

SPAN = 12
LEAST_EQUAL = 10
#: Tokens of the shortest item that is looked for; fewer stand in clean texts by chance.
SHORTEST = 5
#: Fixed masks of SPAN positions and weight 7: of any two positions some mask ignores both, so
#: any stretch with LEAST_EQUAL equal tokens has a seed in common. No fewer masks do that.
MASKS = (
    "110110101100",
    "001111100110",
    "111100010101",
    "101010111001",
    "011100101011",
    "000101011111",
    "011011001101",
    "110001110110",
    "110111010010",
)
#: Bits of the Bloom filter, and of its probes for a hash.
FILTER_BITS, PROBES = 1 << 24, 3
#: Bytes of texts that are hashed at a time.
SLICE = 2 << 20

_OFFSETS = [np.flatnonzero(np.frombuffer(m.encode(), np.uint8) == ord("1")) for m in MASKS]
_PRIME = np.uint64(0x100000001B3)
_WORD = np.zeros(256, np.uint8)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Blocks of scripts written without spaces, whose characters are tokens of their own: Thai,
#: Lao, Myanmar, Khmer, kana, ideographs. Blocks of punctuation, which is between tokens.
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF))
_PUNCTUATION = ((0x2000, 0x206F), (0x3000, 0x303F), (0xFF00, 0xFF0F))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finishing permutation of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _in_blocks(points: np.ndarray, blocks: tuple[tuple[int, int], ...]) -> np.ndarray:
    return np.any([(points >= low) & (points <= high) for low, high in blocks], axis=0)


def _bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the tokens of UTF-8 bytes start and end."""
    word, cut = _WORD[raw].astype(bool), np.zeros(len(raw) + 1, bool)
    three = np.flatnonzero((raw & 0xF0) == 0xE0)
    if len(three):
        first, second, third = (raw[three + i].astype(np.int32) for i in range(3))
        points = (first & 0xF) << 12 | (second & 0x3F) << 6 | third & 0x3F
        between = three[_in_blocks(points, _PUNCTUATION)]
        for i in range(3):
            word[between + i] = False
        alone = three[_in_blocks(points, _UNSPACED)]
        cut[alone] = cut[alone + 3] = True
    four = np.flatnonzero(raw == 0xF0)
    if len(four):
        # The planes of further ideographs.
        alone = four[(raw[four + 1] >= 0xA0) & (raw[four + 1] <= 0xB3)]
        cut[alone] = cut[alone + 4] = True
    before, after = np.concatenate([[False], word]), np.concatenate([word, [False]])
    return np.flatnonzero(after & (~before | cut)), np.flatnonzero(before & (~after | cut))


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, and each text's end among them.

    Tokens are runs of ASCII letters in lower case, digits and characters beyond ASCII but
    punctuation; other capitals are to be lower-cased before. Scripts without spaces give
    a token for each character.
    """
    data = b"\n".join(texts) + b"\n"
    raw = _LOWER[np.frombuffer(data, np.uint8)]
    starts, ends = _bounds(raw)
    hashes = np.zeros(len(starts), np.uint64)
    # Polynomial of the bytes, position by position over all tokens that reach it.
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    alive = np.searchsorted(-length[order], -np.arange(1, (length.max() if len(length) else 0) + 1), side="right")
    first, total = starts[order], np.zeros(len(starts), np.uint64)
    for k, n in enumerate(alive):
        total[:n] = total[:n] * _PRIME + raw[first[:n] + k] + np.uint64(1)
    hashes[order] = total
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return _mixed(hashes), np.searchsorted(starts, text_ends)


def seed_hashes(tokens: np.ndarray) -> np.ndarray:
    """Hashes of each mask at each position at which SPAN tokens begin, masks x positions."""
    n = len(tokens) - SPAN + 1
    if n <= 0:
        return np.zeros((len(MASKS), 0), np.uint64)
    out = np.empty((len(MASKS), n), np.uint64)
    for i, offsets in enumerate(_OFFSETS):
        total = np.full(n, i + 1, np.uint64)
        for k in offsets:
            total *= _PRIME
            total += tokens[k : k + n]
            total ^= total >> np.uint64(29)
        out[i] = _mixed(total)
    return out


def run_hashes(tokens: np.ndarray, length: int) -> np.ndarray:
    """Hashes of each run of ``length`` tokens, none ignored."""
    n = max(0, len(tokens) - length + 1)
    total = np.full(n, len(MASKS) + length, np.uint64)
    for k in range(length):
        total *= _PRIME
        total += tokens[k : k + n]
        total ^= total >> np.uint64(29)
    return _mixed(total)


def probe(hashes: np.ndarray, i: int) -> np.ndarray:
    """The filter bit of each hash's probe ``i``."""
    return (hashes >> np.uint64(20 * i)) & np.uint64(FILTER_BITS - 1)


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of up to SLICE bytes, or one longer text."""
    held, n, start = [], 0, 0
    for i, text in enumerate(texts):
        data = (text.as_py() or "").lower().encode()
        if held and n + len(data) > SLICE:
            yield start, held
            held, n, start = [], 0, i
        held.append(data)
        n += len(data)
    if held:
        yield start, held


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, seed, size, item_near): the seeds of each item, and the tokens they cover."""
    for batch in batches:
        for start, texts in _slices(batch.column("text")):
            hashes, ends = token_hashes(texts)
            for i, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
                size = min(SPAN, int(b - a))
                if size < SHORTEST:
                    continue
                if size == SPAN:
                    seeds = seed_hashes(hashes[a:b])
                else:
                    seeds = run_hashes(hashes[a:b], size)[None, :]
                masks, n = seeds.shape
                around = np.zeros(2 * SPAN + max(int(b - a), SPAN), np.uint64)
                around[SPAN : SPAN + b - a] = hashes[a:b]
                near = np.lib.stride_tricks.sliding_window_view(around, 3 * SPAN)[:n]
                item = batch.column("item_id").slice(start + i, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.chunked_array([item] * (masks * n), item.type).combine_chunks(),
                        _signed(seeds.reshape(-1)),
                        pa.array(np.full(masks * n, size, np.int32)),
                        _lists(np.tile(near, (masks, 1))),
                    ],
                    ["item_id", "seed", "size", "item_near"],
                )


def _lists(values: np.ndarray) -> pa.Array:
    """Rows of equal length as an Arrow list column."""
    rows, width = values.shape
    offsets = np.arange(0, rows * width + 1, width, dtype=np.int32) if rows else np.zeros(1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), _signed(np.ascontiguousarray(values).reshape(-1)))


def item_seeds(benchmark: DataFrame) -> DataFrame:
    rows = benchmark.select("item_id", empty_if_null("text").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    return rows.mapInArrow(_item_seeds, f"item_id {kind}, seed bigint, size int, item_near array<bigint>")


def bloom_filter(seeds: DataFrame) -> np.ndarray:
    """Packed filter bits of a column ``seed``: FILTER_BITS / 8 bytes, whatever its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, np.uint8)
        for batch in batches:
            seeds = batch.column("seed").to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(PROBES):
                bits[probe(seeds, i)] = 1
        words = np.packbits(bits).view(np.int64)
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used])], ["word", "bits"])

    parts = seeds.select("seed").mapInArrow(run, "word bigint, bits bigint")
    words = np.zeros(FILTER_BITS // 64, np.int64)
    merged = parts.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    words[merged["word"].to_numpy(np.int64)] = merged["bits"].to_numpy(np.int64)
    return words.view(np.uint8)


def _passing(hashes: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where hashes pass the filter."""
    at = np.nonzero(bits[probe(hashes, 0)])
    for i in range(1, PROBES):
        passed = bits[probe(hashes[at], i)] == 1
        at = tuple(x[passed] for x in at)
    return at


def _document_hits(packed: bytes, keys: list[str], short: list[int]):
    """(keys, seed, near): seeds of documents that pass the filter, with the tokens around them.

    ``short`` has the lengths of the items shorter than SPAN.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(packed, np.uint8))
        for batch in batches:
            for start, texts in _slices(batch.column("text")):
                hashes, ends = token_hashes(texts)
                for length in (SPAN, *short):
                    seeds = seed_hashes(hashes) if length == SPAN else run_hashes(hashes, length)[None, :]
                    mask, at = _passing(seeds, bits)
                    owner = np.searchsorted(ends, at, side="right")
                    within = at + length <= ends[owner] if len(at) else np.zeros(0, bool)
                    mask, at, owner = mask[within], at[within], owner[within]
                    # Tokens from SPAN before the seed to SPAN behind it; 1 outside of the document.
                    begins = np.concatenate([[0], ends[:-1]])[owner]
                    index = at[:, None] + np.arange(-SPAN, 2 * SPAN)[None, :]
                    outside = (index < begins[:, None]) | (index >= ends[owner][:, None])
                    near = hashes[np.clip(index, 0, max(0, len(hashes) - 1))] if len(at) else np.zeros((0, 3 * SPAN), np.uint64)
                    near = np.where(outside, np.uint64(1), near)
                    rows = pa.array(owner + start)
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(k).take(rows) for k in keys), _signed(seeds[mask, at]), _lists(near)],
                        [*keys, "seed", "near"],
                    )

    return run


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the hits that are overlaps: most equal tokens of a stretch of SPAN aligned tokens, or
    all of a shorter item's."""
    for batch in batches:
        near, item = (
            batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, 3 * SPAN) for c in ("near", "item_near")
        )
        size = batch.column("size").to_numpy()
        upto = np.concatenate([np.zeros((len(near), 1), np.int32), np.cumsum(near == item, axis=1, dtype=np.int32)], axis=1)
        best = (upto[:, SPAN:] - upto[:, :-SPAN]).max(axis=1) if len(near) else np.zeros(0, np.int32)
        within = upto[np.arange(len(near)), SPAN + size] - upto[:, SPAN]
        best = np.where(size < SPAN, within, best)
        found = pa.array(best >= np.where(size < SPAN, size, LEAST_EQUAL))
        names = [n for n in batch.schema.names if n not in ("near", "item_near", "size")]
        judged = pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(best)], [*names, "equal_tokens"])
        yield judged.filter(found)


def contaminated(docs: DataFrame, benchmark: DataFrame, *keys: str) -> DataFrame:
    """Distinct (``keys``, item_id, equal_tokens): documents with a stretch of an item.

    ``equal_tokens`` is the most equal tokens of a stretch of SPAN, or the tokens of a shorter
    item, all of which are there. Null texts count as empty; documents and items of fewer
    than SHORTEST tokens have no stretch; a null item_id is an item of its own; empty
    tables give no rows; other columns are not read.
    """
    seeds = written(item_seeds(benchmark), "item-seeds")
    packed = bloom_filter(seeds).tobytes()
    short = sorted(r["size"] for r in seeds.where(F.col("size") < SPAN).select("size").distinct().collect())
    rows = docs.select(*keys, empty_if_null("text").alias("text"))
    types = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]
    hits = rows.mapInArrow(
        _document_hits(packed, list(keys), short), ", ".join([*types, "seed bigint", "near array<bigint>"])
    )
    pairs = hits.join(seeds, "seed")
    kind = seeds.schema["item_id"].dataType.simpleString()
    judged = pairs.select(*keys, "item_id", "size", "near", "item_near").mapInArrow(
        _judge, ", ".join([*types, f"item_id {kind}", "equal_tokens int"])
    )
    return judged.groupBy(*keys, "item_id").agg(F.max("equal_tokens").alias("equal_tokens"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, columns unchanged, whose text has no stretch of an item."""
    rows = docs.withColumn("__sha", F.sha2(empty_if_null("text"), 256))
    bad = written(contaminated(rows, benchmark, "__sha").select("__sha").distinct(), "contaminated")
    return rows.join(bad, "__sha", "left_anti").drop("__sha")
