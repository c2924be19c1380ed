"""Groups of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Every text has a SimHash of BITS bits over its set and a min-hash key for each of BANDS
bands. At similarity 0.8 two SimHashes differ in about 77 bits of 512, more than any index on
segments can tell from unlike texts, so texts meet if they share a band; one pair of 2e7 at
0.8 does not, and fewer above. Pairs that meet pass a pigeonring filter on the
SimHashes (some chain of the ring of segments keeps within its share of DISTANCE,
before the whole distance is counted), and those that pass are checked on their whole
sets. Only pairs of 0.8 or more are linked. DISTANCE lies more than 7 standard deviations
above the distances of such pairs, 5 for sets of four shingles against five.

Equal texts are compared once. First each text meets the most central text of each of its
bands, the one in the largest groups; texts linked to it are one component. Of bands
that still hold several components, members of different ones are compared inside tasks, tile
by tile: first by SimHash alone, which names the members that need their texts, then
with the texts, a pair in its first common band only. Rows grow with members, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import written
from plazalake.llm.components import component_roots

WORDS = 5
#: Least similarity, in tenths.
TENTHS = 8
BANDS, ROWS = 32, 4
SEED = 42
#: Bits of a SimHash, segments of its ring, segments of the chains that are looked at, and
#: the bits in which texts of similarity 0.8 differ at most.
BITS, SEGMENTS, CHAIN, DISTANCE = 512, 8, 3, 144
#: Members, and shingles of members, that a tile has on average at most.
TILE, TILE_SHINGLES = 1024, 1 << 20

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_RANDOM = np.random.default_rng(SEED)
_DRAWN = _RANDOM.integers(0, 1 << 63, (2, BANDS * ROWS), np.int64).view(np.uint64)
_TIMES, _PLUS = _DRAWN[0] * np.uint64(2) + np.uint64(1), _DRAWN[1]
_PLACES = _RANDOM.integers(0, 1 << 63, WORDS, np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
_LANES = _RANDOM.integers(0, 1 << 63, BITS // 64, np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
_PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Shingles of one text that are permuted, and whose bits are added, at a time.
_BLOCK, _ADDED = 2048, 255
#: Pairs of a tile compared at a time, as rows of one side.
_ROWS_AT_ONCE = 128
_WORDS_KEPT = 300_000


def tokens_of(text: str | None) -> list[bytes]:
    """A text's words; ASCII letters in lower case."""
    return (text or "").encode().translate(_LOWER).split()


def shingle_hashes(tokens: list[bytes], words: int) -> np.ndarray:
    """XXH64 of all shingles of ``words`` words, of all words if there are fewer."""
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(tokens) - words + 1)
    last = ends[min(words, len(tokens)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)),
        np.uint64,
        n,
    )


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS_KEPT:
            self.clear()
        self[word] = made = xxhash.xxh64_intdigest(word, SEED)
        return made


_words = _WordHashes()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _PRIME
    return values ^ (values >> np.uint64(29))


def token_set(tokens: list[bytes]) -> np.ndarray:
    """Sorted distinct hashes of the shingles of WORDS words: of words' hashes, each times its
    place's number. Of fewer words there is one shingle, of none none."""
    if not tokens:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, tokens), np.uint64, len(tokens))
    n = max(1, len(tokens) - WORDS + 1)
    total = np.zeros(n, np.uint64)
    for place in range(min(WORDS, len(tokens))):
        total += hashes[place : place + n] * _PLACES[place]
    return np.unique(_mixed(total))


def shingle_set(text: str | None) -> np.ndarray:
    return token_set(tokens_of(text))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets have a Jaccard similarity of TENTHS tenths or more."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or len(small) * 10 < len(large) * TENTHS:
        return False
    at = large.searchsorted(small)
    at[at == len(large)] = 0
    both = int(np.count_nonzero(large[at] == small))
    return both * 10 >= (len(small) + len(large) - both) * TENTHS


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each band of min-hashes; none without shingles."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for i in range(0, len(hashes), _BLOCK):
        permuted = _TIMES[:, None] * hashes[None, i : i + _BLOCK] + _PLUS[:, None]
        np.minimum(least, permuted.min(axis=1), out=least)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        total = (total ^ row) * _PRIME
        total ^= total >> np.uint64(29)
    return total.view(np.int64)


def wide_print(hashes: np.ndarray) -> bytes:
    """The SimHash of a shingle set: bits that more than half of its hashes have."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), _ADDED):
        lanes = _mixed(hashes[i : i + _ADDED, None] * _LANES[None, :])
        bits = np.unpackbits(lanes.view(np.uint8).reshape(len(lanes), -1), axis=1)
        ones += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return np.packbits(ones * 2 > len(hashes)).tobytes()


def ring_near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether SimHashes, rows of SEGMENTS words that broadcast, differ in DISTANCE bits at most.

    If the ring's differences add up to DISTANCE or less, some segment starts chains all of
    which keep within their proportional share; pairs without such a start fail first.
    """
    apart = np.bitwise_count(a ^ b).astype(np.uint16)
    found = np.zeros(apart.shape[:-1], bool)
    for start in range(SEGMENTS):
        length, total = 0, np.zeros(apart.shape[:-1], np.uint16)
        fits = ~found
        for length in range(1, CHAIN + 1):
            total = total + apart[..., (start + length - 1) % SEGMENTS]
            fits &= total * SEGMENTS <= length * DISTANCE
        found |= fits
    return found & (apart.sum(axis=-1) <= DISTANCE)


def _sizes_near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(a, b) * 10 >= np.maximum(a, b) * TENTHS


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        copies, keys, sizes, prints = [], [], [], []
        for text in batch.column("text"):
            tokens = tokens_of(text.as_py())
            hashes = token_set(tokens)
            copies.append(xxhash.xxh128_digest(b" ".join(tokens)))
            keys.append(band_keys(hashes))
            sizes.append(len(hashes))
            prints.append(wide_print(hashes))
        offsets = np.cumsum([0, *map(len, keys)], dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
        rest = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*map(batch.column, rest), pa.array(copies, pa.binary()), lists, pa.array(sizes, pa.int32()), pa.array(prints, pa.binary())],
            [*rest, "copy", "keys", "shingles", "print"],
        )


def sketches(docs: DataFrame, *keys: str) -> DataFrame:
    """(``keys``, copy, keys, shingles, print): the digest of each row's words, its text's band
    keys, the size of its shingle set and its SimHash."""
    rows = docs.select(*keys, "text")
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    return rows.mapInArrow(_sketched, ", ".join([*types, "copy binary, keys array<bigint>, shingles int, print binary"]))


def _ring_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, SEGMENTS)


def _near_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = ring_near(_ring_rows(batch.column("print_a")), _ring_rows(batch.column("print_b")))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, held = None, np.zeros(0, np.uint64)
    for batch in batches:
        keep = []
        for b, text, other in zip(*map(batch.column, ("b", "text_a", "text_b")), strict=True):
            if b.as_py() != last:
                last, held = b.as_py(), shingle_set(other.as_py())
            keep.append(alike(shingle_set(text.as_py()), held))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _star_links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are alike."""
    first, second = (
        texts.select(F.col("copy").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("shingles", "print"))) for x in "ab"
    )
    sized = pairs.join(first, "a").join(second, "b")
    sized = sized.where(F.least("shingles_a", "shingles_b") * 10 >= F.greatest("shingles_a", "shingles_b") * TENTHS)
    near = written(sized.select("a", "b", "print_a", "print_b").mapInArrow(_near_prints, "a binary, b binary"), "near-prints")
    first, second = (texts.select(F.col("copy").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    both = near.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return written(both.mapInArrow(_checked, "a binary, b binary"), "near-links")


class _Tile:
    """The members of one pair of tiles of a band."""

    def __init__(self, rows: pa.Table):
        self.copies, self.roots = rows.column("copy").to_pylist(), rows.column("root").to_pylist()
        self.side = rows.column("side").to_numpy()
        self.sizes = rows.column("shingles").to_numpy().astype(np.int64)
        self.prints = _ring_rows(rows.column("print"))
        self.keys = np.array(rows.column("keys").to_pylist(), np.int64).reshape(-1, BANDS)
        numbers = {r: i for i, r in enumerate(dict.fromkeys(self.roots))}
        self.root_numbers = np.array([numbers[r] for r in self.roots], np.int64)
        self.band = int(np.flatnonzero(self.keys[0] == rows.column("key")[0].as_py())[0])

    def near_pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs of different components that sizes and SimHashes let pass and whose first
        common band is this."""
        left, right = np.flatnonzero(self.side != 1), np.flatnonzero(self.side != 0)
        for i in range(0, len(left), _ROWS_AT_ONCE):
            a, b = left[i : i + _ROWS_AT_ONCE, None], right[None, :]
            open_ = (self.root_numbers[a] != self.root_numbers[b]) & _sizes_near(self.sizes[a], self.sizes[b])
            if self.side[0] == 2:
                open_ &= a < b
            x, y = np.nonzero(open_)
            x, y = a[x, 0], b[0, y]
            for j in range(0, len(x), 1 << 16):
                p, q = x[j : j + (1 << 16)], y[j : j + (1 << 16)]
                near = ring_near(self.prints[p], self.prints[q])
                p, q = p[near], q[near]
                first = (self.keys[p] == self.keys[q]).argmax(axis=1) == self.band
                yield p[first], q[first]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted (key, low, high, ..) rows, one table for each (key, low, high)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        names = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in names], axis=0)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for i, j in zip(bounds[:-1], bounds[1:], strict=True):
            if i == j:
                continue
            this = tuple(int(c[i]) for c in names)
            if held and this != last:
                yield pa.Table.from_batches(held)
                held = []
            last = this
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, copy) of the members that are in a near pair."""
    for rows in _groups(batches):
        tile = _Tile(rows)
        wanted = np.unique(np.concatenate([np.zeros(0, np.int64), *chain.from_iterable(tile.near_pairs())]))
        copies = [tile.copies[i] for i in wanted.astype(np.int64)]
        key = rows.column("key")[0].as_py()
        yield pa.RecordBatch.from_arrays(
            [pa.array([key] * len(copies), pa.int64()), pa.array(copies, pa.binary())], ["key", "copy"]
        )


def _tile_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between members of different components, at most one for two components."""
    for rows in _groups(batches):
        tile, found = _Tile(rows), []
        texts = rows.column("text")
        sets: dict[int, np.ndarray] = {}
        parent = list(range(int(tile.root_numbers.max()) + 1))

        def root(i: int, tile=tile, parent=parent) -> int:
            x = int(tile.root_numbers[i])
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for p, q in tile.near_pairs():
            for i, j in zip(p.tolist(), q.tolist(), strict=True):
                x, y = root(i), root(j)
                if x == y:
                    continue
                for k in (i, j):
                    if k not in sets:
                        sets[k] = shingle_set(texts[k].as_py())
                if alike(sets[i], sets[j]):
                    parent[x] = y
                    found.append((tile.copies[i], tile.copies[j]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], ["a", "b"]
        )


def _dealt(members: DataFrame) -> DataFrame:
    """``members`` (key, copy, shingles, ..) for each pair of tiles of their band that they are
    part of: sorted by key, low, high."""
    sizes = members.groupBy("key").agg(
        F.ceil(F.greatest(F.count("*") / TILE, F.sum("shingles") / TILE_SHINGLES)).cast("int").alias("tiles")
    )
    tiled = members.join(sizes, "key").withColumn("tile", F.pmod(F.xxhash64("copy"), "tiles").cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    # A member of tile t takes part in the pairs (t, u) for all u >= t and (u, t) for all u < t.
    rest = [c for c in members.columns if c != "key"]
    dealt = tiled.select(
        "key",
        F.least("tile", "other").alias("low"),
        F.greatest("tile", "other").alias("high"),
        F.when(F.col("tile") == F.col("other"), 2).when(F.col("tile") < F.col("other"), 0).otherwise(1).alias("side"),
        *rest,
    )
    return dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")


def roots_of(sketched: DataFrame, docs: DataFrame, *identity: str) -> DataFrame:
    """(copy, root) for each text of ``sketched`` that is linked to another.

    ``docs`` has the texts under the keys ``identity``.
    """
    distinct = sketched.groupBy("copy").agg(F.first(F.struct("keys", "shingles", "print")).alias("of"))
    keyed = written(distinct.select("copy", F.explode("of.keys").alias("key")), "near-keys")
    common = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = written(keyed.join(common, "key"), "near-members")
    weights = members.groupBy("copy").agg(F.sum("n").alias("weight"))
    chosen = sketched.join(weights.select("copy"), "copy", "left_semi").groupBy("copy").agg(
        F.min(F.struct(*identity)).alias("at"), F.first(F.struct("keys", "shingles", "print")).alias("of")
    )
    texts = docs.join(chosen.select("copy", "at.*", "of"), list(identity)).select("copy", "of.*", "text")
    texts = written(texts.dropDuplicates(["copy"]), "near-texts")

    central = members.join(weights, "copy").groupBy("key").agg(F.max(F.struct("weight", "copy"))["copy"].alias("b"))
    stars = members.join(central, "key").select(F.col("copy").alias("a"), "b").where("a <> b").distinct()
    links = _star_links(stars, texts)
    roots = component_roots(links).withColumnRenamed("node", "copy")
    rooted = members.join(roots, "copy", "left").select("key", "copy", F.coalesce("root", "copy").alias("root"))
    apart = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    open_ = written(rooted.join(apart.select("key"), "key"), "near-open")
    facts = open_.join(texts.drop("text"), "copy").select("key", "copy", "root", "keys", "shingles", "print")
    wanted = written(_dealt(facts).mapInArrow(_wanted, "key bigint, copy binary").distinct(), "near-wanted")
    whole = open_.join(wanted, ["key", "copy"]).join(texts, "copy").select(
        "key", "copy", "root", "keys", "shingles", "print", "text"
    )
    more = written(_dealt(whole).mapInArrow(_tile_links, "a binary, b binary"), "near-links")
    return component_roots(links.unionByName(more)).withColumnRenamed("node", "copy")
