"""How far the sources of each language lie from each other, and by which terms.

The kept terms of a language get ids in the order of their counts. The counts of a group
(a language's source) over a block of ids form a segment tree: leaves are counts, a node
is the pair of its halves. Trees are hash-consed: equal pairs of halves are one node,
wherever and in whichever group they stand, so runs of rare or absent terms share nodes.
Two groups are compared by walking both trees at once, level by level; a pair of nodes met
again only raises its multiplicity, so each distinct pair is priced once. Prices of
inner pairs are sums of leaf prices, so adding multiplicities is exact.

Spark counts terms, deals (block, pair of tiles of groups) to tasks and adds up the blocks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalake.llm.common import empty_if_null, written
from plazalake.operators.dedup import top_per_key

#: Documents of a language that a kept term stands in at least.
LEAST_DOCUMENTS = 10
TOP_TERMS = 10
#: Term ids of a block as a power of two, and groups of a tile on average: what a task holds.
BLOCK_BITS = 16
TILE_GROUPS = 16
SCALE = 1_000_000_000

#: Keeps what terms are made of, in lower case; all else becomes a space.
_TERMS = bytes(
    i + 32 if 0x41 <= i <= 0x5A else i if 0x61 <= i <= 0x7A or i >= 0x80 else 0x20 for i in range(256)
)
#: Entries of the partial counts a worker holds, and bytes of a text split at a time.
_HELD_TERMS = 400_000
_SLICE = 1 << 20
_COUNT_FIELDS = ("lang", "source", "term", "n", "docs")
_ABSENT = -1


def _slices(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in order, some at a time."""
    data = (text or "").encode().translate(_TERMS)
    begin = 0
    while begin < len(data):
        end = len(data)
        if end - begin > _SLICE:
            end = data.find(b" ", begin + _SLICE)
            end = len(data) if end < 0 else end
        yield data[begin:end].split()
        begin = end


def terms_of(text: str | None) -> list[str]:
    return [t.decode() for part in _slices(text) for t in part]


def _partial(groups: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in groups.items():
        # The first row stands for the group itself.
        terms = pa.array([None, *n], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(terms), pa.string()),
                pa.array([source] * len(terms), pa.string()),
                terms,
                pa.array([0, *n.values()], pa.int64()),
                pa.array([0, *map(docs.__getitem__, n)], pa.int64()),
            ],
            _COUNT_FIELDS,
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0
    for batch in batches:
        names = (batch.column(i).to_pylist() for i in (0, 1))
        for lang, source, text in zip(*names, batch.column(2), strict=True):
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for part in _slices(text.as_py()):
                n.update(part)
                seen.update(part)
            docs.update(seen)
            held += len(n) - before
            if held > _HELD_TERMS:
                yield from _partial(groups)
                groups, held = {}, 0
    yield from _partial(groups)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group and the
    documents that hold it; a null term with zeros for each group."""
    names = [empty_if_null(F.col(c).cast("string")).alias(c) for c in ("lang", "source", "text")]
    partial = docs.select(*names).mapInArrow(
        _count, "lang string, source string, term string, n bigint, docs bigint"
    )
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str | Column, whole: str | Column) -> Column:
    """1 + floor(SCALE * (n + 2) / whole), exact at any size."""
    n, whole = (F.col(c) if isinstance(c, str) else c for c in (n, whole))
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return F.call_function("div", scaled, whole.cast("decimal(20,0)")) + 1


def divergence(p: str, q: str) -> Column:
    p, q = F.col(p), F.col(q)
    return F.call_function("div", (p - q) * (p - q), p + q)


def _shares(n: np.ndarray, whole: int) -> np.ndarray:
    """``share`` of an array: long division by three digits at a time, so that no product
    passes 63 bits for ``whole`` below 9e15."""
    total, rest = np.divmod(n + 2, whole)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, whole)
        total = total * 1000 + more
    return total + 1


def _divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Forest:
    """Hash-consed segment trees of equal size, one for each row of ``counts``.

    ``levels[k]`` has the two halves of each distinct node of level k + 1, as nodes of
    level k; nodes of level 0 are the distinct counts ``leaves``.
    """

    def __init__(self, counts: np.ndarray):
        width = 1 << max(0, counts.shape[1] - 1).bit_length()
        padded = np.full((len(counts), width), _ABSENT, np.int64)
        padded[:, : counts.shape[1]] = counts
        self.leaves, at = np.unique(padded, return_inverse=True)
        at = at.reshape(padded.shape)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        size = len(self.leaves)
        while at.shape[1] > 1:
            nodes, up = np.unique(at[:, ::2] * size + at[:, 1::2], return_inverse=True)
            self.levels.append(np.divmod(nodes, size))
            at, size = up.reshape(len(at), -1), len(nodes)
        self.roots = at[:, 0]

    def leaf_pairs(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(counts of a, counts of b, how often they face each other), each pair once."""
        x, y, times = self.roots[[a]], self.roots[[b]], np.ones(1, np.int64)
        for left, right in reversed(self.levels):
            x, y = np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
            size = int(y.max()) + 1
            pairs, which = np.unique(x * size + y, return_inverse=True)
            summed = np.zeros(len(pairs), np.int64)
            np.add.at(summed, which, np.concatenate([times, times]))
            (x, y), times = np.divmod(pairs, size), summed
        there = self.leaves[x] != _ABSENT
        return self.leaves[x][there], self.leaves[y][there], times[there]


def _priced(table: pa.Table) -> pa.Table:
    """The block's part of the divergence of each pair of groups of one or two tiles."""
    size = table.column("size")[0].as_py()
    side = table.column("side").to_pylist()
    sources, wholes = table.column("source").to_pylist(), table.column("whole").to_pylist()
    counts = np.zeros((len(sources), size), np.int64)
    for row, entries in enumerate(table.column("entries")):
        if entries.is_valid:
            counts[row, entries.values.field("pos").to_numpy()] = entries.values.field("n").to_numpy()
    rows = range(len(sources))
    if side[0] == 2:
        # Rows come in any order; a pair has to be named alike in every block.
        pairs = list(combinations(sorted(rows, key=sources.__getitem__), 2))
    else:
        pairs = list(product([i for i in rows if side[i] == 0], [i for i in rows if side[i] == 1]))
    forest, values = Forest(counts) if size else None, []
    for a, b in pairs:
        if forest is None:
            values.append(0)
            continue
        of_a, of_b, times = forest.leaf_pairs(a, b)
        values.append(int((_divergences(_shares(of_a, wholes[a]), _shares(of_b, wholes[b])) * times).sum()))
    return pa.table(
        {
            "lang": pa.array([table.column("lang")[0].as_py()] * len(pairs), pa.string()),
            "a": pa.array([sources[a] for a, _ in pairs], pa.string()),
            "b": pa.array([sources[b] for _, b in pairs], pa.string()),
            "value": pa.array(values, pa.int64()),
        }
    )


def _in_blocks(kept: DataFrame) -> DataFrame:
    """``kept`` with block and pos: positions of a block and language are consecutive."""
    order = [F.col("lang"), F.col("lang_n").desc(), F.col("term")]
    # Row numbers count up within each partition of the sorted terms.
    ids = kept.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    mask = (1 << BLOCK_BITS) - 1
    return ids.select(
        "lang", "term", "lang_n", F.shiftright("id", BLOCK_BITS).alias("block"), F.col("id").bitwiseAND(mask).cast("int").alias("pos")
    )


def _pair_values(groups: DataFrame, terms: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, a, b, value) of each pair of groups of a language."""
    blocks = terms.groupBy("lang", "block").agg(F.min("pos").alias("first"), F.count("*").alias("size"))
    entries = counts.groupBy("lang", "source", "block").agg(F.collect_list(F.struct("pos", "n")).alias("entries"))
    tiles = groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE_GROUPS).cast("int").alias("tiles"))
    # A row for each group and block of its language, or one without terms.
    grid = groups.join(tiles, "lang").join(blocks, "lang", "left").withColumn("block", F.coalesce("block", F.lit(-1)))
    grid = grid.join(entries, ["lang", "source", "block"], "left").select(
        "lang",
        "source",
        "whole",
        "block",
        F.coalesce("size", F.lit(0)).alias("size"),
        F.transform("entries", lambda e: F.struct((e["pos"] - F.col("first")).alias("pos"), e["n"].alias("n"))).alias("entries"),
        F.pmod(F.xxhash64("source"), "tiles").cast("int").alias("tile"),
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"),
    )
    # A member of tile t takes part in the pairs (t, u) for all u >= t and (u, t) for all u < t.
    dealt = grid.select(
        "lang",
        "source",
        "whole",
        "block",
        "size",
        "entries",
        F.least("tile", "other").alias("low"),
        F.greatest("tile", "other").alias("high"),
        F.when(F.col("tile") == F.col("other"), 2).when(F.col("tile") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    priced = dealt.groupBy("lang", "block", "low", "high").applyInArrow(
        _priced, "lang string, a string, b string, value bigint"
    )
    return priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) for each (lang, source) group of ``docs``.

    Part ``pair`` has a row for each other source of the language, part ``term`` the
    TOP_TERMS terms that the group uses more than its language. Ranks count from 1 by
    value downwards, equal values by item. Null lang, source and text count as empty;
    every row is a document, repeated ones too; doc_id isn't read, nor are other columns.
    A language without kept terms gives pairs of value 0; an empty table no rows.
    """
    counts = written(term_counts(docs), "term-counts")
    named = counts.where("term IS NOT NULL")
    kept = named.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    terms = written(_in_blocks(kept.where(F.col("docs") >= LEAST_DOCUMENTS)), "kept-terms")
    langs = terms.groupBy("lang").agg(
        (F.sum("lang_n") + 2 * F.count("*")).alias("lang_whole"), (2 * F.count("*")).alias("added")
    )
    held = written(named.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n", "block", "pos"), "kept-counts")
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = (
        counts.where("term IS NULL")
        .select("lang", "source")
        .join(sums, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", (F.coalesce("group_n", F.lit(0)) + F.coalesce("added", F.lit(0))).alias("whole"), "lang_whole")
    )
    groups = written(groups, "groups")

    shares = held.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), share("n", "whole").alias("p"), share("lang_n", "lang_whole").alias("q")
    )
    own = shares.where("p > q").select("lang", "source", "item", divergence("p", "q").alias("value"))
    order = [F.col("value").desc(), F.col("item")]
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)).alias("rank")
    top = top_per_key(own, ["lang", "source"], order, TOP_TERMS)

    pairs = _pair_values(groups, terms, held)
    pairs = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    both = [
        part.select("lang", "source", F.lit(name).alias("part"), "item", "value", rank)
        for name, part in (("pair", pairs), ("term", top))
    ]
    return both[0].unionByName(both[1])
