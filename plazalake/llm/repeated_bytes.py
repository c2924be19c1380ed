"""Removal of repeated 50-byte strings by a depth-limited radix sort of suffixes.

Only suffixes that start at anchors are sorted: an anchor is where the smallest of the
27 hashes of 24-byte strings in some 50-byte window lies. Equal windows have equal
anchors, so two documents share a window exactly if they share an anchor and what lies
around it. The sort goes by three digits, most significant first, and stops at the
threshold; after each, suffixes alone in their group leave:

1. the 24 bytes at the anchor: groups of at least two documents stay;
2. all that windows over the anchor can reach (26 bytes before, 50 from it on): in an
   equal group each but the smallest document's bytes are repeated as a whole;
3. where one first group splits in the second, the single 50-byte windows of the
   smallest documents of each part.

A digit's top bits choose the bucket that a task sorts. Tasks send a bucket one packed
row, in which equal entries of the task are already reduced to the smallest document,
so a string in a third of all documents costs a bucket an entry per task. Buckets
grow in number with the bytes of the texts.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import empty_if_null, fresh_path, written

LENGTH = 50
GRAM = 24
BEFORE = LENGTH - GRAM
REACH = BEFORE + LENGTH
#: Bytes of texts that are worked on at a time, and entries that a task packs at a time.
SLICE = 1 << 20
PACKED = 2_000_000
#: Bytes of texts per bucket, and buckets per shuffle partition at least.
BUCKET_BYTES, BUCKETS_EACH = 8 << 20, 4
#: Bytes of texts in a bucket of the stored table, which one task reads.
STORED_BYTES = 32 << 20

_random = np.random.default_rng(50)
_WEIGHTS = _random.integers(1, 1 << 63, (2, REACH + 2), np.uint64) * np.uint64(2) + np.uint64(1)
_PRIME = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _row_hashes(rows: np.ndarray, which: int = 0) -> np.ndarray:
    """Multilinear hashes of the rows of a matrix of small numbers."""
    return _mixed(((rows.astype(np.uint64) + np.uint64(1)) * _WEIGHTS[which, : rows.shape[1]]).sum(1, dtype=np.uint64))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM bytes from each position on, by doubling."""

    def joined(left: np.ndarray, right: np.ndarray, width: int) -> np.ndarray:
        n = min(len(left), len(right) - width)
        return left[:n] * np.uint64(pow(_PRIME, width, 1 << 64)) + right[width : width + n]

    if len(data) < GRAM:
        return np.zeros(0, np.uint64)
    one = data.astype(np.uint64) + np.uint64(1)
    eight = one
    for width in (1, 2, 4):
        eight = joined(eight, eight, width)
    sixteen = joined(eight, eight, 8)
    n = len(data) - GRAM + 1
    return _mixed(sixteen[:n] * np.uint64(pow(_PRIME, 8, 1 << 64)) + eight[16 : 16 + n])


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    return pick(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of texts that lie one behind the other, and their gram hashes."""
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) < LENGTH:
        return none
    grams = gram_hashes(data)
    rank = (grams >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = _sliding(rank, BEFORE + 1, np.minimum)
    start = 0
    for end in ends.tolist():  # windows that would leave their text count for nothing
        least[max(start, end - LENGTH + 1) : end] = 0
        start = end
    edge = np.zeros(BEFORE, np.uint32)
    most = _sliding(np.concatenate([edge, least, edge]), BEFORE + 1, np.maximum)
    at = np.flatnonzero(most == rank)
    return at, grams[at]


class Sliced:
    """Some rows' texts, one behind the other."""

    def __init__(self, texts: list[bytes], first: int):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts])
        self.starts = np.concatenate([[0], self.ends[:-1]])
        self.rows = np.arange(first, first + len(texts))


def slices(texts: pa.Array) -> Iterator[Sliced]:
    held, n, first = [], 0, 0
    for i, text in enumerate(texts):
        value = text.as_py().encode()
        if held and n + len(value) > SLICE:
            yield Sliced(held, first)
            held, n, first = [], 0, i
        held.append(value)
        n += len(value)
    if held:
        yield Sliced(held, first)


class Entries:
    """Columns of entries: a sort key, a second key, the document and a position."""

    NAMES = ("key", "more", "uid", "ord", "at")
    TYPES = (np.uint64, np.uint64, np.int64, np.int64, np.int64)

    def __init__(self, *columns: np.ndarray):
        self.columns = dict(zip(self.NAMES, columns, strict=True))
        for name, x in self.columns.items():
            setattr(self, name, x)

    def __len__(self) -> int:
        return len(self.key)

    def take(self, index: np.ndarray) -> Entries:
        return Entries(*(x[index] for x in self.columns.values()))

    @classmethod
    def joined(cls, parts: list[Entries]) -> Entries:
        if not parts:
            return cls(*(np.zeros(0, t) for t in cls.TYPES))
        return cls(*(np.concatenate([p.columns[n] for p in parts]) for n in cls.NAMES))

    def ordered(self) -> Entries:
        return self.take(np.lexsort((self.ord, self.more, self.key)))


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values in all columns."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _runs(starts: np.ndarray, n: int) -> np.ndarray:
    """Number of the run of each of n entries."""
    return np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))


def _spans(starts: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    """Start and end of each run of n entries."""
    return zip(starts.tolist(), np.append(starts[1:], n)[: len(starts)].tolist(), strict=True)


def _planes(x: np.ndarray, kind: str) -> bytes:
    """Values byte by byte, all first bytes first, so that empty bytes pack well."""
    return x.astype(kind).view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unplanes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(kind).reshape(-1)


PACKED_ROW = "kind int, bucket int, uid bigint, key binary, more binary, docs binary, counts binary, at binary"
_PACKED_TYPES = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
_PACKED_NAMES = [x.split()[0] for x in PACKED_ROW.split(", ")]
#: Kinds of rows: entries for a bucket, anchors that stay, anchors whose reach is repeated, repeated windows.
FOR_BUCKET, STAYS, REPEATED, WINDOWS = range(4)


def _packed_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in _PACKED_NAMES]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _PACKED_TYPES, strict=True)], _PACKED_NAMES)


def _found_rows(kind: int, uid: np.ndarray, at: np.ndarray) -> list[tuple]:
    """A row for each document with its positions."""
    order = np.lexsort((at, uid))
    uid, at = uid[order], at[order]
    starts = _changes(uid)
    return [
        (kind, None, int(uid[i]), None, None, None, None, at[i:j].astype("<u4").tobytes())
        for i, j in _spans(starts, len(uid))
    ]


def _bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _bucket_rows(entries: Entries, buckets: int, more: str | None) -> list[tuple]:
    """A packed row for each bucket: entries in document order, documents with their counts."""
    bucket = _bucket_of(entries.key, buckets)
    order = np.lexsort((entries.at, entries.uid, bucket))
    entries, bucket = entries.take(order), bucket[order]
    starts = _changes(bucket)
    rows = []
    for i, j in _spans(starts, len(bucket)):
        docs = _changes(entries.uid[i:j])
        ids = np.stack([entries.uid[i:j][docs], entries.ord[i:j][docs]])
        rows.append(
            (
                FOR_BUCKET,
                int(bucket[i]),
                None,
                # Without a second key the low half, which the bucket doesn't tell, is enough.
                entries.key[i:j].astype("<u8" if more else "<u4").tobytes(),
                entries.more[i:j].astype(more).tobytes() if more else None,
                _planes(ids.T.reshape(-1), "<i8"),
                _planes(np.diff(np.append(docs, j - i)), "<u4"),
                _planes(entries.at[i:j], "<u4"),
            )
        )
    return rows


def _unpacked(table: pa.Table, more: str | None) -> Entries:
    parts = []
    for key, second, docs, counts, at in zip(
        *(table.column(c).to_pylist() for c in ("key", "more", "docs", "counts", "at")), strict=True
    ):
        keys = np.frombuffer(key, "<u8" if more else "<u4").astype(np.uint64)
        ids = _unplanes(docs, "<i8").reshape(-1, 2)
        owner = np.repeat(np.arange(len(ids)), _unplanes(counts, "<u4"))
        extra = np.frombuffer(second, more).astype(np.uint64) if more else np.zeros(len(keys), np.uint64)
        parts.append(Entries(keys, extra, ids[owner, 0], ids[owner, 1], _unplanes(at, "<u4").astype(np.int64)))
    return Entries.joined(parts)


def _shared(entries: Entries) -> np.ndarray:
    """Of sorted entries, those whose key is that of more than one document."""
    run = _runs(_changes(entries.key), len(entries))
    first = np.full(run[-1] + 1 if len(run) else 0, np.iinfo(np.int64).max)
    last = np.full(len(first), np.iinfo(np.int64).min)
    np.minimum.at(first, run, entries.uid)
    np.maximum.at(last, run, entries.uid)
    return (first != last)[run] if len(run) else np.zeros(0, bool)


def _smallest(entries: Entries) -> np.ndarray:
    """Of sorted entries, those of the smallest document of their (key, more)."""
    starts = _changes(entries.key, entries.more)
    return entries.ord == entries.ord[starts][_runs(starts, len(entries))] if len(starts) else np.zeros(0, bool)


# First digit.


def _first_map(buckets: int):
    def flush(parts: list[Entries]) -> pa.RecordBatch:
        entries = Entries.joined(parts).ordered()
        shared = _shared(entries)
        rows = _found_rows(STAYS, entries.uid[shared], entries.at[shared])
        # Of a key that the task already knows to be shared, one entry tells the bucket so:
        # it is sent twice, for two documents that no table has.
        keys = np.unique(entries.key[shared])
        told = len(keys) * 2
        marks = Entries(
            np.tile(keys, 2),
            np.zeros(told, np.uint64),
            np.repeat(np.array([-1, -2], np.int64), len(keys)),
            np.zeros(told, np.int64),
            np.zeros(told, np.int64),
        )
        rows += _bucket_rows(Entries.joined([entries.take(~shared), marks]), buckets, None)
        return _packed_rows(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            uid = batch.column("uid").to_numpy(zero_copy_only=False)
            for part in slices(batch.column("text")):
                at, key = anchors(part.data, part.ends)
                owner = np.searchsorted(part.ends, at, side="right")
                zeros = np.zeros(len(at), np.int64)
                parts.append(Entries(key, zeros.astype(np.uint64), uid[part.rows[owner]], zeros, at - part.starts[owner]))
                n += len(at)
                if n >= PACKED:
                    yield flush(parts)
                    parts, n = [], 0
        if n:
            yield flush(parts)

    return run


def _first_reduce(table: pa.Table) -> pa.Table:
    entries = _unpacked(table, None).ordered()
    stays = _shared(entries) & (entries.uid >= 0)
    return pa.Table.from_batches([_packed_rows(_found_rows(STAYS, entries.uid[stays], entries.at[stays]))])


# Second digit.


def _positions(blobs: list[bytes] | None) -> np.ndarray:
    return np.unique(np.concatenate([np.frombuffer(b, "<u4") for b in blobs or [b""]])).astype(np.int64)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, Sliced, np.ndarray, np.ndarray]]:
    """(uid, ord, texts, owner, position) of the marked positions of some texts at a time."""
    for batch in batches:
        uid, order = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "ord"))
        marks = [_positions(x) for x in batch.column("marks").to_pylist()]
        for part in slices(batch.column("text")):
            own = [marks[i] for i in part.rows]
            owner = np.repeat(np.arange(len(own)), [len(m) for m in own])
            yield uid[part.rows], order[part.rows], part, owner, np.concatenate(own)


def _around(part: Sliced, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The REACH bytes around each position, and how many of them lie in the text on both
    sides; bytes outside are 0."""
    place = (part.starts[owner] + at)[:, None] + np.arange(-BEFORE, LENGTH)[None, :]
    inside = (place >= part.starts[owner][:, None]) & (place < part.ends[owner][:, None])
    rows = np.where(inside, part.data[np.clip(place, 0, len(part.data) - 1)], 0)
    sides = np.stack([inside[:, :BEFORE].sum(1), inside[:, BEFORE:].sum(1)], axis=1)
    return np.concatenate([rows, sides], axis=1)


def _second_map(buckets: int):
    def flush(parts: list[Entries]) -> pa.RecordBatch:
        entries = Entries.joined(parts).ordered()
        least = _smallest(entries)
        rows = _found_rows(REPEATED, entries.uid[~least], entries.at[~least])
        return _packed_rows(rows + _bucket_rows(entries.take(least), buckets, "<u8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for uid, order, part, owner, at in _marked(batches):
            for i in range(0, len(at), 1 << 14):
                own, pos = owner[i : i + (1 << 14)], at[i : i + (1 << 14)]
                around = _around(part, own, pos)
                key = _row_hashes(around[:, BEFORE : BEFORE + GRAM])
                parts.append(Entries(key, _row_hashes(around, 1), uid[own], order[own], pos))
                n += len(pos)
            if n >= PACKED // 2:
                yield flush(parts)
                parts, n = [], 0
        if n:
            yield flush(parts)

    return run


def _second_reduce(table: pa.Table) -> pa.Table:
    entries = _unpacked(table, "<u8").ordered()
    least = _smallest(entries)
    rows = _found_rows(REPEATED, entries.uid[~least], entries.at[~least])
    firsts = entries.take(least)
    # First groups that split: of more than one second key, and of more than one document.
    starts = _changes(firsts.key)
    run = _runs(starts, len(firsts))
    parts = np.bincount(run[_changes(firsts.key, firsts.more)], minlength=len(starts))
    split = (parts > 1)[run] & _shared(firsts) if len(run) else np.zeros(0, bool)
    rows += _found_rows(STAYS, firsts.uid[split], firsts.at[split])
    return pa.Table.from_batches([_packed_rows(rows)])


# Third digit.


def _third_map(buckets: int):
    def flush(parts: list[Entries]) -> pa.RecordBatch:
        entries = Entries.joined(parts).ordered()
        least = _smallest(entries)
        rows = _found_rows(WINDOWS, entries.uid[~least], entries.at[~least])
        return _packed_rows(rows + _bucket_rows(entries.take(least), buckets, "<u4"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for uid, order, part, owner, at in _marked(batches):
            place = (part.starts[owner] + at)[:, None] - np.arange(BEFORE + 1)[None, :]
            fits = (place >= part.starts[owner][:, None]) & (place + LENGTH <= part.ends[owner][:, None])
            windows = np.unique(place[fits])
            own = np.searchsorted(part.ends, windows, side="right")
            for i in range(0, len(windows), 1 << 14):
                begin, docs = windows[i : i + (1 << 14)], own[i : i + (1 << 14)]
                rows = part.data[begin[:, None] + np.arange(LENGTH)[None, :]]
                more = _row_hashes(rows, 1) >> np.uint64(32)
                parts.append(Entries(_row_hashes(rows), more, uid[docs], order[docs], begin - part.starts[docs]))
                n += len(begin)
            if n >= PACKED // 2:
                yield flush(parts)
                parts, n = [], 0
        if n:
            yield flush(parts)

    return run


def _third_reduce(table: pa.Table) -> pa.Table:
    entries = _unpacked(table, "<u4").ordered()
    least = _smallest(entries)
    return pa.Table.from_batches([_packed_rows(_found_rows(WINDOWS, entries.uid[~least], entries.at[~least]))])


# The whole.


def _pass(rows: DataFrame, run, reduce, buckets: int, name: str) -> DataFrame:
    """Found rows of one digit: those the tasks know themselves, and those of the buckets.

    Both travel in one shuffle; found rows go to any bucket and through it unchanged.
    """

    def sort_bucket(table: pa.Table) -> pa.Table:
        entries = pc.equal(table.column("kind"), FOR_BUCKET)
        return pa.concat_tables([table.filter(pc.invert(entries)), reduce(table.filter(entries))])

    mapped = rows.mapInArrow(run, PACKED_ROW)
    anywhere = F.pmod(F.xxhash64("uid"), F.lit(buckets)).cast("int")
    dealt = mapped.withColumn("bucket", F.coalesce("bucket", anywhere))
    found = dealt.groupBy("bucket").applyInArrow(lambda table: sort_bucket(table), PACKED_ROW)
    return written(found.select("kind", "uid", "at"), f"{name}-found")


def _marks(found: DataFrame, kind: int, name: str) -> DataFrame:
    return found.where(F.col("kind") == kind).groupBy("uid").agg(F.collect_list("at").alias(name))


def _cuts(text: bytes, reached: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs (starts, ends) of bytes that repeated windows cover."""
    low, high = np.maximum(reached - BEFORE, 0), np.minimum(reached + LENGTH, len(text))
    whole = high - low >= LENGTH
    low, high = np.concatenate([low[whole], windows]), np.concatenate([high[whole], windows + LENGTH])
    if not len(low):
        return low, high
    order = np.argsort(low, kind="stable")
    low, upto = low[order], np.maximum.accumulate(high[order])
    new = np.flatnonzero(np.append(True, low[1:] > upto[:-1]))
    return low[new], upto[np.append(new[1:] - 1, len(low) - 1)]


RESULT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, copy, reached, windows in zip(
            *(batch.column(c).to_pylist() for c in ("text", "copy", "reached", "windows")), strict=True
        ):
            data = text.encode()
            if copy and len(data) >= LENGTH:
                out.append((len(data), len(data), 1, hashlib.sha256(b"").hexdigest()))
                continue
            starts, ends = _cuts(data, _positions(reached), _positions(windows))
            kept, at = hashlib.sha256(), 0
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            out.append((len(data), int((ends - starts).sum()), len(starts), kept.hexdigest()))
        columns = zip(*out, strict=True) if out else [[], [], [], []]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(list(c), t) for c, t in zip(columns, types, strict=True))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _order(doc_id: Column) -> Column:
    """Nulls behind every number."""
    return F.coalesce(doc_id.cast("long"), F.lit(2**63 - 1))


def _stored(docs: DataFrame, size: int) -> DataFrame:
    """The texts with row numbers, as a table bucketed by them: joins on the number move no text.

    Buckets grow in number with the bytes of the texts, as far as Spark allows buckets.
    """
    spark = docs.sparkSession
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    parts = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // STORED_BYTES)), most)
    rows = docs.select("doc_id", empty_if_null("text").alias("text")).select(
        F.monotonically_increasing_id().alias("uid"),
        "doc_id",
        _order(F.col("doc_id")).alias("ord"),
        F.sha2("text", 256).alias("sha"),
        "text",
    )
    name = f"texts_{uuid.uuid4().hex}"
    (
        rows.repartition(parts, "uid")
        .write.bucketBy(parts, "uid")
        .option("path", fresh_path(spark, "texts"))
        .option("compression", "zstd")
        .format("parquet")
        .saveAsTable(name)
    )
    return spark.table(name)


def remove_repeated(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text is empty. A null doc_id counts as larger than every other one and not
    larger than another null; rows with one doc_id never remove each other's bytes. Texts of fewer
    than LENGTH bytes stay whole, an empty table gives no rows, and other columns are
    not read. Whole copies of a smaller document's text are removed whole and are not sorted.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("size")).first()["size"]
    texts = _stored(docs, size)
    ids = texts.select("uid", "ord", "sha")
    firsts = ids.groupBy("sha").agg(F.min(F.struct("ord", "uid")).alias("first"))
    heads = written(
        ids.join(firsts, "sha").select(
            "uid",
            F.col("first.uid").alias("first_uid"),
            (F.col("ord") > F.col("first.ord")).alias("copy"),
        ),
        "heads",
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(BUCKETS_EACH * parts, -(-size // BUCKET_BYTES))

    own = heads.where("uid = first_uid").select("uid").hint("shuffle_hash")
    shared = _pass(texts.join(own, "uid", "left_semi").select("uid", "text"), _first_map(buckets), _first_reduce, buckets, "first")

    def marked(found: DataFrame) -> DataFrame:
        marks = _marks(found, STAYS, "marks").hint("shuffle_hash")
        return texts.join(marks, "uid").select("uid", "ord", "text", "marks")

    second = _pass(marked(shared), _second_map(buckets), _second_reduce, buckets, "second")
    third = _pass(marked(second), _third_map(buckets), _third_reduce, buckets, "third")

    found = second.where(F.col("kind") == REPEATED).unionByName(third.where(F.col("kind") == WINDOWS))
    # Rows that repeat both the text and the doc_id of a first row share what it found.
    twins = heads.where("uid <> first_uid AND NOT copy").select(F.col("uid").alias("twin"), F.col("first_uid").alias("uid"))
    found = found.unionByName(found.join(twins, "uid").select("kind", F.col("twin").alias("uid"), "at"))
    covers = found.groupBy("uid").agg(
        F.collect_list(F.when(F.col("kind") == REPEATED, F.col("at"))).alias("reached"),
        F.collect_list(F.when(F.col("kind") == WINDOWS, F.col("at"))).alias("windows"),
    )
    whole = texts.join(heads.select("uid", "copy").hint("shuffle_hash"), "uid").join(
        covers.hint("shuffle_hash"), "uid", "left"
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return whole.select("doc_id", "text", "copy", "reached", "windows").mapInArrow(
        _removed, f"doc_id {id_type}, {RESULT}"
    )
