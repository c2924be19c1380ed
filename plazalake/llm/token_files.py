"""Token ids as Parquet lists, in document order, for selective reads.

Documents are range-sorted, encoded, and written as one row each. The ids are
dictionary-encoded lists (delta-packed where the dictionary overflows), row groups and
pages have set sizes, and the writer adds page indexes, so one document's or one id
range's pages, or the metadata columns alone, can be read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plazalake.llm.common import empty_if_null, fresh_path, written
from plazalake.sources.tables import READER_ROWS, reading

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Layout of the files: bytes of a row group, rows of a page, bytes of a dictionary.
FILE_OPTIONS = {
    "compression": "snappy",
    "parquet.block.size": 32 << 20,
    "parquet.page.size": 256 << 10,
    "parquet.page.row.count.limit": 1000,
    "parquet.dictionary.page.size": 1 << 20,
    "parquet.enable.dictionary": True,
    "parquet.writer.version": "v2",
}
#: Words of a generation whose ids a worker keeps: about 80 MB, and as much for the generation before.
CACHED_WORDS = 400_000
#: Texts, and bytes of texts, that are encoded at a time; words whose ids are put together at a time.
ROWS, SLICE, BLOCK = 512, 4 << 20, 1 << 20
#: Ids that a task reads from the files at a time, or those of one longer document.
READ_IDS = 1 << 21

_STOPS = b".,"
_BEYOND_LATIN = "\u0250"
_END = np.int32(END_ID).tobytes()
_encoders: dict[tuple[str, int], WordEncoder] = {}


class WordEncoder:
    """Encodes texts word by word, keeping the ids of words in two generations: a full
    young one becomes the old one, whose words come back as they are met again.

    The vocabulary's normaliser and splitter never look across ASCII white space, so a
    text's ids are those of its words in order. It lower-cases, and splits a full stop or
    comma from a letter before it. Only its special strings reach across such
    borders; texts that may hold one are encoded whole.
    """

    def __init__(self, path: str, most: int = CACHED_WORDS):
        # A task has one core; the library's threads would each keep memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.most, self.young, self.old = Tokenizer.from_file(path), most, {}, {}
        # The same vocabulary for words of Latin letters in lower case, which the normaliser
        # leaves alone and the splitter takes as one piece.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytewise])
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True

    def __call__(self, texts: pa.StringArray | list[str]) -> list[np.ndarray]:
        """The ids of each text and the end id. Only a batch's different words, ASCII letters
        in lower case, are looked up."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        special = pc.match_substring(texts, "<|")
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(special, "", texts)))
        coded = split.flatten().dictionary_encode()
        # Words hold no line feed; the end id stands behind them all.
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), "\n")
        words = joined[0].as_py().encode().split(b"\n") if len(coded.dictionary) else []
        self._learn(set(words).difference(self.young))
        held = [*map(self.young.__getitem__, words), _END]
        ids = np.frombuffer(b"".join(held), np.int32)
        sizes = np.fromiter(map(len, held), np.int32, len(held)) // 4
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        borders = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        order = np.insert(coded.indices.to_numpy(), borders, len(words))
        n = sizes[order]
        ends = np.cumsum(n, dtype=np.int64)
        made = np.empty(ends[-1] if len(ends) else 0, np.int32)
        for i in range(0, len(order), BLOCK):
            part, times, upto = order[i : i + BLOCK], n[i : i + BLOCK], ends[i : i + BLOCK]
            first = upto[0] - times[0]
            # Where each id of the texts stands among those of the different words.
            at = np.repeat(starts[part] - (upto - times), times) + np.arange(first, upto[-1])
            made[first : upto[-1]] = ids[at]
        found = np.split(made, ends[borders[:-1] + np.arange(len(texts) - 1)]) if len(texts) else []
        for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)):
            whole = self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False)
            found[i] = np.array([*whole.ids, END_ID], np.int32)
        return found

    def _learn(self, words: set[bytes]) -> None:
        """Put the ids of ``words`` and of all they consist of into the young generation."""
        young, old = self.young, self.old
        parts, stopped = set(), []
        for word in words:
            ids = old.get(word)
            if ids is not None:
                young[word] = ids
            elif not word:
                young[word] = b""
            elif word[-1] in _STOPS and word[-2:-1].isalpha():
                stopped.append((word, word[:-1], word[-1:]))
                parts.update(stopped[-1][1:])
            else:
                parts.add(word)
        parts.difference_update(young)
        known = [p for p in parts if p in old]
        young.update((p, old[p]) for p in known)
        parts.difference_update(known)
        self._encode(list(parts))
        young.update((word, young[low] + young[stop]) for word, low, stop in stopped)

    def _encode(self, words: list[bytes], at_once: int = 20_000) -> None:
        for i in range(0, len(words), at_once):
            plain, rest = [], []
            for word in words[i : i + at_once]:
                (plain if word.isalpha() or _latin(word) else rest).append(word)
            if plain:
                (made,) = self.plain.encode_batch_fast([b" ".join(plain).decode()], add_special_tokens=False)
                ids = np.array(made.ids, np.int32)
                # Each of these words is one piece, whose last id alone marks its end.
                self._keep(plain, ids, np.append(0, np.flatnonzero(self.ends[ids]) + 1))
            if rest:
                texts = [w.decode() for w in rest]
                made = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
                places = np.fromiter((a for a, _ in made.offsets), np.int64, len(made.ids))
                begins = np.cumsum([0, *(len(w) + 1 for w in texts)])
                self._keep(rest, np.array(made.ids, np.int32), np.searchsorted(places, begins))

    def _keep(self, words: list[bytes], ids: np.ndarray, cuts: np.ndarray) -> None:
        data, cuts = ids.tobytes(), (cuts * 4).tolist()
        self.young.update((w, data[a:b]) for w, a, b in zip(words, cuts[:-1], cuts[1:], strict=True))


def _latin(word: bytes) -> bool:
    """Whether a word with ASCII letters in lower case has nothing but Latin ones in lower case."""
    text = word.decode()
    return text.isalpha() and text.islower() and max(text) < _BEYOND_LATIN


def _encoder(path: str, most: int = CACHED_WORDS) -> WordEncoder:
    if (path, most) not in _encoders:
        _encoders[path, most] = WordEncoder(path, most)
    return _encoders[path, most]


def _slices(texts: pa.StringArray) -> Iterator[tuple[int, int]]:
    """(first row, row behind the last) of up to ROWS texts and SLICE bytes, or of one longer text."""
    upto, i = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while i < len(texts):
        before = upto[i - 1] if i else 0
        j = int(np.searchsorted(upto, before + SLICE, side="right"))
        yield i, (j := min(max(j, i + 1), i + ROWS))
        i = j


def _encode(path: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, most)
        at = 0
        for batch in batches:
            for i, j in _slices(batch.column("text")):
                part = batch.slice(i, j - i)
                ids = encode(part.column("text"))
                n = np.fromiter(map(len, ids), np.int64, len(ids))
                ends = at + np.cumsum(n)
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("part"),
                        pa.array(ends - n),
                        pa.array(n),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))),
                    ],
                    ["doc_id", "part", "at", "n_tokens", "ids"],
                )
                at = int(ends[-1])

    return run


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str | None = None, cached_words: int = CACHED_WORDS
) -> None:
    """Write (doc_id, part, at, n_tokens, ids) of all rows in ascending doc_id order.

    Part files follow each other in doc_id order, nulls last, equal doc_ids by their
    text's hash; ``part`` numbers the files and ``at`` is the place within the file.
    A null text gives the end id alone; other columns of ``docs`` are not read.
    ``cached_words`` bounds a worker's memory and changes no result.
    """
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    keys = (F.col("doc_id").isNull(), F.col("doc_id"), F.col("tie"))
    rows = docs.select("doc_id", empty_if_null("text").alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    tokens = ordered.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(
        _encode(vocabulary, cached_words),
        f"doc_id {id_type}, part int, at bigint, n_tokens bigint, ids array<int>",
    )
    tokens.write.options(**FILE_OPTIONS).parquet(path)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        flat, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
        data = memoryview(flat.astype("<u4")).cast("B")
        sums = [zlib.crc32(data[a * 4 : b * 4]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "ids"]
        names = [n for n in batch.schema.names if n != "ids"]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
            [*names, "n_tokens", "ids_crc32"],
        )


def read_tokens(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents in the files of ``path``.

    The totals that place each file among all ids come from the metadata columns alone
    and have a row per file. Spark's reader holds the lists of a set number of rows, with some
    twenty bytes an id, and more while they grow; so it gets as many rows as READ_IDS allows for
    the longest document, and what was read is written before it gets others.
    """
    files = spark.read.parquet(path)
    longest = files.agg(F.max("n_tokens")).first()[0] or 1
    rows = max(1, min(int(spark.conf.get(READER_ROWS)), READ_IDS // longest))
    id_type = files.schema["doc_id"].dataType.simpleString()
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    totals = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    sums = files.select("doc_id", "part", "at", "ids").mapInArrow(
        _checksums, f"doc_id {id_type}, part int, at bigint, n_tokens bigint, ids_crc32 bigint"
    )
    placed = sums.join(totals, "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
    with reading(spark, rows):
        return written(placed, "token-rows")


def encode_documents(
    docs: DataFrame, vocabulary: str | None = None, cached_words: int = CACHED_WORDS
) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder and read them back."""
    path = fresh_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary, cached_words)
    return read_tokens(docs.sparkSession, path)
