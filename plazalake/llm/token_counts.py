"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only.

A batch of the library is filled by bytes, not by rows, and long texts are split, so
neither many nor long texts decide what a worker holds. A text is split only between two
characters that no piece of the vocabulary holds side by side: merging never joins them,
so the counts of the parts add up to the count of the whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

MODEL = "piece_bpe_32k.model"
#: Tokens a document may have before it counts as over the limit.
LIMIT = 4096
#: Bytes of text that are encoded at a time, and characters after which a text is split.
BATCH_BYTES = 1 << 18
PART_CHARS = 1 << 14

_SPACE = "▁"
_counters: dict[str, TokenCounter] = {}


class TokenCounter:
    """Counts tokens as the vocabulary's library does, in parts."""

    def __init__(self, path: str, part_chars: int = PART_CHARS, batch_bytes: int = BATCH_BYTES):
        from sentencepiece import SentencePieceProcessor

        self.part_chars, self.batch_bytes = part_chars, batch_bytes
        self.library = SentencePieceProcessor(model_file=path)
        pieces = map(self.library.id_to_piece, range(self.library.vocab_size()))
        self.joined = {piece[i : i + 2] for piece in pieces for i in range(len(piece) - 1)}

    def parts(self, text: str) -> Iterator[tuple[str, int]]:
        """Parts of ``text``, each about ``part_chars`` long, and how many tokens to take
        off the count of each; a stretch without a safe place stays whole.

        The library puts a space before whatever it encodes. A later part gives it its
        own first space for that, or begins with a character that no space joins: then the
        space is a token too many.
        """
        begin, spare, at = 0, 0, self.part_chars
        while at < len(text) - 1:
            before, after = text[at - 1 : at + 1].replace(" ", _SPACE)
            if before + after in self.joined or (after != _SPACE and _SPACE + after in self.joined):
                at += 1
                continue
            yield text[begin:at], spare
            begin, spare = (at + 1, 0) if after == _SPACE else (at, 1)
            at = begin + self.part_chars
        yield text[begin:], spare

    def _batch(self, held: list[tuple[int, str, int]], counts: np.ndarray) -> None:
        if held:
            rows, parts, spare = zip(*held, strict=True)
            lengths = list(map(len, self.library.encode(list(parts), num_threads=1)))
            np.add.at(counts, np.array(rows), np.array(lengths, np.int64) - np.array(spare))

    def __call__(self, texts: Iterator[tuple[str, int]], rows: int) -> np.ndarray:
        """Token counts of (text, its UTF-8 bytes) pairs."""
        counts, held, size = np.zeros(rows, np.int64), [], 0
        for row, (text, n_bytes) in enumerate(texts):
            share = n_bytes / max(1, len(text))
            for part, spare in self.parts(text):
                held.append((row, part, spare))
                size += int(len(part) * share)
                if size >= self.batch_bytes:
                    self._batch(held, counts)
                    held, size = [], 0
        self._batch(held, counts)
        return counts


def _counter(path: str) -> TokenCounter:
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def _counted(path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            n_bytes = np.array([len(x.as_buffer() or b"") if x.is_valid else 0 for x in texts], np.int64)
            pairs = ((x.as_py() or "", n) for x, n in zip(texts, n_bytes.tolist(), strict=True))
            n_tokens = count(pairs, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)],
                [*batch.schema.names[:-1], "n_bytes", "n_tokens", "over_limit"],
            )

    return run


def count_tokens(docs: DataFrame, *keys: str, model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(``keys``, n_bytes, n_tokens, over_limit) for each row of ``docs``, without a shuffle.

    Null and empty texts have no bytes and no tokens. No begin, end or other token is
    added; strings such as ``</s>`` inside a text are text. Repeated rows are counted
    each; other columns of ``docs`` are not read; an empty table gives no rows.
    """
    rows = docs.select(*keys, "text")
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    schema = ", ".join([*types, "n_bytes bigint, n_tokens bigint, over_limit boolean"])
    return rows.mapInArrow(_counted(model or public_tokenizers.path(MODEL), limit), schema)
