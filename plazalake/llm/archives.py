"""Legacy ARC archives to WARC: writing, converting and reading, record by record.

Archives are gzip files that Spark's text writer makes, one per task, so a lost executor
repeats its file. Readers get the lines of a file in order and cut records out of them by
their declared lengths; they hold one record at a time, whatever the file's size.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalake.llm.common import written

#: Payloads of fewer bytes are never stored as revisits.
LEAST_REVISIT = 100
# The field lists of the two versions' header lines.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURED = "20240101000000"

ARC_RECORD = (
    "archive string, offset bigint, version int, url string, ip string, captured string, mime string, "
    "head binary, payload binary, payload_bytes bigint, payload_digest string"
)


def arc_record(version: int, url: str, date: str, block: bytes, status: int = 200) -> bytes:
    """Header line and network document of one ARC record."""
    url = quote(url, safe="%/:?#[]@!$&'()*+,;=-._~") or "unknown:"
    fields = [url, "0.0.0.0", date, "text/html"]
    if version == 2:
        fields += [str(status), hashlib.md5(block).hexdigest(), "-", "0", "-"]
    return " ".join([*fields, str(len(block))]).encode() + b"\n" + block


def arc_head(version: int, name: str) -> bytes:
    """The version block that opens an ARC file."""
    body = f"{version} 0 plazalake\n{ARC_FIELDS[version]}\n"
    fields = [f"filedesc://{name}", "0.0.0.0", CAPTURED, "text/plain"]
    if version == 2:
        fields += ["200", "-", "-", "0", "-"]
    return f"{' '.join(fields)} {len(body)}\n{body}".encode()


def http_block(page_id: int | None, payload: bytes) -> bytes:
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\nX-Page-Id: {'' if page_id is None else page_id}\r\n\r\n"
    )
    return head.encode() + payload


def _text_rows(values: Iterator[bytes], size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for value in values:
        held.append(value)
        n += len(value)
        if n >= size:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])


def _write(rows: DataFrame, path: str, end: str) -> None:
    text = rows.select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", end).option("compression", "gzip").option("maxRecordsPerFile", 0).text(path)


def write_arc(pages: DataFrame, path: str) -> None:
    """An ARC record for each row of (page_id, url, html); even tasks write version 1
    files, odd ones version 2. Null html is an empty payload, a null or empty url
    ``unknown:``; characters that a header line can't hold are percent-encoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        version = 1 + task % 2

        def values() -> Iterator[bytes]:
            yield arc_head(version, f"{task:05d}.arc")
            for batch in batches:
                for page, url, html in zip(*(batch.column(c) for c in ("page_id", "url", "html")), strict=True):
                    block = http_block(page.as_py(), (html.as_py() or "").encode())
                    yield arc_record(version, url.as_py() or "", CAPTURED, block)

        yield from _text_rows(values())

    _write(pages.select("page_id", "url", "html").mapInArrow(run, "value binary"), path, "\n")


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Stream]]:
    """The byte stream of each archive in turn, from rows (file, value) in file order."""
    source = _Rows(batches)
    while (file := source.file()) is not None:
        stream = Stream(source, file)
        yield file, stream
        stream.rest()


class _Rows:
    """Pieces of (file, bytes): the lines of one batch that lie in one file, joined."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.pieces = self._cut(batches)
        self.next: tuple[str, bytes] | None = next(self.pieces, None)

    @staticmethod
    def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            files = batch.column("file").to_pylist()
            lines = batch.column("value").to_pylist()
            start = 0
            for i in range(1, len(files) + 1):
                if i == len(files) or files[i] != files[start]:
                    yield files[start], b"\n".join(lines[start:i]) + b"\n"
                    start = i

    def file(self) -> str | None:
        return self.next and self.next[0]

    def take(self, file: str) -> bytes:
        if self.file() != file:
            return b""
        data = self.next[1]
        self.next = next(self.pieces, None)
        return data


class Stream:
    """Lines and blocks of declared length from the pieces of one file."""

    def __init__(self, source: _Rows, file: str):
        self.source, self.file, self.buffer, self.at, self.offset = source, file, b"", 0, 0

    def _more(self, wanted: int) -> bool:
        parts, size = [self.buffer[self.at :]], len(self.buffer) - self.at
        while size < wanted and (data := self.source.take(self.file)):
            parts.append(data)
            size += len(data)
        grown = len(parts) > 1
        self.buffer, self.at = b"".join(parts), 0
        return grown

    def line(self) -> bytes | None:
        """The next line without its line feed; None at the end."""
        while (end := self.buffer.find(b"\n", self.at)) < 0:
            if not self._more(len(self.buffer) - self.at + 1):
                return None
        found = self.buffer[self.at : end]
        self.offset += end + 1 - self.at
        self.at = end + 1
        return found

    def block(self, length: int) -> bytes:
        if len(self.buffer) - self.at < length:
            self._more(length)
        found = self.buffer[self.at : self.at + length]
        if len(found) < length:
            raise ValueError(f"{self.file}: a record ends before its declared length")
        self.at += length
        self.offset += length
        return found

    def rest(self) -> None:
        while self.source.take(self.file):
            pass


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Head with its empty line, and payload; no head if the block doesn't start with HTTP."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    m = re.search(rb"\r?\n\r?\n", block)
    end = m.end() if m else len(block)
    return block[:end], block[end:]


def arc_records(stream: Stream) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, version, header fields, block) of each record behind the version block."""
    version, names = 0, []
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        offset = stream.offset - len(line) - 1
        values = line.decode("utf-8", "replace").rstrip("\r").split(" ")
        block = stream.block(int(values[-1]))
        if values[0].startswith("filedesc:"):
            first, fields = block.decode("utf-8", "replace").splitlines()[:2]
            version, names = int(first.split(" ")[0]), fields.split(" ")
            continue
        if len(values) != len(names):
            raise ValueError(f"{stream.file}: {len(values)} fields in a header line of version {version}")
        yield offset, version, dict(zip(names, values, strict=True)), block


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the ARC files in ``path``; without ``payloads`` that column is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in ARC_RECORD.split(", ")]
        rows, size = [], 0
        for file, stream in _streams(batches):
            for offset, version, fields, block in arc_records(stream):
                head, payload = split_http(block)
                rows.append(
                    (
                        file,
                        offset,
                        version,
                        fields["URL"],
                        fields["IP-address"],
                        fields["Archive-date"],
                        fields["Content-type"],
                        head,
                        payload if payloads else None,
                        len(payload),
                        hashlib.sha256(payload).hexdigest(),
                    )
                )
                size += len(payload) if payloads else 400
                if size > 1 << 22:
                    yield _batch(names, rows)
                    rows, size = [], 0
        yield _batch(names, rows)

    return _lines(spark, path).mapInArrow(run, ARC_RECORD)


_TYPES = {
    "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(),
}
ARC_TYPES = [_TYPES[x.split()[1]] for x in ARC_RECORD.split(", ")]


def _batch(names: list[str], rows: list[tuple], types: list[pa.DataType] = ARC_TYPES) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names
    )


def warc_date(captured: str) -> str:
    """14, 12 or 8 digits of an ARC date as a WARC date."""
    d = (captured + "00000000000000")[:14] if len(captured) > 8 else captured[:8] + "000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _record_id(archive: str, offset: int) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}').urn}>"


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the two line ends behind its block."""
    lines = [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block


def convert(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """Rewrite the ARC files of ``arc_path`` as WARC files.

    Ids follow from a record's archive and offset. HTTP records become responses, others
    resources. Of HTTP records with equal payloads of at least LEAST_REVISIT bytes the one
    with the smallest page id, then id, stays; the others revisit it and keep their HTTP
    head alone, whose Content-Length still is that of the payload.
    """
    page = F.expr(r"try_cast(regexp_extract(cast(head AS string), '(?i)X-Page-Id: (\\d+|-\\d+)', 1) AS bigint)")
    index = written(
        read_arc(spark, arc_path, payloads=False)
        .where((F.col("payload_bytes") >= LEAST_REVISIT) & (F.length("head") > 0))
        .select("payload_digest", "archive", "offset", page.alias("page")),
        "arc-index",
    )
    firsts = (
        index.groupBy("payload_digest")
        .agg(
            F.min(F.struct(F.col("page").isNull().alias("no_page"), "page", "archive", "offset")).alias("first"),
            F.count("*").alias("copies"),
        )
        .where("copies > 1")
        .select(
            "payload_digest",
            F.col("first.archive").alias("first_archive"),
            F.col("first.offset").alias("first_offset"),
        )
    )
    # Payloads meet their first record by their own place, which no two share, so that a page
    # that many copy, or an empty one, is no hot key.
    refs = index.join(firsts, "payload_digest").drop("payload_digest", "page")
    joined = read_arc(spark, arc_path).join(refs.hint("shuffle_hash"), ["archive", "offset"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()

        def values() -> Iterator[bytes]:
            info = b"software: plazalake\r\nformat: WARC File Format 1.1\r\n"
            yield warc_record(
                "warcinfo",
                [
                    ("WARC-Record-ID", f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{warc_path}/{task}').urn}>"),
                    ("WARC-Date", warc_date(CAPTURED)),
                    ("Content-Type", "application/warc-fields"),
                ],
                info,
            )
            for batch in batches:
                for i in range(batch.num_rows):
                    yield synthesise({n: batch.column(n)[i].as_py() for n in batch.schema.names})

        yield from _text_rows(values())

    _write(joined.mapInArrow(run, "value binary"), warc_path, WARC_END)


def synthesise(row: dict) -> bytes:
    """The WARC record of an ARC record, ``row``, with the first record of its payload."""
    http = bool(row["head"])
    first = (row["first_archive"], row["first_offset"])
    revisit = http and first[0] is not None and first != (row["archive"], row["offset"])
    fields = [
        ("WARC-Record-ID", _record_id(row["archive"], row["offset"])),
        ("WARC-Date", warc_date(row["captured"])),
        ("WARC-Target-URI", row["url"]),
        ("WARC-IP-Address", row["ip"]),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
    ]
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(*first))]
    block = row["head"] + (b"" if revisit else row["payload"])
    fields += [
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http;msgtype=response" if http else row["mime"]),
    ]
    return warc_record("revisit" if revisit else "response" if http else "resource", fields, block)


WARC_RECORD = (
    "record_id string, record_type string, refers_to_id string, url string, page_id bigint, "
    "payload_bytes bigint, payload_digest string"
)
WARC_TYPES = [_TYPES[x.split()[1]] for x in WARC_RECORD.split(", ")]


def _field(lines: list[bytes], name: bytes) -> str | None:
    for line in lines:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip().decode("utf-8", "replace")
    return None


def warc_records(stream: Stream) -> Iterator[tuple[list[bytes], bytes]]:
    """(header lines, block) of each record."""
    while (line := stream.line()) is not None:
        if not line.startswith(b"WARC/"):
            continue
        head = []
        while (line := stream.line()) is not None and line.strip():
            head.append(line)
        yield head, stream.block(int(_field(head, b"content-length")))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """WARC_RECORD of all records but warcinfo.

    Lengths and digests of responses are those of the bytes read; a digest that differs
    from the declared one raises. Those of revisits are the declared ones of the payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in WARC_RECORD.split(", ")]
        for _, stream in _streams(batches):
            rows = []
            for head, block in warc_records(stream):
                kind = _field(head, b"warc-type")
                if kind == "warcinfo":
                    continue
                http, payload = split_http(block)
                lines = http.splitlines()
                digest = (_field(head, b"warc-payload-digest") or "").removeprefix("sha256:")
                length = len(payload)
                if kind == "revisit":
                    length = int(_field(lines, b"content-length"))
                elif hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"{stream.file}: a payload doesn't have its digest")
                page = _field(lines, b"x-page-id")
                rows.append(
                    (
                        _field(head, b"warc-record-id"),
                        kind,
                        _field(head, b"warc-refers-to"),
                        _field(head, b"warc-target-uri"),
                        int(page) if page else None,
                        length,
                        digest,
                    )
                )
                if len(rows) >= 10_000:
                    yield _batch(names, rows, WARC_TYPES)
                    rows = []
            yield _batch(names, rows, WARC_TYPES)

    return _lines(spark, path).mapInArrow(run, WARC_RECORD)
