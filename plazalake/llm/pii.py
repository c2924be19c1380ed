"""Personal data: patterns propose, checksums confirm, nearby words adjust the score.

Four base kinds are reported whenever their pattern and check hold. Further kinds, and
card numbers inside longer runs of digits, are reported when their score, a start value
plus what context words add, reaches a threshold. Each scan is linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
THRESHOLD = 0.6
CONTEXT_CHARS = 48

# The patterns of the base kinds. A match of the two dotted ones can't start
# inside a run of its first class, so the look-behinds change no match; they keep scans linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
DIGITS = re.compile(r"[0-9]+")
NON_DIGITS = re.compile(r"[^0-9]")

#: Score before context, and the words that raise it.
START = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.5, "iban": 0.9, "ssn": 0.3}
RAISE = 0.4
CONTEXT = {
    "email": ("mail", "contact", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "tarjeta", "carte", "karte"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "taxpayer"),
}


class Span(NamedTuple):
    start: int
    kind: str
    end: int
    score: float
    base: bool

    def __str__(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @ and dotted domain, leftmost and not overlapping."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Runs of groups that look like an IBAN, cut behind the last group that mod 97 confirms."""
    for m in IBAN.finditer(text):
        ends = [i for i in range(m.end(), m.start(), -1) if i == m.end() or text[i] == " "]
        for end in ends:
            whole = text[m.start() : end].replace(" ", "")
            if 15 <= len(whole) <= 34 and mod97(whole):
                yield m.start(), end
                break


def proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, base) of all confirmed matches."""
    for start, end in emails(text):
        yield "email", start, end, True
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m[0].split(".")):
            yield "ip", *m.span(), True
    for m in CARD.finditer(text):
        digits = NON_DIGITS.sub("", m[0]) if m.end() - m.start() >= 14 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield "card", *m.span(), True
        elif len(digits) > 19:
            for part in DIGITS.finditer(text, *m.span()):
                if 14 <= len(part[0]) <= 19 and luhn(part[0]):
                    yield "card", *part.span(), False
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NON_DIGITS.sub("", m[0])) <= 15:
                yield "phone", *m.span(), True
    for start, end in _ibans(text):
        yield "iban", start, end, False
    for m in SSN.finditer(text):
        yield "ssn", *m.span(), False


def find(text: str | None) -> list[Span]:
    """All reported spans by start, then kind as listed in KINDS."""
    text = text or ""
    spans = []
    for kind, start, end, base in proposals(text):
        near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
        near = near.lower()
        score = min(1.0, START[kind] + RAISE * any(word in near for word in CONTEXT[kind]))
        if base or score >= THRESHOLD:
            spans.append(Span(start, kind, end, score, base))
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def redact(text: str | None) -> str:
    """The text with every reported span replaced by its kind; of overlapping spans the first."""
    text, out, at = text or "", [], 0
    for span in find(text):
        if span.start >= at:
            out += [text[at : span.start], f"<{span.kind}>"]
            at = span.end
    return "".join([*out, text[at:]])


SPANS = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"


def annotate(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``spans`` in code points, end exclusive.

    Null counts as the empty text, which has no spans; repeated rows are answered each;
    other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct(
            [
                ("kind", pa.string()),
                ("start", pa.int32()),
                ("end", pa.int32()),
                ("score", pa.float64()),
                ("base", pa.bool_()),
            ]
        )
        for batch in batches:
            found = [[s._asdict() for s in find(x.as_py())] for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(span))], ["doc_id", "spans"]
            )

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def digest(spans: list[str]) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()
