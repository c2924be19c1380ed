"""Toxicity by a subsequence string kernel, a support vector machine and Nystroem landmarks.

The kernel of two strings sums over their common subsequences of three letters that
stretch over at most five, each weighed down by its stretch in both; so letters put in
between or gaps lower the similarity but don't remove it. A sentence's instances are its
words, reduced to letters, and its runs of single letters; a sentence is as toxic as its
most toxic instance, and a document as its most toxic sentence (multiple-instance
learning: of a toxic document only the sentences that hold a telling instance count as
positive).

The machine is linear in the similarities to the landmarks, and each of those is linear in the
weights of a string's subsequences. So a fitted model is one table, a weight for each
three letters, and whole batches of texts are scored by looking subsequences up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import empty_if_null

ORDER, DECAY = 3, 0.7
#: Places of a subsequence's second and third letter behind its first.
STEPS = tuple((i, j) for j in range(2, 5) for i in range(1, j))
#: Letter classes: a to z, other letters by code point, and the marks of a word's two ends.
LATIN, CLASSES = 26, 64
START, END = CLASSES - 2, CLASSES - 1
#: Letters of an instance; longer words are taken in overlapping pieces.
PIECE = 24
#: Most labelled documents that the model is fitted on: those whose keys' hashes come first.
FIT_DOCUMENTS = 8_000
#: Most instances of each class, and landmarks of each class.
POSITIVE, NEGATIVE, LANDMARKS = 1000, 4000, 40
#: Telling are letter groups of GRAM, with marks for a word's ends, that are more likely than
#: LEAST_SURE not in toxic documents by chance; and so many at most.
GRAM, LEAST_SURE, TELLING = 5, 0.75, 400
#: Landmarks of one class are less alike than this.
ALIKE = 0.6
PREDICT_FROM = 0.7
COST = 1.0
#: Texts and letters that are scored at a time.
ROWS = 256
SLICE = 1 << 18

SENTENCE_END = re.compile(r"[.!?\n]+(?=\s|$)")
NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Three or more single letters with only white space between.
SPELLED = re.compile(r"(?<!\S)[^\W\d_](?:\s+[^\W\d_]){2,}(?!\w)")


def instances(text: str) -> set[str]:
    """The strings that a sentence is judged by; pieces of up to PIECE letters."""
    text = text.lower()
    words = {NOT_LETTERS.sub("", w) for w in set(text.split())}
    words.update(NOT_LETTERS.sub("", run) for run in SPELLED.findall(text))
    return {w[i : i + PIECE] for w in words if len(w) >= ORDER for i in _pieces(len(w))}


def _pieces(length: int) -> range:
    return range(0, max(1, length - PIECE // 2), PIECE // 2)


SPACE, DROPPED = 0, 255


@cache
def _class_table() -> np.ndarray:
    """Class of each code point of the basic plane: SPACE, a letter's, or DROPPED."""
    table = np.full(0x10000, DROPPED, np.uint8)
    for code in range(0x10000):
        char = chr(code).lower()[:1]
        if char.isspace():
            table[code] = SPACE
        elif char.isalpha():
            at = ord(char) - ord("a")
            table[code] = 1 + at if 0 <= at < LATIN else 1 + LATIN + at % (CLASSES - LATIN - 3)
    return table


def classes(text: str) -> np.ndarray:
    """Letter classes of a text, SPACE between words; what is neither is left out."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    found = _class_table()[np.minimum(codes, 0xFFFF)]
    return found[found != DROPPED]


def size_of(lengths: np.ndarray) -> np.ndarray:
    """What a string's kernel values are divided by: the root of its own subsequences' squares."""
    total = np.zeros(len(lengths))
    for _, j in STEPS:
        total += DECAY ** (2 * (j + 1)) * np.maximum(lengths - j, 0)
    return np.sqrt(total)


def _places(letters: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each pair of steps: table places of the subsequences that begin at each letter
    (place 0 where one would leave its word), and their weight."""
    wide = letters.astype(np.int32)
    breaks = np.cumsum(letters == SPACE, dtype=np.int32)
    for i, j in STEPS:
        n = max(0, len(wide) - j)
        place = (wide[:n] * CLASSES + wide[i : i + n]) * CLASSES + wide[j : j + n]
        whole = (breaks[:n] == breaks[j : j + n]) & (wide[:n] != SPACE)
        yield np.where(whole, place, 0), DECAY ** (j + 1)


def _weights_from(letters: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of the table's weights of the subsequences that begin at each letter."""
    total = np.zeros(len(letters))
    for place, weight in _places(letters):
        total[: len(place)] += weight * table[place]
    return total


def _words(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of letters."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], letters != SPACE, [False]])))
    return edge[::2], edge[1::2]


def _marked(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters with a mark at both ends of each word, and the words' new starts and ends."""
    shift = 2 * np.arange(len(starts))
    out = np.zeros(len(letters) + 2 * len(starts), np.uint8)
    inside = np.flatnonzero(letters)
    out[inside + np.repeat(shift + 1, ends - starts)] = letters[inside]
    out[starts + shift], out[ends + shift + 1] = START, END
    return out, starts + shift, ends + shift + 2


def _strings(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marked classes of some strings of letters, and where each starts and ends among them."""
    codes = [_class_table()[min(ord(c), 0xFFFF)] for s in strings for c in [*s, " "]]
    ends = np.cumsum([len(x) + 1 for x in strings]) - 1
    return _marked(np.array(codes, np.uint8), ends - [len(x) for x in strings], ends)


def table_of(string: str) -> np.ndarray:
    """The string's subsequence weights over its size."""
    letters, starts, ends = _strings([string])
    table = np.zeros(CLASSES**3)
    for place, weight in _places(letters):
        np.add.at(table, place, weight)
    table[0] = 0
    return table / size_of(ends - starts)[0]


def similarities(strings: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel values over both sizes, strings x landmarks."""
    letters, starts, ends = _strings(strings)
    sizes = size_of(ends - starts)
    out = np.zeros((len(strings), len(landmarks)))
    for k, mark in enumerate(landmarks):
        upto = np.concatenate([[0], np.cumsum(_weights_from(letters, table_of(mark)))])
        out[:, k] = (upto[ends] - upto[starts]) / sizes
    return out


@dataclass
class Model:
    """The landmarks with their weights, and the calibration of document scores."""

    landmarks: list[str]
    weights: np.ndarray
    bias: float
    calibration: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0)

    def table(self) -> np.ndarray:
        table = np.zeros(CLASSES**3)
        for mark, weight in zip(self.landmarks, self.weights, strict=True):
            table += weight * table_of(mark)
        return table

    def probability(self, found: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_document_features(found) @ np.array(self.calibration), -40, 40)))


def _document_features(found: np.ndarray) -> np.ndarray:
    """Of a text's (largest decision value, sum of positive values, instances): the largest
    value, within the margins, the others' sum and the length, on a log scale."""
    most, total, n = found.T
    clipped = np.clip(most, -1.5, 1.0)
    rest = np.maximum(total - np.maximum(most, 0), 0)
    return np.column_stack([clipped, np.log1p(rest), np.log1p(n), np.ones(len(found))])


def _spelled(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The runs of three or more single letters, joined, each with a SPACE behind it."""
    single = np.concatenate([[False], ends - starts == 1, [False]])
    edge = np.flatnonzero(single[1:] != single[:-1])
    runs = [letters[starts[a:b]] for a, b in zip(edge[::2], edge[1::2], strict=True) if b - a >= ORDER]
    return np.concatenate([np.append(r, SPACE) for r in runs]) if runs else letters[:0]


def raw_scores(texts: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    """(largest decision value, sum of positive ones, number) of each text's instances;
    ``bias``, the value of no match, for a text without any."""
    parts, owners, n = [], [], 0
    out = np.column_stack([np.full(len(texts), bias), np.zeros(len(texts)), np.zeros(len(texts))])

    def flush() -> None:
        letters = np.concatenate(parts)
        starts, ends = _words(letters)
        owner = np.array(owners)[np.searchsorted(np.cumsum([len(p) for p in parts]), starts, side="right")]
        fits = ends - starts >= ORDER
        letters, starts, ends = _marked(letters, starts, ends)
        starts, ends, owner = starts[fits], ends[fits], owner[fits]
        upto = np.concatenate([[0], np.cumsum(_weights_from(letters, table))])
        long = np.flatnonzero(ends - starts > PIECE + 2)
        if len(long):
            cut = [
                (starts[w] + i, min(starts[w] + i + PIECE, ends[w]), owner[w])
                for w in long
                for i in _pieces(ends[w] - starts[w])
            ]
            begin, end, whose = np.array(cut).T
            starts, ends, owner = (
                np.concatenate([np.delete(x, long), y]) for x, y in ((starts, begin), (ends, end), (owner, whose))
            )
        values = (upto[ends] - upto[starts]) / size_of(ends - starts) + bias
        np.maximum.at(out[:, 0], owner, values)
        out[:, 1] += np.bincount(owner, np.minimum(np.maximum(values, 0), 1), len(out))
        out[:, 2] += np.bincount(owner, minlength=len(out))

    for i, text in enumerate(texts):
        letters = np.append(classes(text), np.uint8(SPACE))
        letters = np.concatenate([letters, _spelled(letters, *_words(letters))])
        parts.append(letters)
        owners.append(i)
        n += len(letters)
        if n >= SLICE:
            flush()
            parts, owners, n = [], [], 0
    if parts:
        flush()
    return out


def _svm(features: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps on the primal problem."""
    x = np.hstack([features, np.ones((len(features), 1))]).astype(np.float64)
    w = np.zeros(x.shape[1])
    penalty = np.eye(len(w))
    penalty[-1, -1] = 1e-6
    for _ in range(50):
        active = labels * (x @ w) < 1
        xa, ca = x[active], weights[active]
        hessian = penalty + COST * (xa * ca[:, None]).T @ xa
        new = np.linalg.solve(hessian, COST * xa.T @ (ca * labels[active]))
        if np.allclose(new, w, atol=1e-8):
            break
        w = 0.5 * w + 0.5 * new if _ > 20 else new
    return w[:-1], float(w[-1])


def _spread(strings: list[str], most: int = LANDMARKS) -> list[str]:
    """The first strings of which none is much like an earlier one."""
    chosen: list[str] = []
    alike = np.zeros(len(strings))
    for i, string in enumerate(strings):
        if alike[i] < ALIKE:
            chosen.append(string)
            if len(chosen) == most:
                break
            alike = np.maximum(alike, similarities(strings, [string])[:, 0])
    return chosen


def _fit_machine(positive: dict[str, float], negative: dict[str, float]) -> Model:
    """Landmarks: positive strings unlike each other, and the negative ones most like them."""
    if not positive or not negative:
        return Model([], np.zeros(0), -1.0)
    strong = sorted(positive, key=lambda s: (-positive[s], s))
    names = sorted(set(negative).difference(positive))
    marks = _spread(strong)
    near = similarities(names, marks).max(1)
    hard = _spread([names[i] for i in np.lexsort((names, -near))])
    landmarks = marks + hard
    values, vectors = np.linalg.eigh(similarities(landmarks, landmarks))
    kept = values > 1e-3
    root = vectors[:, kept] / np.sqrt(values[kept])
    features = similarities(strong + names, landmarks) @ root
    labels = np.array([1.0] * len(strong) + [-1.0] * len(names))
    counts = np.array([positive[s] for s in strong] + [negative[s] for s in names], np.float64)
    w, bias = _svm(features, labels, counts)
    return Model(landmarks, root @ w, bias)


def _calibrate(model: Model, found: np.ndarray, labels: np.ndarray) -> None:
    """Logistic regression of the labels on the documents' features."""
    if len(set(labels.tolist())) < 2:
        return
    x = _document_features(found)
    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.clip(np.linalg.solve(hessian, x.T @ (labels - p) - 1e-2 * w), -2, 2)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    model.calibration = tuple(w.tolist())


def fit(labelled: DataFrame) -> Model:
    """Fit on rows (text, toxic 0/1), a bounded sample. Rows without a label are left out;
    without rows of both labels every score is that of an untold text."""
    chosen = labelled.where(F.col("toxic").isin(0, 1)).select(
        empty_if_null("text").alias("text"), F.col("toxic").cast("int").alias("toxic")
    )
    chosen = chosen.repartition(labelled.sparkSession.sparkContext.defaultParallelism).persist()
    try:
        totals = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
        strings = chosen.mapInArrow(_labelled_sentences, "toxic int, gram boolean, string string")
        counts = strings.groupBy("gram", "string").agg(
            F.sum("toxic").cast("long").alias("bad"), F.sum(1 - F.col("toxic")).cast("long").alias("good")
        )
        counts = counts.persist()
        telling = _telling(counts.where("gram"), totals)
        found = counts.where("NOT gram").drop("gram")
        model = _fit_machine(
            _with_telling(found.where("bad > good"), telling, "bad"), _ordinary(found, telling)
        )
        counts.unpersist()
        scored = chosen.mapInArrow(_raw_scores(model), "most double, total double, n double, toxic int").toPandas()
        _calibrate(model, scored[["most", "total", "n"]].to_numpy(), scored["toxic"].to_numpy(np.float64))
    finally:
        chosen.unpersist()
    return model


def grams(string: str) -> set[str]:
    marked = f"^{string}$"
    return {marked[i : i + GRAM] for i in range(max(1, len(marked) - GRAM + 1))}


def _labelled_sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, gram, string): each distinct instance of a document's sentences, and each
    of their letter groups, with the document's label."""
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
            found: set[str] = set()
            for sentence in SENTENCE_END.split(text.as_py()):
                found |= instances(sentence)
            groups = set().union(*map(grams, found)) if found else set()
            strings = [*sorted(found), *sorted(groups)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([toxic.as_py()] * len(strings), pa.int32()),
                    pa.array([False] * len(found) + [True] * len(groups), pa.bool_()),
                    pa.array(strings, pa.string()),
                ],
                ["toxic", "gram", "string"],
            )


def _sureness(cells: dict[tuple[int, int], int], share: float) -> dict[tuple[int, int], float]:
    """For each (documents, toxic ones) of letter groups, the share of groups with as many
    documents and at least as many toxic ones that chance doesn't explain.

    ``cells`` counts the groups of each kind, ``share`` is that of toxic documents. The measure
    scales with the labels: a few documents suffice where few groups get so far by chance.
    """
    most = max((n for n, _ in cells), default=0)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, most + 1)))])
    groups: dict[int, dict[int, int]] = {}
    for (n, bad), count in cells.items():
        groups.setdefault(n, {})[bad] = count
    sure = {}
    for n, counts in groups.items():
        total, seen = sum(counts.values()), 0
        for bad in sorted(counts, reverse=True):
            seen += counts[bad]
            if 2 * bad <= n:
                break
            k = np.arange(bad, n + 1)
            tail = np.exp(logs[n] - logs[k] - logs[n - k] + k * np.log(share) + (n - k) * np.log1p(-share)).sum()
            sure[n, bad] = max(0.0, 1 - total * float(tail) / seen)
    return sure


def _telling(counts: DataFrame, totals: dict[int, int]) -> dict[str, float]:
    """The letter groups that tell most, by the signed root of the likelihood ratio of
    their document counts, each with its sureness."""
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return {}
    share = bad / (bad + good)
    cells = counts.groupBy((F.col("bad") + F.col("good")).alias("n"), "bad").count().collect()
    sure = _sureness({(r["n"], r["bad"]): r["count"] for r in cells}, share)
    rows = [(n, b, s) for (n, b), s in sure.items() if s >= LEAST_SURE]

    def part(hits: Column, of: float) -> Column:
        return F.when(hits > 0, hits * F.log(hits / ((F.col("bad") + F.col("good")) * of))).otherwise(0.0)

    passed = counts.sparkSession.createDataFrame(rows, "n long, bad long, sure double")
    likely = counts.withColumn("n", F.col("bad") + F.col("good")).join(F.broadcast(passed), ["n", "bad"])
    ratio = part(F.col("bad"), share) + part(F.col("good"), 1 - share)
    found = likely.orderBy(F.desc(ratio), "string").limit(TELLING)
    return {r["string"]: r["sure"] for r in found.collect()}


def _with_telling(counts: DataFrame, telling: dict[str, float], hits: str) -> dict[str, float]:
    """The instances that hold a telling letter group, with their documents times the surest
    group's sureness; the highest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = batch.column("string").to_pylist()
            sure = np.array([max((telling.get(g, 0.0) for g in grams(x)), default=0.0) for x in strings], np.float64)
            weights = batch.column(hits).to_numpy(zero_copy_only=False) * sure
            made = pa.RecordBatch.from_arrays([batch.column("string"), pa.array(weights)], ["string", "weight"])
            yield made.filter(pa.array(weights > 0))

    found = counts.select("string", hits).mapInArrow(run, "string string, weight double")
    found = found.orderBy(F.desc("weight"), F.xxhash64("string"), "string")
    return {r["string"]: r["weight"] for r in found.limit(POSITIVE).collect()}


def _ordinary(counts: DataFrame, telling: dict[str, float]) -> dict[str, float]:
    """Instances of clean documents: the most frequent, some by hash, and those that hold a
    telling letter group."""
    good = counts.where("good > 0 AND bad <= good")
    frequent = good.orderBy(F.desc("good"), "string").limit(NEGATIVE // 2)
    spread = good.orderBy(F.xxhash64("string"), "string").limit(NEGATIVE // 2)
    rows = frequent.unionByName(spread).collect()
    return _with_telling(good, telling, "good") | {r["string"]: float(r["good"]) for r in rows}


def _raw_scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in batches:
            found = raw_scores(batch.column("text").to_pylist(), table, model.bias)
            columns = [*map(pa.array, np.ascontiguousarray(found.T)), batch.column("toxic")]
            yield pa.RecordBatch.from_arrays(columns, ["most", "total", "n", "toxic"])

    return run


def score(docs: DataFrame, model: Model, *keys: str) -> DataFrame:
    """(``keys``, score, predicted) of each row; null counts as the empty text, whose score is
    that of a text without any match. Other columns are not read."""
    rows = docs.select(*dict.fromkeys([*keys, "text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i in range(0, batch.num_rows, ROWS):
                texts = [x or "" for x in batch.column("text").slice(i, ROWS).to_pylist()]
                scores[i : i + ROWS] = model.probability(raw_scores(texts, table, model.bias))
            columns = [batch.column(k) for k in keys]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores)], [*keys, "score"])

    schema = ", ".join([*(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys), "score double"])
    scored = rows.mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= PREDICT_FROM).cast("int"))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit_on_labels(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> Model:
    """Fit on at most ``most`` labels that aren't held out; that bounds what is broadcast."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").select("doc_id", "toxic").limit(most)
    return fit(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    scored = score(docs, fit_on_labels(docs, labels), "doc_id")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that aren't predicted toxic."""
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"), "text")
    kept = score(rows, fit_on_labels(docs, labels), "row", "text").where("predicted = 0")
    return kept.select("row.*", "text").select(*(f"`{c}`" for c in docs.columns))
