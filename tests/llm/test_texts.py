"""Archives, toxicity, token files, personal data and the pipeline."""

import hashlib
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from plazalake.llm import archives, fair_mix, pii, token_files, toxicity
from plazalake.llm.queries import QUERIES


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, head string")


def through_archives(spark, frame, tmp_path):
    archives.write_arc(frame, f"{tmp_path}/arc")
    archives.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    return archives.read_warc(spark, f"{tmp_path}/warc").collect()


def test_archives(spark, tmp_path):
    long = "x\r\n\r\nWARC/1.1\r\n\n" * 20
    rows = [
        (5, "http://a.example/p q\n", long, ""),
        (3, "http://b.example/", long, ""),
        (3, "http://b.example/", long, ""),
        (9, None, long, ""),
        (None, "http://c.example/", long, ""),
        (10, "http://d.example/", "y" * 99, ""),
        (11, "http://d.example/", "y" * 99, ""),
        (12, "http://e.example/", None, ""),
        (13, "http://e.example/", "", ""),
        (14, "http://f.example/", "é" * 50, ""),
        (15, "http://f.example/", "é" * 50, ""),
        (16, "http://g.example/", "z\n" * 700_000, ""),
    ]
    read = through_archives(spark, pages(spark, rows).repartition(3), tmp_path)
    assert len(read) == len(rows)
    payload = {p: (h or "").encode() for p, _, h, _ in rows}
    for r in read:
        data = payload[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
    kinds = sorted((r["page_id"] or 0, r["record_type"]) for r in read)
    assert [k for p, k in kinds if p == 3] == ["response", "revisit"]
    assert {p for p, k in kinds if k == "revisit"} == {0, 3, 5, 9, 15}
    by_id = {r["record_id"]: r["page_id"] for r in read}
    assert len(by_id) == len(rows)
    assert {by_id[r["refers_to_id"]] for r in read if r["record_type"] == "revisit"} == {3, 14}


def test_copies_across_archives_refer_to_one(spark, tmp_path):
    rows = [(i, f"http://h.example/{i}", ("copy " * 40 if i % 3 else f"own {i} " * 20) if i % 5 else "", "") for i in range(200)]
    read = through_archives(spark, pages(spark, rows).repartition(7), tmp_path)
    by_id = {r["record_id"]: r["page_id"] for r in read}
    assert len(by_id) == len(read) == len(rows)
    copies = {i for i in range(200) if i % 5 and i % 3}
    assert {r["page_id"] for r in read if r["record_type"] == "revisit"} == copies - {1}
    assert {by_id[r["refers_to_id"]] for r in read if r["record_type"] == "revisit"} == {1}


def test_empty_archives(spark, tmp_path):
    assert through_archives(spark, pages(spark, []), tmp_path) == []


def stream(data):
    import pyarrow as pa

    lines = data.split(b"\n")
    batch = pa.RecordBatch.from_pydict({"file": ["f"] * len(lines), "value": lines})
    return next(archives._streams([batch]))[1]


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    data = archives.arc_head(version, "a.arc")
    blocks = [b"", b"one\n", b"HTTP/1.0 200 OK\n\nbody", b"\n\n\n"]
    for b in blocks:
        data += b"\n" + archives.arc_record(version, "http://x/", "20200102030405", b)
    found = list(archives.arc_records(stream(data)))
    assert [(v, b) for _, v, _, b in found] == [(version, b) for b in blocks]
    assert all(data[o:].startswith(b"http://x/") for o, *_ in found)
    assert ("Result-code" in found[0][2]) == (version == 2)


def test_a_record_cut_short_raises():
    data = archives.arc_head(1, "a.arc") + b"\n" + archives.arc_record(1, "http://x/", "20200102030405", b"12345")
    with pytest.raises(ValueError, match="declared length"):
        list(archives.arc_records(stream(data[:-4])))


def test_warc_dates():
    assert archives.warc_date("20200102030405") == "2020-01-02T03:04:05Z"
    assert archives.warc_date("202001020304") == "2020-01-02T03:04:00Z"
    assert archives.warc_date("20200102") == "2020-01-02T00:00:00Z"


def test_archive_query(spark, sf_dir):
    got = {r["page_id"]: r for r in QUERIES["op1_arc_to_warc"](spark, sf_dir).collect()}
    first, want = {}, {}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").orderBy("page_id").collect():
        data = (r["html"] or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        refers = first.setdefault(digest, r["page_id"]) if len(data) >= 100 else r["page_id"]
        want[r["page_id"]] = (len(data), digest, None if refers == r["page_id"] else refers)
    assert {p: (r["payload_bytes"], r["payload_digest"], r["refers_to"]) for p, r in got.items()} == want
    assert all((r["record_type"] == "revisit") == (r["refers_to"] is not None) for r in got.values())


def test_string_kernel_is_that_of_its_definition():
    from itertools import combinations

    def plain(s, t):
        total = 0.0
        for i in combinations(range(len(s)), 3):
            for j in combinations(range(len(t)), 3):
                near = i[-1] - i[0] < 5 and j[-1] - j[0] < 5
                if near and all(s[a] == t[b] for a, b in zip(i, j, strict=True)):
                    total += toxicity.DECAY ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
        return total

    def size(s):
        return sum(toxicity.DECAY ** (2 * (i[-1] - i[0] + 1)) for i in combinations(range(len(s)), 3) if i[-1] - i[0] < 5) ** 0.5

    words, marks = ["idiot", "ixdiot", "abcabc", "zzz", "tidio"], ["idiot", "cabbage", "iot"]
    got = toxicity.similarities(words, marks)
    for i, s in enumerate(words):
        for j, t in enumerate(marks):
            a, b = f"^{s}$", f"^{t}$"
            assert got[i, j] == pytest.approx(plain(a, b) / size(a) / size(b), abs=1e-9)


def test_scores_of_texts_are_those_of_their_instances():
    table, texts = toxicity.table_of("idiot"), ["", "a b", "You IDIOT! i d i o t", "x" * 100 + " i.di.ot", "é" * 30, "no"]
    for text, (most, _, n) in zip(texts, toxicity.raw_scores(texts, table, -1.0), strict=True):
        strings = sorted(toxicity.instances(text))
        want = [toxicity.similarities([s], ["idiot"])[0, 0] - 1 for s in strings if len(s) < toxicity.PIECE]
        assert most >= max(want, default=-1.0) - 1e-9 and (n > 0) == bool(strings)
        if all(len(s) < toxicity.PIECE for s in strings):
            assert most == pytest.approx(max(want, default=-1.0))


def test_instances():
    assert toxicity.instances("You i d i o t, i.d.i.o.t! ID-IOT no") == {"you", "idiot"}
    assert max(map(len, toxicity.instances("x" * 1000))) == toxicity.PIECE


def test_toxicity_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.fit_on_labels(docs, labels)
    rows = toxicity.score(docs.join(labels, "doc_id"), model, "doc_id", "toxic").where(toxicity.held_out(F.col("doc_id"))).collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert sum(toxic) >= 0.85 * len(toxic) > 100
    assert sum(clean) <= 0.01 * len(clean)
    table = model.table()
    plain, *gapped = toxicity.raw_scores(["the and of", "i d i o t", "i.d.i.o.t", "IDIOT", "idxiot"], table, model.bias)[:, 0]
    assert min(gapped) > plain + 0.5


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_toxicity_of_few_labels(spark, size):
    """Each held-out toxic document with one of the commoner insults is found, and no clean one."""
    docs, labels = (spark.read.parquet(f"/root/testdata/{size}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_on_labels(docs, labels)
    rows = toxicity.score(docs.join(labels, "doc_id"), model, "doc_id", "toxic", "text")
    rows = rows.where(toxicity.held_out(F.col("doc_id"))).collect()
    told = [r["predicted"] for r in rows if r["toxic"] == 1 and {"moron", "scum", "loser", "disgusting"} & toxicity.instances(r["text"])]
    assert len(told) > 1 and all(told)
    assert not any(r["predicted"] for r in rows if r["toxic"] == 0)


def test_sureness_scales_with_the_labels():
    few = toxicity._sureness({(3, 3): 13, (3, 0): 1200, (5, 5): 4, (5, 0): 900}, 0.115)
    assert few[3, 3] > 0.75 and few[5, 5] > 0.95
    assert toxicity._sureness({(3, 3): 18, (3, 0): 5800}, 0.116)[3, 3] < 0.75


def test_toxicity_of_odd_rows(odd, clashing, frame, spark):
    labels = spark.createDataFrame([(4, 1, 1), (5, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.classify(odd, labels).collect()
    assert len(rows) == 8 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.classify(frame([]), labels).count() == 0
    assert toxicity.classify(odd, labels.limit(0)).count() == 8
    assert toxicity.without_toxic(clashing, labels).columns == clashing.columns
    assert {r["doc_id"] for r in toxicity.without_toxic(odd, labels.limit(0)).where("text IS NULL").collect()} == {1}


def plain_tokens(rows):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        out.append((doc_id, at, len(ids), zlib.crc32(data)))
        at += len(ids)
    return out


def test_token_files(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op5_token_files"](spark, sf_dir).collect()))
    assert got == plain_tokens(rows)


def test_token_files_of_odd_rows(odd, clashing, frame):
    from tests.llm.conftest import ODD

    rows = [*ODD, (7, "<|endoftext|> it's DON'T  x́ İ　ab\x1c1999!?"), (8, "e ́")]
    got = sorted(map(tuple, token_files.encode_documents(frame(rows)).collect()), key=lambda r: r[1])
    assert [r[1:] for r in got] == [r[1:] for r in plain_tokens(rows)]
    assert token_files.encode_documents(frame([])).count() == 0
    assert token_files.encode_documents(clashing).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_words_encode_like_the_whole_text(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = token_files._encoder(path).tokenizer.encode(text, add_special_tokens=False).ids
    assert token_files._encoder(path)([text])[0].tolist() == [*whole, 1]


def test_words_of_a_batch_are_looked_up_once_whatever_their_case():
    import pyarrow as pa

    encoder = token_files.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["left out", "", "The the\x0bTHE the. <|", " \n", "The the\x0bTHE the.  THE.", "x, \x1c É é", ""]
    for column in (texts[1:], pa.array(texts, pa.string()).slice(1), pa.array([], pa.string())):
        whole = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts[1:]] if len(column) else []
        assert [ids.tolist() for ids in encoder(column)] == whole
    assert {b"the", b"the."} <= encoder.young.keys() and not {b"The", b"THE", b"THE."} & encoder.young.keys()


def test_long_texts_are_encoded_and_read_by_their_size(spark, frame, monkeypatch):
    """Workers get batches by bytes, and Spark's reader as many rows as the longest document allows."""
    import pyarrow as pa

    texts = ["one two", "", "w " * 3000, "é" * 10, "a b c", "it's. " * 700]
    for name, value in (("SLICE", 30), ("BLOCK", 7), ("READ_IDS", 6500)):
        monkeypatch.setattr(token_files, name, value)
    assert list(token_files._slices(pa.array(["left out", *texts]).slice(1))) == [(0, 2), (2, 3), (3, 5), (5, 6)]
    encoder = token_files.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    whole = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert [ids.tolist() for ids in encoder(texts)] == whole
    held, reading = [], token_files.reading
    monkeypatch.setattr(token_files, "reading", lambda s, rows: held.append(rows) or reading(s, rows))
    rows, before = [*enumerate(texts)], spark.conf.get(token_files.READER_ROWS)
    got = token_files.encode_documents(frame(rows))
    assert held == [2] and spark.conf.get(token_files.READER_ROWS) == before
    assert sorted(map(tuple, got.collect())) == plain_tokens(rows)


def test_token_file_layout(spark, frame, tmp_path):
    import pyarrow.parquet as pq

    token_files.write_tokens(frame([(i, "some words " * 50) for i in range(500)]), f"{tmp_path}/t")
    files = sorted(p for p in tmp_path.glob("t/*.parquet"))
    meta = pq.ParquetFile(files[0]).metadata
    column = meta.row_group(0).column(meta.num_columns - 1)
    assert any("DICTIONARY" in e for e in column.encodings) and column.has_offset_index


PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in pattern.finditer(text):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 14 <= len(d) <= 19
                and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0,
                "phone": lambda d=digits: 10 <= len(d) <= 15,
            }[kind]
            if good():
                out.append((m.start(), kind, m.end()))
    return sorted(out, key=lambda s: (s[0], list(PLAIN).index(s[1])))


PIECES = st.sampled_from(
    "a@b.co x.y@z-1.de @ @a.b a@b a@b.c@d.e 1.2.3.4 0256.1.1.1 0001.0002.3.4.5 999.1.1.1 4111 1111 1111 1111 "
    "4111111111111111 4111-1111-1111-1111 5500000000000004 +1(017)555-7713 +49 12345 6789012 +1 2 -- é 😀 . ( ) "
    "DE89370400440532013000 GB82 WEST 1234 5698 7654 32 iban 123-45-6789 ssn".split(" ")
)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(PIECES, st.sampled_from(["", " ", "\n", "-"])), max_size=14))
def test_base_spans(parts):
    text = "".join(a + b for a, b in parts)
    assert [(s.start, s.kind, s.end) for s in pii.find(text) if s.base] == plain_spans(text)


def test_added_spans():
    text = "pay GB82 WEST 1234 5698 7654 32 now, ssn 123-45-6789, DE89370400440532013001"
    assert [(s.kind, text[s.start : s.end]) for s in pii.find(text)] == [
        ("iban", "GB82 WEST 1234 5698 7654 32"),
        ("ssn", "123-45-6789"),
    ]
    assert not pii.find("number 123-45-6789 alone")
    assert [s.kind for s in pii.find("4111111111111111 5500000000000004 1")] == ["card", "card"]
    assert pii.redact("to a@b.co!") == "to <email>!"


def test_long_texts_are_scanned_in_linear_time():
    for piece in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "A1 " * 70_000):
        pii.find(piece)


def test_pii_of_odd_rows(odd, clashing, frame):
    assert pii.annotate(odd).count() == 8
    assert pii.annotate(frame([])).count() == 0
    assert pii.annotate(clashing).columns == ["doc_id", "spans"]


def test_pii_query(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for r in QUERIES["op8_pii_spans"](spark, sf_dir).collect():
        want = plain_spans(texts[r["doc_id"]] or "")
        joined = ",".join(f"{k}:{a}:{b}" for a, k, b in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(x[1] == k for x in want) for k in PLAIN]


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, sf_dir)
        after = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert set(after) <= before
        assert docs.columns == columns or i == len(corpus_pipeline.STAGES) - 1
        assert len(after) == len(set(after)) or i > 2
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert corpus_pipeline.run(spark, sf_dir).count() == docs.count()


def test_mixing_stage_leaves_documents_without_words(spark, frame):
    texts = [None, "", " \n", *("word " * n for n in range(1, 40))]
    rows = [(i, t, "en", None if i % 7 == 3 else f"s{i % 3}", 1) for i, t in enumerate(texts)]
    docs = frame([*rows, (None, None, None, None, None), (99, "a b", None, None, None)])
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in fair_mix.mix(docs).collect() if r["size"]}
    got = Counter(r["doc_id"] for r in corpus_pipeline.mixed(spark, docs, "").collect())
    assert got == +Counter(taken) and not {0, 1, 2} & got.keys() and 2 in got.values()
