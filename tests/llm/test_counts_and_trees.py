"""Token counts, conversation tries and source divergence against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from plazalake.llm import prefix_trie, source_divergence, token_counts
from plazalake.llm.queries import QUERIES

SCRAPS = [
    "a", " ", "  ", "▁", "</s>", "<s>", "<unk>", "é", "漢", "字", "\n", "\t", "\0", "the", " of", "😀",
    "<0x0A>", "　", "12", ".", "한", " " * 17,
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))


@pytest.mark.parametrize("part_chars", [1, 5, 64])
def test_parts_count_like_the_whole(library, part_chars):
    count = token_counts.TokenCounter(public_tokenizers.path(token_counts.MODEL), part_chars, 100)
    r = random.Random(part_chars)
    texts = ["".join(r.choice(SCRAPS) for _ in range(r.randint(0, 40))) for _ in range(1500)]
    texts += ["word " * 3000, "a" * 5000, " " * 3000, "漢字" * 2000]
    got = count(((t, len(t.encode())) for t in texts), len(texts))
    assert got.tolist() == [len(library.encode(t)) for t in texts]
    assert sum(len(list(count.parts(t))) for t in texts) > 2 * len(texts) or part_chars == 64


def test_token_counts(odd, library):
    got = token_counts.count_tokens(odd, "doc_id", limit=9).collect()
    want = [(r["doc_id"], (r["text"] or "").encode(), len(library.encode(r["text"] or ""))) for r in odd.collect()]
    assert [tuple(r) for r in got] == [(i, len(b), n, n > 9) for i, b, n in want]


def test_token_counts_of_odd_tables(frame, clashing):
    assert token_counts.count_tokens(frame([]), "doc_id").collect() == []
    extra = clashing.selectExpr("*", "'x' AS n_tokens", "1 AS n_bytes")
    assert [tuple(r)[:2] for r in token_counts.count_tokens(extra, "doc_id").collect()] == [(1, 16), (2, 16)]


# -- prefix trie ---------------------------------------------------------------------------


def plain_trie(rows):
    """Nodes of (conv_id, turn, role, text) rows as the query's contract says them."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = (*own.get(c - int(np.fmod(c, 5)), [])[:h], *turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = Counter(n[:-1] for n in members if n)
    out = []
    for n, who in members.items():
        below = [m for m in members if m[: len(n)] == n]
        ends = ",".join(str(c) for c in sorted(who) if len(built[c]) == len(n))
        out.append(
            (
                min(who),
                len(n),
                min(members[n[:-1]]) if n else None,
                len(who),
                children[n],
                sum(not children[m] for m in below),
                sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def made_trie(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, node string, key int")
    turns = prefix_trie.with_shared_heads(prefix_trie.ordered_turns(frame))
    return sorted((tuple(r) for r in prefix_trie.trie(turns).collect()), key=repr)


def test_prefix_trie(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LISTED", 2)
    r = random.Random(5)
    rows = []
    for c in [*range(-7, 60), 10**12 + 3]:
        for turn in range(r.choice([1, 2, 3, 9, 17, 30])):
            same = turn if c % 3 else r.randint(0, 9)
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", f"say {same // 2}é", "n", 1))
    rows += [
        (None, 0, "user", "no conversation", "n", 1),
        (70, None, None, None, None, None),
        (70, 1, "user", "a\n", None, None),
        (70, 1, "user", "a\n", None, None),
        (71, 0, "", "", None, None),
        (72, 0, "u", "ser", None, None),
        (74, 0, "us", "er", None, None),
        (75, 0, "user", "word " * 30_000, None, None),
    ]
    assert made_trie(spark, rows) == plain_trie([x[:4] for x in rows])


def test_copies_in_one_trie(spark):
    rows = [(c, t, "user", f"t{t}", None, None) for c in range(0, 1500, 5) for t in range(10)]
    assert made_trie(spark, rows) == plain_trie([x[:4] for x in rows])


def test_empty_trie(spark):
    assert made_trie(spark, []) == []
    assert made_trie(spark, [(None, 1, "user", "x", None, None)]) == []


# -- source divergence ---------------------------------------------------------------------


def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if "a" <= c <= "z" or ord(c) >= 128 else " " for c in lowered).split(" ")


def plain_audit(rows, least):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [t for t in plain_terms(text) if t]
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in docs[lang].items() if n >= least) for lang, _ in groups}

    def shares(lang, count):
        whole = sum(count[t] for t in kept[lang]) + 2 * len(kept[lang])
        return {t: 1 + 10**9 * (count[t] + 2) // whole for t in kept[lang]}

    p = {g: shares(g[0], counts[g]) for g in groups}
    q = {}
    for lang in kept:
        whole = Counter()
        for g in groups:
            whole.update(counts[g] if g[0] == lang else {})
        q[lang] = shares(lang, whole)
    out = []
    for lang, source in groups:
        mine = p[lang, source]
        pairs = [
            (o, sum((mine[t] - p[lang, o][t]) ** 2 // (mine[t] + p[lang, o][t]) for t in kept[lang]))
            for x, o in groups
            if x == lang and o != source
        ]
        terms = [
            (t, (mine[t] - q[lang][t]) ** 2 // (mine[t] + q[lang][t]))
            for t in kept[lang]
            if counts[lang, source][t] and mine[t] > q[lang][t]
        ]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, 10)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, i, v, k + 1) for k, (i, v) in enumerate(items[:most])]
    return sorted(out)


def prose_rows(seed):
    r = random.Random(seed)
    words = ["".join(r.choice("abcABCéß漢") for _ in range(r.randint(1, 3))) for _ in range(150)]
    rows = []
    for i in range(300):
        text = "".join(r.choice(words) + r.choice([" ", "1", "--", "\n"]) for _ in range(r.randint(0, 50)))
        rows.append((i % 290, text, r.choice(["en", "fr", None, ""]), r.choice([None, *(f"s{k}" for k in range(9))])))
    return rows + [(1, None, "xx", "a"), (None, "", "xx", "b"), (2, "once", "yy", "c"), (3, "w " * 40_000, "en", "s1")]


@pytest.mark.parametrize(("bits", "tile"), [(16, 16), (3, 2)])
def test_source_divergence(frame, monkeypatch, bits, tile):
    monkeypatch.setattr(source_divergence, "BLOCK_BITS", bits)
    monkeypatch.setattr(source_divergence, "TILE_GROUPS", tile)
    rows = prose_rows(3)
    got = source_divergence.audit(frame(rows, "doc_id long, text string, lang string, source string")).collect()
    want = plain_audit(rows, source_divergence.LEAST_DOCUMENTS)
    assert sorted(tuple(r) for r in got) == want and len(want) > 300


def test_source_divergence_of_odd_tables(frame, odd, clashing):
    assert source_divergence.audit(frame([])).collect() == []
    assert source_divergence.audit(odd).collect() == []
    extra = clashing.selectExpr("*", "'x' AS lang", "1 AS n", "2 AS term", "3 AS docs")
    got = sorted(tuple(r) for r in source_divergence.audit(extra).collect())
    assert got == [("x", "", "pair", "a", 0, 1), ("x", "a", "pair", "", 0, 1)]


def test_equal_trees_share_nodes():
    counts = np.zeros((2, 1 << 12), np.int64)
    counts[1, 77] = 5
    forest = source_divergence.Forest(counts)
    # One node a level for absent terms, and one more on the way to the only count.
    assert [len(left) for left, _ in forest.levels] == [2] * 12
    of_a, of_b, times = forest.leaf_pairs(0, 1)
    assert sorted(zip(of_a.tolist(), of_b.tolist(), times.tolist(), strict=True)) == [(0, 0, 4095), (0, 5, 1)]


def test_pairs_are_named_alike_whatever_the_order_of_rows():
    columns = {"lang": ["x"] * 3, "source": ["b", "", "a"], "whole": [9, 7, 8], "side": [2] * 3, "size": [1] * 3}
    entries = pa.array([[{"pos": 0, "n": n}] for n in (4, 2, 3)], pa.list_(pa.struct([("pos", pa.int32()), ("n", pa.int64())])))
    rows = pa.table({**columns, "entries": entries})
    got = {tuple(map(tuple, map(dict.values, source_divergence._priced(rows.take(order)).to_pylist()))) for order in permutations(range(3))}
    assert len(got) == 1 and [r[1:3] for r in got.pop()] == [("", "a"), ("", "b"), ("a", "b")]


def test_shares_are_exact():
    r = random.Random(2)
    for whole in (3, 10**9 + 7, 8 * 10**15 + 11):
        n = [0, 1, whole - 2, *(r.randrange(whole) for _ in range(50))]
        got = source_divergence._shares(np.array(n, np.int64), whole)
        assert got.tolist() == [1 + 10**9 * (x + 2) // whole for x in n]


def test_long_texts_split_into_the_same_terms(monkeypatch):
    monkeypatch.setattr(source_divergence, "_SLICE", 7)
    text = "".join(random.Random(1).choice("aB c1é") for _ in range(500))
    assert source_divergence.terms_of(text) == [t for t in plain_terms(text) if t]


@pytest.mark.parametrize("name", ["op11_token_counts", "op12_prefix_trie", "op13_source_divergence"])
def test_registered(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
