"""SimHash groups, benchmark seeds, repeated bytes against plain versions."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from plazalake.llm import benchmark_seeds, repeated_bytes, simhash
from plazalake.llm.components import component_roots

rng = random.Random(7)
WORDS = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints):
    ids = list(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("tile", [2048, 8])
def test_simhash_groups(frame, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    texts = [prose(rng.randint(0, 60), s) for s in range(60)]
    long = prose(1500, 99).split()
    for i in range(60):
        near = list(long)
        near[rng.randrange(1500)] = f"new{i % 40}"
        texts.append(" ".join(near))
    texts += [None, "", "  \n", "Ab Cd", "ab cd", "É é"]
    docs = {i: t for i, t in enumerate(texts)}
    got = {r["doc_id"]: r for r in simhash.near_duplicates(frame(list(docs.items()))).collect()}
    prints = {i: plain_fingerprint(t) for i, t in docs.items()}
    roots = plain_components(prints)
    assert len(got) == len(docs)
    for i, r in got.items():
        assert r["fingerprint"] == f"{prints[i]:016x}" and r["component_id"] == roots[i]


def test_linked_fingerprints_share_a_key():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 3000, np.int64)
    flips = np.array([sum(1 << int(b) for b in r.choice(64, 3, False)) for _ in base], np.uint64)
    other = (base.view(np.uint64) ^ flips).view(np.int64)
    found = np.zeros(len(base), bool)
    import pyarrow as pa

    def keys(bits):
        return [b.column("key").to_numpy() for b in simhash._keys([pa.RecordBatch.from_pydict({"bits": bits})])]

    for k, (x, y) in enumerate(zip(keys(base), keys(other), strict=True)):
        for i in np.flatnonzero(x == y):
            a, _ = simhash._linked(base[i : i + 1], other[i : i + 1], k // 2)
            found[i] |= len(a) > 0
    assert found.all()


def test_one_of_each_group_keeps_columns(frame, clashing):
    docs = frame([(3, "a b c d", "en", "s", 1), (2, "A B C D", "en", "s", 2), (2, "A B C D", "de", "t", 3), (9, "x y z", "en", "s", 4)])
    out = simhash.one_of_each_group(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 9]
    assert simhash.one_of_each_group(clashing).columns == clashing.columns


def shingles_of(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_one_of_each_group_is_that_of_five_words(frame):
    """A tree of texts, each edited from an earlier one, against all pairs by their sets."""
    r, texts = random.Random(11), [prose(n, 700 + n) for n in range(3, 160, 4)]
    for i in range(260):
        words = r.choice(texts).split()
        for _ in range(1 + len(words) * r.randint(0, 10) // 300):
            words[r.randrange(len(words))] = f"new{i}"
        texts.append(" ".join(words))
    sets = [shingles_of(t) for t in texts]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    parent = {i: i for i in range(len(texts))}
    for i, j in sorted(pairs) * len(texts):
        low = min(parent[i], parent[j])
        if parent[i] == parent[j]:
            continue
        parent = {k: low if v in (parent[i], parent[j]) else v for k, v in parent.items()}
    kept = {r["doc_id"] for r in simhash.one_of_each_group(frame(list(enumerate(texts)))).collect()}
    assert kept == set(parent.values()) and len(pairs) > 60 and 20 < len(kept) < len(texts)


def test_odd_rows_and_empty_tables(odd, frame):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 8
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert simhash.near_duplicates(frame([])).count() == 0
    assert simhash.one_of_each_group(frame([])).count() == 0


def test_components_of_a_long_path(spark):
    order = list(range(300))
    rng.shuffle(order)
    links = [(order[i], order[i + 1]) for i in range(299)] + [(1000, 1001), (1000, 1002)]
    got = {r["node"]: r["root"] for r in component_roots(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(300)) and got[1002] == 1000


def plain_seeds(text, items):
    """{item: most equal tokens} by trying every stretch that holds a seed's place."""
    span, need = benchmark_seeds.SPAN, benchmark_seeds.LEAST_EQUAL

    def tokens(t):
        return "".join(c.lower() if c.isalnum() and (c.isascii() or True) else " " for c in t or "").split()

    a, found = tokens(text), {}
    for key, item in items:
        b = tokens(item)
        hits = [
            (i, j)
            for i in range(len(a) - span + 1)
            for j in range(len(b) - span + 1)
            if any(all(a[i + k] == b[j + k] for k in range(span) if m[k] == "1") for m in benchmark_seeds.MASKS)
        ]
        best = 0
        for i, j in hits:
            for s in range(-span, span + 1):
                n = sum(
                    0 <= i + s + k < len(a) and 0 <= j + s + k < len(b) and a[i + s + k] == b[j + s + k]
                    for k in range(span)
                )
                best = max(best, n)
        if best >= need:
            found[key] = max(found.get(key, 0), best)
    return found


def test_benchmark_seeds(frame, spark):
    items = [(i, prose(rng.randint(12, 40), 500 + i)) for i in range(12)] + [(50, "too short"), (51, None)]
    docs = [(i, prose(80, 900 + i)) for i in range(20)]
    for i, (_, item) in enumerate(items[:12]):
        words = item.split()
        for at in range(i % 4, len(words), 9):
            words[at] = "changed"
        docs.append((100 + i, prose(30, i) + ",\n" + " ".join(words).upper() + ". " + prose(30, i + 1)))
    docs += [(200, None), (201, ""), (202, items[0][1]), (202, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in benchmark_seeds.contaminated(frame(docs), bench, "doc_id").collect():
        got.setdefault(r["doc_id"], {})[r["item_id"]] = r["equal_tokens"]
    want = {d: f for d, t in docs if (f := plain_seeds(t, items))}
    assert got == want and len(want) > 8
    kept = benchmark_seeds.without_contaminated(frame(docs), bench)
    assert kept.columns == frame(docs).columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - set(want)


def test_benchmark_overlaps_with_any_two_changes(frame, spark):
    """Every placement of two changed tokens in a stretch of 12, and three in 14, against all alignments."""
    item = [f"w{i}" for i in range(40)]
    docs = []
    for size, changes in ((12, 2), (14, 3)):
        for places in combinations(range(size), changes):
            part = [f"new{i}" if i in places else item[9 + i] for i in range(size)]
            docs.append((len(docs), " ".join([f"a{i}" for i in range(5)] + part + [f"b{i}" for i in range(5)])))

    def most_equal(text):
        a = text.split()
        equal = {(i, j): a[i] == item[j] for i in range(len(a)) for j in range(len(item))}
        return max(
            sum(equal.get((i + k, i + k + d), False) for k in range(12)) for d in range(-30, 40) for i in range(len(a) - 11)
        )

    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"] for r in benchmark_seeds.contaminated(frame(docs), bench, "doc_id").collect()}
    want = {i for i, t in docs if most_equal(t) >= 10}
    assert got == want and len(want) > 66


def test_short_and_unspaced_items(frame, spark):
    """Items below SPAN tokens stand in a document whole; unspaced scripts have a token a character."""
    chinese = "机器学习模型在很多任务上的表现已经超过了人类专家的水平"
    items = [
        (1, "what is the capital of the old kingdom"),
        (2, chinese),
        (3, "ภาษาไทย"),
        (4, "only four tokens here"),
        (5, "say \u201cyes\u201d\u2014or say nothing"),
    ]
    rest = prose(30, 77)
    docs = [
        (1, f"{rest} What is the capital of the OLD kingdom? {rest}"),
        (2, f"{rest} what is the capital of the new kingdom {rest}"),
        (3, f"前文{chinese}。后文"),
        (4, f"前文{chinese[:5]}和{chinese[6:13]}后文"),
        (5, f"{chinese[:9]}"),
        (6, f"{rest} ภาษาไทยง่าย {rest}"),
        (7, f"{rest} only four tokens here {rest}"),
        (8, "say yes or say nothing"),
        (9, "of the old kingdom"),
        (10, "what is the capital of the old kingdom"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = benchmark_seeds.contaminated(frame(docs), bench, "doc_id").collect()
    want = {(1, 1, 8), (10, 1, 8), (3, 2, 12), (4, 2, 11), (6, 3, 7), (8, 5, 5)}
    assert {tuple(r) for r in got} == want


def test_benchmark_odd_rows(odd, clashing, frame, spark):
    bench = spark.createDataFrame([(1, "word " * 20), (None, "a b c d e f g h i j k l m")], "item_id long, text string")
    assert {r["doc_id"] for r in benchmark_seeds.contaminated(odd, bench, "doc_id").collect()} == {6}
    assert benchmark_seeds.contaminated(frame([]), bench, "doc_id").count() == 0
    assert benchmark_seeds.contaminated(odd, bench.limit(0), "doc_id").count() == 0
    assert benchmark_seeds.without_contaminated(clashing, bench).columns == clashing.columns


def plain_removed(rows):
    """{row: (n_bytes, n_removed, n_spans, sha)} with every window of smaller documents in a set."""
    big = 1 << 62
    order = sorted({big if i is None else i for i, _ in rows})
    out, seen = {}, set()
    for key in order:
        own = set()
        for n, (i, text) in enumerate(rows):
            if (big if i is None else i) != key:
                continue
            data = (text or "").encode()
            cover = bytearray(len(data))
            for p in range(len(data) - 49):
                if data[p : p + 50] in seen:
                    cover[p : p + 50] = b"\1" * 50
                own.add(data[p : p + 50])
            kept = bytes(b for b, c in zip(data, cover, strict=True) if not c)
            spans = sum(1 for p in range(len(data)) if cover[p] and not (p and cover[p - 1]))
            out[n] = (i, len(data), sum(cover), spans, hashlib.sha256(kept).hexdigest())
        seen |= own
    return sorted(out.values(), key=str)


def check_removed(frame, rows):
    got = sorted((tuple(r) for r in repeated_bytes.remove_repeated(frame(rows)).collect()), key=str)
    assert got == plain_removed(rows)


def test_removed_bytes(frame):
    rows = [(i, prose(rng.randint(0, 120), i)) for i in range(40)]
    for i in range(40, 90):
        a, b = rng.choice(rows)[1] or "", rng.choice(rows)[1] or ""
        cut = rng.randint(0, max(1, len(a)))
        rows.append((i, a[cut : cut + rng.randint(40, 300)] + rng.choice(["", "é", " x "]) + b[: rng.randint(0, 200)]))
    rng.shuffle(rows)
    check_removed(frame, rows)


def test_stored_texts_get_buckets_by_their_bytes(frame, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "STORED_BYTES", 2000)
    rows = [(i, prose(60, i % 25) + f" {i}") for i in range(40)]
    check_removed(frame, rows)
    size = sum(len(t.encode()) for _, t in rows)
    files = repeated_bytes._stored(frame(rows), size).inputFiles()
    assert 4 < len(files) <= -(-size // 2000)


def test_removed_bytes_of_odd_rows(frame, odd):
    p = "passage that many documents share, of a little over fifty bytes in all. "
    rows = [(1, None), (2, ""), (3, p), (3, p), (4, p), (None, p), (None, "x" + p), (5, "y" * 49), (6, "y" * 49), (7, "y" * 50)]
    rows += [(8, "y" * 120), (9, "y" * 121), (10, p[:49] + "!"), (11, "ab" * 40), (12, "ba" * 40), (3, "z" + p), (13, "é" * 25), (14, "é" * 26)]
    rows += [(20 + i, f"{i} {p}{i}{i * 7919}") for i in range(40)]
    check_removed(frame, rows)
    assert repeated_bytes.remove_repeated(odd).count() == 8
    assert repeated_bytes.remove_repeated(frame([])).count() == 0


def test_removed_bytes_ignore_other_columns(clashing):
    assert repeated_bytes.remove_repeated(clashing).count() == 2
