"""Chunk recipes, fair mixing and chat formatting."""

import hashlib
import re
import sys
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import oracle_check  # noqa: E402

from plazalake.llm import chat_format, chunk_recipes, fair_mix  # noqa: E402
from plazalake.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf_dir, name):
    con = oracle_check.connect(sf_dir)
    assert oracle_check.compare(spark, con, QUERIES[name], ORACLES[name], sf_dir) is None


def test_chunks_concatenate_to_the_text(frame):
    text = "".join(chr(97 + i * i % 26) + (" " if i % 7 == 0 else "") for i in range(9000)) + "a" * 5000
    row = frame([(1, text)]).select(chunk_recipes.chunks_of(F.col("text")).alias("c")).first()
    assert "".join(row["c"]) == text
    assert max(map(len, row["c"])) <= chunk_recipes.CHUNK_MAX + 2


def test_an_inserted_word_leaves_later_chunks_alone(frame):
    words = [f"w{i * i * 7919 % 10007}{'d' if i * i % 11 == 3 else 'e'}" for i in range(3000)]
    a, b = " ".join(words), " ".join(["new", *words])
    rows = frame([(1, a), (2, b)]).select(chunk_recipes.chunks_of(F.col("text")).alias("c")).collect()
    assert len(set(rows[0]["c"]) & set(rows[1]["c"])) >= len(rows[0]["c"]) - 3


def test_recipes_of_odd_rows(odd):
    rows = chunk_recipes.deduplicate(odd).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert len(rows) == 8
    assert sorted(r["kept"] for r in by[4]) == [False, True]
    assert {r["keep_id"] for r in by[4] + by[5]} == {4} and by[5][0]["group_size"] == 3
    assert by[2][0]["keep_id"] == 1 and not by[2][0]["kept"]
    assert by[3][0]["text_sha256"] == hashlib.sha256(b" ").hexdigest()
    assert by[None][0]["kept"]


def test_colliding_identifiers_raise(spark):
    store = spark.createDataFrame([(b"x", "one"), (b"x", "two")], "id binary, chunk string")
    with pytest.raises(ValueError, match="two texts"):
        chunk_recipes.verify(store)


def test_empty_tables(frame, spark):
    none = frame([])
    assert chunk_recipes.deduplicate(none).count() == 0
    assert fair_mix.mix(none).count() == 0
    empty = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert chat_format.format_records(chat_format.records_of(empty)).count() == 0


def test_clashing_columns(clashing):
    assert chunk_recipes.deduplicate(clashing).where("kept").count() == 1
    assert fair_mix.mix(clashing).count() == 2


def plain_mix(rows):
    """The mix of (doc_id, source, size) by a plain loop."""
    sizes = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += size
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: fair_mix.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if 2 * sizes[s] <= level * weight[s]]
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = 2 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return sizes, target


def test_mix_targets_and_shares(frame):
    rows = [(i, f"s{i % 7}" if i % 3 else "s0", i % 50 + (300 if i % 3 == 0 else 0)) for i in range(3000)]
    docs = frame([(i, "w " * n, None, s) for i, s, n in rows])
    out = fair_mix.mix(docs).collect()
    sizes, target = plain_mix(rows)
    source = {i: s for i, s, _ in rows}
    taken = defaultdict(int)
    for r in out:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 700
    assert sorted(map(tuple, out)) == sorted(map(tuple, fair_mix.mix(docs.repartition(5)).collect()))


def test_mix_of_odd_rows(odd):
    rows = fair_mix.mix(odd).collect()
    assert len(rows) == 8
    assert [r["size"] for r in rows if r["doc_id"] in (1, 2, 3)] == [0, 0, 0]
    assert sum(r["taken"] for r in rows) <= 1.5 * sum(r["size"] for r in rows)


def test_one_source_is_taken_one_and_a_half_times(frame):
    out = fair_mix.mix(frame([(i, "w w w", None, "only") for i in range(100)])).collect()
    assert sum(r["taken"] for r in out) == 450


TEXTS = ["", "plain", "</s>", "[INST] x [/INST]", r"[\INST]", r"<\\s>[TURN][END]", "<s<s>>[/SYS][[SYS]", "é\n\U0001f600 </s>"]
ROLES = ["user", "assistant", "system", "tool", "[TURN]", "", "human", "gpt"]


def test_chat_round_trip(spark):
    rows = [(c, t, ROLES[(c * 3 + t) % 8], TEXTS[(c + t * 5) % 8]) for c in range(24) for t in range(5)]
    rows += [(100, 0, "user", "q"), (100, 1, "assistant", "a</s>"), (101, 0, "system", "s"), (101, 1, "user", None)]
    rows += [(101, 2, "assistant", "b"), (102, None, None, None), (None, 0, "user", "no key"), (103, 1, "user", "x"), (103, 1, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    records = chat_format.records_of(frame.withColumn("formatted", F.lit(1)))
    made = chat_format.format_records(records)
    read = made.select(
        "conv_id",
        "formatted",
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.learned_text(F.col("formatted"), F.col("loss")).alias("learned"),
    ).collect()
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or -1, r[2] or "", r[3] or "")):
        want[c].append((role or "", text or ""))
    assert len(read) == len(want)
    for r in read:
        assert [tuple(t) for t in r["turns"]] == want[r["conv_id"]]
        assert r["learned"] == "".join(x for role, x in want[r["conv_id"]] if role == "assistant")
    kinds = {re.match(r'\{"(\w+)"', r["record"])[1] for r in records.collect()}
    assert kinds == {"messages", "conversations", "prompt", "system"}


def test_unknown_layout_raises(spark):
    odd = spark.createDataFrame([(1, '{"dialog":[]}'), (2, None)], "conv_id long, record string")
    for i in (1, 2):
        with pytest.raises(Exception, match="no mapping"):
            chat_format.format_records(odd.where(f"conv_id = {i}")).collect()


def test_records_with_unlike_turns_are_not_cut(spark):
    """A turn with other fields than the first gives the record another fingerprint, and text that
    looks like JSON none."""
    known = [
        '{"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]}',
        '{"prompt": "{\\"x\\": 1}", "completion": "[{\\"y\\": 2}]"}',
        '{"completion": null, "prompt": "p"}',
    ]
    unknown = [
        '{"messages": [{"role": "user", "content": "a"}, {"role": "user", "content": "b"}, {"name": "c", "text": "lost"}]}',
        '{"messages": [{"role": "user", "content": "a"}, {"role": "user", "content": "b", "tool": "t"}]}',
        '{"messages": "text"}',
        '{"prompt": {"text": "inner"}, "completion": "c"}',
        '{"prompt": "p", "completion": "c", "extra": 1}',
        "[]",
        "",
    ]
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(known + unknown)], "i int, record string")
    turns = {r["i"]: r["t"] for r in rows.select("i", chat_format.canonical_turns(F.col("record")).alias("t")).collect()}
    assert [turns[i] is None for i in range(len(rows.collect()))] == [False] * 3 + [True] * len(unknown)
    assert [tuple(t) for t in turns[1]] == [("user", '{"x": 1}'), ("assistant", '[{"y": 2}]')]
    assert [tuple(t) for t in turns[2]] == [("user", "p"), ("assistant", "")]
