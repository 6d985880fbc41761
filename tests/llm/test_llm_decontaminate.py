"""Copies of test items, and the alignment against plain dynamic programming."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhouse.llm import decontaminate as d

DOCUMENTS, ITEMS = "doc_id long, text string, found string, item_id int", "item_id long, text string, doc_id string"


def plain_score(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1][j + 1] = max(0, h[i][j] + (d.MATCH if x == y else d.MISMATCH), h[i][j + 1] + d.GAP, h[i + 1][j] + d.GAP)
    return max(map(max, h))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12))
def test_alignment(a, b):
    score, end_a, end_b = d.smith_waterman(np.array(a, np.uint64), np.array(b, np.uint64))
    assert score == plain_score(a, b) == plain_score(a[:end_a], b[:end_b])


def corpus():
    rng = random.Random(2)
    common, rare = ["the", "of", "and", "to", "in"], [f"word{i}" for i in range(3000)]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.4 else rng.choice(rare) for _ in range(n)]

    items = [prose(30) for _ in range(6)]
    rows = [(i, prose(rng.randint(5, 200))) for i in range(120)]
    exact = [(200 + i, prose(50) + item + prose(50)) for i, item in enumerate(items)]
    edited = []
    for i, item in enumerate(items):
        changed = list(item)
        for k in range(4, 30, 6):
            changed[k] = "other"
        del changed[10]
        edited.append((300 + i, prose(20) + changed + prose(20)))
    shouted = [(400, " ".join(items[0]).upper().replace(" ", ", ").split(" "))]
    return [(i, " ".join(w)) for i, w in rows + exact + edited + shouted], [(i, " ".join(w)) for i, w in enumerate(items)]


@pytest.mark.parametrize("block_chars", [d.BLOCK_CHARS, 200])
def test_copies_are_found_and_clean_rows_left_alone(spark, monkeypatch, block_chars):
    monkeypatch.setattr(d, "SLICE_BYTES", 3000)
    rows, items = corpus()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCUMENTS)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    plain = docs.select("doc_id", "text")
    got = d.with_copies(plain, plain, bench, "c", block_chars=block_chars).selectExpr("doc_id", "explode(c) c").select("doc_id", "c.*").collect()
    want = {(200 + i, i) for i in range(6)} | {(300 + i, i) for i in range(6)} | {(400, 0)}
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert all(r.similarity == 1 and r.first_word == 50 and r.end_word == 80 for r in got if 200 <= r.doc_id < 300)
    assert all(0.5 < r.similarity < 1 for r in got if 300 <= r.doc_id < 400)


def test_odd_rows(spark):
    text = "an entirely unlikely sequence of quite remarkable words stands here today"
    rows = [(1, text, None, 1), (1, text, None, 1), (None, text + " é", "x", 2), (3, None, None, None), (4, "", "x", 1), (5, "short", "x", 1), (6, "word " * 20000, "x", 1)]
    items = [(9, text, None), (7, text, "x"), (8, None, None), (10, "", "x"), (11, "!!", "x"), (None, "short", "x")]
    docs, bench = spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame(items, ITEMS)
    got = [(r.doc_id, r.item_id) for r in d.copies(docs, bench).collect()]
    assert sorted(got, key=str) == sorted([(1, 7), (1, 7), (None, 7), (5, None)], key=str)
    assert d.copies(docs, bench.limit(0)).count() == 0
    assert d.copies(docs.limit(0), bench).count() == 0


def test_words():
    w = d.plain_words(pa.array(["Été, dON'T 3x", None, "×÷ ÀÞ"]))
    data = w.data.tobytes()
    assert [data[a:b].decode() for a, b in zip(w.starts, w.ends)] == ["été", "don", "t", "3x", "×÷", "àþ"]


def test_passages_of_long_items_and_parts_that_stand_apart(spark):
    rng = random.Random(4)
    words = [f"word{i}" for i in range(5000)]

    def prose(n):
        return [rng.choice(words) for _ in range(n)]

    long, short = prose(200), prose(60)
    rows = [(i, prose(300)) for i in range(40)]
    rows += [(100, prose(80) + long[50:75] + prose(80)), (101, prose(80) + long[50:149] + prose(80)), (102, prose(80) + long[10:18] + prose(80))]
    rows += [(103, prose(40) + short[5:17] + prose(150) + short[20:32] + prose(150) + short[40:52] + prose(40)), (104, short[40:52] + prose(8) + short[20:32] + prose(8) + short[5:17])]
    rows += [(105, prose(40) + short[5:17] + prose(150) + short[5:17] + prose(150) + short[5:17] + prose(40))]
    docs = spark.createDataFrame([(i, " ".join(w), "x", 1) for i, w in rows], DOCUMENTS)
    bench = spark.createDataFrame([(1, " ".join(long), "x"), (2, " ".join(short), "x")], ITEMS)
    got = {(r.doc_id, r.item_id): r for r in d.copies(docs, bench).collect()}
    assert set(got) == {(100, 1), (101, 1), (103, 2), (104, 2)}
    assert (got[100, 1].first_word, got[100, 1].end_word, got[100, 1].n_equal, got[100, 1].similarity) == (80, 105, 25, 0.125)
    assert got[103, 2].n_equal == 36 and (got[103, 2].first_word, got[103, 2].end_word) == (40, 40 + 12 * 3 + 300)


def test_longest_run():
    assert d.longest_run(np.array([1, 2, 3, 9, 4]), np.array([7, 2, 3, 9, 1, 2])) == 3 and d.longest_run(np.array([1]), np.array([2])) == 0


def test_shared_prompts_are_no_copies(spark):
    rng = random.Random(8)
    words = [f"word{i}" for i in range(5000)]

    def prose(n):
        return [rng.choice(words) for _ in range(n)]

    prompt, base = prose(16), prose(30)
    items = [prompt + prose(12) for _ in range(300)]
    variants = [[*base[:k], f"new{k}", *base[k + 1 :]] for k in (2, 8, 14, 20, 26)]
    rows = [(i, prose(200)) for i in range(40)]
    rows += [(100, prose(50) + prompt + prose(50)), (101, prose(50) + items[7] + prose(50)), (102, prose(50) + items[9][16:] + prose(50))]
    rows += [(103, prose(50) + variants[3] + prose(50))]
    docs = spark.createDataFrame([(i, " ".join(w), "x", 1) for i, w in rows], DOCUMENTS)
    bench = spark.createDataFrame([(i, " ".join(w), "x") for i, w in enumerate(items + variants)], ITEMS)
    plain = docs.select("doc_id", "text")
    for block_chars in (d.BLOCK_CHARS, 20_000):
        got = d.with_copies(plain, plain, bench, "c", block_chars=block_chars).selectExpr("doc_id", "explode(c) c").select("doc_id", "c.*").collect()
        assert {(r.doc_id, r.item_id) for r in got} == {(101, 7), (102, 9)} | {(103, 300 + k) for k in range(5)}
        assert all(r.similarity == 1 and r.n_equal == 12 for r in got if r.doc_id < 103)


def test_item_counts(spark):
    texts = ["a b c d e f g h", "x a b c d e f g h", "a b c a b c", "a b", ""]
    items = spark.createDataFrame([(t,) for t in texts], "text string")
    w = d.plain_words(pa.array(texts))
    known = [np.unique(d._grams(w.hashes(), w.first, size)[1]) for size in d.SEED_WORDS]
    got = d.item_counts(items, known)
    for size, seen, n in zip(d.SEED_WORDS, known, got):
        sets = [{tuple(x[i : i + size]) for i in range(len(x) - size + 1)} for x in (t.split() for t in texts)]
        want = sorted(sum(g in s for s in sets) for g in set().union(*sets))
        assert len(seen) == len(want) and sorted(n.tolist()) == want


@pytest.mark.parametrize("share", [0.05, 0.1, 0.2])
def test_recall_on_edited_copies(spark, share):
    rng = random.Random(int(share * 100))
    words = [f"word{i}" for i in range(5000)]
    items = [[rng.choice(words) for _ in range(40)] for _ in range(60)]
    rows = []
    for i, item in enumerate(items):
        edited = []
        for w in item:
            kind = rng.choice("rid") if rng.random() < share else ""
            edited += {"": [w], "r": ["other"], "i": [w, "other"], "d": []}[kind]
        around = [rng.choice(words) for _ in range(60)]
        rows.append((i, around + edited + around[::-1]))
        rows.append((100 + i, around + edited[20:] + edited[:20] + around[::-1]))
    docs = spark.createDataFrame([(i, " ".join(w), "x", 1) for i, w in rows], DOCUMENTS)
    bench = spark.createDataFrame([(i, " ".join(w), "x") for i, w in enumerate(items)], ITEMS)
    got = {(r.doc_id, r.item_id) for r in d.copies(docs, bench).collect()}
    assert got <= {(i, i % 100) for i, _ in rows}
    assert sum((i, i) in got for i in range(60)) >= 0.9 * 60 and sum((100 + i, i) in got for i in range(60)) >= 0.9 * 60
