import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhouse.llm import variants

SCHEMA = "doc_id long, text string"


def plain_counts(texts):
    counts = Counter()
    for key, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {w: min(near[w], key=lambda v: (-counts[v], v)) if near[w] else None for w in counts}
    form = {w: f if f and counts[f] >= 2 * counts[w] else None for w, f in form.items()}
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_variants_equal_a_plain_version(spark):
    stems = ["colour", "colours", "color", "colores", "dolor", "grey", "greys", "thing", "things", "thinng", "hthing", "straße", "strasse", "ÉCOLE", "école", "ecole"]
    texts = [(i, " ".join(s for k, s in enumerate(stems) for _ in range(i * k % 5))) for i in range(60)]
    texts += [(900, None), (901, ""), (901, "colour colour"), (901, "colour colour"), (None, "colour-dolor3dolor×école÷école")]
    texts += [(1000 + i, w) for w, n in (("stone", 8), ("stoned", 30), ("stoneed", 90)) for i in range(n)]
    want = plain_variants(plain_counts(texts))
    assert any(r[1] for r in want) and any(r[0] != r[2] and r[1] != r[2] for r in want)
    frame = spark.createDataFrame(texts, SCHEMA).selectExpr("doc_id", "text", "text AS word", "1 AS n", "'x' AS node")
    assert rows(variants.spelling_variants(frame), *COLUMNS) == want


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts = plain_counts([(r.doc_id, r.text) for r in docs.collect()])
    by_hole = defaultdict(set)
    for w in counts:
        for i in range(len(w) + 1):
            by_hole[w[:i] + "*" + w[i:]].add(w)
            if i < len(w):
                by_hole[w[:i] + "*" + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for group in by_hole.values():
        for w in group:
            near[w] |= group - {w}
    got = {r.word: r for r in variants.spelling_variants(docs).collect()}
    assert {w: r.n for w, r in got.items()} == counts
    assert {w: r.n_near for w, r in got.items()} == {w: len(near[w]) for w in counts}
    for w, r in got.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        assert r.form == (best if best and counts[best] >= 2 * counts[w] else None)


def test_pairs_of_short_alphabets_and_nested_words(spark):
    words = {"a" * k: k for k in range(5, 12)} | {"ab" * k: 9 - k for k in range(3, 7)} | {"aabaa": 3, "abaaa": 3, "baaaa": 3, "bbbbb": 7, "bbabb": 4}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = rows(variants.neighbours(frame).selectExpr("least(word, near)", "greatest(word, near)"))
    assert got == sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))


def test_long_words_share_and_part_beyond_the_first_levels(spark):
    long = "abcdefghij" * 12
    words = {long: 3, long + "x": 6, long[:-1]: 12, long[:70] + "q" + long[71:]: 4, long[:33] + long[34:]: 5, "z" * 300: 3, "z" * 150 + "y" + "z" * 150: 3}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = rows(variants.neighbours(frame).selectExpr("least(word, near)", "greatest(word, near)"))
    assert got == sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))


@pytest.mark.parametrize("texts", [[], [(1, None)], [(1, ""), (2, "... 12 \n")], [(1, "word")] * 3])
def test_without_words(spark, texts):
    assert variants.spelling_variants(spark.createDataFrame(texts, SCHEMA)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=12), st.binary(max_size=variants.MOVED_BYTES))
def test_checksums_are_moved(before, run):
    import numpy as np

    moves = test_checksums_are_moved.__dict__.setdefault("moves", variants.Moves())
    moved = moves.moved(np.array([zlib.crc32(before)], np.uint32), np.array([len(run)]))
    assert int(moved[0]) ^ zlib.crc32(run) == zlib.crc32(before + run)


def test_runs_longer_than_the_tables(spark):
    run = "abcdé" * 40
    texts = [(i, f"{run} {run}") for i in range(300)]
    assert rows(variants.word_counts(spark.createDataFrame(texts, SCHEMA))) == sorted(plain_counts(texts).items(), key=repr)
    assert len(plain_counts(texts)) >= 1
