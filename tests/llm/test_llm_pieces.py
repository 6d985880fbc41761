"""Pieces against the public library, brute force, and round trips."""

import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import pieces

needs_model = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="the tokenizer files are not here")
DOCUMENTS = "doc_id long, text string, ids string, place int"


@pytest.fixture(scope="module")
def model():
    return pieces.load()


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def rows():
    rng = random.Random(4)
    made = [(i, "".join(rng.choices("abcdefghit ie.,|\n\t9é日☃ <s>0x41", k=rng.randint(1, 200))), None, 1) for i in range(60)]
    odd = ["", None, " ", "    ", "\n\n", "  Hello  world \n", "日本語 ☃ é́", "x" * 3000, " " * 500 + "ab" * 400 + "🙂", "a" * 62, "a" * 63, "</s> <0x41>"]
    return made + [(100 + i, t, "x", 2) for i, t in enumerate(odd)] + [(None, "no id here", None, None)] + [(7, "twice", "x", 0)] * 2


@needs_model
def test_ids_are_those_of_the_library_and_decode_to_the_text(spark, model, library):
    docs = spark.createDataFrame(rows(), DOCUMENTS)
    got = pieces.encode_decode(docs).collect()
    want = sorted((r[0] if r[0] is not None else -1, library.encode(r[1] or ""), r[1] or "") for r in rows())
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids, r.text) for r in got) == want
    assert all(r.n_pieces == len(r.ids) for r in got)


@needs_model
def test_many_units_and_repeated_units(spark, model, library, monkeypatch):
    monkeypatch.setattr(pieces, "UNIT_BYTES", 40)
    monkeypatch.setattr(pieces, "CUT_BYTES", 30)
    monkeypatch.setattr(pieces, "FOLD_ROWS", 5)
    docs = spark.createDataFrame([(5, "the same text again and again", None, 0)] * 9 + [(5, "x" * 100, None, 0)] * 4, DOCUMENTS).repartition(6)
    got = pieces.encode(docs, model).collect()
    assert len(got) == 13
    assert {tuple(r.ids) for r in got} == {tuple(library.encode(t)) for t in ("the same text again and again", "x" * 100)}


@needs_model
def test_empty_table_and_null_lists(spark, model):
    assert pieces.encode_decode(spark.createDataFrame([], DOCUMENTS)).count() == 0
    df = spark.createDataFrame([(1, None), (2, []), (3, [0])], "a int, ids array<int>")
    assert [r.text for r in pieces.decode(df, model).orderBy("a").collect()] == [None, "", ""]


@needs_model
def test_plain_merges(model, library):
    for text in ("thequickbrownfox", "aaaaaaa", "ing" * 40, "日a☃"):
        assert pieces.plain_merges(model, pieces.BLANK + text) == library.encode(text)


def unigram():
    words = ["▁", "a", "b", "c", "ab", "bc", "abc", "ca", "▁a", "cab"]
    scores = [-3.0, -2.0, -2.5, -2.1, -3.1, -4.0, -6.0, -3.3, -3.9, -5.9]
    rest = [f"<{i}>" for i in range(11, 356)]
    return pieces.Model(
        ["<unk>", *words, *rest], [0.0, *scores, *[0.0] * len(rest)], [False, *[True] * 10, *[False] * len(rest)], [100 + b for b in range(256)], unigram=True)


def best_sum(model, text):
    lowest, best = min(model.scores) - pieces.NO_PIECE, -np.inf
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(text)]
        parts = [text[a:b] for a, b in zip(at, at[1:])]
        if all(p in model.ids or len(p) == 1 for p in parts):
            best = max(best, sum(model.scores[model.ids[p]] if p in model.ids else lowest for p in parts))
    return best


def test_viterbi_finds_the_best_path(spark):
    model = unigram()
    texts = ["".join(t) for n in (1, 3, 5) for t in itertools.product("abcé"[: 4 if n < 5 else 3], repeat=n)]
    segments = spark.createDataFrame([(0, pieces.BLANK + t) for t in texts], "bucket int, segment string")
    got = pieces.best_paths(segments, pieces.piece_table(spark, model), model).collect()
    assert len(got) == len(texts)
    lowest = min(model.scores) - pieces.NO_PIECE
    for r in got:
        joined, total = b"", 0.0
        for i in r.ids:
            joined += model.pieces[i].encode() if i < 100 else bytes([i - 100])
            total += model.scores[i] if i < 100 else 0.0
        total += lowest * r.segment.count("é")
        assert joined.decode() == r.segment and total == pytest.approx(best_sum(model, r.segment))
        assert pieces.plain_merges(model, r.segment) == r.ids or sum(model.scores[i] for i in r.ids if i < 100) == pytest.approx(
            sum(model.scores[i] for i in pieces.plain_merges(model, r.segment) if i < 100))


def test_a_unigram_model_encodes_texts(spark):
    model = unigram()
    texts = ["ab cab", "", None, "abcabc" * 30, "é a"]
    got = pieces.decode(pieces.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model), model)
    assert [(r.doc_id, r.text) for r in got.orderBy("doc_id").collect()] == [(i, t or "") for i, t in enumerate(texts)]


@needs_model
def test_an_input_that_changes_is_refused(spark, model):
    other = F.udf(lambda: os.urandom(8).hex(), "string").asNondeterministic()
    docs = spark.range(400).select(F.col("id").alias("doc_id"), other().alias("text"))
    with pytest.raises(Exception, match="cut its lineage first"):
        pieces.encode(docs, model).collect()
