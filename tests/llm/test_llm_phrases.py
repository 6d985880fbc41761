import hashlib
import random

import numpy as np
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhouse.llm import phrases

SCHEMA = "doc_id long, text string"


def plain_phrases(text):
    known, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in known:
            known.add(text[start:end])
            start = end
    return known


def plain_rows(docs):
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] is not None, d[1] or ""))
    out = []
    for i, (key, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, near = (phrases.signature(t) for t in (text, edited, following))
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), phrases.shown(own), phrases.shown(other), phrases.likeness(own, other), phrases.likeness(own, near)))
    return sorted(out, key=repr)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abé ", max_size=300), st.text(alphabet="abé ", max_size=60))
def test_phrases_and_a_continued_parse(text, other):
    assert phrases.Parse().feed(text).phrases == plain_phrases(text)
    head = phrases.Parse().feed(text)
    assert (head.copy().feed(other).signature() == phrases.signature(text + other)).all()
    a, b = plain_phrases(text), plain_phrases(other)
    exact = len(a & b) / len(a | b) if a | b else 1.0
    assert phrases.likeness(phrases.signature(text), phrases.signature(other)) == pytest.approx(exact)


def test_full_signatures_estimate_the_share():
    draw = random.Random(5)
    words = ["".join(draw.choices("etaoinshr", k=draw.randint(2, 8))) for _ in range(3000)]
    a = " ".join(draw.choices(words, k=4000))
    b = a[: len(a) // 2] + " ".join(draw.choices(words, k=2000))
    one, two = plain_phrases(a), plain_phrases(b)
    assert min(len(one), len(two)) > 10 * phrases.KEPT
    found = phrases.likeness(phrases.signature(a), phrases.signature(b))
    assert abs(found - len(one & two) / len(one | two)) < 0.1
    every = np.unique(phrases.phrase_hashes(sorted(one)))
    assert (phrases.signature(a) == every[: phrases.KEPT]).all()


def test_blocks_bound_the_dictionary(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 50)
    text = "abcabcabdabe" * 20
    state = phrases.Parse().feed(text)
    assert sum(map(len, state.phrases)) <= 50
    every = set().union(*(plain_phrases(text[i : i + 50]) for i in range(0, len(text), 50)))
    assert (state.signature() == np.unique(phrases.phrase_hashes(sorted(every)))[: phrases.KEPT]).all()
    split = phrases.Parse().feed(text[:33]).feed(text[33:])
    assert (split.signature() == state.signature()).all()


@pytest.mark.parametrize("ranges", [1, 3, 12])
def test_rows_equal_a_plain_version(spark, ranges):
    draw = random.Random(3)
    docs = [(3 * i - 40, " ".join(draw.choices(["alpha", "beta", "gamma", "délta", "漢字"], k=draw.randint(0, 60)))) for i in draw.sample(range(60), 60)]
    docs += [(2, None), (2, ""), (5, "same id"), (5, "same id, other text"), (7, "again"), (7, "again"), (None, "no id"), (None, None), (-(2**63), "lowest"), (2**63 - 1, "highest")]
    frame = spark.createDataFrame(docs, SCHEMA).selectExpr("doc_id", "text", "'x' AS key", "1 AS place", "false AS copy", "0 AS own")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        assert rows(phrases.phrase_fingerprints(frame)) == plain_rows(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("docs", [[], [(1, "only one text")], [(None, None)], [(1, ""), (2, "")], [(4, "twin text"), (4, "twin text")]])
def test_few_rows(spark, docs):
    assert rows(phrases.phrase_fingerprints(spark.createDataFrame(docs, SCHEMA))) == plain_rows(docs)


def test_edits_stay_nearer_than_neighbours(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = phrases.phrase_fingerprints(docs).where("n_chars >= 200")
    assert made.where("near_edited <= near_next AND near_next < 0.9").count() == 0
    assert made.where("near_edited = 1.0 AND fingerprint <> edited_fingerprint").count() == 0
