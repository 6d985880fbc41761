"""Substring dedup against a plain count of all windows."""

import collections
import hashlib
import random

import numpy as np
import pytest

from tallyhouse.llm import repeats

DOCUMENTS = "doc_id long, text string, unit string, place int"


def plain(texts, window):
    words = [(t or "").encode().split() for t in texts]
    often = collections.Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {j for k in range(len(w) - window + 1) if often[tuple(w[k : k + window])] > 1 for j in range(k, k + window)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


def texts(seed, window):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "ß\x1f"]
    shared = [" ".join(rng.choices(vocabulary, k=n)) for n in (window - 1, window, window + 1, 3 * window)]
    made = [" ".join([*rng.choices(vocabulary, k=rng.randint(0, 30)), rng.choice(shared), *rng.choices(vocabulary, k=rng.randint(0, 30))]) for _ in range(40)]
    return [*made, made[0], "x " * (4 * window), "a b " * window, None, "", " \n\t ", "one", "y " * (window - 1) + "z", "long " + " ".join(map(str, range(3000)))]


@pytest.mark.parametrize("window, anchor, bits", [(35, 8, 20), (5, 2, 20), (12, 8, 4), (3, 8, 20)])
def test_removed_words(spark, monkeypatch, window, anchor, bits):
    monkeypatch.setattr(repeats, "UNIT_BYTES", 700)
    monkeypatch.setattr(repeats, "HELD_CELLS", 50)
    monkeypatch.setattr(repeats, "BUCKET_WINDOWS", 20)
    rows = [(i, t, "x", 1) for i, t in enumerate(texts(window, window))]
    got = repeats.remove_repeats(spark.createDataFrame(rows, DOCUMENTS), window, anchor, bits).collect()
    want = plain([t for _, t, _, _ in rows], window)
    assert sorted(tuple(r) for r in got) == sorted((i, *w) for (i, *_), w in zip(rows, want))
    assert any(w[1] for w in want) and any(not w[1] for w in want)


def test_anchors_of_equal_windows_differ_in_place():
    grams = np.array([5, 5, 5, 5, 3, 9, 3, 3, 8], np.uint64)
    for span in range(1, 9):
        assert repeats.anchors(grams, span).tolist() == [i + int(np.argmin(grams[i : i + span])) for i in range(len(grams) - span + 1)]


def test_null_and_repeated_ids_and_empty_tables(spark):
    text = " ".join(map(str, range(50)))
    rows = [(None, text, None, None), (3, text + " more", "a", 1), (3, "alone", "a", 1), (None, None, "b", 2)]
    got = repeats.remove_repeats(spark.createDataFrame(rows, DOCUMENTS), bits=16).collect()
    assert sorted((r.doc_id or -1, r.n_removed, r.kept) for r in got) == [(-1, 0, ""), (-1, 50, ""), (3, 0, "alone"), (3, 50, "more")]
    assert repeats.remove_repeats(spark.createDataFrame([], DOCUMENTS), bits=16).count() == 0
