"""Cross-entropy difference against plain models."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import scoring

DOCUMENTS = "doc_id long, text string, target string, n_words int"
LABELS = "doc_id long, quality int, toxic int"


def plain_losses(docs, good):
    """Both models' mean bits per word, from dictionaries, each text left out of its own model."""
    texts = [(t or "").split() for _, t, *_ in docs]
    target = [d in good for d, *_ in docs]
    vocabulary = len({w for ws in texts for w in ws})
    pairs = [list(zip([None, *ws], ws)) for ws in texts]
    totals = [sum(len(ws) for ws, t in zip(texts, target) if t == m) for m in (True, False)]
    out = [[], []]
    for m, side in enumerate((True, False)):
        mine = [i for i in range(len(docs)) if target[i] == side]
        words = collections.Counter(w for i in mine for w in texts[i])
        both = collections.Counter(p for i in mine for p in pairs[i])
        starts = sum(bool(texts[i]) for i in mine)
        scale = min(totals) / totals[m] if min(totals) else 1.0
        for i, ws in enumerate(texts):
            own = target[i] == side
            w, b = (words - collections.Counter(ws), both - collections.Counter(pairs[i])) if own else (words, both)
            size, begun = totals[m] - len(ws) * own, starts - (own and bool(ws))
            bits = 0.0
            for a, x in pairs[i]:
                single = (scale * w[x] + scoring.ADDED) / (scale * size + scoring.ADDED * (vocabulary + 1))
                before = begun if a is None else w[a]
                share = b[a, x] / before if before else single
                bits -= math.log2(scoring.PAIR_WEIGHT * share + (1 - scoring.PAIR_WEIGHT) * single)
            out[m].append(bits / max(1, len(ws)))
    return list(zip(*out))


def rows():
    rng = np.random.default_rng(5)
    a, b = "the cat sat on a mat and ate".split(), "stock price of market fell by ten points".split()
    made = [(i, " ".join(rng.choice(a + b[:2], 20).tolist()), "x", 1) for i in range(30)] + [(100 + i, " ".join(rng.choice(b + a[:2], 20).tolist()), "x", 1) for i in range(30)]
    return [*made, (None, "the cat", None, None), (7, None, "x", 1), (8, "", "x", 1), (9, "unseen words only", "x", 1), (1, made[1][1], "x", 1), (11, "mat " * 5000, "x", 1)]


@pytest.mark.parametrize("unit, bucket", [(scoring.UNIT_BYTES, scoring.BUCKET_KEYS), (500, 40)])
def test_losses(spark, monkeypatch, unit, bucket):
    monkeypatch.setattr(scoring, "UNIT_BYTES", unit)
    monkeypatch.setattr(scoring, "BUCKET_KEYS", bucket)
    good = set(range(30))
    labels = spark.createDataFrame([(i, 1, 0) for i in good] + [(i, 1, 0) for i in good] + [(100, 0, 0), (None, 1, 0), (103, None, 0)], LABELS)
    got = scoring.cross_entropy_difference(spark.createDataFrame(rows(), DOCUMENTS), labels).collect()
    want = plain_losses(rows(), good)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), round(r[1], 6), round(r[2], 6))
    for a, b in zip(sorted(((r.doc_id, r.target_loss, r.background_loss) for r in got), key=key), sorted(((d, *w) for (d, *_), w in zip(rows(), want)), key=key)):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:], abs=1e-6)
    assert all(r.difference == r.target_loss - r.background_loss for r in got)
    assert sorted(r.n_words for r in got if r.doc_id == 9) == [3, 20]
    like = {r.doc_id: r.difference for r in got}
    assert max(like[i] for i in range(30) if i not in (1, 7, 8, 9, 11)) < min(like[100 + i] for i in range(30))


def test_repeated_slices_are_counted_twice(spark, monkeypatch):
    monkeypatch.setattr(scoring, "UNIT_BYTES", 1)
    docs = [(5, "same text twice", "x", 1)] * 3 + [(6, "other text", "x", 1), (5, "same text twice", "x", 1)]
    got = scoring.cross_entropy_difference(spark.createDataFrame(docs, DOCUMENTS), spark.createDataFrame([(5, 1, 0)], LABELS)).collect()
    want = plain_losses(docs, {5})
    assert sorted((r.doc_id, round(r.target_loss, 9), round(r.background_loss, 9)) for r in got) == sorted((d, round(t, 9), round(b, 9)) for (d, *_), (t, b) in zip(docs, want))


def test_no_target_and_no_rows(spark):
    docs = spark.createDataFrame(rows(), DOCUMENTS)
    labels = spark.createDataFrame([], LABELS)
    got = scoring.cross_entropy_difference(docs, labels).collect()
    assert len(got) == len(rows()) and all(math.isfinite(r.difference) for r in got)
    assert scoring.cross_entropy_difference(docs.limit(0), labels).count() == 0
    assert scoring.cross_entropy_difference(docs.limit(0), labels).columns == ["doc_id", "n_words", "target_loss", "background_loss", "difference"]


def test_packed_numbers():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**64 - 1, 1000, dtype=np.uint64))
    n = np.arange(1000, dtype=np.uint32)
    a, b = scoring._unpacked(scoring._packed(scoring._differences(keys), n), np.uint64, np.uint32)
    assert (np.cumsum(a, dtype=np.uint64) == keys).all() and (b == n).all()


def test_good_texts_score_alike_in_and_out_of_the_target(spark):
    """Half of the labels are held back: good texts have the same median either way, and lie below junk."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.where(F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    got = {r.doc_id: r for r in scoring.cross_entropy_difference(docs, seen).collect() if r.n_words >= 50}
    quality = {r.doc_id: r.quality for r in labels.collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 2 == 1
    inside = [r.difference for i, r in got.items() if quality.get(i) == 1 and not held(i)]
    outside = [r.difference for i, r in got.items() if quality.get(i) == 1 and held(i)]
    junk = [r.difference for i, r in got.items() if quality.get(i) == 0 and held(i)]
    auc = np.mean([a < b for a in outside for b in junk])
    print("medians", np.median(inside), np.median(outside), np.median(junk), "auc", auc, len(inside), len(outside), len(junk))
    assert abs(np.median(inside) - np.median(outside)) < 0.5
    assert auc > 0.5
