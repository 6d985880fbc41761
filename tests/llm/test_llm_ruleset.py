"""The rule ensemble: held-out accuracy, and the compiled expression against numpy."""

import zlib

import numpy as np
import pytest

from tallyhouse.llm import ruleset
from tallyhouse.llm.textstats import FEATURES, measure

DOCUMENTS = "doc_id long, text string, score string, held_out int"


def rows():
    rng = np.random.default_rng(1)
    words = "a house by the river was sold and painted last spring while children played near its old garden wall".split()
    good = [(i, " ".join(rng.choice(words, 60).tolist()) + ".") for i in range(150)]
    bad = [(500 + i, " | ".join(rng.choice(words, 60).tolist())) for i in range(75)] + [(600 + i, " ".join(w.upper() + "!!" for w in rng.choice(words, 60).tolist())) for i in range(75)]
    return [(i, t, "x", 1) for i, t in good + bad]


def test_held_out_rows_are_classified(spark):
    docs = spark.createDataFrame([*rows(), (None, None, None, None), (7, "", "x", 1)], DOCUMENTS)
    labels = spark.createDataFrame([(i, int(i < 500), 0) for i, *_ in rows()] + [(None, 1, 0), (3, None, 0), (99999, 0, 0)], "doc_id long, quality int, toxic int")
    got = ruleset.classify(docs, labels).collect()
    assert len(got) == 302
    known = [r for r in got if r.doc_id is not None and r.doc_id != 7]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in known)
    assert sum(r.held_out for r in known) > 60
    assert np.mean([r.predicted == int(r.doc_id < 500) for r in known if r.held_out]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]


def test_held_out_labels_change_nothing(spark):
    docs = spark.createDataFrame(rows(), DOCUMENTS)
    labels = [(i, int(i < 500), 0) for i, *_ in rows()]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    a, b = (sorted(map(tuple, ruleset.classify(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect())) for x in (labels, turned))
    assert a == b


def test_expression_equals_numpy(spark):
    measures = measure(spark.createDataFrame(rows(), DOCUMENTS).select("doc_id", "text")).select("doc_id", *FEATURES).toPandas()
    x, y = measures[list(FEATURES)].to_numpy(), (measures["doc_id"] < 500).to_numpy(float)
    model = ruleset.fit(x, y)
    assert 0 < len(model.rules) < 200
    want = model.score({f: x[:, i] for i, f in enumerate(FEATURES)})
    got = spark.createDataFrame(measures).withColumn("s", model.column()).orderBy("doc_id").toPandas()["s"].to_numpy()
    assert got == pytest.approx(want[np.argsort(measures["doc_id"])], abs=1e-12)


def test_one_class_and_nothing(spark):
    docs = spark.createDataFrame(rows(), DOCUMENTS)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in ruleset.classify(docs, labels.limit(0)).collect()} == {0.5}
    learned = 0.5 if zlib.crc32(b"1") % 3 == 1 else 2 / 3
    assert all(r.score == pytest.approx(learned) for r in ruleset.classify(docs, labels).collect())
    assert ruleset.classify(docs.limit(0), labels).count() == 0


def test_lasso_is_sparse():
    rng = np.random.default_rng(0)
    z = rng.integers(0, 2, (800, 30)).astype(float)
    y = (z[:, 3] + 0.0 > rng.random(800) * 0.2 + 0.4).astype(float)
    _, w = ruleset.lasso(z, y, 0.03)
    assert w[3] > 0.5 and (w != 0).sum() < 8
