"""Isolation-forest quality rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import isolation
from tallyhouse.llm.textstats import COUNTS

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLEAN = "The small house near the river was sold to a young family. They moved in last spring and painted all of its walls. "


def corpus(spark):
    rng = np.random.default_rng(3)
    words = CLEAN.split()
    rows = [(i, " ".join(rng.permutation(words * 2).tolist()), "en", "s", 1) for i in range(120)]
    rows += [(1000 + i, " | ".join(x.upper() + "###" for x in rng.permutation(words * 2).tolist()), "en", "s", 1) for i in range(10)]
    labels = [(r[0], int(r[0] < 1000), 0) for r in rows if r[0] % 2 == 0]
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_junk_goes_and_clean_rows_stay(spark):
    rows, labels = corpus(spark)
    got = {r.doc_id: r for r in isolation.quality_rules(spark.createDataFrame(rows, DOCUMENTS), labels).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept for i in range(120))
    assert not any(got[1000 + i].kept or got[1000 + i].base_failed for i in range(10))


def test_odd_rows(spark):
    rows, labels = corpus(spark)
    odd = [(None, None, None, None, None), (7, "", "en", "s", 0), (7, "", "en", "s", 0), (8, None, "en", "s", 0), (9, CLEAN * 3000, "en", "s", 0)]
    labels = labels.union(spark.createDataFrame([(None, 1, 0), (2, None, 0), (2, 1, None), (99999, 0, 0)], labels.schema))
    docs = spark.createDataFrame(rows + odd, DOCUMENTS).withColumn("N_Words", F.lit("other")).withColumn("kept", F.lit(1))
    got = isolation.quality_rules(docs, labels).where("doc_id is null or doc_id in (7, 8, 9)").collect()
    empty = [r for r in got if r.n_words == 0]
    assert len(empty) == 4 and all(r.base_failed and not r.kept for r in empty)
    assert [r.base_failed for r in got if r.n_words > 50000] == [True]  # one sentence over and over


def test_no_labels_and_no_rows(spark):
    rows, labels = corpus(spark)
    docs = spark.createDataFrame(rows, DOCUMENTS)
    unlabelled = isolation.quality_rules(docs, labels.limit(0))
    assert unlabelled.where("kept = base_failed").count() == 0
    assert isolation.quality_rules(docs.limit(0), labels).count() == 0
    assert unlabelled.columns[:8] == ["doc_id", *COUNTS, "base_failed", "kept"]


def test_path_lengths():
    assert isolation.expected_path(1) == 0 and isolation.expected_path(2) == 1
    assert isolation.expected_path(256) == pytest.approx(2 * (np.log(255) + np.euler_gamma) - 2 * 255 / 256)
    forest = isolation.grow(np.random.default_rng(0).normal(size=(500, 2)))
    near, far = forest.score(np.array([[0.0, 0.0], [30.0, 30.0]]))
    assert far > 0.6 > near


def test_one_wrong_label_does_not_set_the_threshold(spark):
    rows, labels = corpus(spark)
    wrong = labels.union(spark.createDataFrame([(1001, 1, 0)], labels.schema))
    got = {r.doc_id: r for r in isolation.quality_rules(spark.createDataFrame(rows, DOCUMENTS), wrong).collect()}
    assert all(got[i].kept for i in range(120))
    assert not any(got[1000 + i].kept for i in range(10))


def test_threshold_weighs_both_labels():
    bins, clean, junk = np.array([300, 400, 500, 700]), np.array([200, 100, 0, 1]), np.array([0, 0, 20, 10])
    assert isolation.threshold_of(bins, clean, junk, 0.001) == pytest.approx(0.4505)
    assert isolation.threshold_of(bins, clean, 0 * junk, 0.001) == pytest.approx(0.701)
    assert isolation.threshold_of(bins, np.array([200, 90, 10, 1]), np.array([0, 0, 1, 10]), 0.001) == pytest.approx(0.6005)


def test_words_said_many_times_in_a_row_go(spark):
    rng = np.random.default_rng(4)
    pool = ["".join(rng.choice(list("abcdefghij"), int(rng.integers(1, 12))).tolist()).capitalize() + "!" * (i % 5 == 0) for i in range(400)]
    pool = sorted(set(pool))
    clean = [(i, " ".join(rng.choice(rng.permutation(pool), int(rng.integers(40, 90))).tolist()), "en", "s", 1) for i in range(300)]
    stutter = [(2000 + i, " ".join(w for x in rng.choice(pool, 14, replace=False).tolist() for w in [x] * int(rng.integers(4, 7))), "en", "s", 1) for i in range(20)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)] + [(2000 + i, 0, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in isolation.quality_rules(spark.createDataFrame(clean + stutter, DOCUMENTS), labels).collect()}
    assert sum(got[i].kept for i in range(300) if not got[i].base_failed) >= sum(not got[i].base_failed for i in range(300)) - 1
    assert not any(got[2000 + i].kept or got[2000 + i].base_failed for i in range(20))
