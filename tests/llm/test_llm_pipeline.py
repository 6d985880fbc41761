"""The pipeline against plain versions of its stages."""

import os

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tallyhouse.llm import isolation, pieces, pii, queries
from tallyhouse.llm.common import table
from test_llm_simhash import close, groups, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not (os.path.isdir(FOLDER) and os.path.exists(pieces.MODEL)), reason="the given files are not here")


@needs_data
def test_stages_against_plain_versions(spark):
    docs = table(spark, FOLDER, "documents").withColumn("_f", F.lit("x")).withColumn("_Q_kept", F.lit(1))
    odd = docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), *docs.columns[2:])
    docs = docs.unionByName(odd).unionByName(docs.where("doc_id = 3"))
    stages = dict(corpus_pipeline.STAGES)
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)

    verdicts = {r.doc_id for r in isolation.quality_rules(docs, table(spark, FOLDER, "labels")).collect() if r.kept}
    kept = stages["quality rules"](spark, docs, FOLDER)
    rows = kept.collect()
    assert kept.columns == docs.columns and {r.doc_id for r in rows} == verdicts and len(rows) >= len(verdicts)

    single = stages["simhash near-dedup"](spark, kept, FOLDER)
    prints = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    root = groups(close(set(prints.values())), set(prints.values()))
    best = {}
    for i, f in prints.items():
        best[root[f]] = min(best.get(root[f], i), i)
    left = single.collect()
    assert single.columns == docs.columns and sorted(r.doc_id for r in left) == sorted(best.values())

    items = [r.text.lower().split() for r in table(spark, FOLDER, "benchmark").collect()]
    grams = {tuple(w[k : k + 8]) for w in items for k in range(len(w) - 7)}
    clean = stages["benchmark decontamination"](spark, single, FOLDER)
    copied = {r.doc_id for r in left if len([1 for w in [r.text.lower().split()] for k in range(len(w) - 7) if tuple(w[k : k + 8]) in grams]) >= 8}
    rest = clean.collect()
    assert clean.columns == docs.columns and {r.doc_id for r in left} - {r.doc_id for r in rest} == copied and copied

    private = stages["pii"](spark, clean, FOLDER)
    hidden = private.collect()
    assert private.columns == docs.columns and len(hidden) == len(rest)
    before = {r.doc_id: r.text for r in rest}
    for r in hidden:
        assert (r.text == before[r.doc_id]) == (not any(pii.spans(before[r.doc_id])[1].values())) and r.n_chars == len(r.text)
        assert not any(pii.identifiers(r.text).values())

    last = stages["sentencepiece"](spark, private, FOLDER).collect()
    assert sorted((r.doc_id, r.ids, r.text) for r in last) == sorted((r.doc_id, library.encode(r.text), r.text) for r in hidden)


@needs_data
def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 100
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and len(queries.QUERIES) == 13
