"""A corpus pipeline of five stages over ``documents``.

Every stage takes what the stage before it has kept. Extra columns stay until
the last stage, whatever their names are; null and empty texts, repeated rows
and empty tables are treated as the stage's operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import decontaminate, isolation, pieces, pii, simhash
from tallyhouse.llm.common import cut_lineage, documents, fresh, table

#: Neither the forest nor the fingerprints, the alignment or the pieces can be written in SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the others go, texts without words among them."""
    rules = isolation.fit(docs, table(spark, sf_dir, "labels"))
    prefix = "_q_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    return isolation.judge(docs, rules, prefix=prefix).where(F.col(f"`{prefix}kept`")).select(*_names(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id."""
    return simhash.representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a test item."""
    name = fresh(docs, "_copies")
    marked = decontaminate.with_copies(docs, documents(docs), table(spark, sf_dir, "benchmark"), name)
    return marked.where(F.size(name) == 0).select(*_names(docs))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` is that of the new text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, ids, text``: the pieces of every document, and the text they decode to."""
    return pieces.encode_decode(docs)


def _names(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("pii", without_personal_data),
    ("sentencepiece", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; between them the rows are cut off from their history, so that no stage runs twice."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
