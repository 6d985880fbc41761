import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhouse.llm import middle
from tallyhouse.llm.words import text_bytes

UNIT = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
SCHEMA = "doc_id long, text string"


def plain(key, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return key, n, "plain", text, None, None
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, m, z = ("".join(units[x:y]) for x, y in ((0, lo), (lo, hi), (hi, n)))
    if h4 % 100 < 80:
        return key, n, "spm", f"<S>{z}<P>{a}<M>{m}", len(a), len(m)
    return key, n, "psm", f"<P>{a}<S>{z}<M>{m}", len(a), len(m)


def test_forms_equal_a_plain_version_and_are_restored(spark):
    shared = "Ein Satz, der überall steht — with näh and 漢字. " * 60
    texts = [(i, ["", None, " ", "one", " \n two ", f"x{i} {shared}", shared + shared, "a <P> b", "<S", "end<", "é" * 9000, "\t" * 700 + "x" * 5000][i % 12]) for i in range(240)]
    texts += [(None, "no key at all"), (3, "one"), (3, "one")]
    frame = spark.createDataFrame(texts, SCHEMA).selectExpr("doc_id", "text", "'x' AS output", "1 AS n", "'y' AS form")
    made = middle.fill_in_middle(frame)
    assert rows(made, "doc_id", "n", "form", "output", "prefix_chars", "middle_chars") == sorted((plain(*t) for t in texts), key=repr)
    assert {r.form for r in made.collect()} == {"plain", "psm", "spm"}
    back = rows(made.select("doc_id", middle.restored(made["output"], made["form"])))
    assert back == sorted(((k, t or "") for k, t in texts), key=repr)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert rows(middle.fill_in_middle(docs)) == sorted((plain(*r) for r in docs.collect()), key=repr)


def test_no_rows(spark):
    made = middle.digests(middle.fill_in_middle(spark.createDataFrame([], SCHEMA)))
    assert made.count() == 0 and {"doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"} == set(made.columns)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab \né漢", max_size=400), max_size=6), st.integers(0, 2**31))
def test_every_cut_of_small_chunks(texts, seed):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    least, most = middle.LEAST, middle.MOST
    middle.LEAST, middle.MOST = 1 + seed % 7, 8 + seed % 31
    try:
        counted = middle.Counted(data, offsets, middle.Memo(limit=seed % 500))
    finally:
        middle.LEAST, middle.MOST = least, most
    for i, text in enumerate(texts):
        units = UNIT.findall(text)
        assert counted.units[i] == len(units)
        for k in range(len(units) + 1):
            head = "".join(units[:k])
            assert counted.cut(i, k) == (len(head.encode()), len(head))


def test_shared_chunks_are_counted_once_and_told_apart_by_content():
    passage = "".join(f"word{i * i % 977} " for i in range(9000))
    memo = middle.Memo()
    for head in ("first text begins here. ", "another beginning, of other length: "):
        middle.Counted(*text_bytes(pa.array([head + passage])), memo)
    assert memo.asked > 150 and memo.counted < 0.55 * memo.asked
    assert all(middle.summaries([c])[0] == tuple(s) for c, s in memo.known.items())


@pytest.mark.parametrize("text", ["", "x", "a" * 100_000, " " * 9000, "ab " * 40_000])
def test_chunks_tile_each_text(text):
    data, offsets = text_bytes(pa.array(["before", text, "after"]))
    ends, first = middle.chunk_ends(data, offsets)
    sizes = np.diff(ends, prepend=0)
    assert (sizes > 0).all() and (sizes <= middle.MOST).all() and set(offsets[1:].tolist()) - set(ends.tolist()) <= {0}
    assert len(first) == 4 and first[-1] == len(ends)
