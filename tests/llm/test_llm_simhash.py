"""SimHash groups against all pairs."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyhouse.llm import components as c
from tallyhouse.llm import simhash
from tallyhouse.llm.components import components


def plain_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def close(values, distance=4):
    v = np.array(sorted(values), np.uint64)
    a, b = np.nonzero(np.bitwise_count(v[:, None] ^ v[None, :]) <= distance)
    return [(int(v[x]), int(v[y])) for x, y in zip(a, b) if x < y]


@pytest.mark.parametrize("text", ["", " \n", "One", "a b c", "a b c d", "A b C d é\x0b ÀÉ z z z", "w " * 700, "x" * 100000, None])
def test_fingerprint(spark, text):
    got = simhash.with_fingerprint(spark.createDataFrame([(text,)], "text string")).first()["fingerprint"]
    assert got % 2**64 == plain_fingerprint(text)


def near_values(seed, families=40, members=12):
    rng = np.random.default_rng(seed)
    values = set()
    for base in rng.integers(0, 2**63, families).tolist():
        for _ in range(members):
            x = base
            for bit in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                x ^= 1 << bit
            values.add(x)
    return values


@pytest.mark.parametrize("dense", [2048, 4])
def test_bucket_links_join_what_all_pairs_join(monkeypatch, dense):
    monkeypatch.setattr(simhash, "DENSE", dense)
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 1000)
    values = near_values(dense)
    a, b = simhash.bucket_links(np.array(list(values), np.uint64))
    assert groups(zip(a.tolist(), b.tolist()), values) == groups(close(values), values)
    assert len(a) < len(values)


@pytest.mark.parametrize("blocks, agree", [(6, 2), (5, 1), (8, 4)])
def test_classes(spark, blocks, agree):
    values = near_values(5)
    df = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in values], "f long")
    got = {r.f % 2**64: r.root % 2**64 for r in simhash.classes(df, 4, blocks, agree).collect()}
    want = groups(close(values), values)
    assert len({(got[x], want[x]) for x in values}) == len(set(want.values())) == len(set(got.values()))


def test_too_few_blocks(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "f long"), 4, 5, 2)


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 100), (7, 7), (None, 3)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {i: 0 for i in range(51)} | {100: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


WORDS = [f"word{i}" for i in range(400)]


def rows():
    long = " ".join(WORDS)
    return [(5, long, 1), (3, long.upper(), 2), (9, long + " more", 3), (4, " ".join(WORDS[::-1]), 4), (8, None, 5), (7, "", 6), (None, " ", 7),
            (6, "alone here", 8), (6, "alone here", 8), (None, "nobody", 9)]


def test_near_duplicates(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, f int").withColumn("Component_ID", F.lit("x"))
    got = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [
        (-1, -1), (-1, 7), (3, 3), (4, 4), (5, 3), (6, 6), (6, 6), (7, 7), (8, 7), (9, 3)]
    assert {r.fingerprint for r in got if r.component_id == 7} == {"0" * 16}
    assert all(r.fingerprint == f"{plain_fingerprint(dict((x[0], x[1]) for x in rows())[r.doc_id]):016x}" for r in got if r.doc_id)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, _f int").withColumn("_id", F.lit("x"))
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r._f) for r in kept.collect()) == [(-1, 9), (3, 2), (4, 4), (6, 8), (7, 6)]
    assert simhash.representatives(docs.limit(0)).count() == 0


def test_hot_keys_are_dealt_to_many_parts(spark):
    rows = spark.range(5000).selectExpr("id AS member", "if(id % 3 = 0, id, 7L) AS k", "5000 - id AS v", "if(id = 4998, 'x', 'y') AS note")
    got = c.with_least(rows, "k", "member", "v", "least")
    plain = rows.groupBy("k").agg(F.min("v").alias("least"))
    assert got.columns == ["k", "member", "v", "note", "least"] and got.count() == 5000
    assert got.select("k", "member", "least").exceptAll(rows.join(plain, "k").select("k", "member", "least")).count() == 0
    joined = c.spread_join(rows, plain, "k", "member")
    assert joined.select("member", "least").exceptAll(got.select("member", "least")).count() == 0 and joined.count() == 5000
    assert c.with_least(rows.limit(0), "k", "member", "v", "least").count() == 0
