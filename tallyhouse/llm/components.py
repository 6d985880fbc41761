"""Connected components of links between long ids, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage

#: The rows of one key are dealt to this many parts, so that a hot key is no single task.
SALTS = 64


def _salted(rows: DataFrame, member: str) -> DataFrame:
    return rows.withColumn("_salt", F.pmod(F.xxhash64(member), F.lit(SALTS)).cast("int"))


def with_least(rows: DataFrame, key: str, member: str, value: str, name: str) -> DataFrame:
    """Every row with the smallest ``value`` of its key as ``name``.

    Rows of a key are dealt by ``member``, each part has its minimum, and the
    parts of a key, ``SALTS`` at most, meet for the least of them.
    """
    salted = _salted(rows, member)
    parts = salted.groupBy(key, "_salt").agg(F.min(value).alias("_part"))
    least = parts.groupBy(key).agg(F.min("_part").alias(name))
    return salted.join(parts.join(least, key).select(key, "_salt", name), [key, "_salt"]).drop("_salt")


def spread_join(rows: DataFrame, named: DataFrame, key: str, member: str) -> DataFrame:
    """Inner join of ``rows`` with ``named``, which has one row per key; rows of a key are dealt by ``member``."""
    salted = _salted(rows, member)
    parts = salted.select(key, "_salt").distinct().join(named, key)
    return salted.join(parts, [key, "_salt"]).drop("_salt")


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return with_least(both, "a", "b", "b", "m").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    hung = with_least(down, "a", "b", "b", "m")
    moved = hung.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(hung.where("b = m").select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every id that occurs in ``links (a, b)``.

    ``root`` is the smallest id that can be reached. Rows with a null end or
    with equal ends link nothing. Every round hangs all larger neighbours, then
    all smaller ones, on the smallest neighbour and is written to shared
    storage; the number of rounds grows with the logarithm of the longest
    path. Links stay distributed: the driver sees only their count and a hash.
    """
    links = cut_lineage(links.select("a", "b").where("a <> b").distinct())
    before = _signature(links)
    while before[0]:
        links = cut_lineage(_small_star(_large_star(links).distinct()).distinct())
        now = _signature(links)
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
