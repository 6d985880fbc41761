"""Joins give plain results when keys are heavy, absent or too large to broadcast."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyhouse.operators import joins
from tallyhouse.operators.joins import heavy_keys, measured, salted_join, sized_join


@pytest.fixture(scope="module")
def sides(spark):
    hot = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id")
    left = hot.unionByName(spark.createDataFrame([(None, 1), (None, 2), ("alone", 3)], "k string, id bigint"))
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k7", 3), ("other", 4), (None, 5)], "k string, n int")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_a_plain_join(sides, how):
    left, right = sides
    assert rows(salted_join(left, right, ["k"], how, min_rows=100)) == rows(left.join(right, ["k"], how))


def test_salted_join_refuses_joins_that_keep_right_rows(sides):
    with pytest.raises(ValueError):
        salted_join(*sides, ["k"], "full_outer")


def test_sized_join_beyond_the_limit_does_not_broadcast(sides, monkeypatch):
    left, right = sides
    want = rows(left.join(right, ["k"], "left"))
    assert rows(sized_join(left, right, ["k"], "left")) == want
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    assert rows(sized_join(left, right, ["k"], "left")) == want


def test_heavy_rows_reach_many_tasks(spark, sides):
    left, right = sides
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    kept = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        tasks = lambda df: df.filter("k = 'hot'").select(F.spark_partition_id()).distinct().count()
        assert tasks(left.join(right, ["k"])) == 1
        assert tasks(salted_join(left, right, ["k"], min_rows=100)) > 4
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_heavy_keys_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(joins, "HEAVY_KEYS", 5)
    assert heavy_keys(spark.range(100).select((F.col("id") % 20).alias("k")), ["k"], 1).count() == 5


def test_measured(spark):
    assert measured(spark.createDataFrame([("ab", 1), (None, 2)], "s string, n bigint")) == (2, 18)
    assert measured(spark.createDataFrame([], "s string")) == (0, 0)
