"""Sorts, pages and windows, whatever the input order."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tallyhouse.operators import ordering, ranking
from tallyhouse.operators.aggregates import all_true, any_true
from tallyhouse.operators.sets import dedupe_first, role_members, set_diff
from tallyhouse.sources.ordered import OrderedCopy


def shuffled(spark, data, schema, seed):
    data = list(data)
    random.Random(seed).shuffle(data)
    return spark.createDataFrame(data, schema).repartition(5)


def listed(df, column):
    return [r[column] for r in df.collect()]


@pytest.mark.parametrize("seed", [1, 2])
def test_numbers_sort_as_numbers(spark, seed):
    df = shuffled(spark, [(9,), (10,), (2,), (None,)], "n int", seed)
    assert listed(ordering.stable_sort(df, [("n", True)]), "n") == [10, 9, 2, None]
    assert listed(ordering.stable_sort(df, ["n"]), "n") == [None, 2, 9, 10]


@pytest.mark.parametrize("seed", [1, 2])
def test_ties_follow_the_json_of_the_row(spark, seed):
    df = shuffled(spark, [("b", "x"), ("a", "z"), ("a", "y")], "name string, tag string", seed)
    assert [tuple(r) for r in ordering.stable_sort(df, ["name"]).collect()] == [("a", "y"), ("a", "z"), ("b", "x")]


def test_absent_candidate_keys_are_skipped(spark):
    df = spark.createDataFrame([(1,), (3,), (2,)], "version int")
    assert listed(ordering.stable_sort(df, [("version_number", True), ("version", True)]), "version") == [3, 2, 1]


def test_text_sorts_by_code_point(spark):
    df = spark.createDataFrame([("b",), ("B",), ("é",), ("a",)], "s string")
    assert listed(ordering.stable_sort(df, ["s"]), "s") == ["B", "a", "b", "é"]


def runs(spark, n=60, seed=3):
    return shuffled(spark, [(i,) for i in range(1, n + 1)], "run_number int", seed)


def test_newest_runs(spark):
    assert listed(ordering.newest_runs(runs(spark)), "run_number") == list(range(60, 10, -1))
    assert listed(ordering.newest_runs(runs(spark, 40), 10, 15), "run_number") == list(range(25, 15, -1))
    assert listed(ordering.newest_runs(runs(spark), 0, 3), "run_number") == []


@pytest.mark.parametrize("limit,offset", [(5, 0), (5, 7), (None, 55), (2000, 10), (None, None), (1, 59), (3, 60)])
def test_page_equals_a_slice(spark, limit, offset):
    want = list(range(1, 61))[offset or 0 :][: limit if limit is not None else None]
    assert listed(ordering.page(runs(spark), ["run_number"], limit, offset), "run_number") == want


def test_deep_page_over_many_partitions_and_a_heavy_value(spark):
    df = spark.range(20_000).select((F.col("id") % 3 == 0).cast("int").alias("hot"), F.col("id")).repartition(16)
    want = sorted((int(i % 3 == 0), i) for i in range(20_000))[7_000:9_500]
    got = [tuple(r) for r in ordering.page(df, ["hot", "id"], 2_500, 7_000).collect()]
    assert got == want


def test_negative_pages_are_refused(spark):
    with pytest.raises(ValueError):
        ordering.page(runs(spark), ["run_number"], -1)


def lines(spark, n=130):
    return shuffled(spark, [(i, f"line {i}") for i in range(n)], "line_number int, line string", 5)


def test_log_windows_are_ascending(spark):
    take = lambda **k: listed(ordering.log_window(lines(spark), **k), "line_number")
    assert take() == list(range(30, 130))
    assert take(offset=90) == list(range(120, 130))
    assert take(limit=20, order="desc") == list(range(110, 130))
    assert take(limit=20, offset=5, order="desc") == list(range(105, 125))
    assert take(limit=3, offset=2) == [2, 3, 4]
    assert take(limit=0) == []
    with pytest.raises(ValueError):
        take(order="up")


def test_object_keys(spark):
    df = spark.createDataFrame([("file", "a.txt"), ("folder", "a"), ("file", "a-b")], "type string, name string")
    assert listed(ordering.order_object_keys(df), "name") == ["a-b", "a.txt", "a"]


def test_folded_order(spark):
    df = spark.createDataFrame([("b",), ("A",), ("a",), ("B",)], "n string")
    assert listed(ordering.order_folded(df, ["n"]), "n") == ["A", "a", "B", "b"]


def test_nested_sort(spark):
    df = spark.createDataFrame(
        [("u2", [("b", 1), ("a", 2)], ["y", "x"]), ("u1", None, [])], "user string, boxes array<struct<id string, n int>>, roles array<string>"
    )
    got = ordering.sort_nested(df, ["user"], {"boxes": "id"}, ["roles"]).collect()
    assert [r["user"] for r in got] == ["u1", "u2"]
    assert [b["id"] for b in got[1]["boxes"]] == ["a", "b"] and got[1]["roles"] == ["x", "y"] and got[0]["boxes"] is None


def test_first_by_name(spark):
    df = spark.createDataFrame([("b", "Default"), ("a", "other"), ("c", "default")], "name string, type string")
    assert listed(ordering.first_by_name(df, "name", "type", "DEFAULT"), "name") == ["b"]


def test_latest_revision_drops_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 9), ("b", None)], "k string, rev int")
    assert rows(ranking.latest_revision(df, ["k"], ["rev"])) == [("a", 2)]


def test_match_count_with_heavy_and_null_keys(spark):
    data = [("hot", i) for i in range(500)] + [("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)]
    got = ranking.with_match_count(shuffled(spark, data, "k string, v int", 7), ["k"])
    counts = {k: {r["match_count"] for r in got.collect() if r["k"] == k} for k in ("hot", "a", "b", None)}
    assert got.count() == 505 and counts == {"hot": {500}, "a": {2}, "b": {1}, None: {2}}


def test_numbered_rows_of_a_heavy_key(spark):
    df = spark.range(9_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 10).cast("string")).alias("k"), "id").repartition(9)
    got = ranking.numbered_rows(df, ["k"], [F.desc("id")])
    window = {}
    for r in sorted(got.collect(), key=lambda r: (r["k"], -r["id"])):
        window[r["k"]] = window.get(r["k"], 0) + 1
        assert r["row_number"] == window[r["k"]]
    assert sum(window.values()) == 9_000


@pytest.mark.parametrize("limit,offset", [(2, 1), (1500, 2), (0, 0)])
def test_page_per_group(spark, limit, offset):
    df = shuffled(spark, [(k, i) for k in "ab" for i in range(5)], "k string, n int", 2)
    want = sorted(((k, n) for k in "ab" for n in list(range(4, -1, -1))[offset:][:limit]), key=repr)
    assert rows(ranking.page_per_group(df, ["k"], [F.desc("n")], limit, offset)) == want


def test_numbers_and_growth_agree_with_windows_on_many_repeated_keys(spark):
    """1,500 keys of several rows, a key of a third of all rows, null keys, null and equal times."""
    n = F.col("id")
    df = spark.range(9_000).select(
        F.when(n % 3 == 0, -1).when(n % 50 != 1, n % 1_500).alias("k"),
        F.when(n % 7 > 0, F.timestamp_seconds(1_700_000_000 + (n * 7_919) % 997)).alias("t"),
        F.when(n % 11 > 0, n).alias("v"),
    ).repartition(6)
    by = [F.col(c).asc_nulls_first() for c in ("t", "v")]
    inside = Window.partitionBy("k").orderBy(*by)
    want = df.withColumn("row_number", F.row_number().over(inside).cast("bigint"))
    assert rows(ranking.numbered_rows(df, ["k"], by)) == rows(want)
    lagged = df.withColumn("previous_v", F.lag("v").over(inside)).withColumn("growth", F.col("v") - F.col("previous_v"))
    assert rows(ranking.storage_growth(df, "k", "t", "v")) == rows(lagged)
    assert ranking.storage_growth(df.limit(0), "k", "t", "v").count() == 0


def test_growth_crosses_units(spark):
    data = [("d", f"2026-0{m}-{d:02d} 00:00:00", m * 100 + d) for m in (1, 2, 4) for d in (1, 15)]
    df = shuffled(spark, data, "database_id string, t string, active_bytes int", 4).withColumn("computed_ts", F.col("t").cast("timestamp_ntz"))
    got = sorted(rows(ranking.storage_growth(df), "active_bytes", "previous_active_bytes", "growth"))
    assert got == [(101, None, None), (115, 101, 14), (201, 115, 86), (215, 201, 14), (401, 215, 186), (415, 401, 14)]


def test_dedupe_keeps_the_first_copy(spark):
    df = shuffled(spark, [("u1", 2, "b"), ("u1", 1, "a"), ("u2", 3, "c")], "id string, page int, v string", 1)
    assert rows(dedupe_first(df, "id", ["page"]), "id", "v") == [("u1", "a"), ("u2", "c")]


def test_truth_over_no_rows(spark):
    df = spark.createDataFrame([(True,), (None,)], "b boolean")
    for data, want in ((df.filter("false"), (True, False)), (df, (False, True)), (df.filter("b"), (True, True))):
        assert tuple(data.agg(all_true(F.col("b")), any_true(F.col("b"))).first()) == want


def test_set_difference_and_members(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "k string")
    b = spark.createDataFrame([("x",)], "k string")
    assert [r["k"] for r in set_diff(a, b, ["k"]).collect()] == [None, "y"]
    users = spark.createDataFrame([("r", "u", "u@x", False, None)], "granted_to string, username string, email string, is_service_account boolean, granted_at timestamp")
    roles = spark.createDataFrame([("r", "child", None)], "granted_to string, role_name string, granted_at timestamp")
    got = [tuple(r)[:5] for r in role_members(users, roles).collect()]
    assert got == [("r", "child", "role", None, None), ("r", "u", "user", "u@x", False)]


def test_exact_decimals_are_kept(spark):
    df = spark.createDataFrame([(Decimal("9007199254740993"),), (Decimal("9007199254740992"),)], "n decimal(38,0)")
    assert listed(ordering.stable_sort(df, ["n"]), "n") == [Decimal("9007199254740992"), Decimal("9007199254740993")]


def ordered_copy(spark, folder, keys=(), block_rows=7):
    data = [(i, i % 3 if i % 10 else None, f"n{i % 5}") for i in range(100)] * 2
    df = shuffled(spark, data, "i int, k int, name string", 3)
    return df, OrderedCopy(spark, f"{folder}/kept").write(df, [("name", True), "i"], keys, block_rows)


def test_pages_of_a_kept_order_equal_one_sort(spark, folder):
    df, copy = ordered_copy(spark, folder)
    want = [tuple(r) for r in ordering.page(df, [("name", True), "i"]).collect()]
    got = [tuple(r) for offset in range(0, 210, 15) for r in copy.page(15, offset).collect()]
    assert got == want and [tuple(r) for r in copy.page(None, 190).collect()] == want[190:]
    assert copy.page(0, 3).count() == 0 and copy.page(5, 200).count() == 0
    with pytest.raises(ValueError):
        copy.page(-1)


def test_a_page_of_a_kept_order_reads_its_blocks_only(spark, folder):
    _, copy = ordered_copy(spark, folder)
    part = copy.between(15, 28).select(F.expr("regexp_extract(input_file_name(), '__block=([0-9]+)', 1)").alias("block"))
    assert {r.block for r in part.collect()} == {"2", "3"}
    plan = copy.page(14, 14)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__block" in plan and "(__block" in plan.split("PartitionFilters", 1)[1].split("PushedFilters")[0]


def test_pages_inside_a_key_of_a_kept_order(spark, folder):
    df, copy = ordered_copy(spark, folder, ["k"])
    for key in (0, 1, 2, None, 9):
        mine = df.filter(F.col("k").eqNullSafe(F.lit(key).cast("int")))
        want = [tuple(r) for r in ordering.page(mine, [("name", True), "i"]).collect()]
        assert [tuple(r) for offset in range(0, 80, 9) for r in copy.group_page((key,), 9, offset).collect()] == want
    with pytest.raises(ValueError):
        copy.group_page(())


def test_kept_order_of_an_empty_table_and_of_taken_names(spark, folder):
    empty = spark.createDataFrame([], "i int, __Block int").drop("__Block")
    assert OrderedCopy(spark, f"{folder}/e").write(empty, ["i"]).page(5).count() == 0
    with pytest.raises(ValueError):
        OrderedCopy(spark, f"{folder}/f").write(spark.createDataFrame([(1,)], "__Block int"), ["__Block"])
