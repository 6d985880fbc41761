"""Schema changes, drift and snapshots."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tallyhouse.operators import drift, shapes, snapshots
from tallyhouse.plans.table_change import change_table, planned_changes
from tallyhouse.sources.snapshots import SnapshotStore
from tallyhouse.sources.tables import VersionedTable

CATALOG = "table_name string, column_name string, position int, data_type string"


def struct(ddl):
    return T.StructType.fromDDL(ddl)


def test_columns_added_then_dropped_keep_the_row(spark, folder):
    table = VersionedTable(spark, f"{folder}/t")
    table.replace(spark.createDataFrame([(1, "kept")], "id int, label string"))
    wide = change_table(table, struct("id int, label string, amount double, active boolean"))
    assert wide.columns == ["id", "label", "active", "amount"] and rows(wide) == [(1, "kept", None, None)]
    narrow = change_table(table, struct("id int, amount double"), key=["id"], not_null=["id"])
    assert narrow.columns == ["id", "amount"] and rows(narrow) == [(1, None)]


def test_refused_changes(spark):
    df = spark.createDataFrame([(1, "x")], "id int, label string")
    for planned, key in (("id bigint, label string", ()), ("id int, Label string", ()), ("label string", ("id",))):
        with pytest.raises(ValueError):
            shapes.evolve(df, struct(planned), key)


def test_null_in_a_required_column_stops_the_change(spark, folder):
    table = VersionedTable(spark, f"{folder}/t")
    table.replace(spark.createDataFrame([(None, "x")], "id int, label string"))
    with pytest.raises(ValueError, match="id"):
        change_table(table, struct("id int, label string, n int"), not_null=["id"])
    assert table.version() == 1


def test_planned_changes_of_a_table(spark, folder):
    table = VersionedTable(spark, f"{folder}/t")
    table.replace(spark.createDataFrame([(1, "x")], "id int, label string"))
    got = planned_changes(table, "t", struct("id int, extra double"))
    assert rows(got, "column_name", "change") == [("extra", "added"), ("id", "kept"), ("label", "dropped")]


def catalogs(spark):
    current = spark.createDataFrame(
        [("t", "id", 1, "INTEGER"), ("t", "b", 2, "VARCHAR"), ("t", "gone", 3, "DATE"), ("u", "Name", 1, "VARCHAR"),
         ("v", "k", 1, "INTEGER"), ("v", "k2", 2, "INTEGER"), ("w", "mood", 1, "ENUM('Ok')")], CATALOG)
    planned = spark.createDataFrame(
        [("t", "id", 1, "INT"), ("t", "b", 2, "text"), ("t", "z", 3, "INT"), ("t", "a", 4, "INT"), ("u", "name", 1, "VARCHAR"),
         ("v", "k", 1, "INTEGER"), ("w", "mood", 1, "ENUM('ok')")], CATALOG)
    return planned, current


def test_column_changes_and_order(spark):
    planned, current = catalogs(spark)
    changes = shapes.column_changes(planned, current)
    assert rows(changes, "table_name", "column_name", "change") == [
        ("t", "a", "added"), ("t", "b", "kept"), ("t", "gone", "dropped"), ("t", "id", "kept"), ("t", "z", "added"),
        ("u", "Name", "type_changed"), ("u", "name", "type_changed"), ("v", "k", "kept"), ("v", "k2", "dropped"),
        ("w", "mood", "type_changed"),
    ]
    by_name = shapes.order_after_change(changes, current).filter("table_name = 't'")
    assert [r["column_name"] for r in by_name.orderBy("position").collect()] == ["id", "b", "a", "z"]
    configured = shapes.order_after_change(changes, current, planned).filter("table_name = 't'")
    assert [r["column_name"] for r in configured.orderBy("position").collect()] == ["id", "b", "z", "a"]


def test_rebuild_reasons(spark):
    planned, current = catalogs(spark)
    changes = shapes.column_changes(planned, current)
    contracts = spark.createDataFrame(
        [("t", None, ["id"], ["id", "b", "z", "a"]), ("u", None, None, None), ("v", None, ["k2"], None), ("w", ["mood"], None, None)],
        "table_name string, planned_key array<string>, current_key array<string>, planned_order array<string>",
    )
    assert rows(shapes.needs_rebuild(changes, current, contracts)) == [
        ("t", [], False), ("u", ["type_changed"], True), ("v", ["key_dropped"], True), ("w", ["type_changed"], True),
    ]
    keyed = contracts.withColumn("current_key", F.array(F.lit("id")))
    assert rows(shapes.needs_rebuild(changes, current, keyed.filter("table_name = 'w'")), "reasons") == [(["type_changed", "key_changed"],)]
    unknown = current.filter("table_name <> 't'")
    added = shapes.column_changes(planned, unknown)
    ordered = contracts.filter("table_name = 't'").selectExpr("table_name", "planned_key", "current_key", "array('z') AS planned_order")
    assert rows(shapes.needs_rebuild(added, unknown, ordered), "reasons") == [([],)]
    moved = contracts.filter("table_name = 't'").selectExpr("table_name", "planned_key", "current_key", "array('b', 'id', 'z', 'a') AS planned_order")
    assert rows(shapes.needs_rebuild(changes, current, moved), "reasons") == [(["order_changed"],)]


def test_catalog_match_prefers_the_exact_spelling(spark):
    catalog = spark.createDataFrame([("Orders", 1), ("ORDERS", 2), ("Äpfel", 3)], "name string, n int")
    names = spark.createDataFrame([("ORDERS",), ("orders",), ("äpfel",)], "name string")
    assert rows(drift.match_catalog(catalog, names, ["name"]), "name", "n", "is_exact") == [("ORDERS", 2, True), ("orders", 2, False)]


def test_definition_drift(spark):
    stored = spark.createDataFrame([("a", " SELECT 1\n"), ("b", "SELECT 2"), ("c", "x"), ("n", None)], "name string, definition string")
    live = spark.createDataFrame([("a", "SELECT 1"), ("b", "SELECT 3"), ("d", "y"), ("n", None)], "name string, definition string")
    assert rows(drift.definition_drift(stored, live, ["name"])) == [
        ("a", "same"), ("b", "changed"), ("c", "missing"), ("d", "unmanaged"), ("n", "same"),
    ]


def test_identities(spark):
    schema = "address string, id string, created_ts string, version int"
    before = spark.createDataFrame([("a", "1", None, 1), ("b", "1", "t", 1), ("s", "1", "t", 1), ("d", "1", "t", 1), ("x", "1", "t", 1)], schema)
    after = spark.createDataFrame([("a", "1", None, 2), ("b", "2", None, 1), ("s", "2", "t", 1), ("d", "2", "t", 1), ("y", "1", "t", 1)], schema)
    changes = spark.createDataFrame(
        [("s", "snapshot", ["update"], "old", "new"), ("d", "table", ["delete", "create"], None, None), ("b", "table", ["no-op"], "n", "m")],
        "address string, kind string, actions array<string>, before_name string, after_name string",
    )
    assert rows(drift.identity_drift(before, after, changes)) == [("b", ["id", "created_ts"])]
    assert rows(drift.classify_actions(changes), "address", "action") == [("b", "no-op"), ("d", "replace"), ("s", "update")]
    assert rows(drift.is_noop(changes)) == [(False,)]
    assert rows(drift.is_noop(changes.filter("address = 'b'"))) == rows(drift.is_noop(changes.filter("false"))) == [(True,)]


def test_table_diff(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1), (None, "n", 1)], "k int, s string, n int")
    new = spark.createDataFrame([(1, "a", None), (2, "B", None), (4, "d", 1), (None, "n", 2)], "k int, s string, n int")
    assert rows(drift.table_diff(old, new, ["k"])) == [
        (2, "changed", ["s", "n"]), (3, "removed", []), (4, "added", []), (None, "changed", ["n"]),
    ]
    assert drift.table_diff(old, old, ["k"]).count() == 0


def test_leftovers(spark):
    objects = spark.createDataFrame([("share", "tf_b"), ("share", "tf_a"), ("share", "tfx"), ("database", "prod")], "kind string, name string")
    assert rows(drift.leftovers(objects, "tf_", part_size=9), "kind", "names") == [("database", ""), ("share", "tf_a, tf_b")]


def test_snapshot_life(spark, folder):
    store, live = SnapshotStore(spark, f"{folder}/s"), VersionedTable(spark, f"{folder}/t")
    live.replace(spark.range(3))
    first = store.take(live.read(), "Sales", "v1")
    live.replace(spark.range(9))
    assert store.read("sales", "v1").count() == 3
    with pytest.raises(ValueError, match="already"):
        store.take(live.read(), "sales", "v1")
    store.rename(first, "v0")
    assert store.read("sales", "v0").count() == store.read("sales", snapshot_id=first).count() == 3
    assert store.restore("sales", "v0", live).count() == 3 and live.version() == 3
    store.rename(first, "")
    with pytest.raises(LookupError):
        store.read("sales", "v0")


STORED = "database_name string, snapshot_id string, snapshot_name string, created_ts timestamp"


def test_snapshot_states(spark):
    old = dt.datetime(2026, 1, 1)
    catalog = spark.createDataFrame(
        [("Db", "1", "n1", old), ("db", "2", "twice", old), ("db", "3", "twice", old), ("db", "4", "", old), ("lost", "5", "n5", old), ("db", "6", None, old)],
        STORED,
    )
    wanted = spark.createDataFrame(
        [("DB", "1", "other"), ("db", None, "n1"), ("db", "9", "twice"), ("db", "4", "n1"), ("db", "6", "n1"), ("lost", "5", None), ("db", "9", "none"), ("db", "5", "none")],
        "database_name string, snapshot_id string, snapshot_name string",
    )
    live = spark.createDataFrame([("dB",)], "database_name string")
    got = {(r["database_name"], r["snapshot_id"], r["snapshot_name"]): r["status"] for r in snapshots.snapshot_status(wanted, catalog, live).collect()}
    assert got == {
        ("DB", "1", "other"): "found", ("db", None, "n1"): "found", ("db", "9", "twice"): "ambiguous", ("db", "4", "n1"): "cleared",
        ("db", "6", "n1"): "cleared", ("lost", "5", None): "retained_without_database", ("db", "9", "none"): "unlisted", ("db", "5", "none"): "unlisted",
    }
    with pytest.raises(ValueError, match="several"):
        snapshots.resolve_snapshot(catalog, "db", name="twice")


def test_expired_history_keeps_named_snapshots(spark):
    day = lambda n: dt.datetime(2026, 1, n)
    catalog = spark.createDataFrame(
        [("db", "1", "", day(1)), ("db", "2", None, day(5)), ("db", "3", "kept", day(1)), ("forever", "4", "", day(1)), ("none", "5", "", day(7))], STORED
    )
    databases = spark.createDataFrame([("DB", "7 days"), ("forever", None), ("none", "00:00:00")], "database_name string, historical_snapshot_retention string")
    as_of = dt.datetime(2026, 1, 10, tzinfo=dt.timezone.utc)
    assert rows(snapshots.expired_snapshots(catalog, databases, as_of), "snapshot_id") == [("1",), ("5",)]


def test_diff_by_range_joins_only_what_differs(spark):
    old = spark.range(20_000).selectExpr("id AS k", "id % 7 AS a", "CASE WHEN id % 3 = 0 THEN 'x' END AS b")
    new = old.filter("k <> 11").withColumn("a", F.when(F.col("k") == 500, None).otherwise(F.col("a"))).unionByName(
        spark.sql("SELECT 20001L AS k, 1L AS a, 'y' AS b"))
    assert rows(drift.table_diff_by_range(old, new, ["k"])) == rows(drift.table_diff(old, new, ["k"]))
    assert len(drift.differing_ranges(old, new, ["k"])) == 3
    one = old.withColumn("b", F.when(F.col("k") == 77, "z").otherwise(F.col("b")))
    (only,) = drift.differing_ranges(old, one, ["k"], 64)
    kept = drift.table_diff_by_range(old, one, ["k"], 64)
    assert rows(kept) == [(77, "changed", ["b"])]
    assert str(only) in kept._jdf.queryExecution().optimizedPlan().toString()
    assert drift.differing_ranges(old, old, ["k"]) == [] and drift.table_diff_by_range(old, old, ["k"]).count() == 0


def test_swapped_nulls_are_a_difference(spark):
    old = spark.createDataFrame([(1, None, 5), (2, 5, None), (3, None, None)], "k int, a int, b int")
    new = spark.createDataFrame([(1, 5, None), (2, None, 5), (3, None, None)], "k int, a int, b int")
    assert rows(drift.table_diff_by_range(old, new, ["k"], 1)) == [(1, "changed", ["a", "b"]), (2, "changed", ["a", "b"])]
