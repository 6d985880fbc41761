"""Contracts, schema changes, state comparison and snapshots."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators import checks, drift, shapes, snapshots as snaps
from tallyhouse.plans.table_change import change_table
from tallyhouse.plans.warehouse import version_diff
from tallyhouse.settings import scratch_path
from tallyhouse.sources.snapshots import SnapshotStore
from tallyhouse.sources.tables import VersionedTable, merge_into
from workload.registry import query
from workload.relations import (
    CURRENT_COLUMNS,
    PLANNED_COLUMNS,
    SNAPSHOTS,
    columns,
    joined,
    orders,
    snapshots,
    stamp,
    stamp_sql,
    table,
    text,
)

CANONICAL = """CASE upper({t}) WHEN 'INT' THEN 'INTEGER' WHEN 'VARCHAR(10)' THEN 'VARCHAR' WHEN 'TEXT' THEN 'VARCHAR'
    WHEN 'DECIMAL(10, 2)' THEN 'DECIMAL(10,2)' WHEN 'NUMERIC(10,2)' THEN 'DECIMAL(10,2)' WHEN 'REAL' THEN 'FLOAT' ELSE upper({t}) END"""
CHANGES = f"""(WITH c AS (SELECT coalesce(p.table_name, q.table_name) AS table_name, coalesce(p.column_name, q.column_name) AS column_name,
    p.data_type AS planned_type, q.data_type AS current_type, CASE WHEN q.data_type IS NULL THEN 'added' WHEN p.data_type IS NULL THEN 'dropped'
    WHEN {CANONICAL.format(t='p.data_type')} = {CANONICAL.format(t='q.data_type')} THEN 'kept' ELSE 'type_changed' END AS change
    FROM {PLANNED_COLUMNS} AS p FULL OUTER JOIN {CURRENT_COLUMNS} AS q ON p.table_name = q.table_name AND p.column_name = q.column_name),
    x AS (SELECT *, bool_or(change = 'added') OVER w AND bool_or(change = 'dropped') OVER w AS case_clash FROM c WINDOW w AS (PARTITION BY table_name, lower(column_name)))
    SELECT table_name, column_name, planned_type, current_type, CASE WHEN case_clash THEN 'type_changed' ELSE change END AS change, case_clash FROM x)"""


def changes(spark, sf):
    return shapes.column_changes(columns(spark, sf, True), columns(spark, sf, False))


@query("c2_column_changes", f"SELECT * FROM {CHANGES}")
def column_changes(spark, sf):
    return changes(spark, sf)


@query(
    "c3_order_after_change",
    f"""SELECT c.table_name, c.column_name, CAST(row_number() OVER (PARTITION BY c.table_name ORDER BY q.position NULLS LAST, c.column_name) AS INTEGER) AS position
    FROM {CHANGES} AS c LEFT JOIN {CURRENT_COLUMNS} AS q ON q.table_name = c.table_name AND q.column_name = c.column_name WHERE c.planned_type IS NOT NULL""",
)
def order_after_change(spark, sf):
    return shapes.order_after_change(changes(spark, sf), columns(spark, sf, False))


@query(
    "c5_needs_rebuild",
    f"""SELECT table_name, concat_ws(',', CASE WHEN bool_or(change = 'type_changed') THEN 'type_changed' END,
    CASE WHEN bool_or(planned_type IS NULL AND column_name = 'col_1') THEN 'key_dropped' END) AS reasons,
    bool_or(change = 'type_changed') OR bool_or(planned_type IS NULL AND column_name = 'col_1') AS needs_rebuild FROM {CHANGES} GROUP BY table_name""",
)
def needs_rebuild(spark, sf):
    """Tables keyed by their first column; key and order stay as they are."""
    named = [columns(spark, sf, planned).select("table_name") for planned in (True, False)]
    contracts = named[0].unionByName(named[1]).distinct().select(
        "table_name",
        F.lit(None).cast("array<string>").alias("planned_key"),
        F.array(F.lit("col_1")).alias("current_key"),
        F.lit(None).cast("array<string>").alias("planned_order"),
    )
    rows = shapes.needs_rebuild(changes(spark, sf), columns(spark, sf, False), contracts)
    return rows.withColumn("reasons", joined("reasons"))


@query(
    "c5_key_changed",
    f"""SELECT table_name, concat_ws(',', CASE WHEN bool_or(change = 'type_changed') THEN 'type_changed' END,
    CASE WHEN bool_or(planned_type IS NULL AND column_name = 'col_1') THEN 'key_dropped' END,
    CASE WHEN CAST(substr(table_name, 2) AS INTEGER) % 3 = 1 THEN 'key_changed' END) AS reasons,
    bool_or(change = 'type_changed') OR bool_or(planned_type IS NULL AND column_name = 'col_1') OR CAST(substr(table_name, 2) AS INTEGER) % 3 = 1 AS needs_rebuild
    FROM {CHANGES} GROUP BY table_name""",
)
def key_changed(spark, sf):
    """Tables keyed by their first column, a third of which are to have a further key column; a third plan the key they have."""
    named = [columns(spark, sf, planned).select("table_name") for planned in (True, False)]
    third = F.substring("table_name", 2, 9).cast("int") % 3
    contracts = named[0].unionByName(named[1]).distinct().select(
        "table_name",
        F.when(third == 0, F.array(F.lit("col_1"))).when(third == 1, F.array(F.lit("col_1"), F.lit("col_2"))).alias("planned_key"),
        F.array(F.lit("col_1")).alias("current_key"),
        F.lit(None).cast("array<string>").alias("planned_order"),
    )
    rows = shapes.needs_rebuild(changes(spark, sf), columns(spark, sf, False), contracts)
    return rows.withColumn("reasons", joined("reasons"))


@query(
    "c4_evolve",
    "SELECT c_custkey AS id, c_acctbal AS balance, CAST(NULL AS BOOLEAN) AS active, CAST(NULL AS DOUBLE) AS amount FROM customer",
)
def evolve(spark, sf):
    """Customers rewritten with two columns more and one column less."""
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("label"), F.col("c_acctbal").alias("balance")
    )
    target = VersionedTable(spark, scratch_path(spark, "evolve"))
    target.replace(rows)
    planned = T.StructType.fromDDL("id bigint, balance double, amount double, active boolean")
    return change_table(target, planned, key=["id"], not_null=["id"])


@query(
    "c1_column_catalog",
    """SELECT c.table_name, c.column_name, c.position, c.key_position, n.row_count FROM (SELECT 'region' AS table_name, unnest(['r_regionkey', 'r_name']) AS column_name,
    unnest([1, 2]) AS position, unnest([1, NULL]) AS key_position UNION ALL SELECT 'nation', unnest(['n_nationkey', 'n_name', 'n_regionkey']),
    unnest([1, 2, 3]), unnest([1, NULL, NULL]) UNION ALL SELECT 'customer', unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']),
    unnest([1, 2, 3, 4, 5]), unnest([1, NULL, NULL, NULL, NULL])) AS c
    JOIN (SELECT 'region' AS table_name, count(*) AS row_count FROM region UNION ALL SELECT 'nation', count(*) FROM nation
    UNION ALL SELECT 'customer', count(*) FROM customer) AS n ON n.table_name = c.table_name""",
)
def column_catalog(spark, sf):
    """Columns of three tables beside the row count of each."""
    tables = {name: table(spark, sf, name) for name in ("region", "nation", "customer")}
    keys = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"]}
    counts = [df.agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(n)) for n, df in tables.items()]
    rows = shapes.column_catalog(spark, tables, keys).select("table_name", "column_name", "position", "key_position")
    return rows.join(counts[0].unionByName(counts[1]).unionByName(counts[2]), "table_name")


#: The columns of all given tables, and the key of each.
GIVEN = {
    "region": ("r_regionkey int, r_name string", "r_regionkey"),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", "n_nationkey"),
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", "c_custkey"),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", "s_suppkey"),
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", "p_partkey"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string", "o_orderkey"),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz", "l_orderkey l_linenumber"),
    "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string", "event_id"),
    "documents": ("doc_id bigint, text string, lang string, source string, n_chars bigint", "doc_id"),
    "embeddings": ("vec_id bigint, embedding array<float>, label int", "vec_id"),
    "pages": ("page_id bigint, url string, html string", "page_id"),
    "benchmark": ("item_id bigint, text string", "item_id"),
    "labels": ("doc_id bigint, quality int, toxic int", "doc_id"),
    "conversations": ("conv_id bigint, turn bigint, role string, text string", "conv_id turn"),
}


def given_sql() -> str:
    rows = []
    for name, (columns, key) in GIVEN.items():
        for position, (column, kind) in enumerate((c.split() for c in columns.split(", ")), start=1):
            place = key.split().index(column) + 1 if column in key.split() else "NULL"
            rows.append(f"('{name}', '{column}', {position}, '{kind}', true, {place})")
    counts = " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in GIVEN)
    return f"""SELECT c.*, n.row_count FROM (VALUES {", ".join(rows)}) AS c(table_name, column_name, position, data_type, nullable, key_position)
    JOIN ({counts}) AS n ON n.table_name = c.table_name"""


@query("c1_column_catalog_all", given_sql())
def column_catalog_all(spark, sf):
    """Columns of all given tables with type, nullability and key, beside the row count of each table."""
    tables = {name: table(spark, sf, name) for name in GIVEN}
    counts = [df.agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(n)) for n, df in tables.items()]
    rows = shapes.column_catalog(spark, tables, {name: key.split() for name, (_, key) in GIVEN.items()})
    return rows.join(reduce(DataFrame.unionByName, counts), "table_name")


@query(
    "c6_not_null_violations",
    """SELECT 'user_id' AS column_name, count(*) FILTER (WHERE user_id IS NULL) AS violations FROM events
    UNION ALL SELECT 'score', count(*) FILTER (WHERE value > 100) FROM events""",
)
def not_null_violations(spark, sf):
    rows = table(spark, sf, "events").withColumn("score", F.when(F.col("value") <= 100, F.col("value")))
    return checks.not_null_violations(rows, ["user_id", "score"])


@query(
    "c7_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_keys(spark, sf):
    return checks.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("c8_enum_violations", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'o')")
def enum_violations(spark, sf):
    return checks.enum_violations(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "o"])


@query(
    "c9_run_checks",
    """SELECT *, failures = 0 AS passed FROM (SELECT 'not_null:l_orderkey' AS check_name, count(*) FILTER (WHERE l_orderkey IS NULL) AS failures FROM lineitem
    UNION ALL SELECT 'accepted:l_returnflag', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'R')) FROM lineitem
    UNION ALL SELECT 'unique:l_orderkey,l_linenumber', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))""",
)
def run_checks(spark, sf):
    return checks.run_checks(
        table(spark, sf, "lineitem"),
        not_null=["l_orderkey"],
        unique=[["l_orderkey", "l_linenumber"]],
        accepted={"l_returnflag": ["A", "R"]},
    )


@query("c10_rebuild_model", "SELECT 'evolved' AS model_revision, p_partkey, p_brand FROM part")
def rebuild_model(spark, sf):
    model = VersionedTable(spark, scratch_path(spark, "model"))
    rows = table(spark, sf, "part").select("p_partkey", "p_brand")
    model.replace(rows)
    evolved = shapes.rebuild_model(model.read(), {"model_revision": "evolved"})
    return model.read(model.commit(model.stage(evolved), evolved.schema, "rebuild"))


SPELLED = """(SELECT 'Table_' || (p_partkey // 2) AS name, p_partkey FROM part WHERE p_partkey % 2 = 0
    UNION ALL SELECT 'TABLE_' || (p_partkey // 2), p_partkey FROM part WHERE p_partkey % 2 = 1 AND p_partkey % 3 <> 0)"""


@query(
    "c11_match_catalog",
    f"""SELECT w.name, c.name AS found_name, c.p_partkey, c.name = w.name AS is_exact FROM (SELECT DISTINCT 'TABLE_' || (p_partkey // 2) AS name FROM part) AS w
    JOIN {SPELLED} AS c ON lower(c.name) = lower(w.name) QUALIFY row_number() OVER (PARTITION BY w.name ORDER BY c.name = w.name DESC, c.name) = 1""",
)
def match_catalog(spark, sf):
    key = F.col("p_partkey")
    half = text(((key - key % 2) / 2).cast("bigint"))
    parts = table(spark, sf, "part")
    mixed = parts.filter(key % 2 == 0).select(F.concat(F.lit("Table_"), half).alias("name"), "p_partkey")
    upper = parts.filter((key % 2 == 1) & (key % 3 != 0)).select(F.concat(F.lit("TABLE_"), half).alias("name"), "p_partkey")
    wanted = parts.select(F.concat(F.lit("TABLE_"), half).alias("name")).distinct()
    return drift.match_catalog(mixed.unionByName(upper), wanted, ["name"])


@query(
    "c12_definition_drift",
    """SELECT coalesce(s.id, l.id) AS id, CASE WHEN l.id IS NULL THEN 'missing' WHEN s.id IS NULL THEN 'unmanaged'
    WHEN s.d = l.d THEN 'same' ELSE 'changed' END AS status
    FROM (SELECT doc_id AS id, 'SELECT ' || source AS d FROM documents WHERE doc_id % 5 <> 0) AS s
    FULL OUTER JOIN (SELECT doc_id AS id, 'SELECT ' || CASE WHEN doc_id % 3 = 0 THEN lang ELSE source END AS d FROM documents WHERE doc_id % 7 <> 0) AS l ON s.id = l.id""",
)
def definition_drift(spark, sf):
    docs, key = table(spark, sf, "documents"), F.col("doc_id")
    stored = docs.filter(key % 5 != 0).select(key.alias("id"), F.concat(F.lit("  SELECT "), "source", F.lit("\n")).alias("definition"))
    body = F.when(key % 3 == 0, F.col("lang")).otherwise(F.col("source"))
    live = docs.filter(key % 7 != 0).select(key.alias("id"), F.concat(F.lit("SELECT "), body).alias("definition"))
    return drift.definition_drift(stored, live, ["id"])


def plan_rows(spark, sf):
    """Planned changes: an object per customer with its actions and names."""
    key = F.col("c_custkey")
    actions = (
        F.when(key % 6 == 0, F.array(F.lit("delete"), F.lit("create")))
        .when(key % 6 == 1, F.array(F.lit("update")))
        .when(key % 6 == 2, F.array(F.lit("create")))
        .when(key % 6 == 3, F.array(F.lit("delete")))
        .otherwise(F.array(F.lit("no-op")))
    )
    return table(spark, sf, "customer").select(
        F.concat(F.lit("obj."), text(key)).alias("address"),
        F.when(key % 2 == 0, "snapshot").otherwise("table").alias("kind"),
        actions.alias("actions"),
        F.lit("a").alias("before_name"),
        F.when(key % 10 == 0, "b").otherwise("a").alias("after_name"),
    )


@query(
    "c13_identity_drift",
    """SELECT 'obj.' || c_custkey AS address, concat_ws(',', CASE WHEN c_custkey % 4 = 0 THEN 'id' END, CASE WHEN c_custkey % 5 = 0 THEN 'created_ts' END) AS changed_fields
    FROM customer WHERE (c_custkey % 4 = 0 OR c_custkey % 5 = 0) AND c_custkey % 6 NOT IN (0, 3) AND NOT (c_custkey % 2 = 0 AND c_custkey % 10 = 0)""",
)
def identity_drift(spark, sf):
    key = F.col("c_custkey")
    base = table(spark, sf, "customer").select(
        F.concat(F.lit("obj."), text(key)).alias("address"), key, text(key).alias("id"),
        F.when(key % 3 != 0, F.col("c_name")).alias("created_ts"), F.lit(1).alias("version"),
    )
    after = base.withColumns(
        {
            "id": F.when(key % 4 == 0, F.lit("new")).otherwise(F.col("id")),
            "created_ts": F.when(key % 5 == 0, F.lit("later")).otherwise(F.col("created_ts")),
            "version": F.lit(2),
        }
    )
    rows = drift.identity_drift(base.drop("c_custkey"), after.drop("c_custkey"), plan_rows(spark, sf))
    return rows.withColumn("changed_fields", joined("changed_fields"))


@query(
    "c14_classify_actions",
    """SELECT 'obj.' || c_custkey AS address, CASE c_custkey % 6 WHEN 0 THEN 'replace' WHEN 1 THEN 'update' WHEN 2 THEN 'create' WHEN 3 THEN 'delete'
    ELSE 'no-op' END AS action, c_custkey % 6 = 0 AS is_replacement FROM customer""",
)
def classify_actions(spark, sf):
    return drift.classify_actions(plan_rows(spark, sf))


@query("c14_is_noop", "SELECT coalesce(bool_and(c_custkey % 6 IN (4, 5)), true) AS is_noop FROM customer")
def is_noop(spark, sf):
    return drift.is_noop(plan_rows(spark, sf))


@query(
    "c15_table_diff",
    """SELECT coalesce(a.k, b.k) AS order_id, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'changed' END AS status,
    CASE WHEN a.k IS NULL OR b.k IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.c IS DISTINCT FROM b.c THEN 'customer_id' END,
    CASE WHEN a.s IS DISTINCT FROM b.s THEN 'status' END) END AS changed_columns
    FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s FROM orders WHERE o_orderkey % 10 <> 1) AS a
    FULL OUTER JOIN (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 <> 3 THEN o_custkey END AS c, CASE WHEN o_orderkey % 10 = 2 THEN 'X' ELSE o_orderstatus END AS s
    FROM orders WHERE o_orderkey % 10 <> 0) AS b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.c IS DISTINCT FROM b.c OR a.s IS DISTINCT FROM b.s""",
)
def table_diff(spark, sf):
    rows, last = orders(spark, sf).select("order_id", "customer_id", "status"), F.col("order_id") % 10
    new = rows.filter(last != 0).withColumns(
        {
            "customer_id": F.when(last != 3, F.col("customer_id")),
            "status": F.when(last == 2, "X").otherwise(F.col("status")),
        }
    )
    diff = drift.table_diff(rows.filter(last != 1), new, ["order_id"])
    return diff.withColumn("changed_columns", joined("changed_columns"))


@query(
    "c15_diff_by_range",
    """SELECT coalesce(a.k, b.k) AS order_id, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'changed' END AS status,
    CASE WHEN a.k IS NULL OR b.k IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.c IS DISTINCT FROM b.c THEN 'customer_id' END,
    CASE WHEN a.s IS DISTINCT FROM b.s THEN 'status' END) END AS changed_columns
    FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s FROM orders WHERE o_orderkey % 997 <> 1) AS a
    FULL OUTER JOIN (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 997 <> 3 THEN o_custkey END AS c, CASE WHEN o_orderkey % 997 = 2 THEN 'X' ELSE o_orderstatus END AS s
    FROM orders WHERE o_orderkey % 997 <> 0) AS b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.c IS DISTINCT FROM b.c OR a.s IS DISTINCT FROM b.s""",
)
def diff_by_range(spark, sf):
    """Two versions that differ in few rows: only the ranges of keys whose summaries differ are joined."""
    rows, last = orders(spark, sf).select("order_id", "customer_id", "status"), F.col("order_id") % 997
    new = rows.filter(last != 0).withColumns(
        {
            "customer_id": F.when(last != 3, F.col("customer_id")),
            "status": F.when(last == 2, "X").otherwise(F.col("status")),
        }
    )
    diff = drift.table_diff_by_range(rows.filter(last != 1), new, ["order_id"])
    return diff.withColumn("changed_columns", joined("changed_columns"))


@query(
    "c15_version_diff",
    """SELECT o_orderkey AS order_id, 'changed' AS status, 'status' AS changed_columns FROM orders WHERE o_orderkey % 1009 = 2 AND o_orderstatus <> 'X'
    UNION ALL SELECT -o_orderkey - 1, 'added', '' FROM orders WHERE o_orderkey % 1009 = 4""",
)
def version_diff_rows(spark, sf):
    """Two versions of a table laid out by key, a small merge apart; folders that both have are not read."""
    rows, last = orders(spark, sf).select("order_id", "customer_id", "status"), F.col("order_id") % 1009
    versioned = VersionedTable(spark, scratch_path(spark, "versions"))
    merge_into(versioned, rows, ["order_id"])
    added = rows.filter(last == 4).withColumn("order_id", -F.col("order_id") - 1)
    merge_into(versioned, rows.filter(last == 2).withColumn("status", F.lit("X")).unionByName(added), ["order_id"])
    return version_diff(versioned, 1, 2, ["order_id"]).withColumn("changed_columns", joined("changed_columns"))


@query(
    "c16_leftovers",
    """WITH p AS (SELECT 'kind_' || (p_partkey // 50) AS kind, p_brand || '/' || p_partkey AS name FROM part),
    n AS (SELECT *, (row_number() OVER (PARTITION BY kind ORDER BY name) - 1) // 4 AS part FROM p WHERE starts_with(name, 'Brand#2'))
    SELECT k.kind, coalesce(n.part, 0) AS part, coalesce(string_agg(n.name, ', ' ORDER BY n.name), '') AS names
    FROM (SELECT DISTINCT kind FROM p) AS k LEFT JOIN n ON n.kind = k.kind GROUP BY k.kind, n.part""",
)
def leftovers(spark, sf):
    key = F.col("p_partkey")
    kind = F.concat(F.lit("kind_"), text(((key - key % 50) / 50).cast("bigint")))
    rows = table(spark, sf, "part").select(kind.alias("kind"), F.concat("p_brand", F.lit("/"), text(key)).alias("name"))
    return drift.leftovers(rows, "Brand#2", part_size=4)


@query(
    "c17_slug_collisions",
    """SELECT slug, count(*) AS tenants FROM (SELECT DISTINCT page_id, regexp_replace(lower(split_part(url, '/', 3)), '[^a-z0-9_]', '_', 'g') AS slug FROM pages)
    GROUP BY slug HAVING count(*) > 1""",
)
def slug_collisions(spark, sf):
    rows = table(spark, sf, "pages").select(F.split_part("url", F.lit("/"), F.lit(3)).alias("slug"), F.col("page_id").alias("tenant_id"))
    return checks.slug_collisions(rows)


@query("n1_take_snapshot", "SELECT 'orders' AS database_name, 'nightly' AS snapshot_name, count(*) AS row_count FROM orders")
def take_snapshot(spark, sf):
    store = SnapshotStore(spark, scratch_path(spark, "snapshots"))
    store.take(orders(spark, sf), "orders", "nightly")
    rows = store.read("orders", "nightly").agg(F.count("*").alias("row_count"))
    return rows.withColumns({"database_name": F.lit("orders"), "snapshot_name": F.lit("nightly")})


# Requests by id and name; ids beyond the table are not listed.
WANTED = """(SELECT 'dB_' || (o_custkey % 40) AS database_name, CASE WHEN o_orderkey % 4 = 0 THEN 'gone' || o_orderkey ELSE 's' || o_orderkey END AS snapshot_id,
    'snap_' || (o_orderkey // 2) AS snapshot_name FROM orders)"""
LOOKUP = f"""(SELECT w.*, i.snapshot_name AS id_name, n.matches, n.name_id FROM {WANTED} AS w
    LEFT JOIN {SNAPSHOTS} AS i ON lower(i.database_name) = lower(w.database_name) AND i.snapshot_id = w.snapshot_id
    LEFT JOIN (SELECT lower(database_name) AS db, snapshot_name, count(*) AS matches, max(snapshot_id) AS name_id FROM {SNAPSHOTS}
    WHERE snapshot_name <> '' GROUP BY ALL) AS n ON n.db = lower(w.database_name) AND n.snapshot_name = w.snapshot_name)"""
STATE = """CASE WHEN id_name = '' THEN 'cleared' WHEN id_name IS NOT NULL THEN 'found' WHEN matches > 1 THEN 'ambiguous' WHEN matches = 1 THEN 'found' ELSE 'unlisted' END"""


def wanted_snapshots(spark, sf):
    key = F.col("o_orderkey")
    half = text(((key - key % 2) / 2).cast("bigint"))
    return table(spark, sf, "orders").select(
        F.concat(F.lit("dB_"), text(F.col("o_custkey") % 40)).alias("database_name"),
        F.concat(F.when(key % 4 == 0, "gone").otherwise("s"), text(key)).alias("snapshot_id"),
        F.concat(F.lit("snap_"), half).alias("snapshot_name"),
    )


@query(
    "n2_resolve_snapshots",
    f"""SELECT database_name, snapshot_id, snapshot_name, {STATE} AS state,
    CASE WHEN {STATE} = 'found' THEN CASE WHEN id_name IS NOT NULL THEN snapshot_id ELSE name_id END END AS resolved_id FROM {LOOKUP}""",
)
def resolve_snapshots(spark, sf):
    return snaps.resolve_snapshots(snapshots(spark, sf), wanted_snapshots(spark, sf))


@query(
    "n3_snapshot_status",
    f"""SELECT database_name, snapshot_id, snapshot_name, CASE WHEN {STATE} = 'found' AND lower(database_name) NOT IN
    (SELECT DISTINCT 'db_' || o_custkey FROM orders WHERE o_custkey < 30) THEN 'retained_without_database' ELSE {STATE} END AS status FROM {LOOKUP}""",
)
def snapshot_status(spark, sf):
    live = table(spark, sf, "orders").filter("o_custkey < 30").select(F.concat(F.lit("DB_"), text("o_custkey")).alias("database_name"))
    return snaps.snapshot_status(wanted_snapshots(spark, sf), snapshots(spark, sf), live)


@query(
    "n4_rename_snapshot",
    f"SELECT database_name, snapshot_id, CASE WHEN snapshot_id = 's11' THEN 'release' WHEN snapshot_id = 's13' THEN '' ELSE snapshot_name END AS snapshot_name FROM {SNAPSHOTS}",
)
def rename_snapshot(spark, sf):
    renamed = snaps.rename_snapshot(snapshots(spark, sf), "s11", "release")
    return snaps.rename_snapshot(renamed, "s13", "").select("database_name", "snapshot_id", "snapshot_name")


@query("n5_read_snapshot", "SELECT o_orderkey AS order_id, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P'")
def read_snapshot(spark, sf):
    """A snapshot keeps its rows while the table grows."""
    root = scratch_path(spark, "as-of")
    live, store = VersionedTable(spark, f"{root}/live"), SnapshotStore(spark, f"{root}/snapshots")
    rows = orders(spark, sf).select("order_id", "status")
    live.replace(rows.filter("status <> 'P'"))
    store.take(live.read(), "Orders", "before")
    live.append(rows.filter("status = 'P'"))
    return store.read("orders", "before")


@query(
    "n6_expired_snapshots",
    f"""SELECT snapshot_id, {stamp_sql('created_ts')} AS created_ts FROM {SNAPSHOTS} AS s JOIN (SELECT 'db_' || k AS db, k % 5 * 200 AS days
    FROM (SELECT DISTINCT o_custkey % 40 AS k FROM orders) WHERE k % 5 <> 4) AS d ON d.db = lower(s.database_name)
    WHERE s.snapshot_name = '' AND s.created_ts < TIMESTAMP '2001-06-01 00:00:00' - to_days(CAST(d.days AS INTEGER))""",
)
def expired_snapshots(spark, sf):
    number = F.col("o_custkey") % 40
    kept = (
        F.when(number % 5 == 4, "infinite").when(number % 5 == 0, "00:00:00").otherwise(F.concat(text(number % 5 * 200), F.lit(" days")))
    )
    databases = table(spark, sf, "orders").select(
        F.concat(F.lit("DB_"), text(number)).alias("database_name"), kept.alias("historical_snapshot_retention")
    ).distinct()
    as_of = dt.datetime(2001, 6, 1, tzinfo=dt.timezone.utc)
    rows = snaps.expired_snapshots(snapshots(spark, sf), databases, as_of)
    return rows.select("snapshot_id", stamp("created_ts").alias("created_ts"))


@query("n7_restore", "SELECT o_orderkey AS order_id, o_orderstatus AS status FROM orders")
def restore(spark, sf):
    """A table emptied by mistake and restored from its snapshot."""
    root = scratch_path(spark, "restore")
    live, store = VersionedTable(spark, f"{root}/live"), SnapshotStore(spark, f"{root}/snapshots")
    live.replace(orders(spark, sf).select("order_id", "status"))
    store.take(live.read(), "orders", "full")
    live.replace(live.read().filter("false"))
    return store.restore("orders", "full", live)
