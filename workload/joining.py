"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.operators import joins
from tallyhouse.operators.drift import table_diff
from tallyhouse.operators.roles import role_closure
from tallyhouse.operators.sets import differences
from workload.registry import query
from workload.relations import (
    CLOSURE,
    GRANTS,
    READERS,
    RUNS,
    TENANT_FACTS,
    WANTED_GRANTS,
    grants,
    joined,
    readers,
    role_edges,
    runs,
    stamp,
    stamp_sql,
    table,
    tenant_facts,
    text,
    wanted_grants,
)


@query(
    "j1_entitled_rows",
    f"""SELECT f.tenant_id, f.event_id, CAST(f.amount AS DOUBLE) AS amount FROM {TENANT_FACTS} AS f
    JOIN {READERS} AS r ON r.tenant_id = f.tenant_id WHERE r.reader_name = 'svc_8'""",
)
def entitled_rows(spark, sf):
    rows = joins.entitled_rows(tenant_facts(spark, sf), readers(spark, sf), "svc_8")
    return rows.select("tenant_id", "event_id", F.col("amount").cast("double").alias("amount"))


@query(
    "j1_entitled_once",
    f"""SELECT f.tenant_id, f.event_id FROM {TENANT_FACTS} AS f
    WHERE f.tenant_id IN (SELECT tenant_id FROM {READERS} WHERE reader_name = 'svc_8')""",
)
def entitled_once(spark, sf):
    """A doubled entitlement must not double the facts."""
    doubled = readers(spark, sf).unionByName(readers(spark, sf))
    return joins.entitled_rows(tenant_facts(spark, sf), doubled, "svc_8", once=True).select("tenant_id", "event_id")


@query(
    "j2_customer_event_summary",
    f"""SELECT c.c_custkey AS customer_id, c.c_name AS email, count(e.o_orderkey) AS event_count,
    CAST(coalesce(sum(CAST(e.o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_amount, {stamp_sql('max(e.o_orderdate)')} AS last_event_ts
    FROM customer AS c LEFT JOIN orders AS e ON c.c_custkey = e.o_custkey GROUP BY ALL""",
)
def customer_event_summary(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("email"))
    events = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("event_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderdate").alias("event_ts"),
    )
    return joins.customer_event_summary(customers, events).withColumns(
        {"total_amount": F.col("total_amount").cast("double"), "last_event_ts": stamp("last_event_ts")}
    )


@query(
    "j3_anti_both_ways",
    """SELECT coalesce(a.k, b.k) AS custkey, CASE WHEN a.k IS NULL THEN 'unexpected' ELSE 'missing' END AS status
    FROM (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 5000) AS a
    FULL OUTER JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 400000) AS b ON a.k = b.k
    WHERE a.k IS NULL OR b.k IS NULL""",
)
def anti_both_ways(spark, sf):
    rich = table(spark, sf, "customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("custkey"))
    big = table(spark, sf, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("custkey"))
    return differences(rich, big, ["custkey"]).filter("status <> 'matched'")


@query(
    "j4_grant_exists",
    f"""SELECT share_name, grantee_type, grantee_name, privilege FROM {WANTED_GRANTS} AS w
    WHERE EXISTS (SELECT 1 FROM {GRANTS} AS g WHERE lower(g.share_name) = lower(w.share_name) AND lower(g.grantee_type) = lower(w.grantee_type)
        AND lower(g.grantee_name) = lower(w.grantee_name) AND lower(g.privilege) = lower(w.privilege))""",
)
def grant_exists(spark, sf):
    keys = ["share_name", "grantee_type", "grantee_name", "privilege"]
    return joins.grant_exists(wanted_grants(spark, sf), grants(spark, sf), keys)


@query(
    "j5_full_outer_null_safe",
    """SELECT coalesce(a.c_custkey, b.s_suppkey) AS id, CASE WHEN a.c_custkey IS NULL THEN 'added' WHEN b.s_suppkey IS NULL THEN 'removed'
    ELSE 'changed' END AS status, CASE WHEN a.c_custkey IS NOT NULL AND b.s_suppkey IS NOT NULL THEN concat_ws(',',
    CASE WHEN a.c_nationkey IS DISTINCT FROM b.s_nationkey THEN 'nation' END, CASE WHEN a.b IS DISTINCT FROM b.b THEN 'balance' END) ELSE '' END AS changed
    FROM (SELECT *, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS b FROM customer) AS a
    FULL OUTER JOIN (SELECT *, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS b FROM supplier) AS b ON a.c_custkey = b.s_suppkey
    WHERE a.c_custkey IS NULL OR b.s_suppkey IS NULL OR a.c_nationkey IS DISTINCT FROM b.s_nationkey OR a.b IS DISTINCT FROM b.b""",
)
def full_outer_null_safe(spark, sf):
    """Customers and suppliers of the same number; null balances are equal."""
    left = table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "c_nationkey AS nation", "CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance"
    )
    right = table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS id", "s_nationkey AS nation", "CASE WHEN s_acctbal > 0 THEN s_acctbal END AS balance"
    )
    return table_diff(left, right, ["id"]).select("id", "status", joined("changed_columns").alias("changed"))


@query(
    "j6_matching_patterns",
    """SELECT DISTINCT p.share_name, t.schema_name, t.table_name FROM (SELECT DISTINCT lang AS schema_name, source AS table_name FROM documents) AS t
    JOIN (SELECT DISTINCT 'share_' || (doc_id % 50) AS share_name, CASE WHEN doc_id % 10 = 0 THEN lang ELSE lang || '.' || source END AS pattern FROM documents) AS p
    ON p.pattern = t.schema_name OR p.pattern = t.schema_name || '.' || t.table_name""",
)
def matching_patterns(spark, sf):
    docs = table(spark, sf, "documents")
    tables = docs.select(F.col("lang").alias("schema_name"), F.col("source").alias("table_name")).distinct()
    pattern = F.when(F.col("doc_id") % 10 == 0, F.col("lang")).otherwise(F.concat_ws(".", "lang", "source"))
    patterns = docs.select(
        F.concat(F.lit("share_"), text(F.col("doc_id") % 50)).alias("share_name"), pattern.alias("pattern")
    ).distinct()
    return joins.matching_patterns(tables, patterns)


@query(
    "j7_gate_on_success",
    f"""SELECT c_custkey AS job_id, c_name FROM customer WHERE c_custkey IN (SELECT job_id FROM (SELECT *, row_number() OVER
    (PARTITION BY job_id ORDER BY run_number DESC) AS rn FROM {RUNS}) WHERE rn = 1 AND status = 'RUN_STATUS_SUCCEEDED')""",
)
def gate_on_success(spark, sf):
    jobs = table(spark, sf, "customer").select(F.col("c_custkey").alias("job_id"), "c_name")
    return joins.gate_on_success(jobs, runs(spark, sf))


@query(
    "j8_recursive_join",
    f"{CLOSURE} SELECT member_name AS role, role_name AS holds, is_direct FROM closure WHERE member_type = 'role'",
)
def recursive_join(spark, sf):
    """The role graph alone, cycle included."""
    closure = role_closure(role_edges(spark, sf).filter("member_type = 'role'"))
    return closure.select(F.col("member_name").alias("role"), F.col("role_name").alias("holds"), "is_direct")
