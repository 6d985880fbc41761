"""Projections, filters and predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyhouse.operators import filters
from tallyhouse.operators.aggregates import completed_orders
from workload.registry import query
from workload.relations import (
    AGENT_RUNS,
    DAILY_USAGE,
    ORDERS,
    agent_runs,
    daily_usage,
    orders,
    stamp,
    stamp_sql,
    table,
    text,
)


@query("p1_project", "SELECT c_custkey, c_name FROM customer")
def project(spark, sf):
    return filters.project(table(spark, sf, "customer"), ["c_custkey", "c_name"])


@query(
    "p2_typed_rows",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS database_type, CAST(o_custkey AS VARCHAR) AS owner,
    CAST(NULL AS VARCHAR) AS comment FROM orders""",
)
def typed_rows(spark, sf):
    return filters.typed_rows(
        table(spark, sf, "orders"),
        {"id": "o_orderkey", "database_type": "o_orderpriority", "owner": "o_custkey", "comment": None},
    )


@query(
    "p2_typed_values",
    """SELECT CAST(event_id AS VARCHAR) AS id, regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0+$', '') || 'Z' AS at, lower(hex(event_type)) AS raw,
    '["' || event_type || '",null]' AS tags, regexp_replace(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '\\.?0+$', '') AS amount FROM events""",
)
def typed_values(spark, sf):
    """Times, bytes, lists and decimals as text."""
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("at"),
        F.col("event_type").cast("binary").alias("raw"),
        F.array(F.col("event_type"), F.lit(None)).alias("tags"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
    )
    return filters.typed_rows(rows, {"id": None, "at": None, "raw": None, "tags": None, "amount": None})


@query(
    "p3_repository_metrics",
    "SELECT p_name || '/' || p_partkey AS repo, p_partkey AS stars, CAST(p_size AS BIGINT) AS forks, p_partkey + p_size AS engagement FROM part",
)
def repository_metrics(spark, sf):
    rows = table(spark, sf, "part").select(
        F.concat("p_name", F.lit("/"), text("p_partkey")).alias("repo"),
        F.col("p_partkey").alias("stars"),
        F.col("p_size").cast("bigint").alias("forks"),
    )
    return filters.repository_metrics(rows)


@query("p4_filter_name", "SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) = lower('Machinery')")
def filter_name(spark, sf):
    return filters.filter_name(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "Machinery")


@query("p5_filter_optional", "SELECT p_partkey, p_brand, p_type FROM part WHERE p_type = 'ECONOMY'")
def filter_optional(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    return filters.filter_optional(rows, p_type="ECONOMY", p_brand=None)


@query(
    "p6_usage_between",
    f"""SELECT CAST(usage_date AS VARCHAR) AS usage_date, CAST(event_count AS VARCHAR) AS event_count FROM {DAILY_USAGE}
    WHERE usage_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
)
def usage_between(spark, sf):
    return filters.usage_between(daily_usage(spark, sf), "2024-01-05", "2024-01-20")


@query("p7_recent_rows", "SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 7 DAY")
def recent_rows(spark, sf):
    as_of = dt.datetime(2024, 1, 30, 12, tzinfo=dt.timezone.utc)
    return filters.recent_rows(table(spark, sf, "events").select("event_id", "user_id", "ts"), "ts", as_of).drop("ts")


@query(
    "p8_quality_predicates",
    f"SELECT order_id, CAST(amount AS DOUBLE) AS amount FROM {ORDERS} WHERE status = 'F' AND amount >= 0 AND order_date IS NOT NULL",
)
def quality_predicates(spark, sf):
    rows = completed_orders(orders(spark, sf), "F")
    return rows.select("order_id", F.col("amount").cast("double").alias("amount"))


@query("p9_filter_prefix", "SELECT doc_id, source FROM documents WHERE 'tf_' || source LIKE 'tf\\_src1%' ESCAPE '\\'")
def filter_prefix(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source", F.concat(F.lit("tf_"), "source").alias("name"))
    return filters.filter_prefix(rows, "name", "tf_src1").drop("name")


@query(
    "p10_bridge_finish_time",
    f"""SELECT session_id, run_seq, {stamp_sql('end_time')} AS end_time, {stamp_sql('end_time')} AS run_finished_ts FROM {AGENT_RUNS}""",
)
def bridge_finish_time(spark, sf):
    """Rows of the older schema get both names of the finish time."""
    rows = filters.bridge_finish_time(agent_runs(spark, sf, "run_finished_ts"))
    return rows.select(
        "session_id", "run_seq", stamp("end_time").alias("end_time"), stamp("run_finished_ts").alias("run_finished_ts")
    )


@query("p11_filter_in", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def filter_in(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return filters.filter_in(rows, "o_orderpriority", ["1-URGENT", "5-LOW"])


@query(
    "p11_filter_in_table",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def filter_in_table(spark, sf):
    listed = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    return filters.filter_in(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", listed)


TOPICS = "(SELECT doc_id, lang || '/' || source || CASE WHEN doc_id % 2 = 0 THEN '/old' ELSE '' END AS topic FROM documents)"


@query("p12_topic_subtree", f"SELECT doc_id, topic FROM {TOPICS} WHERE topic = 'en/src1' OR starts_with(topic, 'en/src1/')")
def topic_subtree(spark, sf):
    tail = F.when(F.col("doc_id") % 2 == 0, "/old").otherwise("")
    rows = table(spark, sf, "documents").select("doc_id", F.concat("lang", F.lit("/"), "source", tail).alias("topic"))
    return filters.topic_subtree(rows, "en/src1")


@query(
    "p13_filter_by_reference",
    """SELECT doc_id FROM documents WHERE (lang = 'en' AND source = 'src3') OR (lang = 'en' AND 'src' || (doc_id % 20) = 'src3')""",
)
def filter_by_reference(spark, sf):
    """Documents that reference table ``src3`` of schema ``en``, in any of two references."""
    def reference(target):
        return F.struct(
            F.lit("catalog").alias("type"),
            F.lit("md:docs").alias("url"),
            F.col("lang").alias("schema"),
            target.alias("table"),
            F.lit(None).cast("string").alias("column"),
        )

    other = F.concat(F.lit("src"), text(F.col("doc_id") % 20))
    rows = table(spark, sf, "documents").select(
        "doc_id", F.array(reference(F.col("source")), reference(other)).alias("references")
    )
    wanted = {"type": "catalog", "url": "md:docs", "schema": "en", "table": "src3", "column": None}
    return filters.filter_by_reference(rows, wanted).select("doc_id")


@query(
    "p14_explode_grantees",
    """SELECT doc_id, unnest([lang, source]) AS grantee_name, 'role' AS grantee_type, 'read' AS privilege
    FROM documents WHERE doc_id % 3 = 0""",
)
def explode_grantees(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 3 == 0, "Role").otherwise("organization").alias("access"),
        F.array("lang", "source").alias("access_role_names"),
    )
    return filters.explode_grantees(rows)


@query(
    "p15_token_inventory",
    """SELECT event_id AS id, '' AS token FROM events
    WHERE event_type = 'signup' OR ts > TIMESTAMP '2024-01-16 00:00:00' ORDER BY id""",
)
def token_inventory(spark, sf):
    """Events as tokens; a sign-up never expires."""
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.col("props").alias("token"),
        F.when(F.col("event_type") != "signup", F.col("ts")).alias("expire_at"),
    )
    as_of = dt.datetime(2024, 1, 16, tzinfo=dt.timezone.utc)
    return filters.token_inventory(rows, as_of).select("id", "token")


@query(
    "p16_active_tenants",
    "SELECT c_custkey AS tenant_id, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)",
)
def active_tenants(spark, sf):
    """Customers without an order above the limit."""
    tenants = table(spark, sf, "customer").select(F.col("c_custkey").alias("tenant_id"), "c_name")
    suspended = table(spark, sf, "orders").filter("o_totalprice > 450000").select(F.col("o_custkey").alias("tenant_id"))
    return filters.active_tenants(tenants, suspended)


@query(
    "p17_split_valid",
    """SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN NOT l_quantity <= 40 THEN 'quantity' WHEN NOT l_discount < 0.08 THEN 'discount'
    WHEN NOT l_tax > 0 THEN 'tax' ELSE 'valid' END AS outcome FROM lineitem""",
)
def split_valid(spark, sf):
    rules = {"quantity": F.col("l_quantity") <= 40, "discount": F.col("l_discount") < 0.08, "tax": F.col("l_tax") > 0}
    valid, rejected = filters.split_valid(table(spark, sf, "lineitem"), rules)
    keys = ["l_orderkey", "l_linenumber", "l_suppkey"]
    good = valid.select(*keys, F.lit("valid").alias("outcome"))
    return good.unionByName(rejected.select(*keys, F.col("reject_reason").alias("outcome")))
