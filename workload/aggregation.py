"""Aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.operators import aggregates
from tallyhouse.operators.usage import uptime_seconds
from tallyhouse.plans.warehouse import refresh_changed_marts
from tallyhouse.settings import scratch_path
from tallyhouse.sources.tables import VersionedTable
from workload.registry import query
from workload.relations import (
    AGENT_RUNS,
    LATEST_ORDERS,
    ORDERS,
    REVISION,
    RUNS,
    STORAGE,
    TENANT_FACTS,
    USAGE,
    agent_runs,
    joined,
    orders,
    runs,
    storage,
    table,
    tenant_facts,
    text,
    usage,
)


def revenue_rows(df):
    return df.select(text("order_date").alias("order_date"), "order_count", F.col("revenue").cast("double").alias("revenue"))


@query(
    "a1_daily_revenue",
    f"""SELECT CAST(order_date AS VARCHAR) AS order_date, count(*) AS order_count, CAST(sum(amount) AS DOUBLE) AS revenue
    FROM {ORDERS} WHERE status = 'F' AND amount >= 0 AND order_date IS NOT NULL GROUP BY order_date""",
)
def daily_revenue(spark, sf):
    return revenue_rows(aggregates.daily_revenue(orders(spark, sf), "F"))


@query(
    "a2_daily_revenue_mart",
    f"""SELECT CAST(order_date AS VARCHAR) AS order_date, count(*) AS order_count, CAST(sum(amount) AS DOUBLE) AS revenue
    FROM {LATEST_ORDERS} WHERE status = 'F' AND amount >= 0 AND order_date IS NOT NULL GROUP BY order_date""",
)
def daily_revenue_mart(spark, sf):
    return revenue_rows(aggregates.daily_revenue_mart(orders(spark, sf), ["customer_id"], REVISION, "F"))


@query(
    "a2_changed_mart",
    f"""SELECT CAST(order_date AS VARCHAR) AS order_date, count(*) AS order_count, CAST(sum(amount) AS DOUBLE) AS revenue
    FROM {LATEST_ORDERS} WHERE status = 'F' AND amount >= 0 AND order_date IS NOT NULL GROUP BY order_date""",
)
def changed_mart(spark, sf):
    """The mart kept up by changes: orders arrive in three batches, and a customer's later order takes the place of the earlier one,
    also where it is not completed; a batch that brings no newer revision changes nothing."""
    rows, root = orders(spark, sf), scratch_path(spark, "changes")
    raw, mart = VersionedTable(spark, f"{root}/raw"), VersionedTable(spark, f"{root}/mart")
    raw.create(rows.schema, ["customer_id"], 8)
    year = F.year("ordered_at")
    for batch in (rows.filter(year < 1996), rows.filter((year >= 1996) & (year < 1998)), rows.filter((year >= 1998) | year.isNull())):
        raw.append(batch)
        mart_rows = refresh_changed_marts(raw, mart, ["customer_id"], REVISION, "F", buckets=4)
    return revenue_rows(mart_rows)


@query(
    "a3_nullable_aggregates",
    """SELECT user_id, count(CASE WHEN event_type <> 'error' THEN event_id END) AS event_count,
    CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS total_amount,
    strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_event_ts FROM events GROUP BY ALL""",
)
def nullable_aggregates(spark, sf):
    """Counts that skip nulls, a sum that is never null, the last time; grouped by all plain columns."""
    table(spark, sf, "events").createOrReplaceTempView("workload_events")
    return spark.sql(
        """SELECT user_id, count(CASE WHEN event_type <> 'error' THEN event_id END) AS event_count,
        CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS total_amount,
        date_format(max(ts), 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS last_event_ts FROM workload_events GROUP BY ALL"""
    )


@query(
    "a4_tenant_summary",
    f"SELECT tenant_id, count(*) AS event_count, CAST(sum(amount) AS DOUBLE) AS total_amount FROM {TENANT_FACTS} GROUP BY tenant_id",
)
def tenant_summary(spark, sf):
    rows = aggregates.tenant_summary(tenant_facts(spark, sf))
    return rows.withColumn("total_amount", F.col("total_amount").cast("double"))


@query("a5_row_count", "SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, sf):
    return aggregates.row_count(table(spark, sf, "lineitem"))


@query("a6_total", "SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem")
def total(spark, sf):
    priced = table(spark, sf, "lineitem").select(F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    return aggregates.total(priced, "price").select(F.col("total").cast("double").alias("total"))


@query(
    "a7_name_list",
    """SELECT p_type, part, string_agg(p_brand, ', ' ORDER BY p_brand) AS names
    FROM (SELECT p_type, p_brand, (row_number() OVER (PARTITION BY p_type ORDER BY p_brand) - 1) // 6 AS part FROM part) GROUP BY p_type, part""",
)
def name_list(spark, sf):
    """Brands of every part by type. Brands repeat, and their copies go on in the next list."""
    brands = table(spark, sf, "part").select("p_type", "p_brand")
    return aggregates.name_list(brands, "p_brand", ", ", ["p_type"], part_size=6)


@query(
    "a7_name_list_empty",
    "SELECT CAST(0 AS BIGINT) AS part, coalesce(string_agg(p_brand, ', ' ORDER BY p_brand), '') AS names FROM part WHERE p_brand LIKE 'tf\\_%' ESCAPE '\\'",
)
def name_list_empty(spark, sf):
    return aggregates.name_list(table(spark, sf, "part").filter(F.col("p_brand").startswith("tf_")), "p_brand", part_size=6)


@query("a8_distinct_values", "SELECT DISTINCT o_custkey FROM orders")
def distinct_values(spark, sf):
    return aggregates.distinct_values(table(spark, sf, "orders"), "o_custkey")


@query(
    "a9_all_any_true",
    """SELECT o_custkey, coalesce(bool_and(o_totalprice > 10000), true) AS all_large, coalesce(bool_or(o_totalprice > 450000), false) AS any_huge
    FROM orders GROUP BY o_custkey""",
)
def all_any_true(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        aggregates.all_true(F.col("o_totalprice") > 10000).alias("all_large"),
        aggregates.any_true(F.col("o_totalprice") > 450000).alias("any_huge"),
    )


@query(
    "a9_over_no_rows",
    """SELECT coalesce(bool_and(o_totalprice > 0), true) AS all_true, coalesce(bool_or(o_totalprice > 0), false) AS any_true
    FROM orders WHERE o_orderstatus = 'none'""",
)
def over_no_rows(spark, sf):
    positive = F.col("o_totalprice") > 0
    return table(spark, sf, "orders").filter("o_orderstatus = 'none'").agg(
        aggregates.all_true(positive).alias("all_true"), aggregates.any_true(positive).alias("any_true")
    )


@query(
    "a10_uptime_total",
    f"""SELECT CAST(sum(uptime_seconds) AS DOUBLE) AS uptime_seconds FROM {USAGE} WHERE lower(user_name) = lower('user_8')
    AND start_time >= TIMESTAMP '2024-01-05 00:00:00' AND end_time <= TIMESTAMP '2024-01-25 00:00:00'""",
)
def uptime_total(spark, sf):
    rows = uptime_seconds(usage(spark, sf), "user_8", "2024-01-05T00:00:00Z", "2024-01-25T02:00:00+02:00")
    return rows.select(F.col("uptime_seconds").cast("double").alias("uptime_seconds"))


@query(
    "a11_billed_uptime",
    f"""SELECT user_name, instance_size, CAST(sum(uptime_seconds) AS DOUBLE) AS uptime_seconds,
    CAST(sum(uptime_seconds * size_multiplier) AS DOUBLE) AS billed_seconds, CAST(sum(queries) AS BIGINT) AS queries FROM {USAGE} GROUP BY ALL""",
)
def billed_uptime(spark, sf):
    return aggregates.billed_uptime(usage(spark, sf)).withColumns(
        {c: F.col(c).cast("double") for c in ("uptime_seconds", "billed_seconds")}
    )


@query(
    "a12_ai_units",
    f"SELECT user_name, surface, count(*) AS runs, CAST(sum(ai_units) AS DOUBLE) AS ai_units FROM {AGENT_RUNS} GROUP BY ALL",
)
def ai_units(spark, sf):
    return aggregates.ai_units(agent_runs(spark, sf)).withColumn("ai_units", F.col("ai_units").cast("double"))


@query(
    "a13_storage_by_owner",
    f"""SELECT user_name, count(*) AS databases, CAST(sum(active_bytes) AS DOUBLE) AS active_bytes, CAST(sum(historical_bytes) AS DOUBLE) AS historical_bytes,
    CAST(sum(coalesce(retained_for_clone_bytes, 0)) AS DOUBLE) AS retained_for_clone_bytes, CAST(sum(failsafe_bytes) AS DOUBLE) AS failsafe_bytes,
    CAST(sum(active_bytes + historical_bytes + coalesce(retained_for_clone_bytes, 0) + failsafe_bytes) AS DOUBLE) AS total_bytes
    FROM {STORAGE} GROUP BY user_name""",
)
def storage_by_owner(spark, sf):
    rows = aggregates.storage_by_owner(storage(spark, sf))
    return rows.withColumns({c: F.col(c).cast("double") for c in (*aggregates.STORAGE_CLASSES, "total_bytes")})


@query(
    "a14_status_map",
    f"""SELECT job_id, string_agg(run_number || '=' || status, ';' ORDER BY run_number) AS statuses FROM {RUNS} GROUP BY job_id""",
)
def status_map(spark, sf):
    pairs = F.transform(F.map_entries("statuses"), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"]))
    return aggregates.status_map(runs(spark, sf)).select("job_id", F.array_join(pairs, ";").alias("statuses"))


@query(
    "a15_collect_sorted",
    """SELECT user_id, part, string_agg(event_type, ',' ORDER BY event_type) AS kinds
    FROM (SELECT user_id, event_type, (row_number() OVER (PARTITION BY user_id ORDER BY event_type) - 1) // 2 AS part
    FROM (SELECT DISTINCT user_id, event_type FROM events)) GROUP BY user_id, part""",
)
def collect_sorted(spark, sf):
    rows = aggregates.collect_sorted(table(spark, sf, "events"), ["user_id"], "event_type", "kinds", part_size=2)
    return rows.select("user_id", "part", joined("kinds").alias("kinds"))


@query(
    "a16_run_outcomes",
    f"""SELECT job_id, count(*) AS runs, count(*) FILTER (WHERE status = 'RUN_STATUS_SUCCEEDED') AS succeeded,
    count(*) FILTER (WHERE status = 'RUN_STATUS_TIMED_OUT') AS failed, count(*) FILTER (WHERE status = ' Running ') AS unfinished,
    CAST(sum(epoch_us(ended_at) - epoch_us(started_at)) AS DOUBLE) / count(*) / 1000000 AS avg_seconds,
    CAST(count(*) FILTER (WHERE status = 'RUN_STATUS_TIMED_OUT') AS DOUBLE) / count(*) AS failure_rate FROM {RUNS} GROUP BY job_id""",
)
def run_outcomes(spark, sf):
    return aggregates.run_outcomes(runs(spark, sf))


@query(
    "a17_leftover_total",
    """SELECT CAST((SELECT count(*) FROM part WHERE p_brand = 'Brand#2') + (SELECT count(*) FROM customer WHERE c_acctbal < 0)
    + (SELECT count(*) FROM supplier WHERE s_acctbal < 0) AS BIGINT) AS total""",
)
def leftover_total(spark, sf):
    return aggregates.leftover_total(
        table(spark, sf, "part").filter("p_brand = 'Brand#2'"),
        table(spark, sf, "customer").filter("c_acctbal < 0"),
        table(spark, sf, "supplier").filter("s_acctbal < 0"),
    )
