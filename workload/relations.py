"""Warehouse relations over the given tables, in Spark and in SQL.

Each function has a SQL constant of the same meaning beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. Its footer is read for the schema only the first time."""
    path = f"{sf}/{name}.parquet"
    if path not in SCHEMAS:
        SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(SCHEMAS[path]).parquet(path)


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def stamp(column: str | Column) -> Column:
    """A time as text, so that results compare by value in both engines."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def stamp_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def joined(column: str | Column) -> Column:
    return F.array_join(column, ",")


ORDERS = """(SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderstatus AS status, o_orderdate AS ordered_at FROM orders)"""


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("ordered_at"),
    )


# A customer is the versioned object; its orders are the revisions.
LATEST_ORDERS = f"""(SELECT * FROM {ORDERS} WHERE customer_id IS NOT NULL AND ordered_at IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ordered_at DESC, order_id DESC) = 1)"""
REVISION = ("ordered_at", "order_id")

RUNS = """(SELECT o_custkey AS job_id, o_orderkey + 1 AS run_number,
    CASE o_orderstatus WHEN 'F' THEN 'RUN_STATUS_SUCCEEDED' WHEN 'O' THEN ' Running ' ELSE 'RUN_STATUS_TIMED_OUT' END AS status,
    o_orderdate AS started_at, o_orderdate + to_seconds(o_orderkey % 3600) AS ended_at FROM orders)"""


def runs(spark: SparkSession, sf: str) -> DataFrame:
    state = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("job_id"),
        (F.col("o_orderkey") + 1).alias("run_number"),
        F.when(state == "F", "RUN_STATUS_SUCCEEDED")
        .when(state == "O", " Running ")
        .otherwise("RUN_STATUS_TIMED_OUT")
        .alias("status"),
        F.col("o_orderdate").alias("started_at"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") % 3600)).alias("ended_at"),
    )


USAGE = """(SELECT time_bucket(INTERVAL 30 SECOND, ts) AS start_time, time_bucket(INTERVAL 30 SECOND, ts) + INTERVAL 30 SECOND AS end_time,
    'User_' || user_id AS user_name,
    CASE event_type WHEN 'view' THEN 'small' WHEN 'click' THEN 'medium' ELSE 'large' END AS instance_size,
    CAST(CASE event_type WHEN 'view' THEN 0.25 WHEN 'click' THEN 1 ELSE 4 END AS DECIMAL(10,4)) AS size_multiplier,
    event_id AS instance_id, event_id % 2 = 0 AS is_read_scaling,
    CAST(value AS DECIMAL(18,2)) AS uptime_seconds, CAST(json_extract_string(props, '$.k') AS BIGINT) AS queries FROM events)"""


def usage(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    bucket = F.window("ts", "30 seconds")
    return table(spark, sf, "events").select(
        bucket.start.alias("start_time"),
        bucket.end.alias("end_time"),
        F.concat(F.lit("User_"), text("user_id")).alias("user_name"),
        F.when(kind == "view", "small").when(kind == "click", "medium").otherwise("large").alias("instance_size"),
        F.when(kind == "view", 0.25).when(kind == "click", 1.0).otherwise(4.0).cast("decimal(10,4)").alias("size_multiplier"),
        F.col("event_id").alias("instance_id"),
        (F.col("event_id") % 2 == 0).alias("is_read_scaling"),
        F.col("value").cast("decimal(18,2)").alias("uptime_seconds"),
        F.get_json_object("props", "$.k").cast("bigint").alias("queries"),
    )


AGENT_RUNS = """(SELECT CAST(TIMESTAMP '2026-11-01 00:00:00' + to_seconds(conv_id * 60 + turn) AS TIMESTAMP) AS end_time,
    role AS user_name, CASE WHEN turn % 2 = 0 THEN 'chat' ELSE 'editor' END AS surface, conv_id AS session_id, turn AS run_seq,
    CAST(length(text) * CAST(0.000000125 AS DECIMAL(10,9)) AS DECIMAL(38,9)) AS ai_units FROM conversations)"""


def agent_runs(spark: SparkSession, sf: str, finished_as: str = "end_time") -> DataFrame:
    """One agent run per turn, in either generation of the schema."""
    seconds = F.col("conv_id") * 60 + F.col("turn")
    first = F.lit("2026-11-01 00:00:00").cast("timestamp_ntz")
    return table(spark, sf, "conversations").select(
        (first + F.make_dt_interval(secs=seconds)).alias(finished_as),
        F.col("role").alias("user_name"),
        F.when(F.col("turn") % 2 == 0, "chat").otherwise("editor").alias("surface"),
        F.col("conv_id").alias("session_id"),
        F.col("turn").alias("run_seq"),
        (F.length("text") * F.lit("0.000000125").cast("decimal(10,9)")).cast("decimal(38,9)").alias("ai_units"),
    )


STORAGE = """(SELECT 'db_' || o_custkey AS database_name, o_custkey AS database_id, 'owner_' || (o_custkey % 50) AS user_name,
    o_orderdate + to_microseconds(o_orderkey) AS computed_ts, CAST(round(o_totalprice * 100) AS BIGINT) AS active_bytes,
    o_orderkey * 1000 AS historical_bytes, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS retained_for_clone_bytes,
    CAST(7 AS BIGINT) AS failsafe_bytes FROM orders)"""


def storage(spark: SparkSession, sf: str) -> DataFrame:
    """Storage history: a customer is a database, its orders are computations."""
    micros = F.make_dt_interval(secs=F.col("o_orderkey").cast("decimal(18,6)") / F.lit(1_000_000).cast("decimal(10,0)"))
    return table(spark, sf, "orders").select(
        F.concat(F.lit("db_"), text("o_custkey")).alias("database_name"),
        F.col("o_custkey").alias("database_id"),
        F.concat(F.lit("owner_"), text(F.col("o_custkey") % 50)).alias("user_name"),
        (F.col("o_orderdate") + micros).alias("computed_ts"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("active_bytes"),
        (F.col("o_orderkey") * 1000).alias("historical_bytes"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey")).alias("retained_for_clone_bytes"),
        F.lit(7).cast("bigint").alias("failsafe_bytes"),
    )


SNAPSHOTS = """(SELECT 'Db_' || (o_custkey % 40) AS database_name, 's' || o_orderkey AS snapshot_id,
    CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'snap_' || (o_orderkey // 2) END AS snapshot_name,
    o_orderdate + to_microseconds(o_orderkey) AS created_ts, CAST(round(o_totalprice) AS BIGINT) AS active_bytes FROM orders)"""


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot catalog: some unnamed, some names used twice in one database."""
    key = F.col("o_orderkey")
    micros = F.make_dt_interval(secs=key.cast("decimal(18,6)") / F.lit(1_000_000).cast("decimal(10,0)"))
    half = ((key - key % 2) / 2).cast("bigint")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("Db_"), text(F.col("o_custkey") % 40)).alias("database_name"),
        F.concat(F.lit("s"), text(key)).alias("snapshot_id"),
        F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("snap_"), text(half))).alias("snapshot_name"),
        (F.col("o_orderdate") + micros).alias("created_ts"),
        F.round("o_totalprice").cast("bigint").alias("active_bytes"),
    )


DAILY_USAGE = """(SELECT event_type AS tenant_id, CAST(ts AS DATE) AS usage_date, count(*) AS event_count,
    event_type || '@example.com' AS contact_email FROM events GROUP BY ALL)"""


def daily_usage(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("tenant_id"), F.to_date("ts").alias("usage_date"))
        .agg(F.count("*").alias("event_count"))
        .withColumn("contact_email", F.concat("tenant_id", F.lit("@example.com")))
    )


# A user may read the event types in which it has an event above 150.
READERS = "(SELECT DISTINCT 'svc_' || user_id AS reader_name, event_type AS tenant_id FROM events WHERE value > 150)"


def readers(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "events")
        .filter("value > 150")
        .select(F.concat(F.lit("svc_"), text("user_id")).alias("reader_name"), F.col("event_type").alias("tenant_id"))
        .distinct()
    )


TENANT_FACTS = "(SELECT event_type AS tenant_id, event_id, CAST(value AS DECIMAL(18,2)) AS amount, ts, user_id FROM events)"


def tenant_facts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("tenant_id"),
        "event_id",
        F.col("value").cast("decimal(18,2)").alias("amount"),
        "ts",
        "user_id",
    )


# Users hold nation roles, nations region roles, regions the staff role, and
# staff one region again, which closes a cycle. Supplier roles form a tree.
ROLE_EDGES = """(SELECT 'user' AS member_type, 'u' || c_custkey AS member_name, 'nation_' || c_nationkey AS role_name FROM customer
    UNION ALL SELECT 'user', 'u' || c_custkey, 'sup_' || (c_custkey % 100) FROM customer WHERE c_acctbal > 9000
    UNION ALL SELECT 'role', 'nation_' || n_nationkey, 'region_' || n_regionkey FROM nation
    UNION ALL SELECT 'role', 'region_' || r_regionkey, 'staff' FROM region
    UNION ALL SELECT 'role', 'staff', 'region_' || r_regionkey FROM region WHERE r_regionkey = 0
    UNION ALL SELECT 'role', 'sup_' || s_suppkey, 'sup_' || (s_suppkey // 4) FROM supplier WHERE s_suppkey > 0
    UNION ALL SELECT 'role', 'sup_' || s_suppkey, 'nation_' || s_nationkey FROM supplier)"""


def role_edges(spark: SparkSession, sf: str) -> DataFrame:
    def edge(df: DataFrame, kind: str, member: Column, role: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("member_type"), member.alias("member_name"), role.alias("role_name"))

    def named(prefix: str, column: str | Column) -> Column:
        return F.concat(F.lit(prefix), text(column))

    people, sellers = table(spark, sf, "customer"), table(spark, sf, "supplier")
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    parent = ((F.col("s_suppkey") - F.col("s_suppkey") % 4) / 4).cast("bigint")
    edges = [
        edge(people, "user", named("u", "c_custkey"), named("nation_", "c_nationkey")),
        edge(people.filter("c_acctbal > 9000"), "user", named("u", "c_custkey"), named("sup_", F.col("c_custkey") % 100)),
        edge(nations, "role", named("nation_", "n_nationkey"), named("region_", "n_regionkey")),
        edge(regions, "role", named("region_", "r_regionkey"), F.lit("staff")),
        edge(regions.filter("r_regionkey = 0"), "role", F.lit("staff"), named("region_", "r_regionkey")),
        edge(sellers.filter("s_suppkey > 0"), "role", named("sup_", "s_suppkey"), named("sup_", parent)),
        edge(sellers, "role", named("sup_", "s_suppkey"), named("nation_", "s_nationkey")),
    ]
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out


CLOSURE = f"""WITH RECURSIVE e AS (SELECT DISTINCT * FROM {ROLE_EDGES}),
walk AS (SELECT member_type, member_name, role_name FROM e
    UNION SELECT w.member_type, w.member_name, e.role_name FROM walk AS w JOIN e ON e.member_type = 'role' AND e.member_name = w.role_name),
closure AS (SELECT w.member_type, w.member_name, w.role_name, e.role_name IS NOT NULL AS is_direct FROM walk AS w
    LEFT JOIN e ON e.member_type = w.member_type AND e.member_name = w.member_name AND e.role_name = w.role_name
    WHERE NOT (w.member_type = 'role' AND w.member_name = w.role_name))"""

# Twenty customers share one share; its access mode depends on its number.
SHARES = """(SELECT DISTINCT 'share_' || (c_custkey // 20) AS share_name,
    CASE (c_custkey // 20) % 5 WHEN 0 THEN 'ORGANIZATION' WHEN 1 THEN 'unrestricted' ELSE 'Restricted' END AS access FROM customer)"""
GRANTS = """(SELECT 'share_' || (c_custkey // 20) AS share_name, CASE WHEN c_custkey % 4 = 0 THEN 'role' ELSE 'user' END AS grantee_type,
    CASE WHEN c_custkey % 4 = 0 THEN 'nation_' || c_nationkey ELSE 'u' || c_custkey END AS grantee_name, 'read' AS privilege
    FROM customer WHERE c_acctbal < 6000)"""
WANTED_GRANTS = """(SELECT 'share_' || (c_custkey // 20) AS share_name, CASE WHEN c_custkey % 4 = 0 THEN 'role' ELSE 'user' END AS grantee_type,
    CASE WHEN c_custkey % 4 = 0 THEN 'nation_' || c_nationkey ELSE 'u' || c_custkey END AS grantee_name, 'READ' AS privilege
    FROM customer WHERE c_acctbal > 1000)"""
AUDIENCES = f"""(SELECT g.share_name, g.grantee_type, g.grantee_name FROM {GRANTS} AS g
    WHERE g.share_name IN (SELECT share_name FROM {SHARES} WHERE lower(access) = 'restricted')
    UNION ALL SELECT share_name, 'organization', 'ENTIRE_ORGANIZATION' FROM {SHARES} WHERE lower(access) = 'organization'
    UNION ALL SELECT share_name, 'domain', 'ALL_USERS' FROM {SHARES} WHERE lower(access) = 'unrestricted')"""


def share_name() -> Column:
    key = F.col("c_custkey")
    return F.concat(F.lit("share_"), text(((key - key % 20) / 20).cast("bigint")))


def shares(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    number = ((key - key % 20) / 20).cast("bigint") % 5
    access = F.when(number == 0, "ORGANIZATION").when(number == 1, "unrestricted").otherwise("Restricted")
    return table(spark, sf, "customer").select(share_name().alias("share_name"), access.alias("access")).distinct()


def grant_rows(spark: SparkSession, sf: str, condition: str, privilege: str) -> DataFrame:
    is_role = F.col("c_custkey") % 4 == 0
    role, user = F.concat(F.lit("nation_"), text("c_nationkey")), F.concat(F.lit("u"), text("c_custkey"))
    return table(spark, sf, "customer").filter(condition).select(
        share_name().alias("share_name"),
        F.when(is_role, "role").otherwise("user").alias("grantee_type"),
        F.when(is_role, role).otherwise(user).alias("grantee_name"),
        F.lit(privilege).alias("privilege"),
    )


def grants(spark: SparkSession, sf: str) -> DataFrame:
    return grant_rows(spark, sf, "c_acctbal < 6000", "read")


def wanted_grants(spark: SparkSession, sf: str) -> DataFrame:
    return grant_rows(spark, sf, "c_acctbal > 1000", "READ")


# Twenty parts are the columns of one table; the two catalogs differ in names,
# types and presence.
PLANNED_COLUMNS = """(SELECT 't' || (p_partkey // 20) AS table_name,
    CASE WHEN p_size % 7 = 0 THEN 'Col_' ELSE 'col_' END || (p_partkey % 20) AS column_name, CAST(p_partkey % 20 + 1 AS INTEGER) AS position,
    CASE p_size % 4 WHEN 0 THEN 'INT' WHEN 1 THEN 'varchar(10)' WHEN 2 THEN 'decimal(10, 2)' ELSE 'double' END AS data_type
    FROM part WHERE p_size % 5 <> 0)"""
CURRENT_COLUMNS = """(SELECT 't' || (p_partkey // 20) AS table_name, 'col_' || (p_partkey % 20) AS column_name,
    CAST(p_partkey % 20 + 1 AS INTEGER) AS position,
    CASE p_size % 4 WHEN 0 THEN 'INTEGER' WHEN 1 THEN 'TEXT' WHEN 2 THEN 'NUMERIC(10,2)'
        ELSE CASE WHEN p_size % 3 = 0 THEN 'REAL' ELSE 'DOUBLE' END END AS data_type
    FROM part WHERE p_size % 5 <> 1)"""


def columns(spark: SparkSession, sf: str, planned: bool) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    prefix = F.when(size % 7 == 0, "Col_").otherwise("col_") if planned else F.lit("col_")
    kind = size % 4
    if planned:
        data_type = F.when(kind == 0, "INT").when(kind == 1, "varchar(10)").when(kind == 2, "decimal(10, 2)").otherwise("double")
    else:
        real = F.when(size % 3 == 0, "REAL").otherwise("DOUBLE")
        data_type = F.when(kind == 0, "INTEGER").when(kind == 1, "TEXT").when(kind == 2, "NUMERIC(10,2)").otherwise(real)
    return table(spark, sf, "part").filter(size % 5 != (0 if planned else 1)).select(
        F.concat(F.lit("t"), text(((key - key % 20) / 20).cast("bigint"))).alias("table_name"),
        F.concat(prefix, text(key % 20)).alias("column_name"),
        (key % 20 + 1).cast("int").alias("position"),
        data_type.alias("data_type"),
    )
