"""Sources, sinks and versioned tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.aggregates import daily_revenue_mart
from tallyhouse.functions.render import json_value, rows_json
from tallyhouse.operators.ordering import page
from tallyhouse.plans.warehouse import refresh_marts
from tallyhouse.settings import scratch_path
from tallyhouse.sources import readers
from tallyhouse.sources.listing import scan_files
from tallyhouse.sources.tables import (
    VersionedTable,
    append_rows,
    ledgered_append,
    merge_into,
    merge_upsert,
    publish,
    read_published,
)
from workload.registry import query
from workload.relations import LATEST_ORDERS, ORDERS, REVISION, orders, table, text


@query(
    "s1_read_keyed_json",
    "SELECT 'Customer/' || c_custkey AS repo, CAST(c_nationkey AS BIGINT) AS stars, c_custkey % 7 AS forks FROM customer",
)
def read_keyed_json(spark, sf):
    """Customers written as lines of JSON arrays, read back as a keyed batch."""
    rows = table(spark, sf, "customer").select(
        F.concat(F.lit("Customer/"), text("c_custkey")).alias("repo"),
        F.col("c_nationkey").cast("bigint").alias("stars"),
        (F.col("c_custkey") % 7).alias("forks"),
    )
    path = scratch_path(spark, "json")
    rows.select(F.to_json(F.array(F.struct("repo", "stars", "forks"))).alias("value")).write.text(path)
    return readers.read_keyed_json(spark, path, "repo string, stars bigint, forks bigint", "repo", multiline=False)


@query(
    "s2_read_csv",
    "SELECT p_partkey, p_name, p_size, p_retailprice FROM part",
)
def read_csv(spark, sf):
    path = scratch_path(spark, "csv")
    table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice").write.option("header", True).csv(path)
    rows = readers.read_csv(spark, path)
    return rows.select(F.col("p_partkey").cast("bigint"), "p_name", "p_size", "p_retailprice")


@query(
    "s3_lake_table",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS occurred_at, user_id, 'https://example.com/' || event_type AS url
    FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""",
)
def lake_table(spark, sf):
    """Page views written to a lake path and filtered when read."""
    path = scratch_path(spark, "lake")
    table(spark, sf, "events").select(
        "event_id",
        F.col("ts").alias("occurred_at"),
        "user_id",
        F.concat(F.lit("https://example.com/"), "event_type").alias("url"),
    ).write.parquet(path)
    rows = readers.lake_table(spark, path)
    since = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return rows.filter(F.col("occurred_at") >= since).withColumn(
        "occurred_at", F.date_format("occurred_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


@query(
    "s3_lake_rows",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS occurred_at, user_id, 'https://example.com/' || event_type AS url FROM events""",
)
def lake_rows(spark, sf):
    """All page views of a lake path, read back with a known schema."""
    path = scratch_path(spark, "views")
    views = table(spark, sf, "events").select(
        "event_id", F.col("ts").alias("occurred_at"), "user_id", F.concat(F.lit("https://example.com/"), "event_type").alias("url")
    )
    views.write.parquet(path)
    rows = readers.lake_table(spark, path, views.schema)
    return rows.withColumn("occurred_at", F.date_format("occurred_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(
    "s4_append_rows",
    f"""SELECT order_id, CAST(amount AS DOUBLE) AS amount, status FROM {ORDERS}
    UNION ALL SELECT order_id, CAST(amount AS DOUBLE), NULL FROM {ORDERS} WHERE status = 'P'""",
)
def append(spark, sf):
    """Append with a column list: the column left out is null in the new rows."""
    rows = orders(spark, sf).select("order_id", "amount", "status")
    target = VersionedTable(spark, scratch_path(spark, "append"))
    target.replace(rows)
    append_rows(rows.filter("status = 'P'"), target, ["amount", "order_id"])
    return target.read().withColumn("amount", F.col("amount").cast("double"))


@query("s5_generate_rows", "SELECT range AS id, 'seed' AS label FROM range((SELECT count(*) FROM orders))")
def generate_rows(spark, sf):
    return readers.generate_rows(spark, table(spark, sf, "orders").count(), "seed")


@query("s5_generate_per_row", "SELECT p_partkey, unnest(range(1, p_size + 1)) AS id, 'seed' AS label FROM part")
def generate_per_row(spark, sf):
    """As many rows for each part as its size says."""
    return readers.generate_per_row(table(spark, sf, "part"), "p_partkey", "p_size", "seed")


@query(
    "s6_refresh_table",
    f"""SELECT CAST(order_date AS VARCHAR) AS order_date, count(*) AS order_count, CAST(sum(amount) AS DOUBLE) AS revenue
    FROM {LATEST_ORDERS} WHERE status = 'F' AND amount >= 0 AND order_date IS NOT NULL GROUP BY order_date""",
)
def refresh(spark, sf):
    """The mart refreshed twice; the second run changes nothing."""
    mart = VersionedTable(spark, scratch_path(spark, "mart"))
    for _ in range(2):
        rows = refresh_marts(orders(spark, sf), mart, ["customer_id"], REVISION, "F")
    return rows.select(text("order_date").alias("order_date"), "order_count", F.col("revenue").cast("double").alias("revenue"))


@query(
    "s7_merge_upsert",
    f"""SELECT customer_id, order_id, CAST(amount AS DOUBLE) AS amount FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ordered_at >= TIMESTAMP '1998-01-01' DESC, ordered_at DESC, order_id DESC) AS rn
    FROM {ORDERS}) WHERE rn = 1""",
)
def merge(spark, sf):
    """Orders up to 1997 as the target, later ones merged twice as the batch."""
    rows = orders(spark, sf).select("customer_id", "order_id", "amount", "ordered_at")
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    target = VersionedTable(spark, scratch_path(spark, "merge"))
    target.create(rows.schema)
    for batch in (rows.filter(F.col("ordered_at") < cut), rows.filter(F.col("ordered_at") >= cut)):
        merge_into(target, batch, ["customer_id"], REVISION)
    repeated = merge_upsert(target.read(), rows.filter(F.col("ordered_at") >= cut), ["customer_id"], REVISION)
    return repeated.select("customer_id", "order_id", F.col("amount").cast("double").alias("amount"))


@query(
    "s7_repeated_batches",
    f"""WITH first AS (SELECT customer_id, order_id, amount, ordered_at FROM {ORDERS} WHERE order_id % 3 = 0),
    firsts AS (SELECT * FROM first QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ordered_at DESC, order_id DESC) = 1),
    later AS (SELECT customer_id, order_id, amount * 2 AS amount, ordered_at FROM {ORDERS} WHERE order_id % 3 = 1
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ordered_at DESC, order_id DESC) = 1)
    SELECT coalesce(l.customer_id, f.customer_id) AS customer_id, CASE WHEN l.customer_id IS NULL THEN f.order_id ELSE l.order_id END AS order_id,
    CAST(CASE WHEN l.customer_id IS NULL THEN f.amount ELSE l.amount END AS DOUBLE) AS amount, CAST(3 AS BIGINT) AS versions
    FROM firsts AS f FULL OUTER JOIN later AS l ON l.customer_id = f.customer_id""",
)
def repeated_batches(spark, sf):
    """A batch merged twice, one that updates and adds keys, and one with a missing key, which fails and changes nothing."""
    rows = orders(spark, sf).select("customer_id", "order_id", "amount", "ordered_at")
    first, later = rows.filter("order_id % 3 = 0"), rows.filter("order_id % 3 = 1").withColumn("amount", (F.col("amount") * 2).cast("decimal(18,2)"))
    invalid = rows.filter("order_id % 3 = 2").withColumn("customer_id", F.when(F.col("order_id") % 5 != 0, F.col("customer_id")))
    target = VersionedTable(spark, scratch_path(spark, "batches"))
    for batch in (first, first, later):
        merge_into(target, batch, ["customer_id"], REVISION, buckets=16)
    try:
        merge_into(target, invalid, ["customer_id"], REVISION)
    except PySparkException as error:
        if "merge key" not in str(error):
            raise
    kept = target.read().select("customer_id", "order_id", F.col("amount").cast("double").alias("amount"))
    return kept.withColumn("versions", F.lit(target.version()).cast("bigint"))


@query(
    "s8_append_ledger",
    """SELECT 'run-1' AS run_id, 'succeeded' AS status, count(*) AS rows FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'run-2', 'succeeded', count(*) FROM orders WHERE o_orderstatus <> 'F'""",
)
def ledger(spark, sf):
    rows = orders(spark, sf)
    root = scratch_path(spark, "ledger")
    target, log = VersionedTable(spark, f"{root}/orders"), VersionedTable(spark, f"{root}/runs")
    ledgered_append(target, rows.filter("status = 'F'"), log, "run-1")
    return ledgered_append(target, rows.filter("status <> 'F'"), log, "run-2").drop("loaded_at")


@query(
    "s9_rows_json",
    """SELECT event_id, '{"amount":' || regexp_replace(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '\\.?0+$', '') || ',"id":' || event_id
    || ',"kind":"' || event_type || '","note":' || CASE WHEN event_id % 2 = 0 THEN 'null' ELSE '"odd"' END
    || ',"occurred_at":"' || regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0+$', '') || 'Z"'
    || ',"raw":"' || lower(hex(event_type)) || '","tags":["' || event_type || '",null]}' AS row_json FROM events""",
)
def json_rows(spark, sf):
    """Whole rows as JSON text, numbers exact, nulls kept."""
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("ID"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.col("event_type").alias("kind"),
        F.when(F.col("event_id") % 2 == 1, "odd").alias("note"),
        F.col("ts").alias("occurred_at"),
        F.col("event_type").cast("binary").alias("raw"),
        F.array(F.col("event_type"), F.lit(None)).alias("tags"),
    )
    return rows_json(rows).select(F.get_json_object("row_json", "$.id").cast("bigint").alias("event_id"), "row_json")


@query(
    "s9_nested_json",
    """SELECT event_id, '{"by_code":{"' || lower(hex(event_type)) || '":' || event_id || '},"by_time":{"'
    || regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0+$', '') || 'Z":null},"share":'
    || regexp_replace(CAST(CAST(event_id AS DECIMAL(38,9)) / 1000000000 AS DECIMAL(38,9))::VARCHAR, '\\.?0+$', '') || '}' AS row_json FROM events""",
)
def nested_json(spark, sf):
    """Rows whose maps have binary and time keys, and decimals down to a billionth."""
    rows = table(spark, sf, "events").select(
        "event_id",
        F.create_map(F.col("event_type").cast("binary"), "event_id").alias("by_code"),
        F.create_map("ts", F.lit(None).cast("int")).alias("by_time"),
        (F.col("event_id").cast("decimal(20,0)") * F.lit(Decimal("0.000000001"))).cast("decimal(38,9)").alias("share"),
    )
    inner = [f for f in rows.schema.fields if f.name != "event_id"]
    return rows.select("event_id", json_value(F.struct(*[f.name for f in inner]), T.StructType(inner)).alias("row_json"))


@query("s10_list_files", "SELECT DISTINCT 'usage_date=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS name, 'folder' AS type FROM events")
def list_files(spark, sf):
    """Events written to a folder per day; the folders of the listing."""
    path = scratch_path(spark, "days")
    days = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("usage_date"))
    days.repartitionByRange("usage_date", "event_id").write.partitionBy("usage_date").parquet(path)
    return readers.list_files(spark, path).select("name", "type").filter("type = 'folder'")


@query(
    "s10_list_file_rows",
    """SELECT 'usage_date=' || CAST(CAST(ts AS DATE) AS VARCHAR) || '/part=' || CAST(event_id % 8 AS VARCHAR) || '/' AS folder, 'file' AS type,
    CAST(sum(strlen(CAST(event_id AS VARCHAR)) + 1) AS BIGINT) AS size, true AS written_since FROM events GROUP BY ALL""",
)
def list_file_rows(spark, sf):
    """Event ids written as lines to eight files per day; the files of the listing, each in a folder of its own."""
    path = scratch_path(spark, "lines")
    ids = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("value"), F.to_date("ts").alias("usage_date"), (F.col("event_id") % 8).alias("part"))
    began = spark.sql("SELECT date_trunc('second', current_timestamp())").first()[0]
    ids.repartition("usage_date", "part").write.partitionBy("usage_date", "part").text(path)
    files = readers.list_files(spark, path, recursive=True).filter("type = 'file'")
    folder = F.regexp_extract("name", "^(.*/)part-[^/]*$", 1)
    return files.select(folder.alias("folder"), "type", "size", (F.col("last_modified") >= F.lit(began)).alias("written_since"))


@query(
    "s10_scan_files",
    """SELECT 'usage_date=' || CAST(CAST(ts AS DATE) AS VARCHAR) || '/part=' || CAST(event_id % 8 AS VARCHAR) || '/' AS folder, 'file' AS type,
    CAST(sum(strlen(CAST(event_id AS VARCHAR)) + 1) AS BIGINT) AS size, true AS written_since FROM events GROUP BY ALL
    UNION ALL SELECT DISTINCT 'usage_date=' || CAST(CAST(ts AS DATE) AS VARCHAR), 'folder', NULL, NULL FROM events""",
)
def scan_file_rows(spark, sf):
    """The same files listed by executors, a prefix each, together with the folders of the first level."""
    path = scratch_path(spark, "scan")
    ids = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("value"), F.to_date("ts").alias("usage_date"), (F.col("event_id") % 8).alias("part"))
    began = spark.sql("SELECT date_trunc('second', current_timestamp())").first()[0]
    ids.repartition("usage_date", "part").write.partitionBy("usage_date", "part").text(path)
    found = scan_files(spark, path, recursive=True)
    folder = F.when(F.col("type") == "file", F.regexp_extract("name", "^(.*/)part-[^/]*$", 1)).otherwise(F.col("name"))
    return found.select(folder.alias("folder"), "type", "size", (F.col("last_modified") >= F.lit(began)).alias("written_since"))


@query(
    "s10_scan_page",
    """SELECT 'usage_date=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS name, 'folder' AS type FROM events GROUP BY ALL
    UNION ALL SELECT 'event-kind-' || event_type, 'file' FROM events GROUP BY ALL ORDER BY name LIMIT 20 OFFSET 3""",
)
def scan_page(spark, sf):
    """One page of a first-level listing, files and folders by name; nothing below that level is listed."""
    path = scratch_path(spark, "page")
    events = table(spark, sf, "events")
    events.select("event_id", F.to_date("ts").alias("usage_date")).repartition("usage_date").write.partitionBy("usage_date").parquet(f"{path}/days")
    kinds = events.select(F.concat(F.lit("event-kind-"), "event_type").alias("value")).distinct()
    kinds.select(F.col("value").alias("kind"), "value").repartition("kind").write.partitionBy("kind").text(f"{path}/kinds")
    days = scan_files(spark, f"{path}/days").filter("type = 'folder'")
    named = scan_files(spark, f"{path}/kinds", recursive=True).filter("type = 'file'")
    kind = named.select(F.regexp_extract("name", "^kind=([^/]*)/", 1).alias("name"), "type")
    return page(days.select("name", "type").unionByName(kind), ["name"], limit=20, offset=3)


@query("s11_data_files", "SELECT 'lineitem.parquet' AS file_name, count(*) AS rows FROM lineitem")
def data_files(spark, sf):
    files = readers.data_files(table(spark, sf, "lineitem"))
    return files.select(F.element_at(F.split("file_path", "/"), -1).alias("file_name"), "rows")


@query(
    "s12_publish",
    "SELECT o_orderstatus AS status, count(*) AS row_count FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL",
)
def publication(spark, sf):
    """Consumers of a manual share keep the last published copy while the source grows."""
    rows = orders(spark, sf)
    root = scratch_path(spark, "share")
    live, share = VersionedTable(spark, f"{root}/live"), VersionedTable(spark, f"{root}/published")
    live.replace(rows.filter("status <> 'P'"))
    publish(live.read(), share)
    live.append(rows.filter("status = 'P'"))
    return read_published(share).groupBy("status").agg(F.count("*").alias("row_count"))


@query(
    "layered_refresh",
    f"""SELECT CAST(order_date AS VARCHAR) AS order_date, count(*) AS order_count, CAST(sum(amount) AS DOUBLE) AS revenue
    FROM {LATEST_ORDERS} WHERE status = 'F' AND amount >= 0 GROUP BY order_date""",
)
def layered(spark, sf):
    """The whole layered model as one lazy plan."""
    rows = daily_revenue_mart(orders(spark, sf), ["customer_id"], REVISION, "F")
    return rows.select(text("order_date").alias("order_date"), "order_count", F.col("revenue").cast("double").alias("revenue"))
