"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.functions import names, parse, render
from workload.registry import query
from workload.relations import ORDERS, RUNS, orders, runs, stamp, table, text


@query("f1_same_name", "SELECT doc_id FROM documents WHERE lower(source) = lower('SRC' || (doc_id % 20))")
def same_name(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source")
    return rows.filter(names.same_name("source", F.concat(F.lit("SRC"), text(F.col("doc_id") % 20)))).select("doc_id")


@query(
    "f2_ascii_folded",
    """SELECT conv_id, turn, md5(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS folded,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') = lower(text) AS same_as_lower FROM conversations""",
)
def ascii_folded(spark, sf):
    folded = names.ascii_folded("text")
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.md5(folded).alias("folded"), (folded == F.lower("text")).alias("same_as_lower")
    )


@query("f3_coalesce", "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END, o_orderstatus, '') AS label FROM orders")
def coalesce(spark, sf):
    first = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority"))
    return table(spark, sf, "orders").select("o_orderkey", F.coalesce(first, "o_orderstatus", F.lit("")).alias("label"))


@query("f4_shown_if", "SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN c_name END AS c_name FROM customer")
def shown_if(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", names.shown_if(F.col("c_acctbal") > 5000, "c_name").alias("c_name")
    )


@query(
    "f5_casts",
    f"""SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(order_date AS VARCHAR) AS order_date, CAST(amount AS VARCHAR) AS amount,
    epoch_us(CAST(CAST(order_date AS VARCHAR) AS DATE)) AS day_micros FROM {ORDERS}""",
)
def casts(spark, sf):
    day = F.unix_micros(text("order_date").cast("date").cast("timestamp"))
    return orders(spark, sf).select(
        text("order_id").alias("order_id"), text("order_date").alias("order_date"), text("amount").alias("amount"), day.alias("day_micros")
    )


@query(
    "f6_utc_instant",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN epoch_us(date_trunc('second', ts)) - 7200000000
    ELSE epoch_us(date_trunc('second', ts)) END AS micros FROM events""",
)
def utc_instant(spark, sf):
    """Times written with an offset of two hours, in UTC, and without an offset."""
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    offset = F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, "+02:00").otherwise("Z")
    written = table(spark, sf, "events").select("event_id", F.concat(local, offset).alias("written"))
    return written.select("event_id", F.unix_micros(parse.utc_instant("written")).alias("micros"))


@query("f7_interval_arithmetic", "SELECT event_id, strftime(ts - INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S.%f') AS week_before FROM events")
def interval_arithmetic(spark, sf):
    return table(spark, sf, "events").select("event_id", stamp(F.col("ts") - F.expr("INTERVAL 7 DAYS")).alias("week_before"))


@query("f8_keys", "SELECT 'user:' || c_name AS typed, c_nationkey || '/user/' || c_name AS path FROM customer")
def keys(spark, sf):
    return table(spark, sf, "customer").select(
        names.typed_key(F.lit("user"), "c_name").alias("typed"),
        names.path_key(text("c_nationkey"), F.lit("user"), "c_name").alias("path"),
    )


@query(
    "f9_interval_text",
    """SELECT event_id, CAST(to_months(CAST(event_id % 31 - 15 AS INTEGER)) + to_days(CAST(event_id % 5 - 2 AS INTEGER))
    + to_microseconds((event_id % 7 - 3) * CAST(round(value * 100) AS BIGINT) * 1234567) AS VARCHAR) AS wait FROM events""",
)
def interval_text(spark, sf):
    micros = (F.col("event_id") % 7 - 3) * F.round(F.col("value") * 100).cast("bigint") * 1234567
    rows = table(spark, sf, "events")
    return rows.select(
        "event_id", render.interval_text(F.col("event_id") % 31 - 15, F.col("event_id") % 5 - 2, micros).alias("wait")
    )


@query("f10_blob_text", "SELECT doc_id, lower(hex(text)) AS blob FROM documents")
def blob_text(spark, sf):
    blob = F.col("text").cast("binary")
    return table(spark, sf, "documents").select("doc_id", render.blob_text(blob).alias("blob"))


@query(
    "f11_time_text",
    """SELECT event_id, regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0+$', '') || 'Z' AS at FROM events""",
)
def time_text(spark, sf):
    return table(spark, sf, "events").select("event_id", render.time_text("ts").alias("at"))


@query("f12_uuid_text", "SELECT doc_id, CAST(CAST(md5(text) AS UUID) AS VARCHAR) AS uuid FROM documents")
def uuid_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", render.uuid_text(F.unhex(F.md5("text"))).alias("uuid"))


@query(
    "f13_retention_days",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 90 WHEN 1 THEN 1 WHEN 2 THEN 0 END AS days FROM orders""",
)
def retention_days(spark, sf):
    key = F.col("o_orderkey")
    written = (
        F.when(key % 4 == 0, F.concat(text(key % 90), F.lit(" days")))
        .when(key % 4 == 1, "1 day")
        .when(key % 4 == 2, "00:00:00")
        .otherwise("infinite")
    )
    rows = table(spark, sf, "orders").select("o_orderkey", written.alias("retention"))
    return rows.select("o_orderkey", parse.retention_days("retention").alias("days"))


@query("f14_run_status", f"SELECT run_number, regexp_replace(lower(trim(status)), '^run_status_', '') AS status FROM {RUNS}")
def run_status(spark, sf):
    return runs(spark, sf).select("run_number", parse.run_status("status").alias("status"))


@query(
    "f15_is_failure",
    f"""SELECT run_number, regexp_replace(lower(trim(status)), '^run_status_', '')
    IN ('failed', 'error', 'errored', 'canceled', 'cancelled', 'timed_out', 'timeout') AS failed FROM {RUNS}""",
)
def is_failure(spark, sf):
    return runs(spark, sf).select("run_number", parse.is_failure("status").alias("failed"))


@query(
    "f16_flags",
    """SELECT o_orderkey, o_orderkey % 4 = 0 OR o_orderkey % 4 = 1 AS granted,
    CASE o_orderkey % 4 WHEN 0 THEN true WHEN 2 THEN false END AS scheduled FROM orders""",
)
def flags(spark, sf):
    key = F.col("o_orderkey") % 4
    written = F.when(key == 0, "true").when(key == 1, "TRUE").when(key == 2, "false")
    rows = table(spark, sf, "orders").select("o_orderkey", written.alias("flag"))
    return rows.select(
        "o_orderkey", parse.text_flag("flag").alias("granted"), parse.optional_flag("flag").alias("scheduled")
    )


@query(
    "f17_slug",
    """SELECT page_id, regexp_replace(lower(coalesce(CASE WHEN page_id % 2 = 0 THEN url END, 'Page ' || page_id)), '[^a-z0-9_]', '_', 'g') AS slug FROM pages""",
)
def slug(spark, sf):
    preferred = F.when(F.col("page_id") % 2 == 0, F.col("url"))
    fallback = F.concat(F.lit("Page "), text("page_id"))
    return table(spark, sf, "pages").select("page_id", names.slug(preferred, fallback).alias("slug"))


DEFINITION = "'CREATE VIEW v' || doc_id || ' AS SELECT ''' || replace(source, '''', '') || ''' AS s, ' || doc_id || ';'"


@query(
    "f18_view_body",
    f"SELECT doc_id, regexp_replace(substr(d, strpos(d, ' AS ') + 4), ';$', '') AS body FROM (SELECT doc_id, {DEFINITION} AS d FROM documents)",
)
def view_body(spark, sf):
    written = F.concat(
        F.lit("CREATE VIEW v"), text("doc_id"), F.lit(" AS SELECT '"), "source", F.lit("' AS s, "), text("doc_id"), F.lit(";")
    )
    rows = table(spark, sf, "documents").select("doc_id", written.alias("definition"))
    return rows.select("doc_id", parse.view_body("definition").alias("body"))


# Every document with three share addresses written into it: one that ends in a
# token, one quoted and one plain, URL-encoded one.
ADDRESSED = """(SELECT doc_id, 'could not read md:_share/' || source || ' x/' || md5(text) || ' or ''md:_share/o''''' || lang || ''' and MD%3A_share%2F' || source || '. ' || text AS message
    FROM documents)"""


def sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


@query(
    "f19_redact_addresses",
    f"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(message, {sql_text(parse.TOKEN_ADDRESS)}, '{parse.REDACTED}', 'g'),
    {sql_text(parse.QUOTED_ADDRESS)}, '\\1{parse.REDACTED}\\2', 'g'), {sql_text(parse.PLAIN_ADDRESS)}, '{parse.REDACTED}', 'g')) AS message,
    contains(message, '_share') AS had_address FROM {ADDRESSED}""",
)
def redact_addresses(spark, sf):
    message = F.concat(
        F.lit("could not read md:_share/"), "source", F.lit(" x/"), F.md5("text"), F.lit(" or 'md:_share/o''"), "lang",
        F.lit("' and MD%3A_share%2F"), "source", F.lit(". "), "text",
    )
    rows = table(spark, sf, "documents").select("doc_id", message.alias("message"))
    return rows.select(
        "doc_id",
        F.md5(parse.redact_addresses("message")).alias("message"),
        F.col("message").contains("_share").alias("had_address"),
    )


@query(
    "f20_contains_name",
    "SELECT doc_id, list_contains(list_transform([lang, source, 'Src3x'], lambda x: lower(x)), lower('SRC3')) AS listed FROM documents",
)
def contains_name(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.array("lang", "source", F.lit("Src3x")).alias("names"))
    return rows.select("doc_id", names.contains_name("names", F.lit("SRC3")).alias("listed"))


@query("f21_list_json", """SELECT doc_id, '["' || lang || '","' || source || '"]' AS names FROM documents""")
def list_json(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.to_json(F.array("lang", "source")).alias("names"))


@query(
    "f22_json_text",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type || chr(10) || '"x"' WHEN 1 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || '00'
    WHEN 2 THEN props END AS value FROM events""",
)
def json_text(spark, sf):
    """String, number, object and null values of JSON as text."""
    kind = F.col("event_id") % 4
    raw = (
        F.when(kind == 0, F.concat(F.lit('"'), "event_type", F.lit('\\n\\"x\\""')))
        .when(kind == 1, F.concat(text(F.col("value").cast("decimal(18,2)")), F.lit("00")))
        .when(kind == 2, F.col("props"))
        .otherwise("null")
    )
    rows = table(spark, sf, "events").select("event_id", raw.alias("raw"))
    return rows.select("event_id", parse.json_text("raw").alias("value"))


@query("f23_contains", "SELECT conv_id, turn, contains(text, 'tion') AS found FROM conversations")
def contains(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", F.contains("text", F.lit("tion")).alias("found"))


@query(
    "f24_canonical_type",
    """SELECT p_partkey, CASE p_size % 8 WHEN 0 THEN 'INTEGER' WHEN 1 THEN 'VARCHAR' WHEN 2 THEN 'DECIMAL(' || p_size || ',2)'
    WHEN 3 THEN 'VARCHAR[]' WHEN 4 THEN 'TIMESTAMP WITH TIME ZONE' WHEN 5 THEN 'DOUBLE' WHEN 6 THEN 'DECIMAL(18,3)'
    ELSE 'ENUM(''Ok'', ''' || p_type || ''')' END AS canonical FROM part""",
)
def canonical_type(spark, sf):
    size, kind = text("p_size"), F.col("p_size") % 8
    written = (
        F.when(kind == 0, "int")
        .when(kind == 1, F.concat(F.lit("Varchar("), size, F.lit(")")))
        .when(kind == 2, F.concat(F.lit("numeric("), size, F.lit(", 2)")))
        .when(kind == 3, "TEXT[]")
        .when(kind == 4, "timestamptz")
        .when(kind == 5, "float8")
        .when(kind == 6, "decimal")
        .otherwise(F.concat(F.lit("ENUM('Ok', '"), "p_type", F.lit("')")))
    )
    rows = table(spark, sf, "part").select("p_partkey", written.alias("written"))
    return rows.select("p_partkey", parse.canonical_type("written").alias("canonical"))


@query(
    "f25_number_order",
    """SELECT o_custkey, CAST(max(n) AS VARCHAR) AS largest, CAST(min(n) AS VARCHAR) AS smallest FROM (SELECT o_custkey,
    (CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END) * (CAST(o_orderkey AS HUGEINT) * 100000000000000000000000000000000 + CAST(round(o_totalprice * 100) AS BIGINT)) AS n
    FROM orders) GROUP BY o_custkey""",
)
def number_order(spark, sf):
    """Largest and smallest of long integers held as text, per customer."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    zeros = F.lpad(cents, 32, "0")
    digits = F.regexp_replace(F.concat(text("o_orderkey"), zeros), "^0+", "")
    signed = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "-").otherwise(""), digits)
    rows = table(spark, sf, "orders").select("o_custkey", signed.alias("n"))
    order = parse.number_order("n")
    return rows.groupBy("o_custkey").agg(F.max_by("n", order).alias("largest"), F.min_by("n", order).alias("smallest"))
