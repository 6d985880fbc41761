"""Usage, storage, run and log reports, and their streaming forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.operators import usage as reports
from tallyhouse.settings import scratch_path
from tallyhouse.sources.logs import LogStore
from tallyhouse.sources.tables import VersionedTable
from tallyhouse.streaming.merge import stream_merge
from tallyhouse.streaming.usage import read_events, run_accounted, run_available, stream_dedupe, stream_usage_windows
from workload.registry import query
from workload.relations import (
    AGENT_RUNS,
    RUNS,
    STORAGE,
    USAGE,
    agent_runs,
    runs,
    stamp,
    stamp_sql,
    storage,
    table,
    usage,
)


@query(
    "u1_compute_usage",
    f"""SELECT {stamp_sql('start_time')} AS start_time, {stamp_sql('end_time')} AS end_time, user_name, instance_id, is_read_scaling,
    CAST(uptime_seconds AS DOUBLE) AS uptime_seconds, queries FROM {USAGE}
    WHERE start_time >= TIMESTAMP '2024-01-05 00:00:00' AND end_time <= TIMESTAMP '2024-01-20 00:00:00'""",
)
def compute_usage(spark, sf):
    rows = reports.compute_usage(usage(spark, sf), start="2024-01-05T00:00:00Z", end="2024-01-20T00:00:00Z")
    return rows.select(
        stamp("start_time").alias("start_time"), stamp("end_time").alias("end_time"), "user_name", "instance_id",
        "is_read_scaling", F.col("uptime_seconds").cast("double").alias("uptime_seconds"), "queries",
    )


@query(
    "u1_compute_usage_user",
    f"""SELECT {stamp_sql('start_time')} AS start_time, user_name, instance_id FROM {USAGE} WHERE lower(user_name) = 'user_12'
    ORDER BY start_time, user_name, instance_id, is_read_scaling LIMIT 20 OFFSET 3""",
)
def compute_usage_user(spark, sf):
    rows = reports.compute_usage(usage(spark, sf), "USER_12", limit=20, offset=3)
    return rows.select(stamp("start_time").alias("start_time"), "user_name", "instance_id")


@query(
    "u2_agent_usage",
    f"""SELECT {stamp_sql('end_time')} AS end_time, user_name, surface, session_id, run_seq, CAST(ai_units AS DOUBLE) AS ai_units FROM {AGENT_RUNS}
    WHERE end_time >= TIMESTAMP '2026-11-01 00:10:00' AND end_time < TIMESTAMP '2026-11-01 01:20:00'""",
)
def agent_usage(spark, sf):
    rows = reports.agent_usage(agent_runs(spark, sf), start="2026-11-01T00:10:00Z", end="2026-11-01T03:20:00+02:00")
    return rows.select(
        stamp("end_time").alias("end_time"), "user_name", "surface", "session_id", "run_seq",
        F.col("ai_units").cast("double").alias("ai_units"),
    )


@query(
    "u4_storage_info",
    f"""SELECT database_name, {stamp_sql('computed_ts')} AS computed_ts, active_bytes, historical_bytes FROM {STORAGE}
    QUALIFY row_number() OVER (PARTITION BY database_id ORDER BY computed_ts DESC) = 1""",
)
def storage_info(spark, sf):
    rows = reports.storage_info(storage(spark, sf))
    return rows.select("database_name", stamp("computed_ts").alias("computed_ts"), "active_bytes", "historical_bytes")


@query(
    "u4_storage_history",
    f"SELECT database_name, {stamp_sql('computed_ts')} AS computed_ts, active_bytes FROM {STORAGE} WHERE lower(database_name) = 'db_5'",
)
def storage_history(spark, sf):
    rows = reports.storage_info(storage(spark, sf), "DB_5", include_history=True)
    return rows.select("database_name", stamp("computed_ts").alias("computed_ts"), "active_bytes")


def windows_sql(width: str) -> str:
    return f"""SELECT {stamp_sql('time_bucket(INTERVAL ' + width + ', ts)')} AS start_time, {stamp_sql('time_bucket(INTERVAL ' + width + ', ts) + INTERVAL ' + width)} AS end_time,
    user_id, count(*) AS queries, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY ALL"""


def windows(spark, sf, width):
    events = table(spark, sf, "events").withColumn("value", F.col("value").cast("decimal(18,2)"))
    return shown(reports.usage_windows(events, width))


def shown(rows):
    return rows.withColumns(
        {"start_time": stamp("start_time"), "end_time": stamp("end_time"), "total": F.col("total").cast("double")}
    )


@query("u5_usage_windows", windows_sql("30 SECOND"))
def usage_windows(spark, sf):
    return windows(spark, sf, "30 seconds")


@query("u5_usage_windows_hour", windows_sql("1 HOUR"))
def usage_windows_hour(spark, sf):
    return windows(spark, sf, "1 hour")


@query("u5_usage_windows_day", windows_sql("1 DAY"))
def usage_windows_day(spark, sf):
    return windows(spark, sf, "1 day")


@query(
    "u6_latest_runs",
    f"""SELECT job_id, run_number, regexp_replace(lower(trim(status)), '^run_status_', '') AS status FROM {RUNS}
    QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY run_number DESC) = 1""",
)
def latest_runs(spark, sf):
    return reports.latest_runs(runs(spark, sf).select("job_id", "run_number", "status"))


@query("u7_find_run", f"SELECT job_id, run_number, status FROM {RUNS} WHERE run_number = 42")
def find_run(spark, sf):
    return reports.find_run(runs(spark, sf).select("job_id", "run_number", "status"), 42)


@query(
    "u8_log_matches",
    """SELECT conv_id AS job_id, role AS run_number, count(*) AS line_count, count(*) FILTER (WHERE contains(text, 'tion')) AS matches,
    bool_or(contains(text, 'tion')) AS has_marker FROM conversations GROUP BY ALL""",
)
def log_matches(spark, sf):
    logs = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("job_id"), F.col("role").alias("run_number"), F.col("text").alias("line")
    )
    return reports.log_matches(logs, "tion")


@query(
    "u8_indexed_matches",
    """SELECT conv_id AS job_id, role AS run_number, count(*) AS line_count, count(*) FILTER (WHERE contains(text, 'nthan')) AS matches,
    bool_or(contains(text, 'nthan')) AS has_marker FROM conversations GROUP BY ALL""",
)
def indexed_matches(spark, sf):
    """A rare marker in many logs: lines come in two batches, and only those of runs whose trigrams allow it are read."""
    logs = table(spark, sf, "conversations").select(F.col("conv_id").alias("job_id"), F.col("role").alias("run_number"), F.col("text").alias("line"), "turn")
    store = LogStore(spark, scratch_path(spark, "logs"))
    for batch in (logs.filter("turn < 2"), logs.filter("turn >= 2")):
        store.add(batch, buckets=16)
    return store.search("nthan")


def event_stream(spark, sf):
    return read_events(spark, sf, table(spark, sf, "events").schema, "events.parquet")


@query(
    "t1_stream_usage_windows",
    f"SELECT * FROM ({windows_sql('1 HOUR')}) WHERE end_time <= (SELECT {stamp_sql('max(ts) - INTERVAL 10 MINUTE')} FROM events)",
)
def stream_windows(spark, sf):
    """Hourly windows of the event stream that the watermark has closed."""
    events = event_stream(spark, sf).withColumn("value", F.col("value").cast("decimal(18,2)"))
    return shown(run_available(stream_usage_windows(events, width="1 hour"), scratch_path(spark, "windows")))


@query(
    "t1_stream_account",
    f"""WITH e AS (SELECT ts, {stamp_sql('max(ts) OVER () - INTERVAL 10 MINUTE')} AS closed FROM events),
    c AS (SELECT count(*) AS n, count(*) FILTER (WHERE ts IS NULL) AS untimed,
        count(*) FILTER (WHERE {stamp_sql("time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR")} <= closed) AS done FROM e)
    SELECT unnest(['in', 'untimed', 'out', 'late']) AS status, unnest([n, untimed, done, 0]) AS rows FROM c""",
)
def stream_account(spark, sf):
    """Rows that came in, had no time, left in closed windows, and were too late, from the ledger of the run.

    The events come as one file, so that none of them is late.
    """
    path = scratch_path(spark, "account")
    ledger = VersionedTable(spark, f"{path}/ledger")
    run_accounted(event_stream(spark, sf), f"{path}/windows", ledger, "events", width="1 hour")
    told = ledger.read().filter(F.col("status").isin("in", "untimed", "out", "late"))
    return told.groupBy("status").agg(F.sum("rows").alias("rows"))


@query(
    "t2_stream_merge",
    """SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def merged_stream(spark, sf):
    """The newest event per user, merged from a stream of four batches by user buckets.

    Each batch holds some of every user's events in no order of time, so later
    batches update, and some are too late; a replay changes nothing.
    """
    path = scratch_path(spark, "stream")
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    events.repartitionByRange(4, F.col("event_id") % 4).write.parquet(f"{path}/in")
    batches = read_events(spark, f"{path}/in", events.schema, max_files=1)
    target = VersionedTable(spark, f"{path}/table")
    for attempt in ("first", "second"):
        rows = stream_merge(batches, target, ["user_id"], ["ts", "event_id"], f"{path}/{attempt}", most_parts=3, buckets=4)
    return rows.drop("ts")


@query("t3_stream_dedupe", "SELECT event_id, user_id, event_type FROM events")
def deduped_stream(spark, sf):
    """Every event arrives twice, as from overlapping pages, and is kept once."""
    twice = event_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    rows = run_available(stream_dedupe(twice, "event_id"), scratch_path(spark, "dedupe"))
    return rows.select("event_id", "user_id", "event_type")
