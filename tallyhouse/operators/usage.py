"""Usage, storage, run and log reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.parse import instant_literal, parse_instant, run_status
from tallyhouse.operators.aggregates import any_true, uptime_total
from tallyhouse.operators.filters import bridge_finish_time, filter_name
from tallyhouse.operators.ordering import page
from tallyhouse.operators.ranking import latest_revision, latest_storage


def check_window(start: str | None, end: str | None) -> None:
    """Refuse an empty or reversed window. Bounds are compared as instants."""
    first = parse_instant(start) if start is not None else None
    last = parse_instant(end) if end is not None else None
    if first is not None and last is not None and last <= first:
        raise ValueError(f"end_time {end} must be later than start_time {start}")


def compute_usage(
    df: DataFrame,
    user: str | None = None,
    start: str | None = None,
    end: str | None = None,
    limit: int | None = None,
    offset: int | None = None,
) -> DataFrame:
    """Usage windows that lie wholly inside the bounds, in window order."""
    check_window(start, end)
    rows = filter_name(df, "user_name", user)
    if start is not None:
        rows = rows.filter(F.col("start_time") >= instant_literal(rows, "start_time", parse_instant(start)))
    if end is not None:
        rows = rows.filter(F.col("end_time") <= instant_literal(rows, "end_time", parse_instant(end)))
    order = [c for c in ("start_time", "user_name", "instance_id", "is_read_scaling") if c in df.columns]
    return page(rows, order, limit, offset)


def uptime_seconds(df: DataFrame, user: str, start: str, end: str) -> DataFrame:
    """Exact uptime of one user over the usage windows inside the bounds."""
    return uptime_total(compute_usage(df, user, start, end))


def agent_usage(
    df: DataFrame,
    user: str | None = None,
    start: str | None = None,
    end: str | None = None,
    limit: int | None = None,
    offset: int | None = None,
) -> DataFrame:
    """Agent runs that finished in ``[start, end)``, so windows never count a run twice."""
    check_window(start, end)
    rows = filter_name(bridge_finish_time(df), "user_name", user)
    if start is not None:
        rows = rows.filter(F.col("end_time") >= instant_literal(rows, "end_time", parse_instant(start)))
    if end is not None:
        rows = rows.filter(F.col("end_time") < instant_literal(rows, "end_time", parse_instant(end)))
    return page(rows, ["end_time", "session_id", "run_seq"], limit, offset)


def storage_info(
    history: DataFrame,
    database: str | None = None,
    include_history: bool = False,
    limit: int | None = None,
    offset: int | None = None,
) -> DataFrame:
    """The latest storage row of each database, or all of them."""
    rows = filter_name(history, "database_name", database)
    rows = rows if include_history else latest_storage(rows)
    return page(rows, ["database_name", "database_id", "computed_ts"], limit, offset)


def usage_windows(
    events: DataFrame, width: str = "30 seconds", ts: str = "ts", user: str = "user_id", amount: str = "value"
) -> DataFrame:
    """Events rolled into tumbling windows per user; the end is exclusive."""
    return (
        events.groupBy(F.window(ts, width).alias("w"), F.col(user).alias("user_id"))
        .agg(F.count("*").alias("queries"), F.sum(amount).alias("total"))
        .select(F.col("w.start").alias("start_time"), F.col("w.end").alias("end_time"), "user_id", "queries", "total")
    )


def latest_runs(runs: DataFrame, key: str = "job_id") -> DataFrame:
    """The newest run of each job with a normalised status."""
    return latest_revision(runs, [key], ["run_number"]).withColumn("status", run_status("status"))


def find_run(runs: DataFrame, number: int, key: str = "job_id", value: object = None) -> DataFrame:
    """The run with this number, of one job or of every job."""
    rows = runs.filter(F.col("run_number") == number)
    return rows if value is None else rows.filter(F.col(key) == F.lit(value))


def log_matches(logs: DataFrame, marker: str, keys: Sequence[str] = ("job_id", "run_number")) -> DataFrame:
    """Line count per run and whether any line holds the marker."""
    found = F.col("line").contains(marker)
    return logs.groupBy(*keys).agg(
        F.count("*").alias("line_count"), F.count_if(found).alias("matches"), any_true(found).alias("has_marker")
    )


def snapshot_listing(
    snapshots: DataFrame, database: str | None = None, limit: int | None = None, offset: int | None = None
) -> DataFrame:
    rows = filter_name(snapshots, "database_name", database)
    return page(rows, ["database_name", "created_ts", "snapshot_id"], limit, offset)


