"""Usage windows, runs, logs and storage."""

import datetime as dt
import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyhouse.operators import aggregates, usage
from tallyhouse.operators.filters import recent_rows, token_inventory
from tallyhouse.operators.joins import gate_on_success
from tallyhouse.sources.logs import SLOTS, LogStore, gram_slots


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def compute(spark):
    data = [
        ("2026-11-01 00:00:00", "Alice", "d1", "30.000000001"),
        ("2026-11-01 00:00:30", "alice", "d2", "29.999999999"),
        ("2026-11-01 00:01:00", "bob", "", "1"),
    ]
    schema = "start_time timestamp, end_time timestamp, user_name string, instance_id string, is_read_scaling boolean, uptime_seconds string"
    records = [(at(s), at(s) + dt.timedelta(seconds=30), u, i, None, up) for s, u, i, up in data]
    return spark.createDataFrame(records, schema)


def test_window_is_wholly_inside(compute):
    got = usage.compute_usage(compute, start="2026-11-01T00:00:00Z", end="2026-11-01T00:01:00Z")
    assert [r["instance_id"] for r in got.collect()] == ["d1", "d2"]
    got = usage.compute_usage(compute, start="2026-11-01T00:00:01Z", end="2026-11-01T02:01:29+02:00")
    assert [r["instance_id"] for r in got.collect()] == ["d2"]


def test_user_filter_and_exact_total(compute):
    mine = usage.compute_usage(compute, user="ALICE")
    assert rows(aggregates.uptime_total(mine)) == [(Decimal("60.000000000"),)]
    assert rows(aggregates.uptime_total(usage.compute_usage(compute, user="nobody"))) == [(Decimal("0E-9"),)]


BASE = dt.datetime(2024, 2, 29, 23, 30, tzinfo=dt.timezone.utc)
ELSEWHERE = BASE.astimezone(dt.timezone(dt.timedelta(hours=-5, minutes=-30))).isoformat()
#: Every pair of bounds some minutes before or after the base, with the same instants in another zone, and open sides.
WINDOWS = [
    (start, end, start_at < end_at)
    for start, start_at in ((BASE.isoformat(), 0), (ELSEWHERE, 0))
    for end, end_at in ((ELSEWHERE, 0), *(((BASE + dt.timedelta(minutes=m)).isoformat(), m) for m in (-7, 0, 7)))
] + [(None, ELSEWHERE, True), (ELSEWHERE, None, True), (None, None, True), (BASE.replace(tzinfo=None).isoformat(), None, False)]
WINDOWS += [(None, BASE.strftime(odd), False) for odd in ("%Y%m%dT%H%M%SZ", "%G-W%V-%uT%H:%M:%SZ", "%Y-%m-%dT%H+00:00", "%Y-%m-%d %H:%M:%SZ")]


@pytest.mark.parametrize("start,end,good", WINDOWS)
def test_window_bounds(compute, start, end, good):
    if good:
        usage.check_window(start, end)
    else:
        with pytest.raises(ValueError):
            usage.compute_usage(compute, start=start, end=end)


def test_agent_windows_never_count_a_run_twice(spark):
    data = [(at(f"2026-11-0{d} 00:00:00"), "u", "s", d, "0.000000001") for d in (1, 2, 3)]
    runs = spark.createDataFrame(data, "run_finished_ts timestamp, user_name string, session_id string, run_seq int, ai_units string")
    first = usage.agent_usage(runs, start="2026-11-01T00:00:00Z", end="2026-11-02T00:00:00Z")
    second = usage.agent_usage(runs, start="2026-11-02T00:00:00Z", end="2026-11-03T00:00:00Z")
    assert [r["run_seq"] for r in first.collect()] == [1] and [r["run_seq"] for r in second.collect()] == [2]
    units = aggregates.ai_units(runs.selectExpr("*", "'chat' AS surface"))
    assert rows(units) == [("u", "chat", 3, Decimal("0.000000003"))]


RUNS = "job_id string, run_number int, status string, started_at timestamp, ended_at timestamp"


def run_table(spark):
    start = at("2026-01-01 00:00:00")
    data = [
        ("a", 1, "RUN_STATUS_FAILED", start, start + dt.timedelta(seconds=10)),
        ("a", 2, "SUCCEEDED", start, start + dt.timedelta(seconds=20)),
        ("b", 1, "succeeded", start, None),
        ("b", 2, " Timed_Out ", start, start + dt.timedelta(seconds=1)),
        ("c", 1, "running", start, None),
    ]
    return spark.createDataFrame(data, RUNS)


def test_runs(spark):
    runs = run_table(spark)
    assert rows(usage.latest_runs(runs), "job_id", "status") == [("a", "succeeded"), ("b", "timed_out"), ("c", "running")]
    assert rows(usage.find_run(runs, 2, value="b"), "status") == [(" Timed_Out ",)]
    outcomes = rows(aggregates.run_outcomes(runs))
    assert outcomes[0] == ("a", 2, 1, 1, 0, 15.0, 0.5)
    assert outcomes[2] == ("c", 1, 0, 0, 1, None, 0.0)
    assert rows(aggregates.status_map(runs, limit=1)) == [("a", {2: "SUCCEEDED"}), ("b", {2: " Timed_Out "}), ("c", {1: "running"})]


def test_gate_opens_on_the_latest_success_only(spark):
    data = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "job_id string")
    assert rows(gate_on_success(data, run_table(spark))) == [("a",)]


def test_log_search(spark):
    logs = spark.createDataFrame([("j", 1, "start job"), ("j", 1, "done"), ("j", 2, None)], "job_id string, run_number int, line string")
    assert rows(usage.log_matches(logs, "job")) == [("j", 1, 2, 1, True), ("j", 2, 1, 0, False)]


def test_storage(spark):
    data = [("Db", 1, at("2026-01-01 00:00:00"), 5), ("Db", 1, at("2026-01-02 00:00:00"), 7), ("x", 2, at("2026-01-01 00:00:00"), 1)]
    history = spark.createDataFrame(data, "database_name string, database_id int, computed_ts timestamp, active_bytes bigint")
    assert [r["active_bytes"] for r in usage.storage_info(history).collect()] == [7, 1]
    assert [r["active_bytes"] for r in usage.storage_info(history, "DB", include_history=True).collect()] == [5, 7]
    full = history.selectExpr("'o' AS user_name", "active_bytes", "CAST(NULL AS BIGINT) AS historical_bytes",
                              "1 AS retained_for_clone_bytes", "CAST(9007199254740993 AS BIGINT) AS failsafe_bytes")
    assert rows(aggregates.storage_by_owner(full), "databases", "total_bytes") == [(3, Decimal(13 + 3 + 3 * 9007199254740993))]


def test_recent_rows_and_tokens(spark):
    now = dt.datetime(2026, 1, 8, tzinfo=dt.timezone.utc)
    data = spark.createDataFrame([(1, "s", at("2026-01-01 00:00:00")), (2, "s", at("2026-01-01 00:00:01")), (0, "s", None)], "id int, token string, expire_at timestamp")
    assert rows(recent_rows(data, "expire_at", now), "id") == [(2,)]
    as_ntz = data.withColumn("expire_at", data.expire_at.cast("timestamp_ntz"))
    assert rows(recent_rows(as_ntz, "expire_at", now), "id") == [(2,)]
    when = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
    assert [tuple(r)[:2] for r in token_inventory(data, when).collect()] == [(0, ""), (2, "")]


def test_indexed_search_equals_a_search_of_all_lines(spark, folder):
    draw = random.Random(4)
    words = ["start", "failed", "añadir", "ok", "漢字テスト", "retry 12", "", "a", "ab", "abc"]
    batches = []
    for _ in range(2):
        batches.append([("j%d" % draw.randrange(6), draw.randrange(4), " ".join(draw.choices(words, k=draw.randrange(4)))) for _ in range(60)])
    batches[1] += [("late", 1, "needle in here"), ("late", 2, None), ("j1", 1, "a needle, too")]
    schema = "job_id string, run_number int, line string"
    store = LogStore(spark, f"{folder}/logs")
    store.add(spark.createDataFrame(batches[0], schema), buckets=4)
    store.lines.append(spark.createDataFrame(batches[1], schema))  # a job that failed before it wrote the index
    assert store.indexed() < store.lines.version()
    store.catch_up()
    every = spark.createDataFrame(batches[0] + batches[1], schema)
    for marker in ("needle", "failed a", "ñad", "テスト", "ab", "", "nowhere"):
        want = every.groupBy("job_id", "run_number").agg(
            F.count("*"), F.count_if(F.col("line").contains(marker)), F.coalesce(F.bool_or(F.col("line").contains(marker)), F.lit(False)))
        assert rows(store.search(marker)) == rows(want), marker
    assert rows(store.candidates("needle"), "job_id", "run_number") == [("j1", 1), ("late", 1)]
    assert store.candidates("nowhere").isEmpty()
    assert store.candidates("ab").count() == store.index.read().count()


def test_grams_of_texts(spark):
    data = spark.createDataFrame([("",), ("ab",), ("abc",), ("abcabc",), ("aé漢x",), (None,)], "t string")
    sizes = [len(r[0]) if r[0] is not None else None for r in data.select(gram_slots("t")).collect()]
    assert sizes == [0, 0, 1, 3, 2, 0]


def test_index_of_long_lines_and_of_runs_in_many_blocks(spark, folder):
    """Hashing a line once cut it anew for each of its characters: this took many minutes."""
    data = spark.range(1_200).selectExpr("id % 3 AS job_id", "id % 2 AS run_number", "concat(repeat('añ漢', 2000), id, ' end') AS line")
    store = LogStore(spark, f"{folder}/logs")
    begun = time.monotonic()
    store.add(data, buckets=4)
    assert rows(store.search("漢77 e")) == [(j, r, 200, int((j, r) == (2, 1)), (j, r) == (2, 1)) for j in range(3) for r in range(2)]
    assert time.monotonic() - begun < 120


def test_index_of_another_hash_is_made_anew(spark, folder):
    store = LogStore(spark, f"{folder}/logs")
    store.add(spark.createDataFrame([("j", 1, "a needle")], "job_id string, run_number int, line string"), buckets=2)
    store.index.replace(store.index.read().withColumn("grams", F.lit(bytes(SLOTS // 8))), f"lines@{store.lines.version()}")
    with pytest.raises(LookupError):
        store.search("needle")
    store.catch_up()
    assert rows(store.search("needle")) == [("j", 1, 1, 1, True)]
