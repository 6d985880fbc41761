"""Streams over files: late events, replays and repeated pages."""

import datetime as dt

from conftest import rows
from tallyhouse.sources.tables import VersionedTable, bucket_of, changed_folders
from tallyhouse.streaming.merge import crowded, fold, stream_merge
from tallyhouse.streaming.usage import read_events, run_accounted, run_available, stream_dedupe, stream_usage_windows

SCHEMA = "event_id int, ts timestamp_ntz, user_id int, value double"


def write(spark, folder, name, *events):
    """One file per call; files are read in the order they are written."""
    data = [(i, dt.datetime(2026, 1, 1) + dt.timedelta(seconds=s), u, v) for i, s, u, v in events]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def stream(spark, folder):
    return read_events(spark, f"{folder}/in", spark.createDataFrame([], SCHEMA).schema, max_files=1)


def test_late_events_are_dropped_and_windows_close(spark, folder):
    write(spark, folder, "a", (1, 0, 7, 1.0), (2, 29, 7, 2.0), (3, 30, 7, 4.0))
    write(spark, folder, "b", (4, 1000, 7, 8.0))
    write(spark, folder, "c", (6, 1001, 7, 32.0))
    write(spark, folder, "d", (5, 5, 7, 16.0))
    windows = stream_usage_windows(stream(spark, folder), watermark="1 minute")
    got = run_available(windows, f"{folder}/out")
    start = dt.datetime(2026, 1, 1)
    half = dt.timedelta(seconds=30)
    assert rows(got) == [(start, start + half, 7, 2, 3.0), (start + half, start + 2 * half, 7, 1, 4.0)]


def test_second_run_takes_only_new_files(spark, folder):
    write(spark, folder, "a", (1, 0, 7, 1.0), (2, 500, 7, 1.0))
    windows = stream_usage_windows(stream(spark, folder), watermark="1 minute")
    assert run_available(windows, f"{folder}/out").count() == 1
    write(spark, folder, "b", (3, 2000, 7, 1.0))
    assert run_available(windows, f"{folder}/out").count() == 2


def test_stream_merge_keeps_the_newest_and_survives_replay(spark, folder):
    write(spark, folder, "a", (1, 10, 7, 1.0), (2, 5, 7, 2.0), (3, 1, 8, 3.0))
    write(spark, folder, "b", (4, 4, 7, 9.0), (5, 2, 8, 4.0))
    table = VersionedTable(spark, f"{folder}/t")
    want = [(1, 7, 1.0), (5, 8, 4.0)]
    events = stream(spark, folder)
    assert rows(stream_merge(events, table, ["user_id"], ["ts", "event_id"], f"{folder}/p1"), "event_id", "user_id", "value") == want
    version = table.version()
    stream_merge(events, table, ["user_id"], ["ts", "event_id"], f"{folder}/p1")
    assert table.version() == version
    assert rows(stream_merge(events, table, ["user_id"], ["ts", "event_id"], f"{folder}/p2"), "event_id", "user_id", "value") == want


def test_folding_keeps_the_same_rows(spark, folder):
    for n in range(4):
        write(spark, folder, f"f{n}", (n, n, 7, float(n)), (10 + n, 9 - n, 8, float(n)))
    table = VersionedTable(spark, f"{folder}/t")
    got = stream_merge(stream(spark, folder), table, ["user_id"], ["ts", "event_id"], f"{folder}/p", most_parts=2)
    assert rows(got, "event_id", "user_id") == [(10, 8), (3, 7)]
    assert crowded(table, 2) == [] and len(table.entry()["paths"]) <= 4


def test_a_fold_leaves_other_buckets_alone(spark, folder):
    for n in range(3):
        write(spark, folder, f"f{n}", *[(100 * n + u, n, u, float(n)) for u in (range(40) if n == 0 else (7,))])
    table = VersionedTable(spark, f"{folder}/t")
    got = stream_merge(stream(spark, folder), table, ["user_id"], ["ts", "event_id"], f"{folder}/p", most_parts=9)
    want = rows(got, "event_id", "user_id")
    assert (207, 7) in want and len(want) == 40
    (full,) = crowded(table, 2)
    before = table.version()
    fold(table, ["user_id"], ["ts", "event_id"], [full])
    gone, come = changed_folders(table, before, table.version())
    assert {bucket_of(p) for p in gone} == {bucket_of(p) for p in come} == {full} and (len(gone), len(come)) == (3, 1)
    assert rows(table.read().filter("user_id = 7"), "event_id") == [(207,)] and table.read().count() == 40


def test_a_table_without_a_layout_gets_one(spark, folder):
    write(spark, folder, "a", (9, 50, 3, 2.0))
    table = VersionedTable(spark, f"{folder}/t")
    table.replace(spark.createDataFrame([(1, dt.datetime(2026, 1, 1), 3, 1.0), (2, dt.datetime(2026, 1, 1), 4, 1.0)], SCHEMA))
    got = stream_merge(stream(spark, folder), table, ["user_id"], ["ts", "event_id"], f"{folder}/p")
    assert rows(got, "event_id", "user_id") == [(2, 4), (9, 3)]


def test_repeats_within_the_watermark_are_dropped(spark, folder):
    write(spark, folder, "a", (1, 0, 7, 1.0), (2, 1, 7, 1.0), (1, 2, 7, 1.0))
    write(spark, folder, "b", (2, 3, 7, 1.0), (3, 4, 7, 1.0))
    got = run_available(stream_dedupe(stream(spark, folder), "event_id"), f"{folder}/out")
    assert rows(got, "event_id") == [(1,), (2,), (3,)]


def account(ledger):
    out = {}
    for r in ledger.read().collect():
        out.setdefault(r["run_id"], {})[r["status"]] = r["rows"]
    return out


def test_late_rows_are_accounted_for(spark, folder):
    write(spark, folder, "a", (1, 0, 7, 1.0), (2, 29, 7, 2.0), (3, 30, 7, 4.0))
    write(spark, folder, "b", (4, 1000, 7, 8.0))
    write(spark, folder, "c", (6, 1001, 7, 32.0))
    write(spark, folder, "d", (5, 5, 7, 16.0), (8, 6, 7, 1.0), (9, 8, 8, 1.0), (10, 1002, 8, 1.0))
    ledger = VersionedTable(spark, f"{folder}/ledger")
    got = run_accounted(stream(spark, folder), f"{folder}/out", ledger, "first", watermark="1 minute")
    assert rows(got, "queries") == [(1,), (2,)]
    first = account(ledger)
    assert {f"first:{i}" for i in range(4)} <= set(first)  # and perhaps one without rows that closes windows
    assert [first[f"first:{i}"]["late"] for i in range(4)] == [0, 0, 0, 3]
    assert first["first:2"] == {"in": 1, "untimed": 0, "windows": 2, "out": 3, "open": 2, "late": 0}
    assert first["first:3"] == {"in": 4, "untimed": 0, "windows": 0, "out": 0, "open": 3, "late": 3}

    spark.createDataFrame([(11, None, 7, 1.0)], SCHEMA).write.mode("append").parquet(f"{folder}/in")
    write(spark, folder, "e", (12, 9, 7, 1.0), (13, 5000, 7, 1.0))
    write(spark, folder, "f", (14, 5001, 7, 1.0))
    run_accounted(stream(spark, folder), f"{folder}/out", ledger, "second", watermark="1 minute")
    every = account(ledger)
    total = {s: sum(lines[s] for lines in every.values()) for s in ("in", "untimed", "out", "late")}
    last = max(every, key=lambda k: int(k.split(":")[1]))
    assert total == {"in": 13, "untimed": 1, "out": 6, "late": 4}
    assert total["in"] == total["untimed"] + total["out"] + total["late"] + every[last]["open"]


def test_nothing_new_has_no_account(spark, folder):
    write(spark, folder, "a", (1, 0, 7, 1.0))
    ledger = VersionedTable(spark, f"{folder}/ledger")
    for run in ("first", "second"):
        run_accounted(stream(spark, folder), f"{folder}/out", ledger, run)
    assert all(k.startswith("first:") for k in account(ledger))
