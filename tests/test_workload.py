"""Registered queries beside their SQL; all of them with WORKLOAD=all."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "a2_daily_revenue_mart", "a7_name_list", "c2_column_changes", "c15_table_diff", "f9_interval_text", "f19_redact_addresses",
    "f25_number_order", "g6_audit_shares", "g7_audit_roles", "g7_role_differences", "a14_status_map", "f10_blob_text", "g9_object_grantees", "j2_customer_event_summary", "j7_gate_on_success", "l1_deep_page", "l6_log_tail_offset",
    "n3_snapshot_status", "p6_usage_between", "p17_split_valid", "s9_rows_json", "u1_compute_usage", "u5_usage_windows_hour",
    "v2_mask_column", "v7_visible_counts", "w1_latest_revision", "w2_with_match_count", "w5_storage_growth", "x2_dedupe_first",
)
COUNTS = {"s": 12, "p": 17, "j": 8, "a": 17, "w": 6, "l": 10, "x": 4, "f": 25, "v": 10, "g": 10, "u": 9, "c": 17, "n": 7, "t": 3}


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip("the given tables are not here")
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(entry.queries()) if os.environ.get("WORKLOAD") == "all" else SAMPLE)
def test_query_equals_its_sql(spark, con, name):
    message, _, good = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), FOLDER)
    assert good, message


def test_every_operator_has_a_query():
    named = {re.match(r"([a-z])(\d+)_", n).groups() for n in entry.queries() if re.match(r"[a-z]\d+_", n)}
    missing = [f"{k}{i}" for k, n in COUNTS.items() for i in range(1, n + 1) if (k, str(i)) not in named]
    assert missing == ["u3"]  # the survey has no U3
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name, least", [("l2_order_by_all_rows", 200), ("c1_column_catalog_all", 63), ("s10_list_file_rows", 50)])
def test_whole_inputs(spark, con, name, least):
    message, _, good = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], FOLDER)
    assert good and int(message.split()[1]) >= least, message


def test_entry(spark, con):
    rows = entry.entry(spark)
    assert rows.columns == ["order_date", "order_count", "revenue"] and rows.count() > 0
