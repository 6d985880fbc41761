"""Golden results of the warehouse models and the merge pipeline."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tallyhouse.operators.aggregates import daily_revenue, daily_revenue_mart, name_list, tenant_summary
from tallyhouse.operators.checks import (
    colliding_tenants,
    duplicate_keys,
    enum_violations,
    not_null_violations,
    require_checks,
    run_checks,
    slug_collisions,
)
from tallyhouse.operators.joins import customer_event_summary
from tallyhouse.plans.warehouse import build_metrics, changed_rows, ingest, refresh_changed_marts, refresh_marts, version_diff
from tallyhouse.sources import listing, tables
from tallyhouse.sources.listing import scan_files
from tallyhouse.sources.readers import data_files, list_files, read_csv, read_keyed_json
from tallyhouse.sources.tables import (
    VersionedTable,
    append_ledger,
    append_rows,
    bucket_of,
    buckets_of,
    changed_folders,
    layout_of,
    ledgered_append,
    merge_into,
    merge_upsert,
    publish,
    read_share,
    rows_with_keys,
)

DAY = dt.date(2025, 3, 14)
ORDERS = "order_id string, order_date date, amount decimal(18,2), status string"
SIMPLE = [
    ("k2", DAY, Decimal("8.25"), "completed"),
    ("z9", DAY + dt.timedelta(days=40), Decimal("77.10"), "cancelled"),
    ("b7", DAY, Decimal("31.40"), "completed"),
]
#: The first order again, revised.
VERSIONED = [(*SIMPLE[0][:2], SIMPLE[0][2] + Decimal("1.50"), "completed", 5)] + [(*r, 3) for r in SIMPLE]
TOTAL = sum(r[2] for r in SIMPLE if r[3] == "completed")
LATEST = TOTAL + Decimal("1.50")


def versioned(spark, data=VERSIONED):
    return spark.createDataFrame(data, ORDERS + ", source_revision bigint")


def test_daily_revenue(spark):
    got = daily_revenue(spark.createDataFrame(SIMPLE, ORDERS))
    assert rows(got) == [(DAY, 2, TOTAL)]
    assert got.schema["revenue"].dataType.simpleString() == "decimal(18,2)"


def test_daily_revenue_skips_bad_rows(spark):
    bad = [("x", None, Decimal("1.00"), "completed"), ("y", DAY, Decimal("-1.00"), "completed"), ("z", DAY, None, "completed")]
    assert rows(daily_revenue(spark.createDataFrame(SIMPLE + bad, ORDERS))) == [(DAY, 2, TOTAL)]


def test_layered_mart_uses_latest_revision_whatever_the_input_order(spark):
    for data in (VERSIONED, VERSIONED[::-1]):
        assert rows(daily_revenue_mart(versioned(spark, data))) == [(DAY, 2, LATEST)]


def test_refresh_is_repeatable_and_empty_input_empties_the_mart(spark, folder):
    mart = VersionedTable(spark, f"{folder}/mart")
    for _ in range(2):
        assert rows(refresh_marts(versioned(spark), mart)) == [(DAY, 2, LATEST)]
    emptied = refresh_marts(versioned(spark, []), mart)
    assert emptied.count() == 0
    assert emptied.schema.simpleString() == "struct<order_date:date,order_count:bigint,revenue:decimal(18,2)>"
    assert rows(mart.read(3)) == [(DAY, 2, LATEST)]


def test_customer_without_events_keeps_a_row(spark):
    customers = spark.createDataFrame([("c1", "a@x"), ("c2", "b@x"), (None, "n@x")], "customer_id string, email string")
    events = spark.createDataFrame(
        [("e1", "c1", 1.5, dt.datetime(2026, 1, 1)), (None, "c1", None, dt.datetime(2026, 1, 3)), ("e3", None, 9.0, None)],
        "event_id string, customer_id string, amount double, event_ts timestamp_ntz",
    )
    assert rows(customer_event_summary(customers, events)) == [
        ("c1", "a@x", 1, 1.5, dt.datetime(2026, 1, 3)),
        ("c2", "b@x", 0, 0.0, None),
        (None, "n@x", 0, 0.0, None),
    ]


def test_customer_listed_twice_counts_twice_as_in_the_plain_join(spark):
    customers = spark.createDataFrame([("c1", "a@x"), ("c1", "a@x")], "customer_id string, email string")
    events = spark.createDataFrame([("e1", "c1", 1.5, None)], "event_id string, customer_id string, amount double, event_ts timestamp_ntz")
    assert rows(customer_event_summary(customers, events)) == [("c1", "a@x", 2, 3.0, None)]


def test_tenant_summary(spark):
    facts = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 3.0), ("b", 3, 1.0)], "tenant_id string, event_id int, amount double")
    assert rows(tenant_summary(facts)) == [("a", 2, 5.0), ("b", 1, 1.0)]


REPOS = "repo string, stars bigint, forks bigint"
FIRST = [{"repo": "demo/acme", "stars": 10, "forks": 2}, {"repo": "demo/globex", "stars": 5, "forks": 1}]
UPDATED = [{"repo": "demo/acme", "stars": 12, "forks": 3}, {"repo": "demo/globex", "stars": 5, "forks": 1}]
INVALID = [{"stars": 99}]


def batch(spark, folder, name, data):
    path = f"{folder}/{name}.json"
    with open(path, "w") as f:
        json.dump(data, f)
    return read_keyed_json(spark, path, REPOS, "repo")


def test_pipeline_merge_update_and_rejected_batch(spark, folder):
    raw, log, model = (VersionedTable(spark, f"{folder}/{n}") for n in ("raw", "log", "model"))
    for number, data in enumerate((FIRST, FIRST, UPDATED)):
        ingest(raw, batch(spark, folder, f"b{number}", data), ["repo"], log, f"run-{number}")
    assert rows(raw.read(), "repo", "stars") == [("demo/acme", 12), ("demo/globex", 5)]
    with pytest.raises(PySparkException, match="merge key"):
        ingest(raw, batch(spark, folder, "bad", INVALID), ["repo"], log, "run-bad")
    assert raw.read().count() == 2
    assert rows(log.read(), "run_id", "status", "rows")[-1] == ("run-bad", "failed", 0)
    assert rows(build_metrics(raw, model), "repo", "engagement") == [("demo/acme", 15), ("demo/globex", 6)]
    evolved = build_metrics(raw, model, {"model_revision": "evolved"})
    assert evolved.columns[0] == "model_revision"
    assert rows(evolved.select("model_revision").distinct()) == [("evolved",)]


def test_model_with_a_null_key_is_not_published(spark, folder):
    raw, model = VersionedTable(spark, f"{folder}/raw"), VersionedTable(spark, f"{folder}/model")
    raw.replace(spark.createDataFrame([("a", 1, 1)], REPOS))
    build_metrics(raw, model)
    raw.append(spark.createDataFrame([(None, 1, 1)], REPOS))
    with pytest.raises(ValueError, match="not_null:repo"):
        build_metrics(raw, model)
    assert model.version() == 1


def test_json_batch_with_a_row_that_is_no_object_fails(spark, folder):
    for name, data in (("number", [{"repo": "a"}, 7]), ("blank", [{"repo": ""}]), ("type", [{"repo": "a", "stars": "many"}])):
        with pytest.raises((PySparkException, Py4JJavaError)):
            batch(spark, folder, name, data).collect()


def test_merge_keeps_absent_rows_and_reduces_the_batch(spark):
    target = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], "k string, v int, rev int")
    new = spark.createDataFrame([("b", 3, 2), ("b", 4, 3), ("c", 5, 1)], "k string, v int, rev int")
    assert rows(merge_upsert(target, new, ["k"], ["rev"])) == [("a", 1, 1), ("b", 4, 3), ("c", 5, 1)]
    with pytest.raises(PySparkException, match="repeats"):
        merge_upsert(target, new, ["k"]).collect()


def test_merge_rewrites_only_folders_that_hold_a_key(spark, folder):
    table = VersionedTable(spark, f"{folder}/t")
    for k in ("a", "b", "c"):
        table.append(spark.createDataFrame([(k, 1)], "k string, v int"))
    first, second, third = table.entry()["paths"]
    new = spark.createDataFrame([(2, "b"), (3, "d")], "v int, k string")
    assert rows(merge_into(table, new, ["k"])) == [("a", 1), ("b", 2), ("c", 1), ("d", 3)]
    paths = table.entry()["paths"]
    assert paths[:2] == [first, third] and len(paths) == 3


def test_merge_into_new_table_twice(spark, folder):
    table = VersionedTable(spark, f"{folder}/t")
    new = spark.createDataFrame([("a", 1)], "k string, v int")
    assert rows(merge_into(table, new, ["k"])) == rows(merge_into(table, new, ["k"])) == [("a", 1)]


def laid_out(spark, folder, n=5000, buckets=64):
    table = VersionedTable(spark, f"{folder}/laid")
    merge_into(table, spark.range(n).selectExpr("concat('k', id) AS k", "id AS v", "1 AS rev"), ["k"], buckets=buckets)
    return table


def test_one_key_rewrites_one_bucket(spark, folder):
    table = laid_out(spark, folder)
    assert len({bucket_of(p) for p in table.entry()["paths"]}) == 64
    before = table.version()
    merge_into(table, spark.createDataFrame([(2, -7, "k41")], "rev int, v long, k string"), ["k"])
    gone, come = changed_folders(table, before, table.version())
    assert len(gone) == len(come) == 1 and bucket_of(gone[0]) == bucket_of(come[0])
    assert rows(table.read().filter("rev = 2")) == [("k41", -7, 2)] and table.read().count() == 5000


def test_scattered_keys_rewrite_their_buckets_only(spark, folder):
    table = laid_out(spark, folder, n=6000, buckets=1024)
    before, layout = table.version(), layout_of(table.entry())
    batch = spark.range(0, 7000, 7).selectExpr("concat('k', id) AS k", "-id AS v", "2 AS rev")
    merge_into(table, batch, ["k"])
    gone, come = changed_folders(table, before, table.version())
    wanted = buckets_of(batch, layout)
    assert {bucket_of(p) for p in come} == wanted and len(wanted) < 1024
    assert {bucket_of(p) for p in gone} <= wanted
    assert rows(rows_with_keys(table, batch.filter("v > -20")), "k", "v") == [("k0", 0), ("k14", -14), ("k7", -7)]
    assert table.read().agg({"v": "sum"}).first()[0] == sum(range(6000)) - sum(range(0, 6000, 7)) - sum(range(0, 7000, 7))


def test_merge_removes_keys_and_empty_buckets(spark, folder):
    table = laid_out(spark, folder, n=40)
    batch = spark.createDataFrame([(f"k{i}", i, 9) for i in range(30)], "k string, v long, rev int")
    merge_into(table, batch, ["k"], gone=F.col("rev") == 9)
    assert rows(table.read(), "v") == [(i,) for i in range(30, 40)]
    assert len(table.entry()["paths"]) <= 10
    merge_into(table, batch.limit(0), ["k"])
    assert table.read().count() == 10


def test_log_names_changes_and_sometimes_all_folders(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "WHOLE_EVERY", 4)
    table = VersionedTable(spark, f"{folder}/t")
    for n in range(7):
        table.append(spark.range(n, n + 1))
    lines = {r["version"]: r for r in table.log().collect()}
    assert [len(lines[v]["added"]) for v in (2, 3, 5, 7)] == [1] * 4
    assert sorted(v for v, r in lines.items() if r["paths"] is not None) == [1, 4]
    for version in (1, 3, 4, 7):
        assert rows(table.read(version)) == [(i,) for i in range(version)]
    with pytest.raises(LookupError):
        table.read(99)
    table.replace(spark.range(2))
    assert rows(table.read()) == [(0,), (1,)] and table.entry()["paths"][0].startswith(f"{folder}/t/data/")


def test_layout_ends_when_its_key_changes(spark, folder):
    from pyspark.sql import types as T

    from tallyhouse.plans.table_change import change_table

    table = laid_out(spark, folder, n=50)
    keep = T.StructType([f for f in table.read().schema.fields if f.name != "k"])
    change_table(table, keep)
    assert layout_of(table.entry()) is None and table.read().columns == ["v", "rev"]
    merge_into(table, spark.createDataFrame([(3, 5)], "v long, rev int"), ["v"])
    assert rows(table.read().filter("v < 5"), "v", "rev") == [(0, 1), (1, 1), (2, 1), (3, 5), (4, 1)]


def test_tables_where_a_rename_is_no_single_step_are_refused(spark):
    with pytest.raises(ValueError, match="single step"):
        VersionedTable(spark, "s3a://bucket/t").commit([], spark.range(1).schema, base=0)


def test_version_diff_reads_changed_folders_only(spark, folder):
    table = laid_out(spark, folder, n=300)
    before = table.version()
    merge_into(table, spark.createDataFrame([("k5", -1, 2), ("new", 1, 1), ("k6", 6, 1)], "k string, v long, rev int"), ["k"])
    diff = version_diff(table, before, table.version(), ["k"])
    assert rows(diff) == [("k5", "changed", ["v", "rev"]), ("new", "added", [])]
    assert len(diff.inputFiles()) <= 6


def test_changed_marts_equal_full_ones(spark, folder):
    import random

    draw = random.Random(11)
    raw, mart, full = (VersionedTable(spark, f"{folder}/{n}") for n in ("raw", "mart", "full"))
    raw.create(versioned(spark).schema, ["order_id"], 8)
    steps = [VERSIONED]
    for step in range(2):
        batch = [
            (f"n{draw.randrange(30)}", DAY + dt.timedelta(days=draw.randrange(4)) if draw.random() < 0.95 else None, Decimal(draw.randrange(-50, 900)) / 4,
             draw.choice(["completed", "completed", "cancelled"]), 10 * step + draw.randrange(10) * 31 % 17)
            for _ in range(25)
        ]
        steps.append([(*b[:4], 1000 * step + i) for i, b in enumerate(batch)])
    steps += [[("k2", DAY, Decimal("8.25"), "cancelled", 9000), ("b7", DAY + dt.timedelta(days=90), Decimal("1.00"), "completed", 9000)], [(None, DAY, Decimal("5.00"), "completed", 1)]]
    for step in steps:
        raw.append(versioned(spark, step))
        want = rows(refresh_marts(raw.read(), full))
        assert rows(refresh_changed_marts(raw, mart)) == want
        version = mart.version()
        assert rows(refresh_changed_marts(raw, mart)) == want and mart.version() == version


def test_changed_marts_after_merges_touch_changed_days_only(spark, folder):
    raw, mart = VersionedTable(spark, f"{folder}/raw"), VersionedTable(spark, f"{folder}/mart")
    data = [(f"o{i}", DAY + dt.timedelta(days=i % 40), Decimal(i), "completed", 1) for i in range(400)]
    merge_into(raw, versioned(spark, data), ["order_id"], ["source_revision"])
    refresh_changed_marts(raw, mart)
    first = mart.version()
    merge_into(raw, versioned(spark, [("o3", DAY, Decimal("1.50"), "completed", 2)]), ["order_id"], ["source_revision"])
    got = refresh_changed_marts(raw, mart)
    assert rows(got.filter(got.order_date <= DAY + dt.timedelta(days=3)))[::3] == [
        (DAY, 11, Decimal(sum(range(0, 400, 40))) + Decimal("1.50")), (DAY + dt.timedelta(days=3), 9, Decimal(sum(range(43, 400, 40)))),
    ]
    changed = changed_rows(raw, 1, 2, ["order_id"], ["source_revision"])
    assert rows(changed, "order_id", "source_revision", "sign") == [("o3", 1, -1), ("o3", 2, 1)]
    gone, come = changed_folders(mart, first, mart.version())
    assert 1 <= len(come) <= 2 and len(gone) == len(come)


def test_append_by_name_leaves_other_columns_null(spark, folder):
    table = VersionedTable(spark, f"{folder}/t")
    table.replace(spark.createDataFrame([("a", 1)], "k string, v int"))
    append_rows(spark.createDataFrame([(2, "x", "b")], "v int, junk string, k string"), table, ["k"])
    assert rows(table.read()) == [("a", 1), ("b", None)]
    with pytest.raises(ValueError, match="junk"):
        append_rows(spark.createDataFrame([("x",)], "junk string"), table, ["junk"])


def test_failed_write_leaves_no_version(spark, folder):
    table, log = VersionedTable(spark, f"{folder}/t"), VersionedTable(spark, f"{folder}/log")
    table.replace(spark.createDataFrame([("a", 1)], "k string, v int"))
    broken = spark.range(10).selectExpr("cast(id as string) AS k", "cast(raise_error('boom') as int) AS v")
    with pytest.raises(PySparkException, match="boom"):
        ledgered_append(table, broken, log, "r1")
    assert table.version() == 1 and rows(table.read()) == [("a", 1)]
    assert rows(log.read(), "run_id", "status", "rows") == [("r1", "failed", 0)]


def test_ledger_counts_rows(spark, folder):
    table, log = VersionedTable(spark, f"{folder}/t"), VersionedTable(spark, f"{folder}/log")
    ledgered_append(table, spark.range(7), log, "r1")
    append_ledger(log, "r2", 0, "skipped")
    assert rows(log.read(), "run_id", "status", "rows") == [("r1", "succeeded", 7), ("r2", "skipped", 0)]


def test_of_two_publishers_the_second_fails(spark, folder):
    table = VersionedTable(spark, f"{folder}/t")
    table.replace(spark.range(1))
    base = table.version()
    schema = spark.range(1).schema
    table.commit(table.stage(spark.range(2)), schema, "race", base)
    with pytest.raises(RuntimeError, match="another writer"):
        table.commit(table.stage(spark.range(3)), schema, "race", base)
    again = VersionedTable(spark, f"{folder}/t")
    assert (again.version(), again.read().count(), again.read(base).count()) == (base + 1, 2, 1)
    again.append(spark.range(4))
    assert again.read().count() == 6


def test_manual_share_shows_the_published_copy(spark, folder):
    live, share = VersionedTable(spark, f"{folder}/live"), VersionedTable(spark, f"{folder}/share")
    live.replace(spark.range(2))
    publish(live.read(), share)
    live.append(spark.range(3))
    assert read_share(share, live, "manual").count() == 2
    assert read_share(share, live, "automatic").count() == 5
    publish(live.read(), share)
    assert read_share(share, live, "manual").count() == 5


def test_checks(spark):
    data = spark.createDataFrame([("a", "x", 1), ("a", None, 2), (None, "z", None)], "k string, s string, n int")
    assert rows(not_null_violations(data, ["k", "n", "s"])) == [("k", 1), ("n", 1), ("s", 1)]
    assert rows(duplicate_keys(data, ["k"])) == [("a", 2)]
    assert rows(enum_violations(data, "s", ["X", "z"])) == [("a", "x", 1)]
    results = run_checks(data, not_null=["k"], unique=[["k"], ["n"]], accepted={"s": ["x", "z"]})
    assert rows(results) == [
        ("accepted:s", 0, True),
        ("not_null:k", 1, False),
        ("unique:k", 1, False),
        ("unique:n", 0, True),
    ]
    with pytest.raises(ValueError, match="not_null:k"):
        require_checks(results)


def test_checks_over_no_rows_pass(spark):
    empty = spark.createDataFrame([], "k string")
    require_checks(run_checks(empty, not_null=["k"], unique=[["k"]]))


def test_slugs(spark):
    tenants = spark.createDataFrame([("acme-eu", None), ("x", "Acme EU"), ("y", None)], "tenant_id string, slug string")
    assert rows(slug_collisions(tenants)) == [("acme_eu", 2)]


def test_name_list(spark):
    data = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "name string")
    assert rows(name_list(data, "name", part_size=9)) == [(0, "a, b, b")]
    assert rows(name_list(data.filter("false"), "name", part_size=9)) == [(0, "")]
    assert rows(name_list(data, "name", part_size=2)) == [(0, "a, b"), (1, "b")]
    keyed = spark.createDataFrame([("x", n) for n in "ca"] + [("y", "b")] * 5 + [("y", "a"), (None, "d"), ("z", None)], "k string, name string")
    assert rows(name_list(keyed, "name", "+", ["k"], part_size=4)) == [
        ("x", 0, "a+c"), ("y", 0, "a+b+b+b"), ("y", 1, "b+b"), ("z", 0, ""), (None, 0, "d"),
    ]
    tenants = spark.createDataFrame([("A b", 1), ("a-b", 2), ("c", 3)], "slug string, tenant_id int")
    assert rows(colliding_tenants(tenants, part_size=5)) == [("a_b", 0, ["1", "2"])]


def test_files(spark, folder):
    folder = f"{folder}/a+b (1)"
    spark.range(3).coalesce(1).write.parquet(f"{folder}/lake/t")
    spark.range(2).coalesce(1).write.option("header", True).csv(f"{folder}/lake/c")
    assert rows(list_files(spark, f"{folder}/lake"), "name", "type") == [("c", "folder"), ("t", "folder")]
    files = rows(list_files(spark, f"{folder}/lake/t"), "name", "type")
    assert [t for n, t in files if n.endswith(".parquet")] == ["file"]
    assert rows(data_files(spark.read.parquet(f"{folder}/lake/t")), "rows") == [(3,)]
    assert read_csv(spark, f"{folder}/lake/c").schema.simpleString() == "struct<id:int>"


def write_lines(path, *names):
    import pathlib

    for n in names:
        file = pathlib.Path(path, n)
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("x" * len(n))


def test_listing_is_the_same_however_it_is_dealt(spark, folder):
    names = ["a.txt", "b+c (1).txt", "x/1", "x/y/2", "x/y/z/3", "w/4", "w=1/5", "v/u/t/6", *[f"many/{i}" for i in range(40)]]
    write_lines(folder, *names, "_SUCCESS", ".hidden", "x/_temporary/7")
    first = sorted((n.split("/")[0], "folder" if "/" in n else "file") for n in {n.split("/")[0]: n for n in names}.values())
    assert rows(scan_files(spark, folder), "name", "type") == first
    for prefixes in (1, 4, 64):
        got = scan_files(spark, f"file://{folder}/", recursive=True, prefixes=prefixes)
        assert rows(got.filter("type = 'file'"), "name", "size") == sorted(((n, len(n)) for n in names), key=repr)
        assert rows(got.filter("type = 'folder'"), "name", "size") == [(n, None) for n, t in first if t == "folder"]
    assert got.filter("last_modified > current_timestamp() - INTERVAL 1 HOUR").count() == len(names)
    assert scan_files(spark, folder, recursive=True, prefixes=64).rdd.getNumPartitions() > 8


def test_first_level_lists_nothing_below_it(folder, monkeypatch):
    write_lines(folder, "a", "x/1", "x/y/2")
    asked = []
    monkeypatch.setattr(listing, "level", lambda files, f, plain=listing.level: asked.append(f) or plain(files, f))
    reader = listing.ListingReader(folder, False, 64)
    (only,) = reader.partitions()
    assert asked == []
    found = [n for b in reader.read(only) for n in b.column(0).to_pylist()]
    assert sorted(found) == ["a", "x"] and asked == [folder]


def test_listing_an_empty_folder(spark, folder):
    assert scan_files(spark, folder).count() == scan_files(spark, folder, recursive=True).count() == 0
