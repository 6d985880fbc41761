"""Layered warehouse refresh and the pipeline build, end to end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.aggregates import MONEY, completed_orders, daily_revenue_mart
from tallyhouse.operators.checks import require_checks, run_checks
from tallyhouse.operators.drift import table_diff
from tallyhouse.operators.filters import repository_metrics
from tallyhouse.operators.joins import sized_join
from tallyhouse.operators.ranking import latest_revision
from tallyhouse.operators.shapes import rebuild_model
from tallyhouse.settings import cut_lineage
from tallyhouse.sources.tables import (
    VersionedTable,
    append_ledger,
    bucket_of,
    changed_folders,
    in_buckets,
    layout_of,
    merge_into,
    refresh_table,
    schema_of,
)

DAILY_REVENUE = T.StructType(
    [
        T.StructField("order_date", T.DateType()),
        T.StructField("order_count", T.LongType()),
        T.StructField("revenue", T.DecimalType(18, 2)),
    ]
)


def refresh_marts(
    raw: DataFrame,
    mart: VersionedTable,
    keys: Sequence[str] = ("order_id",),
    revision: Sequence[str] = ("source_revision",),
    completed: str = "completed",
) -> DataFrame:
    """Latest revisions to daily revenue to a new mart version.

    It is one plan with one shuffle by order and one by day. Readers keep the
    old version until the new one is complete.
    """
    if mart.entry() is None:
        mart.create(DAILY_REVENUE)
    return refresh_table(daily_revenue_mart(raw, keys, revision, completed), mart)


def version_diff(table: VersionedTable, old: int, new: int, keys: Sequence[str]) -> DataFrame:
    """Row diff of two versions of a table by unique key. Folders that both versions have are not read."""
    before, after = changed_folders(table, old, new)
    schema = schema_of(table.entry(new))
    return table_diff(table.rows_of(before, schema_of(table.entry(old))), table.rows_of(after, schema), keys)


def changed_rows(
    table: VersionedTable, old: int, new: int, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """What changed in the newest rows per key between two versions: rows that went, ``sign`` -1, and that came, 1.

    Only keys in folders that one of the versions lacks can differ, and in a
    table laid out by key all rows of such a key lie in the buckets of these
    folders. A key whose newest row is the same has no rows here; rows are
    compared in all columns, null equal to null.
    """
    before, after = table.entry(old), table.entry(new)
    schema = schema_of(after)
    folders = [p for side in changed_folders(table, old, new) for p in side]
    buckets = {bucket_of(p) for p in folders}
    layout = layout_of(after)
    whole = layout is None or layout.keys != tuple(keys) or None in buckets
    touched = table.rows_of(folders, schema).select(*keys).distinct()

    def newest(entry, sign: int) -> DataFrame:
        paths = entry["paths"] if whole else in_buckets(entry["paths"], buckets)
        rows = sized_join(table.rows_of(paths, schema), touched, keys, "left_semi").select(*schema.names)
        return latest_revision(rows, keys, order).withColumn("sign", F.lit(sign))

    both = newest(before, -1).unionByName(newest(after, 1))
    return both.groupBy(*[F.col(f"`{c}`") for c in schema.names]).agg(F.sum("sign").cast("int").alias("sign")).filter("sign <> 0")


def refresh_changed_marts(
    raw: VersionedTable,
    mart: VersionedTable,
    keys: Sequence[str] = ("order_id",),
    revision: Sequence[str] = ("source_revision",),
    completed: str = "completed",
    buckets: int = 16,
) -> DataFrame:
    """Bring the daily mart up to the newest raw version by the rows that changed since the last refresh.

    The old revision of an order is taken out of its day and the new one added
    to its own; a day without orders goes. The mart's log says which raw version
    it shows, so a refresh that is repeated changes nothing, and one that failed
    starts again from what readers see. The first refresh is a full one. The
    result equals that of ``refresh_marts``.
    """
    target = raw.version()
    if mart.entry() is None:
        mart.create(DAILY_REVENUE, ["order_date"], buckets)
        mart.replace(daily_revenue_mart(raw.read(target), keys, revision, completed), f"raw@{target}")
        return mart.read()
    shown = mart.log().select(F.regexp_extract("note", "^raw@([0-9]+)$", 1).try_cast("long").alias("at"))
    last = shown.agg(F.max("at")).first()[0]
    if last is None:
        raise ValueError(f"{mart.path} is not kept by this refresh")
    if last == target:
        return mart.read()
    changes = completed_orders(changed_rows(raw, last, target, keys, revision), completed)
    days = cut_lineage(changes.groupBy("order_date").agg(F.sum("sign").alias("more"), F.sum(F.col("amount") * F.col("sign")).alias("added")))
    held = mart.read().withColumnsRenamed({"order_count": "held_count", "revenue": "held_revenue"})
    summed = sized_join(days, held, ["order_date"], "left").select(
        "order_date",
        (F.coalesce("held_count", F.lit(0)) + F.col("more")).alias("order_count"),
        (F.coalesce("held_revenue", F.lit(0)) + F.col("added")).cast(MONEY).alias("revenue"),
    )
    return merge_into(mart, cut_lineage(summed), ["order_date"], gone=F.col("order_count") == 0, note=f"raw@{target}")


def ingest(raw: VersionedTable, batch: DataFrame, keys: Sequence[str], ledger: VersionedTable, run_id: str) -> DataFrame:
    """Merge a batch into the raw table and record the load. The batch is read once and kept for both."""
    try:
        batch = cut_lineage(batch)
        rows = merge_into(raw, batch, keys)
    except Exception:
        append_ledger(ledger, run_id, 0, "failed")
        raise
    append_ledger(ledger, run_id, batch.count(), "succeeded")
    return rows


def build_metrics(raw: VersionedTable, model: VersionedTable, extra: dict | None = None) -> DataFrame:
    """Build the repository model, check it, and publish it only when it passes."""
    rows = repository_metrics(raw.read())
    rows = rebuild_model(rows, extra) if extra else rows
    staged = model.stage(rows)
    written = model.rows_of(staged, rows.schema)
    require_checks(run_checks(written, not_null=["repo", "stars"], unique=[["repo"]]))
    return model.read(model.commit(staged, rows.schema, "build"))

