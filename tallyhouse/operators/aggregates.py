"""Revenue, tenant, usage, storage and run aggregates.

All of them combine on the map side, so the number of rows per key does not
decide the size of a reduce task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.parse import is_failure, run_status
from tallyhouse.operators.joins import same
from tallyhouse.operators.ranking import in_order, in_parts, latest_revision, page_per_group, place_numbers

MONEY = "decimal(18,2)"
UNITS = "decimal(38,9)"
BYTES = "decimal(38,0)"


def completed_orders(orders: DataFrame, completed: str = "completed") -> DataFrame:
    """Orders that may enter a revenue model: right status, amount not negative, dated."""
    return (
        orders.filter(F.col("status") == completed)
        .filter(F.col("amount") >= 0)
        .filter(F.col("order_date").isNotNull())
    )


def daily_revenue(orders: DataFrame, completed: str = "completed") -> DataFrame:
    """Completed orders and revenue per day."""
    return (
        completed_orders(orders, completed)
        .groupBy("order_date")
        .agg(F.count("*").alias("order_count"), F.sum("amount").cast(MONEY).alias("revenue"))
    )


def daily_revenue_mart(
    orders: DataFrame,
    keys: Sequence[str] = ("order_id",),
    revision: Sequence[str] = ("source_revision",),
    completed: str = "completed",
) -> DataFrame:
    """Daily revenue over the latest revision of each order."""
    return daily_revenue(latest_revision(orders, keys, revision), completed)


def tenant_summary(facts: DataFrame) -> DataFrame:
    return facts.groupBy("tenant_id").agg(
        F.count("*").alias("event_count"), F.sum("amount").alias("total_amount")
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def total(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.sum(column).alias("total"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def name_list(
    df: DataFrame, column: str, sep: str = ", ", keys: Sequence[str] = (), *, part_size: int
) -> DataFrame:
    """Names joined into texts in order, ``part_size`` names to a ``part``; no names give an empty text.

    Equal names are counted before they are ordered, and the copies of a name
    are split between parts like different names.
    """
    keys = list(keys)
    names = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("__n"))
    placed = in_order(names, [F.col(c).asc_nulls_first() for c in (*keys, column)])
    ends = place_numbers(placed, "__end", keys, "__n").withColumn("__start", F.col("__end") - F.col("__n"))
    own_parts = F.expr(f"sequence(__start div {int(part_size)}, (__end - 1) div {int(part_size)})")
    low, high = F.col("part") * F.lit(part_size), (F.col("part") + 1) * F.lit(part_size)
    copies = (F.least("__end", high) - F.greatest("__start", low)).cast("int")
    names = ends.withColumn("part", F.explode(own_parts)).withColumn(
        "__text", F.array_join(F.array_repeat(F.col(column), copies), sep)
    )
    ordered = F.sort_array(F.collect_list(F.struct(F.col(column).alias("name"), F.col("__text").alias("text"))))
    text = F.array_join(F.transform(ordered, lambda e: e["text"]), sep)
    listed = names.groupBy(*keys, "part").agg(text.alias("names"))
    if keys:
        renamed = {k: f"__k{i}" for i, k in enumerate(keys)}
        on = [same(F.col(k), F.col(r)) for k, r in renamed.items()]
        found = df.select(*keys).distinct().join(listed.withColumnsRenamed(renamed), on, "left")
    else:
        found = df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("part")).join(listed, "part", "full_outer")
    return found.select(
        *keys, F.coalesce("part", F.lit(0)).cast("bigint").alias("part"), F.coalesce("names", F.lit("")).alias("names")
    )


def all_true(condition: Column) -> Column:
    """True over no rows, and false when a value is unknown."""
    return F.coalesce(F.bool_and(F.coalesce(condition, F.lit(False))), F.lit(True))


def any_true(condition: Column) -> Column:
    """False over no rows."""
    return F.coalesce(F.bool_or(F.coalesce(condition, F.lit(False))), F.lit(False))


def uptime_total(usage: DataFrame) -> DataFrame:
    """Exact uptime of the given usage rows."""
    return usage.agg(
        F.coalesce(F.sum(F.col("uptime_seconds").cast(UNITS)), F.lit(0).cast(UNITS)).cast(UNITS).alias("uptime_seconds")
    )


def billed_uptime(usage: DataFrame) -> DataFrame:
    """Uptime times the multiplier of the instance size, per user and size."""
    billed = F.col("uptime_seconds").cast("decimal(18,6)") * F.col("size_multiplier").cast("decimal(10,4)")
    return usage.groupBy("user_name", "instance_size").agg(
        F.sum(F.col("uptime_seconds").cast(UNITS)).cast(UNITS).alias("uptime_seconds"),
        F.sum(billed).cast(UNITS).alias("billed_seconds"),
        F.sum("queries").alias("queries"),
    )


def ai_units(usage: DataFrame) -> DataFrame:
    """AI units per user and surface, to nine decimal places."""
    return usage.groupBy("user_name", "surface").agg(
        F.count("*").alias("runs"), F.sum(F.col("ai_units").cast(UNITS)).cast(UNITS).alias("ai_units")
    )


STORAGE_CLASSES = ("active_bytes", "historical_bytes", "retained_for_clone_bytes", "failsafe_bytes")


def storage_by_owner(storage: DataFrame) -> DataFrame:
    """Bytes of every class per owner, and their total."""
    parts = [F.coalesce(F.col(c).cast(BYTES), F.lit(0).cast(BYTES)) for c in STORAGE_CLASSES]
    sums = [F.sum(p).cast(BYTES).alias(c) for p, c in zip(parts, STORAGE_CLASSES)]
    totals = storage.groupBy("user_name").agg(F.count("*").alias("databases"), *sums)
    return totals.withColumn(
        "total_bytes", reduce(lambda a, b: a + b, [F.col(c) for c in STORAGE_CLASSES]).cast(BYTES)
    )


def status_map(runs: DataFrame, key: str = "job_id", limit: int | None = None) -> DataFrame:
    """Run number to status for the runs of each job, or for the newest ``limit`` of them."""
    newest = runs if limit is None else page_per_group(runs, [key], [F.desc("run_number")], limit)
    entries = F.sort_array(F.collect_list(F.struct("run_number", "status")))
    return newest.groupBy(key).agg(F.map_from_entries(entries).alias("statuses"))


def collect_sorted(
    df: DataFrame, keys: Sequence[str], column: str, name: str | None = None, *, part_size: int
) -> DataFrame:
    """Sorted set of values per key, ``part_size`` values to a ``part``.

    Copies are removed before values meet.
    """
    values = in_parts(df.select(*keys, column).filter(F.col(column).isNotNull()).distinct(), keys, [column], part_size)
    return values.groupBy(*keys, "part").agg(F.sort_array(F.collect_list(column)).alias(name or column))


def run_outcomes(runs: DataFrame, key: str = "job_id") -> DataFrame:
    """Run counts by outcome, mean duration and failure rate per job."""
    status = run_status("status")
    seconds = F.unix_micros(F.col("ended_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))
    failures = F.count_if(is_failure("status"))
    return runs.groupBy(key).agg(
        F.count("*").alias("runs"),
        F.count_if(status == "succeeded").alias("succeeded"),
        failures.alias("failed"),
        F.count_if((status != "succeeded") & ~is_failure("status")).alias("unfinished"),
        (F.sum(seconds) / F.count(seconds) / F.lit(1_000_000)).alias("avg_seconds"),
        (failures / F.count("*")).alias("failure_rate"),
    )


def leftover_total(*listings: DataFrame) -> DataFrame:
    """Total row count over several listings."""
    counts = [listing.agg(F.count("*").alias("n")) for listing in listings]
    return reduce(DataFrame.unionByName, counts).agg(F.sum("n").alias("total"))
