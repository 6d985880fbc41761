"""Joins that check sizes before they broadcast and split heavy keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A side is broadcast only when a count shows it is below both limits.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024

# At most this many keys are salted. Every other key then holds less than
# 1/HEAVY_KEYS of the rows. Salting changes where rows meet, never the result.
HEAVY_KEYS = 100_000
HEAVY_ROWS = 100_000
SALTS = 64


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes of ``df``, in one distributed aggregate."""
    width = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        if field.dataType.typeName() in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif field.dataType.typeName() in ("array", "map", "struct"):
            as_text = F.to_json(F.struct(F.col(f"`{field.name}`").alias("v")))
            width = width + F.coalesce(F.octet_length(as_text), F.lit(0))
        else:
            width = width + F.lit(8)
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def fits_broadcast(size: tuple[int, int]) -> bool:
    rows, width = size
    return rows <= BROADCAST_ROWS and width <= BROADCAST_BYTES


def heavy_keys(df: DataFrame, keys: Sequence[str], min_rows: int | None = None) -> DataFrame | None:
    """The heaviest keys with their row counts, never more than ``HEAVY_KEYS``, or nothing.

    Only key columns are read, and counts are combined on the map side, so a hot
    key costs one row per task. The answer decides the plan: data without heavy
    keys is not made to pay for them.
    """
    least = HEAVY_ROWS if min_rows is None else min_rows
    found = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("__rows"))
        .filter(F.col("__rows") >= least)
        .orderBy(F.desc("__rows"), *keys)
        .limit(HEAVY_KEYS)
    )
    rows = found.collect()
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
    min_rows: int | None = None,
) -> DataFrame:
    """Equi join that spreads the left rows of a heavy key over many tasks.

    Only the right rows of heavy keys are repeated, once per salt. The salt
    comes from the row itself, so a rerun task produces the same rows.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join keeps left rows and cannot run {how}")
    keys = list(keys)
    hot = heavy_keys(left, keys, min_rows)
    if hot is None:
        return left.join(right, keys, how)
    hot = F.broadcast(hot.select(*keys, F.lit(True).alias("__hot")))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int")
    matchless = F.lit(False)  # a null key joins nothing, so its rows may go anywhere
    for k in keys:
        matchless = matchless | F.col(k).isNull()
    salted_left = left.join(hot, keys, "left").withColumn(
        "__salt", F.when(F.col("__hot") | matchless, spread).otherwise(F.lit(0))
    )
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_right = right.join(hot, keys, "left").withColumn(
        "__salt", F.explode(F.when(F.col("__hot"), every_salt).otherwise(F.array(F.lit(0))))
    )
    joined = salted_left.drop("__hot").join(salted_right.drop("__hot"), [*keys, "__salt"], how)
    return joined.drop("__salt")


def sized_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    size: tuple[int, int] | None = None,
) -> DataFrame:
    """Join on ``keys``: broadcast ``right`` when it is small, else salt heavy keys.

    ``right`` is measured unless the caller already knows its rows and bytes.
    """
    if fits_broadcast(size or measured(right)):
        return left.join(F.broadcast(right), list(keys), how)
    return salted_join(left, right, keys, how)


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def entitled_rows(
    facts: DataFrame,
    readers: DataFrame,
    user: str | None,
    tenant: str = "tenant_id",
    reader: str = "reader_name",
    once: bool = False,
) -> DataFrame:
    """Facts of the tenants that ``user`` may read; no entitlement, no rows.

    A repeated entitlement row repeats the facts. ``once=True`` keeps each fact
    a single time.
    """
    mine = readers.filter(F.col(reader) == F.lit(user).cast("string")).select(tenant)
    return sized_join(facts, mine, [tenant], "left_semi" if once else "inner").select(*facts.columns)


def customer_event_summary(customers: DataFrame, events: DataFrame) -> DataFrame:
    """Per customer: non-null event count, total amount, last event time.

    Events are reduced per customer before the join, so a customer with a large
    share of the events costs one row per task in the shuffle.
    """
    per_customer = (
        events.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("event_id").alias("__events"),
            F.sum("amount").alias("__amount"),
            F.max("event_ts").alias("last_event_ts"),
        )
    )
    people = customers.groupBy("customer_id", "email").agg(F.count("*").alias("__copies"))
    zero = F.lit(0).cast(per_customer.schema["__amount"].dataType)
    return people.join(per_customer, "customer_id", "left").select(
        "customer_id",
        "email",
        (F.coalesce("__events", F.lit(0)) * F.col("__copies")).alias("event_count"),
        F.coalesce(F.col("__amount") * F.col("__copies"), zero).alias("total_amount"),
        "last_event_ts",
    )


def grant_exists(desired: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Desired grants that the listing reports, ignoring letter case."""
    folded = [f"__{k}" for k in keys]
    wanted = desired.select("*", *[F.lower(k).alias(f) for k, f in zip(keys, folded)])
    listed = actual.select(*[F.lower(k).alias(f) for k, f in zip(keys, folded)]).distinct()
    return wanted.join(listed, folded, "left_semi").select(*desired.columns)


def matching_patterns(tables: DataFrame, patterns: DataFrame) -> DataFrame:
    """Tables of each share that its include patterns name.

    A pattern is ``schema`` or ``schema.table``. Both kinds are equality joins,
    so nothing is compared pairwise.
    """
    by_schema = patterns.select("share_name", F.col("pattern").alias("schema_name"))
    by_table = patterns.select("share_name", F.col("pattern").alias("__path"))
    with_path = tables.withColumn("__path", F.concat_ws(".", "schema_name", "table_name"))
    cols = ["share_name", "schema_name", "table_name"]
    return (
        sized_join(tables, by_schema, ["schema_name"])
        .select(*cols)
        .unionByName(with_path.join(by_table, "__path").select(*cols))
        .distinct()
    )


def gate_on_success(df: DataFrame, runs: DataFrame, key: str = "job_id", succeeded: str = "succeeded") -> DataFrame:
    """Rows whose job finished its latest run with success."""
    from tallyhouse.functions.parse import run_status

    newest = Window.partitionBy(key).orderBy(F.desc("run_number"))
    passed = (
        runs.withColumn("__rn", F.row_number().over(newest))
        .filter("__rn = 1")
        .filter(run_status("status") == succeeded)
        .select(key)
    )
    return salted_join(df, passed, [key], "left_semi")
