"""Column catalogs, schema changes and in-place evolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.names import ascii_folded
from tallyhouse.functions.parse import canonical_type

CATALOG = (
    "table_name string, column_name string, position int, data_type string, nullable boolean, key_position int"
)


def column_catalog(
    spark: SparkSession, tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """One row per table and column. Only schemas are read, never rows."""
    keys = keys or {}
    rows = []
    for table, df in tables.items():
        key = list(keys.get(table, ()))
        for position, f in enumerate(df.schema.fields, start=1):
            key_position = key.index(f.name) + 1 if f.name in key else None
            rows.append((table, f.name, position, f.dataType.simpleString(), f.nullable, key_position))
    return spark.createDataFrame(rows, CATALOG)


def column_changes(planned: DataFrame, current: DataFrame) -> DataFrame:
    """Per table and column: kept, added, dropped or type_changed.

    An added name that differs from a dropped one only in the case of ASCII
    letters is the same column to the catalog, so both count as type_changed.
    """
    def side(df: DataFrame, name: str, other: str) -> DataFrame:
        return df.select(
            "table_name", "column_name", F.col("data_type").alias(name), F.lit(None).cast("string").alias(other)
        )

    both = side(planned, "planned_type", "current_type").unionByName(side(current, "current_type", "planned_type"))
    columns = both.groupBy("table_name", "column_name").agg(
        F.max("planned_type").alias("planned_type"), F.max("current_type").alias("current_type")
    )
    change = (
        F.when(F.col("current_type").isNull(), "added")
        .when(F.col("planned_type").isNull(), "dropped")
        .when(canonical_type("planned_type") == canonical_type("current_type"), "kept")
        .otherwise("type_changed")
    )
    named = columns.withColumn("change", change).withColumn("__folded", ascii_folded("column_name"))
    clash = (
        named.groupBy("table_name", "__folded")
        .agg(F.bool_or(F.col("change") == "added").alias("__a"), F.bool_or(F.col("change") == "dropped").alias("__d"))
        .filter("__a AND __d")
        .select("table_name", "__folded", F.lit(True).alias("__clash"))
    )
    return named.join(clash, ["table_name", "__folded"], "left").select(
        "table_name",
        "column_name",
        "planned_type",
        "current_type",
        F.when(F.col("__clash"), "type_changed").otherwise(F.col("change")).alias("change"),
        F.coalesce("__clash", F.lit(False)).alias("case_clash"),
    )


def order_after_change(changes: DataFrame, current: DataFrame, configured: DataFrame | None = None) -> DataFrame:
    """Column positions after the change: survivors in order, then added ones.

    Added columns follow ``configured`` (table_name, column_name, position) when
    given, and their names otherwise.
    """
    kept = changes.filter(F.col("planned_type").isNotNull())
    old = current.select("table_name", "column_name", F.col("position").alias("__old"))
    rows = kept.join(old, ["table_name", "column_name"], "left")
    if configured is None:
        rows = rows.withColumn("__new", F.lit(None).cast("int"))
    else:
        wanted = configured.select("table_name", "column_name", F.col("position").alias("__new"))
        rows = rows.join(wanted, ["table_name", "column_name"], "left")
    order = Window.partitionBy("table_name").orderBy(
        F.col("__old").asc_nulls_last(), F.col("__new").asc_nulls_last(), F.col("column_name")
    )
    return rows.select("table_name", "column_name", F.row_number().over(order).alias("position"))


def needs_rebuild(changes: DataFrame, current: DataFrame, contracts: DataFrame) -> DataFrame:
    """Tables whose change cannot be made in place, with the reasons.

    ``contracts`` has ``table_name``, ``planned_key``, ``current_key`` and
    ``planned_order`` arrays. A null planned key or order keeps the current one;
    a current key or order that is not known is no reason to rebuild.
    """
    by_table = changes.groupBy("table_name").agg(
        F.bool_or(F.col("change") == "type_changed").alias("type_changed"),
        F.collect_list(F.when(F.col("planned_type").isNull(), F.col("column_name"))).alias("__dropped"),
    )
    configured = contracts.filter(F.col("planned_order").isNotNull()).select(
        "table_name", F.posexplode("planned_order").alias("position", "column_name")
    )
    after = (
        order_after_change(changes, current, configured)
        .groupBy("table_name")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("position", "column_name"))), lambda e: e["column_name"]).alias("__after"))
    )
    known = current.select("table_name").distinct().withColumn("__known", F.lit(True))
    facts = contracts.join(by_table, "table_name").join(after, "table_name", "left").join(known, "table_name", "left")
    reasons = {
        "type_changed": F.col("type_changed"),
        "key_dropped": F.arrays_overlap(F.coalesce("current_key", F.array().cast("array<string>")), F.col("__dropped")),
        "key_changed": F.col("planned_key") != F.col("current_key"),
        "order_changed": F.col("__known") & F.col("planned_order").isNotNull() & ~F.col("planned_order").eqNullSafe(F.col("__after")),
    }
    listed = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in reasons.items()]), lambda r: r.isNotNull())
    return facts.select("table_name", listed.alias("reasons"), (F.size(listed) > 0).alias("needs_rebuild"))


def evolve(
    df: DataFrame, planned: T.StructType, key: Sequence[str] = (), ordered: bool = False
) -> DataFrame:
    """``df`` with the planned columns: new ones null, missing ones dropped, rows kept.

    Survivors keep their order. Added columns come in name order, or as planned
    when ``ordered``. A changed type, a name that changes only its ASCII case
    and a dropped key column are refused, because they need a rebuild.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in planned.fields}
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    added, dropped = [n for n in want if n not in have], [n for n in have if n not in want]
    changed = [n for n in have if n in want and have[n] != want[n]]
    respelled = {n.translate(lower) for n in added} & {n.translate(lower) for n in dropped}
    if changed or respelled:
        raise ValueError(f"column types cannot change in place: {sorted([*changed, *respelled])}")
    if set(dropped) & set(key):
        raise ValueError(f"key columns cannot be dropped: {sorted(set(dropped) & set(key))}")
    kept = [F.col(f"`{n}`") for n in have if n in want]
    new = [F.lit(None).cast(want[n]).alias(n) for n in (added if ordered else sorted(added))]
    return df.select(*kept, *new)


def rebuild_model(df: DataFrame, extra: Mapping[str, object]) -> DataFrame:
    """A model with extra literal columns in front. Its source is not touched."""
    return df.select(*[F.lit(v).alias(n) for n, v in extra.items()], "*")
