"""Latest rows, match counts, deltas and pages inside a key.

``row_number() <= n`` filters keep at most ``n`` rows per key in every task
before the shuffle, so one heavy key does not fill one task. Anything that has
to number all rows of a key goes through :func:`numbered_rows`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.joins import same
from tallyhouse.settings import cut_lineage

# Up to this many leading rows per key the plan keeps a bounded prefix per task.
SHORT_PREFIX = 1_000


def latest_revision(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key. Rows without a key or revision are dropped."""
    required = [F.col(c).isNotNull() for c in (*keys, *order)]
    present = df
    for condition in required:
        present = present.filter(condition)
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return present.withColumn("__rn", F.row_number().over(newest)).filter("__rn = 1").drop("__rn")


def current_version(versions: DataFrame, object_id: str, version: str = "version") -> DataFrame:
    """The highest version number of each object."""
    return latest_revision(versions, [object_id], [version])


def latest_storage(history: DataFrame) -> DataFrame:
    """The newest storage computation of each database."""
    return latest_revision(history, ["database_id"], ["computed_ts"])


def with_match_count(df: DataFrame, keys: Sequence[str], name: str = "match_count") -> DataFrame:
    """Each row beside the number of rows that share its keys. Null is a key like any other.

    Counts combine on the map side and are joined back. No row has to meet the
    others of its key, so adaptive execution may split a heavy key.
    """
    renamed = {k: f"__k{i}" for i, k in enumerate(keys)}
    counts = df.groupBy(*[F.col(k).alias(r) for k, r in renamed.items()]).agg(F.count("*").alias(name))
    on = [same(F.col(k), F.col(r)) for k, r in renamed.items()]
    return df.join(counts, on, "left").select(*df.columns, name)


def numbered_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "row_number"
) -> DataFrame:
    """Exact ``row_number`` per key for keys of any size and number.

    Rows are range partitioned over key and order, so a large key spans many
    tasks, and numbered from their place.
    """
    by_key = [F.col(k).asc_nulls_first() for k in keys]
    return place_numbers(in_order(df, [*by_key, *total_order(df, order)]), name, keys)


def total_order(df: DataFrame, order: Sequence[Column]) -> list[Column]:
    """``order`` and after it every plain column, so that only equal rows tie."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    return [*order, *[F.col(f"`{c}`").asc_nulls_first() for c in plain]]


def in_order(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows range partitioned and sorted, and materialised so that places are fixed."""
    return cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))


def with_places(placed: DataFrame) -> DataFrame:
    return placed.withColumn("__part", F.spark_partition_id()).withColumn("__pos", F.monotonically_increasing_id())


def end_rows(marked: DataFrame, which: str, *columns: Column) -> DataFrame:
    """The ``first`` or ``last`` row of each partition: one row per partition, so it may be broadcast."""
    at = F.min("__pos") if which == "first" else F.max("__pos")
    ends = marked.groupBy(F.col("__part").alias("__p")).agg(at.alias("__end"))
    found = marked.join(F.broadcast(ends), (F.col("__part") == F.col("__p")) & (F.col("__pos") == F.col("__end")))
    return found.select("__p", *columns)


def place_numbers(
    placed: DataFrame, name: str = "row_number", keys: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Number rows that are materialised in order, per key; or add up ``weight`` instead.

    ``placed`` must come from :func:`cut_lineage`, so that partition numbers and
    row order are the same each time it is read. Rows are numbered inside their
    partition. Only the first key of a partition can have rows before it, in
    partitions that end with the same key, so the table of what lies ahead has
    one row per partition and is broadcast.
    """
    marked = with_places(placed)
    size = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    key = F.struct(*(F.col(f"`{k}`") for k in keys)) if keys else F.struct(F.lit(0).alias("all"))
    first, last = (end_rows(marked, which, key.alias("__key")) for which in ("first", "last"))
    tail = (
        marked.join(F.broadcast(last), (F.col("__part") == F.col("__p")) & same(key, F.col("__key")))
        .groupBy("__p", "__key")
        .agg(F.sum(size).alias("__n"))
    )
    flow = first.select("__p", "__key", F.lit(0).cast("bigint").alias("__n"), F.lit(0).alias("__at")).unionByName(
        tail.withColumn("__at", F.lit(1))
    )
    ahead = (
        flow.withColumn("__ahead", F.sum("__n").over(Window.partitionBy("__key").orderBy("__p", "__at")))
        .filter("__at = 0")
        .select("__p", "__key", "__ahead")
    )
    if keys or weight:
        inside = Window.partitionBy("__part", *keys).orderBy("__pos")
        counted = F.row_number().over(inside) if weight is None else F.sum(size).over(inside)
        local = marked.withColumn("__local", counted)
    else:  # a place in the partition is the number itself
        begin = end_rows(marked, "first", F.col("__pos").alias("__begin")).withColumnRenamed("__p", "__b")
        local = marked.join(F.broadcast(begin), F.col("__part") == F.col("__b")).withColumn(
            "__local", F.col("__pos") - F.col("__begin") + 1
        )
    behind = F.when(same(key, F.col("__key")), F.col("__ahead")).otherwise(F.lit(0))
    return (
        local.join(F.broadcast(ahead), F.col("__part") == F.col("__p"))
        .withColumn(name, (F.col("__local") + behind).cast("bigint"))
        .select(*placed.columns, name)
    )


def in_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int) -> DataFrame:
    """Rows with the ``part`` of their key's ordered list that they belong to, ``size`` rows each.

    A list built per key and part is bounded, and the parts in order are the whole list.
    """
    ranked = numbered_rows(df, keys, [F.col(c) for c in order], "__rn")
    return ranked.withColumn("part", F.expr(f"(__rn - 1) div {int(size)}")).drop("__rn")


def page_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int, offset: int = 0
) -> DataFrame:
    """Rows ``offset + 1`` to ``offset + limit`` of every key; ties are ordered by the other columns."""
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must not be negative")
    if limit == 0:
        return df.limit(0)
    if limit + offset <= SHORT_PREFIX:
        position = Window.partitionBy(*keys).orderBy(*total_order(df, order))
        ranked = df.withColumn("__rn", F.row_number().over(position)).filter(F.col("__rn") <= limit + offset)
    else:
        ranked = numbered_rows(df, keys, order, "__rn").filter(F.col("__rn") <= limit + offset)
    return ranked.filter(F.col("__rn") > offset).drop("__rn")


def storage_growth(
    history: DataFrame, key: str = "database_id", at: str = "computed_ts", measure: str = "active_bytes"
) -> DataFrame:
    """Change of ``measure`` since the previous computation of the same key.

    Unknown times come first; rows of one time are ordered by the measure, then
    by the other columns. Rows are range partitioned over key and time, so a
    long history spans many tasks: the first row of a partition takes its
    predecessor from the last row of the partition before.
    """
    previous = f"previous_{measure}"
    order = total_order(history, [F.col(c).asc_nulls_first() for c in (key, at, measure)])
    marked = with_places(in_order(history, order))
    last = end_rows(marked, "last", F.col(key).alias("__k"), F.col(measure).alias("__v"))
    # One row per partition. The first partition with rows has none before it.
    carry = F.lag(F.struct("__k", "__v")).over(Window.orderBy("__p"))
    before = last.select("__p", carry.alias("__before"))
    inside = Window.partitionBy("__part", key).orderBy("__pos")
    continued = F.col("__before").isNotNull() & same(F.col("__before.__k"), F.col(key))
    value = F.when(F.col("__rn") > 1, F.col("__lag")).when(continued, F.col("__before.__v"))
    rows = (
        marked.withColumn("__rn", F.row_number().over(inside))
        .withColumn("__lag", F.lag(measure).over(inside))
        .join(F.broadcast(before), F.col("__part") == F.col("__p"))
        .select(*history.columns, value.alias(previous))
    )
    return rows.withColumn("growth", F.col(measure) - F.col(previous))
