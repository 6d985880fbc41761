"""Total orders, pages and newest-first listings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.ranking import SHORT_PREFIX, numbered_rows, total_order

# Rows returned when no limit is given.
NEWEST_RUNS = 50
LAST_LOG_LINES = 100


def as_order(key: str | Column | tuple[str, bool], nulls: str = "last") -> Column:
    """A sort column. ``(name, True)`` means descending."""
    if isinstance(key, Column):
        return key
    name, descending = key if isinstance(key, tuple) else (key, False)
    column = F.col(f"`{name}`")
    if descending:
        return column.desc_nulls_last() if nulls == "last" else column.desc_nulls_first()
    return column.asc_nulls_last() if nulls == "last" else column.asc_nulls_first()


def page(df: DataFrame, order: Sequence, limit: int | None = None, offset: int | None = None) -> DataFrame:
    """Rows in ``order``, cut to a window. Rows that tie are ordered by their other columns.

    A short window is a top-k, in which each task keeps ``limit + offset`` rows.
    A deep window is cut from exact row numbers, so no task holds the skipped
    rows. Without a window it is a distributed sort.
    """
    if (limit is not None and limit < 0) or (offset is not None and offset < 0):
        raise ValueError("limit and offset must not be negative")
    by = total_order(df, [as_order(k) for k in order])
    skip = offset or 0
    if limit == 0:
        return df.limit(0)
    if limit is None and skip == 0:
        return df.orderBy(*by)
    if limit is not None and limit + skip <= SHORT_PREFIX:
        return df.orderBy(*by).offset(skip).limit(limit)
    rows = numbered_rows(df, [], by, "__rn").filter(F.col("__rn") > skip)
    if limit is not None:
        rows = rows.filter(F.col("__rn") <= skip + limit)
    return rows.orderBy("__rn").drop("__rn")


def order_by_all(df: DataFrame, limit: int | None = None, offset: int | None = None) -> DataFrame:
    """Order by every column, left to right, nulls last."""
    return page(df, df.columns, limit, offset)


def canonical_json(df: DataFrame) -> Column:
    """One JSON text per row with its columns in name order."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"})


def stable_sort(df: DataFrame, keys: Sequence[str | tuple[str, bool]]) -> DataFrame:
    """Sort that never depends on input order.

    Candidate keys the rows lack are skipped. Ascending keys put nulls first,
    numbers sort as numbers and text by code point. Rows that tie are ordered by
    their JSON, which also lets the sort split a heavy key.
    """
    by = []
    for key in keys:
        name, descending = key if isinstance(key, tuple) else (key, False)
        if name not in df.columns:
            continue
        value = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(F.struct(value.alias("v")))
        by.append(value.desc_nulls_last() if descending else value.asc_nulls_first())
    return df.orderBy(*by, canonical_json(df))


def newest_runs(
    runs: DataFrame, limit: int = NEWEST_RUNS, offset: int = 0, order: Sequence = (("run_number", True),)
) -> DataFrame:
    """Runs newest first. Without a limit, the newest fifty."""
    return page(runs, order, limit, offset)


def log_window(
    lines: DataFrame,
    limit: int | None = None,
    offset: int | None = None,
    order: str = "asc",
    position: str = "line_number",
    ties: Sequence[str] = (),
) -> DataFrame:
    """A window of log lines, always returned in ascending order.

    ``order`` names the end that ``limit`` and ``offset`` count from. Without a
    limit it is the last hundred lines, and an offset skips within those.
    """
    if order not in ("asc", "desc"):
        raise ValueError("order must be asc or desc")
    ascending = [position, *ties]
    backwards = [(c, True) for c in ascending]
    if limit is None:
        tail = page(lines, backwards, LAST_LOG_LINES)
        return page(tail, ascending, LAST_LOG_LINES, offset)
    window = page(lines, ascending if order == "asc" else backwards, limit, offset)
    return window.orderBy(*[as_order(c) for c in ascending])


def object_key(kind: str = "type", name: str = "name") -> Column:
    """Sort key of a file listing: a folder sorts as its name plus a slash."""
    return F.when(F.col(kind) == "folder", F.concat(F.col(name), F.lit("/"))).otherwise(F.col(name))


def order_object_keys(df: DataFrame, limit: int | None = None, offset: int | None = None) -> DataFrame:
    return page(df, [object_key().asc_nulls_last()], limit, offset)


def order_folded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Order ignoring letter case; the exact spelling breaks ties."""
    by: list[Column] = []
    for c in columns:
        by += [F.lower(c).asc_nulls_last(), F.col(c).asc_nulls_last()]
    return df.orderBy(*by)


def by_field(field: str) -> Callable[[Column, Column], Column]:
    """Comparator of two array elements by one of their fields."""
    return lambda a, b: F.when(a[field] < b[field], -1).when(a[field] > b[field], 1).otherwise(0)


def sort_nested(
    df: DataFrame, order: Sequence[str], structs: dict[str, str] | None = None, lists: Sequence[str] = ()
) -> DataFrame:
    """Sort the rows, array-of-struct columns by one field, and plain arrays.

    ``structs`` maps a column to the field that orders its elements.
    """
    out = df
    for column, field in (structs or {}).items():
        out = out.withColumn(column, F.array_sort(column, by_field(field)))
    for column in lists:
        out = out.withColumn(column, F.sort_array(column))
    return out.orderBy(*[as_order(c, "first") for c in order])


def first_by_name(df: DataFrame, name: str = "name", kind: str | None = None, value: str | None = None) -> DataFrame:
    """The first row in name order, optionally of one kind (any letter case)."""
    rows = df if kind is None else df.filter(F.upper(kind) == F.upper(F.lit(value)))
    return page(rows, [name], 1)
