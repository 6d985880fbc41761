"""A table change from planned columns to rewritten rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyhouse.operators.checks import not_null_violations
from tallyhouse.operators.shapes import column_catalog, column_changes, evolve
from tallyhouse.sources.tables import VersionedTable


def planned_changes(table: VersionedTable, name: str, planned: T.StructType) -> DataFrame:
    """What the planned columns would change, one row per column."""
    spark = table.spark
    current = column_catalog(spark, {name: table.read()})
    wanted = column_catalog(spark, {name: spark.createDataFrame([], planned)})
    return column_changes(wanted, current)


def change_table(
    table: VersionedTable, planned: T.StructType, key: Sequence[str] = (), not_null: Sequence[str] = ()
) -> DataFrame:
    """Add and drop columns in a new version of the table. Rows are kept.

    A column that must not be null is checked on the new rows before they are
    published.
    """
    rows = evolve(table.read(), planned, key)
    staged = table.stage(rows)
    written = table.rows_of(staged, rows.schema)
    if not_null:
        broken = {r["column_name"]: r["violations"] for r in not_null_violations(written, not_null).collect()}
        if any(broken.values()):
            raise ValueError(f"columns hold nulls: {sorted(c for c, n in broken.items() if n)}")
    return table.read(table.commit(staged, rows.schema, "change"))
