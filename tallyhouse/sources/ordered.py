"""A sorted copy of a table, from which page after page reads only the blocks it lies in."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.ordering import as_order
from tallyhouse.operators.ranking import in_order, place_numbers, total_order

BLOCK_ROWS = 1_000_000
POSITION, BLOCK = "__position", "__block"


class OrderedCopy:
    """Rows in a kept order below ``path``: ``rows`` by block of positions, ``groups`` by key, and ``about``, written last.

    The table is sorted once. A page is a range of positions, so it names its
    blocks, and no other file is opened. A copy without ``about`` was not
    finished and is not read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def write(self, df: DataFrame, order: Sequence, keys: Sequence[str] = (), block_rows: int = BLOCK_ROWS) -> OrderedCopy:
        """Sort ``df`` by ``keys`` and ``order``, with all its plain columns as tie break, and keep it in blocks.

        Sorting is by range, so neither a large key nor a frequent value is one
        task, and positions come from row counts per partition.
        """
        if block_rows < 1:
            raise ValueError("a block holds at least one row")
        taken = {c.lower() for c in df.columns} & {POSITION, BLOCK}
        if taken:
            raise ValueError(f"the copy needs the names {sorted(taken)}")
        by = [*[F.col(f"`{k}`").asc_nulls_first() for k in keys], *total_order(df, [as_order(k) for k in order])]
        numbered = place_numbers(in_order(df, by), POSITION)
        blocks = numbered.withColumn(BLOCK, F.expr(f"({POSITION} - 1) div {int(block_rows)}"))
        blocks.write.partitionBy(BLOCK).parquet(f"{self.path}/rows")
        rows = self.rows_of(df.schema)
        if keys:
            groups = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min(POSITION).alias("first"), F.count("*").alias("rows"))
            groups.repartitionByRange(*[F.col(f"`{k}`") for k in keys]).sortWithinPartitions(*keys).write.parquet(f"{self.path}/groups")
        said = rows.agg(F.lit(block_rows).cast("long").alias("block_rows"), F.count("*").alias("rows"), F.lit(df.schema.json()).alias("schema"))
        said.withColumn("keys", F.array(*[F.lit(k) for k in keys]).cast("array<string>")).write.parquet(f"{self.path}/about")
        return self

    def rows_of(self, schema: T.StructType) -> DataFrame:
        full = T.StructType([*schema.fields, T.StructField(POSITION, T.LongType()), T.StructField(BLOCK, T.LongType())])
        return self.spark.read.schema(full).parquet(f"{self.path}/rows")

    def about(self) -> tuple[int, T.StructType, list[str]]:
        row = self.spark.read.parquet(f"{self.path}/about").first()
        return row["block_rows"], T.StructType.fromJson(json.loads(row["schema"])), list(row["keys"])

    def between(self, first: int, last: int | None) -> DataFrame:
        """Rows at the positions ``first`` to ``last``, from 1, with their position."""
        size, schema, _ = self.about()
        low, high = F.lit((first - 1) // size), None if last is None else F.lit((last - 1) // size)
        at: Column = (F.col(BLOCK) >= low) & (F.col(POSITION) >= first)
        if last is not None:
            at = at & (F.col(BLOCK) <= high) & (F.col(POSITION) <= last)
        return self.rows_of(schema).filter(at).drop(BLOCK)

    def page(self, limit: int | None = None, offset: int | None = None) -> DataFrame:
        """Rows ``offset + 1`` to ``offset + limit`` in the kept order; without a limit all after ``offset``."""
        return self.window(1, None, limit, offset)

    def group_page(self, key: Sequence, limit: int | None = None, offset: int | None = None) -> DataFrame:
        """The page inside one key, of which a null is one like any other. An unknown key has no rows."""
        _, _, keys = self.about()
        if len(keys) != len(key):
            raise ValueError(f"the copy is grouped by {keys}")
        found = self.spark.read.parquet(f"{self.path}/groups") if keys else None
        if found is None:
            return self.page(limit, offset)
        for name, value in zip(keys, key):
            found = found.filter(F.col(f"`{name}`").isNull() if value is None else F.col(f"`{name}`") == F.lit(value))
        row = found.first()
        return self.window(1, 0, limit, offset) if row is None else self.window(row["first"], row["rows"], limit, offset)

    def window(self, first: int, rows: int | None, limit: int | None, offset: int | None) -> DataFrame:
        if (limit is not None and limit < 0) or (offset is not None and offset < 0):
            raise ValueError("limit and offset must not be negative")
        begin = first + (offset or 0)
        ends = [e for e in (None if rows is None else first + rows - 1, None if limit is None else begin + limit - 1) if e is not None]
        last = min(ends) if ends else None
        if last is not None and last < begin:
            return self.between(1, 1).limit(0).drop(POSITION)
        return self.between(begin, last).orderBy(POSITION).drop(POSITION)
