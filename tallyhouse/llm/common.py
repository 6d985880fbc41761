"""Helpers shared by the operators: shared storage, typed empty input, batches."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.settings import cut_lineage, scratch_path

__all__ = ["cut_lineage", "documents", "fresh", "map_batches", "scratch_path", "slices", "table"]
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the text alone, so that further columns of any name do no harm."""
    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str
) -> DataFrame:
    """``mapInArrow`` whose workers look for this package where the driver has found it, besides their own path.

    A worker gives free memory back when a task ends, since it lives on and
    the next task may run beside it in another worker.
    """
    env = df.sparkSession.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [known, ROOT]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    from tallyhouse.llm import words

    words.forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def slices(batches: Iterator[pa.RecordBatch], column: int | str, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of the batches, cut after ``limit`` bytes of a text column.

    A row longer than that is a slice of its own; no row is cut or left out.
    """
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes.astype(np.int64))
        lo = 0
        while lo < batch.num_rows:
            start = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, start + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi
