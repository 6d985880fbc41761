"""Run logs with an index of trigrams, so that a marker search reads few lines.

Lines lie in a table laid out by run. Beside it an index keeps, per run, its
line count and a bitmap of the hashed trigrams of its lines. A run whose bitmap
lacks a trigram of the marker cannot hold it; the lines of the others are read
from their buckets and searched exactly. Trigrams are hashed in numpy, a block
of lines at a time; Spark deals the lines and brings the bitmaps of a run together.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.joins import sized_join
from tallyhouse.operators.usage import log_matches
from tallyhouse.settings import cut_lineage
from tallyhouse.sources.tables import BUCKETS, VersionedTable, changed_folders, merge_into, rows_with_keys, schema_of

#: Bits of a run's bitmap, which is the size that the bitmap aggregates have.
SLOTS = 32_768
GRAM = 3
#: Lines whose bitmaps a task fills at once, and the most bytes of them.
BLOCK = 512
BLOCK_BYTES = 4_000_000
#: What the index notes of its lines. An index of another hash has another note and is made anew.
NOTE = "trigrams@"


def line_slots(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The slots of all trigrams of some lines, and beside each the place of its line.

    The bytes of the lines are cut into characters at once, in numpy. Bytes
    that belong to no character are passed over.
    """
    lines = pc.fill_null(lines.cast(pa.large_binary()), b"")
    ends = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
    data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    if len(starts) < GRAM:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first, padded = data[starts], np.append(data, np.zeros(3, np.uint8))
    chars = first.astype(np.uint32)
    for place, least in enumerate((0xC0, 0xE0, 0xF0), 1):
        long = np.flatnonzero(first >= least)
        chars[long] |= padded[starts[long] + place].astype(np.uint32) << np.uint32(8 * place)
    line = np.repeat(np.arange(len(lines)), np.diff(np.searchsorted(starts, ends - ends[0])))
    grams = chars[:-2] * np.uint32(0x9E3779B1) + chars[1:-1] * np.uint32(0x85EBCA77) + chars[2:] * np.uint32(0xC2B2AE3D)
    grams = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    slots = (grams ^ (grams >> np.uint32(16))) % np.uint32(SLOTS)
    inside = line[:-2] == line[2:]
    return line[:-2][inside], slots[inside].astype(np.int64)


def gram_slots(text: str | Column) -> Column:
    """The distinct slots of the trigrams of a text, none if it is shorter."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def slots(texts: pa.Array) -> pa.Array:
        line, slot = line_slots(texts)
        pairs = np.unique(line * SLOTS + slot)
        ends = np.searchsorted(pairs, np.arange(len(texts) + 1) * SLOTS)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pairs % SLOTS, pa.int32()))

    return slots(F.col(text) if isinstance(text, str) else text)


def line_blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch cut after ``BLOCK`` lines, or before if they are long. A very long line is a block of its own."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("line")), 0).to_numpy().astype(np.int64))
    start = 0
    while start < batch.num_rows:
        full = np.searchsorted(size, (size[start - 1] if start else 0) + BLOCK_BYTES, side="right")
        end = max(start + 1, min(int(full), start + BLOCK))
        yield batch.slice(start, end - start)
        start = end


def run_bitmaps(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys..., line_count, grams``: per run its lines and the bitmap of their trigrams.

    Tasks fill bitmaps for blocks of lines, so no row per trigram is made; those of one run meet in an aggregate of fixed size.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in line_blocks(whole):
                code = np.zeros(batch.num_rows, np.int64)
                for k in keys:
                    named = batch.column(k).dictionary_encode(null_encoding="encode")
                    code = np.unique(code, return_inverse=True)[1] * len(named.dictionary) + named.indices.to_numpy()
                _, one, run, count = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
                line, slot = line_slots(batch.column("line"))
                bits = np.zeros((len(one), SLOTS), bool)
                bits[run[line], slot] = True
                grams = pa.array([g.tobytes() for g in np.packbits(bits, axis=1, bitorder="little")], pa.binary())
                found = [batch.column(k).take(pa.array(one)) for k in keys]
                yield pa.RecordBatch.from_arrays([*found, pa.array(count, pa.int64()), grams], [*keys, "line_count", "grams"])

    fields = [lines.schema[k] for k in keys]
    schema = T.StructType([*fields, T.StructField("line_count", T.LongType()), T.StructField("grams", T.BinaryType())])
    return merged_bitmaps(lines.select(*keys, "line").mapInArrow(fill, schema), keys)


def merged_bitmaps(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per run from several."""
    return rows.groupBy(*keys).agg(F.sum("line_count").alias("line_count"), F.bitmap_or_agg("grams").alias("grams"))


def has_bits(bitmap: str, slots: Sequence[int]) -> Column:
    """Whether a bitmap has all of these bits."""
    every = F.lit(True)
    for slot in slots:
        byte = F.conv(F.hex(F.substring(F.col(bitmap), slot // 8 + 1, 1)), 16, 10).cast("int")
        every = every & (F.shiftright(byte, slot % 8).bitwiseAND(F.lit(1)) == 1)
    return every


class LogStore:
    """Lines ``keys..., line`` below a path. Keys are never null."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = ("job_id", "run_number")):
        self.spark, self.keys = spark, list(keys)
        self.lines = VersionedTable(spark, f"{path.rstrip('/')}/lines")
        self.index = VersionedTable(spark, f"{path.rstrip('/')}/index")

    def add(self, logs: DataFrame, buckets: int = BUCKETS) -> int:
        """Append lines and bring the index up to them. Lines of a run may come in several batches."""
        logs = logs.select(*self.keys, "line")
        if self.lines.entry() is None:
            self.lines.create(logs.schema, self.keys, buckets)
        self.lines.append(logs)
        return self.catch_up(buckets)

    def indexed(self) -> int:
        """The version of the lines that the index covers."""
        entry = self.index.entry()
        return 0 if entry is None or not entry["note"].startswith(NOTE) else int(entry["note"].removeprefix(NOTE))

    def catch_up(self, buckets: int = BUCKETS) -> int:
        """Index what was appended since the index was written, also where a job failed between the two tables."""
        done, target = self.indexed(), self.lines.version()
        if done == target:
            return target
        new = self.lines.read(target) if not done else self.lines.rows_of(changed_folders(self.lines, done, target)[1], schema_of(self.lines.entry(target)))
        fresh = run_bitmaps(new, self.keys)
        if done:
            fresh = cut_lineage(fresh)
            fresh = merged_bitmaps(fresh.unionByName(rows_with_keys(self.index, fresh.select(*self.keys))), self.keys)
        fresh = cut_lineage(fresh)
        merge_into(self.index, fresh, self.keys, note=f"{NOTE}{target}", buckets=buckets)
        return target

    def candidates(self, marker: str) -> DataFrame:
        """Runs that may hold the marker. One of fewer than three characters rules no run out."""
        slots = self.spark.range(1).select(gram_slots(F.lit(marker)).alias("s")).first()["s"]
        return self.index.read().filter(has_bits("grams", slots)).select(*self.keys, "line_count")

    def search(self, marker: str) -> DataFrame:
        """Line count and matches of every run: what ``log_matches`` gives for all lines, from the lines of candidates."""
        target = self.indexed()
        if not target:
            raise LookupError("no lines were indexed")
        wanted = cut_lineage(self.candidates(marker).select(*self.keys))
        found = log_matches(rows_with_keys(self.lines, wanted, target), marker, self.keys).drop("line_count")
        runs = self.index.read().select(*self.keys, "line_count")
        counted = sized_join(runs, found, self.keys, "left")
        return counted.select(
            *self.keys, "line_count", F.coalesce("matches", F.lit(0)).alias("matches"), F.coalesce("has_marker", F.lit(False)).alias("has_marker")
        )
