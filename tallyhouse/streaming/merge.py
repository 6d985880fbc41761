"""Upserting a stream into a versioned table."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.ranking import latest_revision
from tallyhouse.sources.tables import BUCKETS, VersionedTable, bucket_of, in_buckets, layout_of, schema_of

# A bucket of more parts than this is folded into one before it is read on.
MOST_PARTS = 16


def newest_rows(table: VersionedTable, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest revision per key over all parts of the table."""
    return latest_revision(table.read(), keys, order)


def crowded(table: VersionedTable, most_parts: int) -> list[int]:
    """Buckets with more parts than that; the log alone tells."""
    parts = Counter(bucket_of(p) for p in table.entry()["paths"])
    return sorted(b for b, n in parts.items() if b is not None and n > most_parts)


def fold(table: VersionedTable, keys: Sequence[str], order: Sequence[str], buckets: Iterable[int] | None = None) -> int:
    """Rewrite buckets, by default all, as one part each that holds every key once. The others keep their parts."""
    entry = table.entry()
    layout, schema, paths = layout_of(entry), schema_of(entry), entry["paths"]
    folded = paths if layout is None or buckets is None else in_buckets(paths, set(buckets))
    staged = table.stage(latest_revision(table.rows_of(folded, schema), keys, order), layout)
    rewritten = set(folded)
    return table.commit([*[p for p in paths if p not in rewritten], *staged], schema, "fold", entry["version"])


def stream_merge(
    stream: DataFrame,
    table: VersionedTable,
    keys: Sequence[str],
    order: Sequence[str],
    progress: str,
    most_parts: int = MOST_PARTS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Merge what is there now, batch by batch, and return the newest row per key.

    The table is laid out by key. A batch is reduced to its newest rows and
    appended to its buckets, so its cost does not grow with the table;
    superseded rows go when the parts of a bucket are folded, which leaves the
    other buckets alone. Revisions decide, so a batch that arrives twice or
    late changes nothing. A batch that was committed before a failure is
    recognised by its note and skipped.
    """
    entry = table.entry()
    if entry is None:
        table.create(stream.schema, keys, buckets)
    elif layout_of(entry) is None:
        table.lay_out(keys, buckets)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        note = f"{progress}#{batch_id}"
        if not table.log().filter(F.col("note") == note).isEmpty():
            return
        table.append(latest_revision(batch, keys, order), note)
        full = crowded(table, most_parts)
        if full:
            fold(table, keys, order, full)

    query = (
        stream.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return newest_rows(table, keys, order)
