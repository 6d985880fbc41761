"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into phrases, each the shortest piece not yet in its
dictionary; texts that compress well together share phrases. The phrases are
hashed and the least hashes kept, so that two signatures estimate which share
of the phrases of both texts is common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import map_batches
from tallyhouse.llm.words import BYTE_BASE, BYTE_VALUES, span_hashes

#: Hashes in a signature, of 32 bits each.
KEPT = 192
#: Code points that share a dictionary; each further block of a text begins with an empty one, which bounds it.
BLOCK = 1 << 20
#: A range of neighbouring documents holds about this many bytes of text; there are at most so many ranges.
RANGE_BYTES, MOST_RANGES = 64 << 20, 1 << 14
LOWEST = -(2**63)


@dataclass
class Parse:
    """The state of a parse: phrases of the current block, the unfinished one, code points read, and hashes of earlier blocks."""

    phrases: set[str] = field(default_factory=set)
    open: str = ""
    read: int = 0
    least: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))

    def copy(self) -> Parse:
        return Parse(self.phrases.copy(), self.open, self.read, self.least)

    def feed(self, text: str) -> Parse:
        at = 0
        while at < len(text):
            step = min(len(text) - at, BLOCK - self.read % BLOCK)
            self._block(text[at : at + step] if step < len(text) else text)
            at += step
            self.read += step
            if self.read % BLOCK == 0:
                self.least, self.phrases, self.open = self.signature(), set(), ""
        return self

    def _block(self, text: str) -> None:
        known, add, phrase = self.phrases, self.phrases.add, self.open
        for c in text:
            phrase += c
            if phrase not in known:
                add(phrase)
                phrase = ""
        self.open = phrase

    def signature(self) -> np.ndarray:
        """The ``KEPT`` least hashes of all phrases so far, in order."""
        return np.unique(np.concatenate([self.least, phrase_hashes(list(self.phrases))]))[:KEPT]


def phrase_hashes(phrases: list[str]) -> np.ndarray:
    """A 32-bit hash of each phrase."""
    if not phrases:
        return np.zeros(0, np.uint32)
    column = pa.array(phrases, pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[: len(phrases) + 1]
    values = BYTE_VALUES[np.frombuffer(data, np.uint8)[: at[-1]]]
    return (span_hashes(values, at[:-1], at[1:], BYTE_BASE) >> np.uint64(32)).astype(np.uint32)


def signature(text: str) -> np.ndarray:
    return Parse().feed(text).signature()


def shown(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Of the least hashes of both signatures together, the share that both have; 1 for two empty ones.

    Signatures of fewer than ``KEPT`` hashes hold all of them, and the result
    is then exact but for equal hashes.
    """
    every = np.concatenate([a, b])
    if not len(every):
        return 1.0
    every.sort()
    twice = np.append(every[1:] == every[:-1], False)
    new = np.concatenate([[True], ~twice[:-1]])
    if len(a) == KEPT or len(b) == KEPT:  # beyond the end of a full signature nothing is known of its text
        kept = np.flatnonzero(new)[:KEPT]
    else:
        kept = np.flatnonzero(new)
    return float(np.count_nonzero(twice[kept]) / len(kept))


@dataclass
class Document:
    """A text, the parse of the part of it that an edit leaves, and its signature."""

    doc_id: int | None
    text: str
    cut: int
    head: Parse
    signature: np.ndarray

    @classmethod
    def of(cls, doc_id: int | None, text: str) -> Document:
        cut = len(text) - len(text) // 2
        head = Parse().feed(text[:cut])
        return cls(doc_id, text, cut, head, head.copy().feed(text[cut:]).signature())

    def beside(self, following: Document) -> tuple:
        part = following.text[: len(self.text) - self.cut]
        edited = self.head.feed(part).signature()
        digest = hashlib.sha256((self.text[: self.cut] + part).encode()).hexdigest()
        return (self.doc_id, len(self.text), digest, shown(self.signature), shown(edited), likeness(self.signature, edited), likeness(self.signature, following.signature))


MADE = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order, after them copies of the row that follows the range. One document is held besides the current one."""
    held, follows, made, size = None, False, [], 0
    for batch in batches:
        for doc_id, text, copy in zip(*(batch.column(i) for i in range(3))):
            if follows:
                continue
            current = Document.of(doc_id.as_py(), text.as_py() or "")
            follows = copy.as_py()
            if held is not None:
                made.append(held.beside(current))
                size += 1
            held = current
            if size == 256:
                yield pa.RecordBatch.from_pylist([dict(zip(MADE.names, m)) for m in made], MADE)
                made, size = [], 0
    if made:
        yield pa.RecordBatch.from_pylist([dict(zip(MADE.names, m)) for m in made], MADE)


def _range_of(bounds: list[int]):
    """The range of a key in descending order of keys, by binary search; only keys travel to the workers."""

    @F.arrow_udf("int")
    def place(keys: pa.Array) -> pa.Array:
        found = np.searchsorted(np.array(bounds, np.int64), keys.to_numpy(zero_copy_only=False), side="left")
        return pa.array(len(bounds) - found, pa.int32())

    return place


def with_next(docs: DataFrame) -> DataFrame:
    """Documents in ranges, sorted by descending id; the row that follows a range is in it too, last and marked ``copy``.

    Bounds of the ranges are quantiles of the ids; the driver gets one number
    per range. Each text travels once, and the first of a range a second time.
    """
    key = F.coalesce("doc_id", F.lit(LOWEST))
    docs = docs.withColumn("key", key)
    count, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, min(count, MOST_RANGES, max(parallel, (size or 0) // RANGE_BYTES)))
    bounds = []
    if ranges > 1:
        quantiles = [i / ranges for i in range(1, ranges)]
        bounds = sorted(set(docs.agg(F.percentile_approx("key", quantiles, 16 * ranges)).first()[0]))
    place = _range_of(bounds)
    heads = sorted(map(tuple, docs.select(place("key").alias("place"), "key").groupBy("place").agg(F.max("key")).collect()))
    before = {key: heads[i - 1][0] for i, (_, key) in enumerate(heads)}  # the first range follows the last

    @F.arrow_udf("int")
    def earlier(keys: pa.Array) -> pa.Array:
        return pa.array([before.get(k) for k in keys.to_pylist()], pa.int32())

    own = F.struct(place("key").alias("place"), F.lit(False).alias("copy"))
    also = F.struct(earlier("key").alias("place"), F.lit(True).alias("copy"))
    dealt = docs.withColumn("own", own).withColumn("also", also).withColumn("to", F.explode(F.when(F.col("also.place").isNull(), F.array("own")).otherwise(F.array("own", "also"))))
    rows = dealt.select("doc_id", "text", F.col("to.copy").alias("copy"), F.col("to.place").alias("place"), "key")
    parts = max(1, len(heads))
    sorted_rows = rows.repartitionByRange(parts, "place").sortWithinPartitions("place", "copy", F.desc("key"), F.isnull("doc_id"), "text")
    return sorted_rows.select("doc_id", "text", "copy", "place")


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task may get several ranges; each is taken for itself."""
    current, held = None, []

    def pieces() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            places = batch.column(3).to_numpy()
            cuts = np.flatnonzero(np.diff(places)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if hi > lo:
                    yield int(places[lo]), batch.slice(lo, hi - lo)

    stream = pieces()
    pending = next(stream, None)
    while pending is not None:
        current, held = pending[0], [pending[1]]

        def of_range() -> Iterator[pa.RecordBatch]:
            nonlocal pending
            yield held.pop()
            for place, piece in stream:
                if place != current:
                    pending = (place, piece)
                    return
                yield piece
            pending = None

        yield from _neighbours(of_range())


def phrase_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row its fingerprint, that of its edited text, and how alike its own is to that and to the next row's.

    The edited text has its later half, rounded down, replaced by as much of
    the next row's text from its start. Next is the next lower id; after the
    lowest comes the highest. Rows of one id follow each other by text, null
    ids come last, a single row is its own next. Null texts are empty; an
    empty text has an empty fingerprint. Equal texts have equal fingerprints.
    Texts are parsed whole, block by block; other columns are not read.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(with_next(rows), _by_range, SCHEMA)
