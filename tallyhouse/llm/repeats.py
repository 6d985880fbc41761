"""Substring dedup: a count-min sketch before repeated windows are grouped exactly.

Of the short n-grams inside a window the one of least hash is its anchor, so
equal windows have equal anchors at different places. Anchors are few, and the
sketch counts them. Only windows whose anchor is estimated to occur twice or
more are grouped; an estimate is never too low, so none is lost.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import documents, map_batches, slices
from tallyhouse.llm.words import WORD_BASE, Words, mix, powers, words_in, words_of

WINDOW, ANCHOR = 35, 8
#: Texts are packed into units of this many bytes; a longer text is a unit of its own.
UNIT_BYTES = 2 << 20
#: The sketch: rows, and cells per row as a power of two. Its size bounds what is broadcast: ROWS * 2**CELL_BITS bits.
ROWS, CELL_BITS = 2, 27
BLOCK = 32_768
#: Sketch cells that a task holds before it passes them on.
HELD_CELLS = 1 << 21
#: Windows are dealt to buckets of about this many.
BUCKET_WINDOWS = 1 << 20
SECOND_BASE = 0xA24BAED4963EE407


def _rolling(values: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hashes of all runs of ``size`` values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(base, len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[size:] - total[:-size]) * down[:n])


def anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` n-grams the place of the least one, the leftmost of equal ones."""
    value, at = grams, np.arange(len(grams))
    width = 1
    while width < span:
        step = min(width, span - width)
        if len(value) <= step:
            return np.zeros(0, np.int64)
        right = value[step:] < value[:-step]
        value, at = np.where(right, value[step:], value[:-step]), np.where(right, at[step:], at[:-step])
        width += step
    return at


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The sketch cell of each anchor in one row; rows follow each other."""
    salt = np.uint64((row + 1) * 0x632BE59BD9B4E019 % 2**64)
    return (mix(hashes ^ salt) >> np.uint64(64 - bits)).astype(np.int64) + (row << bits)


class Windows:
    """The windows of some texts, with the places and hashes of their anchors."""

    def __init__(self, words: Words, window: int, anchor: int):
        self.words = words
        self.hashes = words.hashes()
        self.starts = words.windows(window)
        anchor = min(anchor, window)
        grams = _rolling(self.hashes, anchor, WORD_BASE)
        at = anchors(grams, window - anchor + 1)
        self.places, self.anchor_of = np.unique(at[self.starts], return_inverse=True) if len(self.starts) else (np.zeros(0, np.int64),) * 2
        self.grams = grams[self.places]

    def asked(self, sketch: np.ndarray, bits: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows that the sketch estimates to be repeated: two hashes of each distinct one, in
        order; their starts; which distinct one each is; and how often each occurs here."""
        often = np.ones(len(self.grams), bool)
        for row in range(ROWS):
            cell = cells(self.grams, row, bits)
            often &= (sketch[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
        starts = self.starts[often[self.anchor_of]] if len(self.starts) else self.starts
        first, second = _rolling(self.hashes, window, WORD_BASE)[starts], _rolling(self.hashes, window, SECOND_BASE)[starts]
        second = second.astype(np.uint32)
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(a)]
        which = np.empty(len(a), np.int64)
        which[order] = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        return np.stack([a[heads], b[heads].astype(np.uint64)]), starts, which, np.diff(np.append(heads, len(a)))


def sketch(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, bits: int = CELL_BITS) -> tuple[np.ndarray, int]:
    """The merged sketch of all texts as one bit per cell, set if its count is two or more; and the number of anchors.

    Each task counts its own anchors; the cells of all tasks are added up. The
    driver gets at most ``ROWS * 2**bits`` bits, however large the corpus is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted(found: list[np.ndarray]) -> pa.RecordBatch:
            cell, n = np.unique(np.concatenate(found), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.where(cell < 0, n, np.minimum(n, 2)))], names=["cell", "n"])

        for part in slices(batches, 1, UNIT_BYTES):
            grams = Windows(words_of(part.column(1)), window, anchor).grams
            held += [cells(grams, row, bits) for row in range(ROWS)]
            held.append(np.full(len(grams), -1))
            if sum(map(len, held)) > HELD_CELLS:
                yield counted(held)
                held = []
        if held:
            yield counted(held)

    counts = map_batches(docs, run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).where("n >= 2 or cell < 0")
    size = F.when(F.col("cell") < 0, F.lit(-1)).otherwise(F.col("cell") / BLOCK).cast("long")
    blocks = counts.groupBy(size.alias("block")).agg(
        F.bitmap_construct_agg(F.when(F.col("cell") >= 0, F.col("cell") % BLOCK).otherwise(0)).alias("bits"), F.sum("n").alias("n")).toArrow()
    bitmap, total = np.zeros(ROWS << bits >> 3, np.uint8), 0
    for block, filled, n in zip(*(blocks.column(i).to_pylist() for i in range(3))):
        if block < 0:
            total = n
        else:
            at = block * BLOCK // 8
            part = np.frombuffer(filled, np.uint8)
            bitmap[at : at + len(part)] = part[: len(bitmap) - at]
    return bitmap, total


def _unit(ids: pa.Array, words: Words) -> int:
    mark = xxhash.xxh64(repr(ids.to_pylist()).encode())
    mark.update(words.data.tobytes())
    mark.update(words.offsets.tobytes())
    return mark.intdigest() >> 1


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From asking rows sorted by bucket, for each row one bit per window: whether any other row of the bucket has it too."""

    def solve(bucket: int, units: list[int], packs: list[bytes]) -> Iterator[pa.RecordBatch]:
        found = [np.frombuffer(p, np.uint8) for p in packs]
        counts = np.array([len(p) // 12 for p in found])
        a = np.concatenate([p[: 8 * n].view(np.uint64) for p, n in zip(found, counts)])
        b = np.concatenate([p[8 * n :].view(np.uint32) for p, n in zip(found, counts)])
        order = np.lexsort((b, a))
        same = (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]])
        repeated = np.zeros(len(a), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        bits = [np.packbits(x).tobytes() for x in np.split(repeated, np.cumsum(counts)[:-1])]
        yield pa.RecordBatch.from_arrays([pa.array(units), pa.array([bucket] * len(units), pa.int32()), pa.array(bits, pa.binary())], names=["unit", "place", "pack"])

    current, units, packs = None, [], []
    for batch in batches:
        for bucket, unit, pack in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if bucket != current and units:
                yield from solve(current, units, packs)
                units, packs = [], []
            current = bucket
            units.append(unit)
            packs.append(pack)
    if units:
        yield from solve(current, units, packs)


ANSWERS = "unit long, place int, pack binary"


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, bits: int = CELL_BITS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` for every row of ``docs (doc_id, text)``.

    A word goes if a window of ``window`` words that covers it has a word
    sequence that starts at any other place of any text, the same text
    included. Windows are judged on the input. ``kept`` holds the words that
    stay, joined by one blank. Null and empty texts have no words and stay
    empty; repeated rows repeat each other's windows; null ids keep their
    rows. Texts of any length are taken whole. ``docs`` is read more than once
    and has to give the same rows each time, as a table does.

    Texts travel once, packed into units. What a unit asks of a bucket is one
    row, in which a window stands once however often the unit has it.
    """
    docs = documents(docs)
    bitmap, total = sketch(docs, window, anchor, bits)
    small = zstandard.compress(bitmap.tobytes(), 1)
    buckets = 1 << max(6, (total * (window - anchor + 2) // 2 // BUCKET_WINDOWS).bit_length())

    def opened() -> np.ndarray:
        return np.frombuffer(zstandard.decompress(small), np.uint8)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = opened()
        for part in slices(batches, 1, UNIT_BYTES):
            words = words_of(part.column(1))
            keys, *_ = Windows(words, window, anchor).asked(known, bits, window)
            bucket = (keys[0] >> np.uint64(65 - buckets.bit_length())).astype(np.int64)  # keys are sorted, so buckets are
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets)) if len(bucket) else np.zeros(1, np.int64)
            packs = [keys[0, lo:hi].tobytes() + keys[1, lo:hi].astype(np.uint32).tobytes() for lo, hi in zip(cuts[:-1], cuts[1:])]
            unit = _unit(part.column(0), words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts[:-1]].astype(np.int32)), pa.array(np.full(len(packs), unit)), pa.array(packs, pa.binary())], names=["bucket", "unit", "pack"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, UNIT_BYTES):
            words, ids = words_of(part.column(1)), part.column(0)
            packed = pickle.dumps((ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), words.offsets, words.data.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_unit(ids, words)]), pa.array([-1], pa.int32()), pa.array([zstandard.compress(packed, 3)], pa.binary())], names=["unit", "place", "pack"])

    def solve(known: np.ndarray, packed: bytes, answers: dict[int, bytes]) -> pa.RecordBatch:
        doc_ids, nulls, offsets, data = pickle.loads(zstandard.decompress(packed))
        words = words_in(np.frombuffer(data, np.uint8), offsets)
        keys, starts, which, often = Windows(words, window, anchor).asked(known, bits, window)
        bucket = (keys[0] >> np.uint64(65 - buckets.bit_length())).astype(np.int64)
        number, n = np.unique(bucket, return_counts=True)
        if number.tolist() != sorted(answers) or any(-(-int(c) // 8) != len(answers[b]) for b, c in zip(number.tolist(), n)):
            raise RuntimeError("texts were packed in two ways: the input gives other rows when it is read again; cut its lineage first")
        told = [np.unpackbits(np.frombuffer(answers[b], np.uint8))[:c].astype(bool) for b, c in zip(number.tolist(), n.tolist())]
        repeated = np.concatenate([np.zeros(0, bool), *told]) | (often > 1)
        hit = starts[repeated[which]]
        depth = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(depth, hit, 1)
        np.add.at(depth, hit + window, -1)
        stays = np.cumsum(depth[:-1]) == 0
        kept = []
        for d in range(len(doc_ids)):
            own = data[offsets[d] : offsets[d + 1]].split()
            mask = stays[words.first[d] : words.first[d + 1]]
            kept.append(b" ".join(own if mask.all() else compress(own, mask.tolist())))
        removed = np.diff(np.concatenate([[0], np.cumsum(~stays)])[words.first])
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64(), mask=nulls), pa.array(words.counts.astype(np.int64)), pa.array(removed.astype(np.int64)),
             pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array([k.decode() for k in kept], pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, current, packs, answers = opened(), None, [], {}
        for batch in batches:
            for unit, place, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if unit != current:
                    for p in packs:
                        yield solve(known, p, answers)
                    current, packs, answers = unit, [], {}
                if place < 0:
                    packs.append(packed)
                else:
                    answers[place] = packed
        for p in packs:
            yield solve(known, p, answers)

    asked = map_batches(docs, ask, "bucket int, unit long, pack binary").repartition("bucket").sortWithinPartitions("bucket")
    rows = map_batches(docs, pack, ANSWERS).unionByName(map_batches(asked, _exact, ANSWERS))
    return map_batches(rows.repartition("unit").sortWithinPartitions("unit", "place"), assemble, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
