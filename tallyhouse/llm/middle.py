"""Fill-in-middle examples: content-defined chunks, each counted once and then looked up by its content.

A text is cut into chunks where a rolling hash of its last bytes says so, so
copies of a passage give the same chunks wherever they stand. What is known of
a chunk (word ends inside, code points, whether it begins and ends with white
space) is kept under its bytes. The counts of a text are sums over its chunks,
with the words that cross a chunk's edge settled by what its two sides are; the
sums name the chunk that holds a cut, and only that chunk is read again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import map_batches, slices
from tallyhouse.llm.words import BYTE_BASE, BYTE_VALUES, DELIMITER, powers, text_bytes

SLICE_BYTES = 1 << 20
#: Bytes that the rolling hash covers, and bits of it that are zero where a chunk ends: one place in 512.
ROLL, CUT_BITS = 16, 9
LEAST, MOST = 64, 4096
#: Bytes of chunks that a task keeps; when they are full it begins anew.
KEPT_BYTES = 8 << 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MADE = "doc_id long, n long, form string, output string, prefix_chars long, middle_chars long"


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the chunks of each text end, and for each text the number of its first chunk.

    A chunk ends after ``ROLL`` bytes of the text whose hash ends in
    ``CUT_BITS`` zeros if it has ``LEAST`` bytes by then, after ``MOST`` bytes,
    and at the end of the text.
    """
    n = len(data) - ROLL + 1
    marks = np.zeros(0, np.int64)
    if n > 0:
        up, down = powers(BYTE_BASE, len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=total[1:])
        rolled = (total[ROLL:] - total[:-ROLL]) * down[:n]
        marks = np.flatnonzero(rolled >> np.uint64(64 - CUT_BITS) == 0) + ROLL
    ends, first, bounds = [], [0], offsets.tolist()
    near = np.searchsorted(marks, [bounds[:-1], bounds[1:]])
    for lo, hi, a, b in zip(bounds[:-1], bounds[1:], *near.tolist()):
        last = lo
        for mark in marks[a:b].tolist():
            if mark - lo < ROLL or mark - last < LEAST:
                continue
            while mark - last > MOST:
                last += MOST
                ends.append(last)
            if mark - last >= LEAST:
                ends.append(mark)
                last = mark
        while hi - last > MOST:
            last += MOST
            ends.append(last)
        if hi > last:
            ends.append(hi)
        first.append(len(ends))
    return np.array(ends, np.int64), np.array(first, np.int64)


def summaries(chunks: list[bytes]) -> list[tuple[int, int, bool, bool]]:
    """Of each chunk, none of them empty: word ends inside, code points begun, and whether its first and its last byte is white space."""
    data = np.frombuffer(b"".join(chunks), np.uint8)
    ends = np.cumsum([len(c) for c in chunks])
    starts = ends - np.array([len(c) for c in chunks])
    space = DELIMITER[data]
    inside = np.zeros(len(data), np.int64)
    inside[1:] = ~space[:-1] & space[1:]
    inside[starts] = 0
    return list(zip(np.add.reduceat(inside, starts).tolist(), np.add.reduceat((data & 0xC0 != 0x80).astype(np.int64), starts).tolist(),
                    space[starts].tolist(), space[ends - 1].tolist()))


class Memo:
    """Summaries of chunks by their bytes; a chunk is taken for a known one only if all of its bytes are the same."""

    def __init__(self, limit: int = KEPT_BYTES):
        self.known: dict[bytes, tuple[int, int, bool, bool]] = {}
        self.size, self.limit, self.asked, self.counted = 0, limit, 0, 0

    def of(self, chunks: list[bytes]) -> np.ndarray:
        new = list(dict.fromkeys(c for c in chunks if c not in self.known))
        self.asked += len(chunks)
        self.counted += len(new)
        made = dict(zip(new, summaries(new))) if new else {}
        found = [self.known.get(c) or made[c] for c in chunks]
        self.size += sum(map(len, new))
        if self.size > self.limit:
            self.known, self.size = {}, 0
        else:
            self.known |= made
        return np.array(found, np.int64).reshape(-1, 4)


class Counted:
    """Texts with what their chunks add up to. A unit is a word with the white space before it, or the white space at the end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, memo: Memo):
        self.data, self.offsets = data, offsets
        self.ends, self.first = chunk_ends(data, offsets)
        self.starts = np.concatenate([[0], self.ends[:-1]])[: len(self.ends)]
        whole = data.tobytes()
        inside, chars, opens, closes = memo.of([whole[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist())]).T
        last = np.zeros(len(self.ends), bool)
        last[self.first[1:][np.diff(self.first) > 0] - 1] = True
        after = np.append(opens[1:], 1)[: len(opens)].astype(bool) | last
        self.inside = inside
        self.words = np.concatenate([[0], np.cumsum(inside + (after & ~closes.astype(bool)))])
        self.chars = np.concatenate([[0], np.cumsum(chars)])
        tail = np.zeros(len(offsets) - 1, np.int64)
        filled = np.diff(self.first) > 0
        tail[filled] = closes[self.first[1:][filled] - 1]
        self.units = self.words[self.first[1:]] - self.words[self.first[:-1]] + tail

    def cut(self, text: int, unit: int) -> tuple[int, int]:
        """Bytes and code points of a text before the end of its first ``unit`` units."""
        if unit == 0:
            return 0, 0
        a, b = int(self.first[text]), int(self.first[text + 1])
        if unit == self.units[text]:
            return int(self.offsets[text + 1] - self.offsets[text]), int(self.chars[b] - self.chars[a])
        wanted = self.words[a] + unit
        chunk = int(np.searchsorted(self.words[a + 1 : b + 1], wanted)) + a
        rank = int(wanted - self.words[chunk])
        lo, hi = int(self.starts[chunk]), int(self.ends[chunk])
        if rank <= self.inside[chunk]:
            space = DELIMITER[self.data[lo:hi]]
            hi = lo + int(np.flatnonzero(~space[:-1] & space[1:])[rank - 1]) + 1
        chars = int(np.count_nonzero(self.data[lo:hi] & 0xC0 != 0x80))
        return hi - int(self.offsets[text]), int(self.chars[chunk] - self.chars[a]) + chars


def draws(key: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """``doc_id, n, form, output, prefix_chars, middle_chars`` for every row.

    Of the texts, ``percent`` in a hundred are cut in three at ends of units
    drawn from the key, and of these ``spm_percent`` in a hundred are written
    suffix first. Texts that are empty, or hold one of the marks, stay plain. Null texts are empty; a null key draws as an
    empty one; repeated rows give repeated results; other columns are not read.
    A text is worked on whole, however long. Nothing is shuffled and nothing
    depends on other rows: the memo saves counting, and a task that is run
    again gives the same rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo()
        marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
        for part in slices(batches, 1, SLICE_BYTES):
            data, offsets = text_bytes(part.column(1))
            counted = Counted(data, offsets, memo)
            whole, bounds, units = data.tobytes(), offsets.tolist(), counted.units.tolist()
            forms, outputs, prefixes, middles = [], [], [], []
            for i, doc in enumerate(part.column(0).to_pylist()):
                own = whole[bounds[i] : bounds[i + 1]]
                h1, h2, h3, h4 = draws(doc, seed)
                if not own or h3 % 100 >= percent or any(m in own for m in marks):
                    forms.append("plain")
                    outputs.append(own)
                    prefixes.append(None)
                    middles.append(None)
                    continue
                low, high = sorted((h1 % (units[i] + 1), h2 % (units[i] + 1)))
                (a, before), (b, until) = counted.cut(i, low), counted.cut(i, high)
                spm = h4 % 100 < spm_percent
                forms.append("spm" if spm else "psm")
                pieces = [marks[0], own[:a], marks[1], own[b:]]
                outputs.append(b"".join([*(pieces[2:] + pieces[:2] if spm else pieces), marks[2], own[a:b]]))
                prefixes.append(before)
                middles.append(until - before)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(units, pa.int64()), pa.array(forms, pa.string()), pa.array(outputs, pa.binary()).cast(pa.string()),
                 pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64())],
                names=["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"])

    return map_batches(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), run, MADE)


def restored(output: Column, form: Column) -> Column:
    """The exact text behind an output. Marks cannot run into the text beside them, and the text holds none."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(parts[2], parts[3], parts[1]))


def digests(made: DataFrame) -> DataFrame:
    """The examples with hashes in place of texts."""
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
