"""Words of many texts at once, as positions and hashes in numpy arrays.

A word is a run of bytes other than the blank and 0x09 to 0x0D, which in
UTF-8 is the same as a run of characters other than these.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DELIMITER = np.zeros(256, bool)
DELIMITER[[0x20, *range(0x09, 0x0E)]] = True
#: Odd multipliers and their inverses modulo 2**64.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base`` and its inverse to the powers 0 to n - 1, modulo 2**64."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        known = (made[0], made[1])
        if size <= 1 << 23:
            _POWERS[base] = known
    return known


def forget() -> None:
    """Drop the powers that are kept."""
    _POWERS.clear()


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for every span, from prefix sums."""
    up, down = powers(base, max(1, len(values)))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


@dataclass
class Words:
    """Words of a list of texts. ``first[d]:first[d + 1]`` are the words of text ``d``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The number of the text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(BYTE_VALUES[self.data], self.starts, self.ends, BYTE_BASE)

    def windows(self, size: int) -> np.ndarray:
        """Numbers of the words that start a run of ``size`` words within one text."""
        n = len(self.starts)
        last = np.repeat(self.first[1:], self.counts)
        return np.flatnonzero(np.arange(n) + size <= last)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and where each text begins. Null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, pa.scalar("", column.type))
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def words_of(column: pa.Array) -> Words:
    data, offsets = text_bytes(column)
    return words_in(data, offsets)


def words_in(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~DELIMITER[data]
    before = np.zeros(len(data), bool)
    after = np.zeros(len(data), bool)
    if len(data):
        before[1:] = inside[:-1]
        after[:-1] = inside[1:]
        cuts = offsets[:-1]
        before[cuts[cuts < len(data)]] = False
        ends_at = offsets[1:]
        after[ends_at[ends_at > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once."""
    if len(keys) < 2:
        return np.zeros(len(keys), bool)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    found = np.zeros(len(keys), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def later_copies(keys: np.ndarray) -> np.ndarray:
    """True where a key has occurred before."""
    found = np.zeros(len(keys), bool)
    if len(keys) > 1:
        order = np.argsort(keys, kind="stable")
        found[order[1:][keys[order[1:]] == keys[order[:-1]]]] = True
    return found


def per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``marks`` between consecutive ``bounds``."""
    total = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=total[1:])
    return np.diff(total[bounds])
