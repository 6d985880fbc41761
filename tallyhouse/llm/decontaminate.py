"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.llm.common import documents, map_batches, slices
from tallyhouse.llm.words import WORD_BASE, Words, mix, powers, text_bytes, words_in

SLICE_BYTES = 1 << 20
#: Test items are taken in blocks of about this many characters; each block is one pass over the corpus.
BLOCK_CHARS = 8 << 20
#: A seed is the shortest of these n-grams that chance would bring to the corpus at most RARE times.
SEED_WORDS, RARE = (3, 5, 8), 1.0
MATCH, MISMATCH, GAP = 2, -1, -1
#: A passage is a copy from this share of the item's own score on, and this many equal words (or all of a shorter item's).
LEAST_SCORE, LEAST_WORDS = 0.5, 8
#: So is one of any share that has this many equal words in a row, or scores as much with this share of its words equal.
PASSAGE_WORDS, PASSAGE_EQUAL = 13, 0.9
#: What more items than this have in common is a prompt: it gives no seed, and its words (in runs of the longest seed) score nothing.
MOST_ITEMS = 3
FILTER_BITS = 22

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[b for b in range(128) if not (chr(b).isalnum())]] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True


def plain_words(column: pa.Array) -> Words:
    """Words of letters and digits in lower case: ASCII signs part words, and Latin-1 capitals are lowered too."""
    data, offsets = text_bytes(column)
    data = np.where(_UPPER[data], data + 32, data).astype(np.uint8)
    follows = np.zeros(len(data), bool)
    if len(data):
        follows[1:] = data[:-1] == 0xC3
    accented = follows & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    data[accented] += 0x20
    data[_SEPARATOR[data]] = 0x20
    return words_in(data, offsets)


def smith_waterman(a: np.ndarray, b: np.ndarray, counts: np.ndarray | None = None) -> tuple[int, int, int]:
    """The best local alignment of two word sequences: its score, and where it ends in ``a`` and in ``b`` (exclusive).

    Words of ``a`` where ``counts`` is 0 neither gain nor lose anything against
    a word of ``b``. Of equal scores the one that ends first in ``a``, and then
    in ``b``.
    """
    best = (0, 0, 0)
    if not len(a) or not len(b):
        return best
    counts = np.ones(len(a), np.int64) if counts is None else counts
    row = np.zeros(len(b) + 1, np.int64)
    slope = np.arange(len(b) + 1) * -GAP
    for i, x in enumerate(a):
        step = np.zeros(len(b) + 1, np.int64)
        np.maximum(row[:-1] + np.where(b == x, MATCH, MISMATCH) * counts[i], row[1:] + GAP, out=step[1:])
        np.maximum(step, 0, out=step)
        row = np.maximum.accumulate(step + slope) - slope  # gaps along the row
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), i + 1, j)
    return best


def longest_run(a: np.ndarray, b: np.ndarray, counts: np.ndarray | None = None) -> int:
    """The most consecutive words that two word sequences share; words of ``a`` where ``counts`` is 0 are not counted."""
    best, row = 0, np.zeros(len(b) + 1, np.int64)
    counts = np.ones(len(a), np.int64) if counts is None else counts
    for x, count in zip(a, counts):
        row[1:] = np.where(b == x, row[:-1] + count, 0)
        best = max(best, int(row.max()))
    return best


@dataclass
class Items:
    """Test items of a block: word hashes and which words are the item's own (1, shared ones 0), and seeds as sorted
    hashes with the item and place of each."""

    ids: list[int | None]
    words: list[np.ndarray]
    counts: list[np.ndarray]
    sizes: list[int]
    seeds: list[np.ndarray]
    item: list[np.ndarray]
    place: list[np.ndarray]
    filters: list[np.ndarray]

    def matches(self, words: np.ndarray, first: np.ndarray) -> list[list[tuple]]:
        """For each text, (item, similarity, equal words, first word, end word) of the best copy of each item in it."""
        hits = []
        total = _prefix(words)
        last = np.repeat(first[1:], np.diff(first))
        for size, seeds, item, place, known in zip(self.sizes, self.seeds, self.item, self.place, self.filters):
            at = np.flatnonzero(np.arange(len(words)) + size <= last)
            found = _runs(total, at, size)
            maybe = np.flatnonzero(known[(found >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            at, found = at[maybe], found[maybe]
            lo, hi = np.searchsorted(seeds, found, side="left"), np.searchsorted(seeds, found, side="right")
            many = hi - lo
            which = np.repeat(lo, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            at = np.repeat(at, many)
            hits.append(np.stack([np.searchsorted(first, at, side="right") - 1, item[which], at - place[which], at], 1))
        out: list[list[tuple]] = [[] for _ in range(len(first) - 1)]
        found = np.concatenate(hits) if hits else np.zeros((0, 4), np.int64)
        if not len(found):
            return out
        found = np.unique(found, axis=0)
        cut = np.flatnonzero((np.diff(found[:, :2], axis=0) != 0).any(axis=1)) + 1
        for group in np.split(found, cut):
            doc, item = int(group[0, 0]), int(group[0, 1])
            best = self._best(words[first[doc] : first[doc + 1]], item, group[:, 2] - first[doc], group[:, 3] - first[doc])
            if best:
                out[doc].append(best)
        return out

    def _best(self, text: np.ndarray, item: int, begins: np.ndarray, seeds: np.ndarray) -> tuple | None:
        own, counts = self.words[item], self.counts[item]
        n = int(counts.sum())
        pad = max(4, len(own) // 2)
        spans = []
        lo, hi = int(begins[0]) - pad, int(begins[0]) + len(own) + pad
        for b in begins[1:].tolist():
            if b - pad <= hi:
                hi = b + len(own) + pad
            else:
                spans.append((lo, hi))
                lo, hi = b - pad, b + len(own) + pad
        spans = [(max(lo, 0), min(hi, len(text))) for lo, hi in [*spans, (lo, hi)]]
        aligned = [smith_waterman(own, text[lo:hi], counts) for lo, hi in spans]
        first = max(range(len(spans)), key=lambda k: aligned[k][0])
        if not aligned[first][0]:
            return None
        best = _part(own, counts, text, aligned[first], spans[first][0])
        if best.score >= LEAST_SCORE * MATCH * n and best.equal >= min(LEAST_WORDS, n):
            return (self.ids[item], best.score / (MATCH * n), best.equal, best.lo, best.hi)
        parts = self._parts(own, counts, text, spans, seeds, best)
        score, equal = sum(p.score for p in parts), sum(p.equal for p in parts)
        if len(parts) > 1 and score >= LEAST_SCORE * MATCH * n and equal >= min(LEAST_WORDS, n):
            return (self.ids[item], score / (MATCH * n), equal, min(p.lo for p in parts), max(p.hi for p in parts))
        if best.score >= MATCH * PASSAGE_WORDS:
            mine = counts[best.own_lo : best.own_hi]
            alike = best.equal >= PASSAGE_EQUAL * max(mine.sum(), best.hi - best.lo - (mine == 0).sum())
            if alike or longest_run(own[best.own_lo : best.own_hi], text[best.lo : best.hi], mine) >= PASSAGE_WORDS:
                return (self.ids[item], best.score / (MATCH * n), best.equal, best.lo, best.hi)
        return None

    @staticmethod
    def _parts(own: np.ndarray, counts: np.ndarray, text: np.ndarray, spans: list[tuple[int, int]], seeds: np.ndarray, best: Part) -> list[Part]:
        """The best part of an item in a text and further ones, wherever a seed stands outside of those before. No word
        of the item counts twice."""
        parts, seeds = [best], np.unique(seeds)
        left = np.ones(len(own), bool)
        left[best.own_lo : best.own_hi] = False
        rest = [x for lo, hi in spans for x in ([(lo, best.lo), (best.hi, hi)] if lo <= best.lo < hi else [(lo, hi)])]
        while rest:
            lo, hi = rest.pop()
            if lo >= hi or np.searchsorted(seeds, lo) == np.searchsorted(seeds, hi):
                continue
            found = None
            edges = np.flatnonzero(np.diff(left.astype(np.int8), prepend=0, append=0))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                aligned = smith_waterman(own[a:b], text[lo:hi], counts[a:b])
                if aligned[0] >= MATCH * SEED_WORDS[0] and (found is None or aligned[0] > found[0][0]):
                    found = aligned, a, b
            if found is None:
                continue
            aligned, a, b = found
            part = _part(own[a:b], counts[a:b], text, aligned, lo)
            left[a + part.own_lo : a + part.own_hi] = False
            parts.append(part)
            rest += [(lo, part.lo), (part.hi, hi)]
        return parts


@dataclass
class Part:
    """An alignment: its score, its equal words, and the words from ``own_lo`` and ``lo`` on that it has of the item and the text."""

    score: int
    equal: int
    own_lo: int
    own_hi: int
    lo: int
    hi: int


def _part(own: np.ndarray, counts: np.ndarray, text: np.ndarray, aligned: tuple[int, int, int], lo: int) -> Part:
    """The part that ends where ``smith_waterman`` says for the text from ``lo`` on."""
    score, end_a, end_b = aligned[0], aligned[1], lo + aligned[2]
    _, back_a, back_b = smith_waterman(own[:end_a][::-1], text[lo:end_b][::-1], counts[:end_a][::-1])
    mine = slice(end_a - back_a, end_a)
    equal = _equal_words(own[mine][counts[mine] > 0], text[end_b - back_b : end_b])
    return Part(score, equal, end_a - back_a, end_a, end_b - back_b, end_b)


def _equal_words(a: np.ndarray, b: np.ndarray) -> int:
    """Words of ``a`` that occur in ``b``, each as often as it does there at most."""
    left, n = np.unique(a, return_counts=True)
    right, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    return int(np.minimum(n[i], m[j]).sum())


def _prefix(words: np.ndarray) -> np.ndarray:
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(WORD_BASE, max(1, len(words)))[0][: len(words)], out=total[1:])
    return total


def _runs(total: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words that start at ``at``."""
    return mix((total[at + size] - total[at]) * powers(WORD_BASE, max(1, len(total)))[1][at])


def distinct_items(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """``text, id``: equal texts are one item, under their smallest id; empty ones none."""
    items = benchmark.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).where("length(text) > 0")
    return items.groupBy("text").agg(F.min("id").alias("id"))


def item_blocks(items: DataFrame, block_chars: int) -> Iterator[pa.Table]:
    """The test items in blocks of bounded size."""
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // block_chars)
    for b in range(blocks):
        yield items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).orderBy("id", "text").toArrow()


def word_counts(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """How often each hash of a sorted vocabulary occurs in all texts, and how many words these have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, words = np.zeros(len(vocabulary), np.int64), 0
        for part in slices(batches, 1, SLICE_BYTES):
            h = plain_words(part.column(1)).hashes()
            at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
            counts += np.bincount(at[vocabulary[at] == h], minlength=len(vocabulary))
            words += len(h)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(counts[some], words))], names=["word", "n"])

    found = map_batches(docs, run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(vocabulary), np.int64)
    where, n = found.column("word").to_numpy(), found.column("n").to_numpy()
    counts[where[where >= 0]] = n[where >= 0]
    return counts, int(n[where < 0].sum())


def _grams(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of ``size`` words inside of texts start, and their hashes."""
    last = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(np.arange(len(hashes)) + size <= last)
    return at, _runs(_prefix(hashes), at, size)


def item_counts(items: DataFrame, known: list[np.ndarray]) -> list[np.ndarray]:
    """In how many items of the whole table each n-gram occurs: one sorted array of hashes per size of ``SEED_WORDS``."""
    edges = np.cumsum([0, *map(len, known)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(edges[-1], np.int64)
        for part in slices(batches, 0, SLICE_BYTES):
            w = plain_words(part.column(0))
            hashes = w.hashes()
            for size, grams, edge in zip(SEED_WORDS, known, edges):
                at, found = _grams(hashes, w.first, size)
                if not len(at) or not len(grams):
                    continue
                place = np.minimum(np.searchsorted(grams, found), len(grams) - 1)
                item = np.searchsorted(w.first, at, side="right") - 1
                once = np.unique((item * len(grams) + place)[grams[place] == found])
                counts[edge : edge + len(grams)] += np.bincount(once % len(grams), minlength=len(grams))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["gram", "n"])

    found = map_batches(items.select("text"), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(edges[-1], np.int64)
    counts[found.column("gram").to_numpy()] = found.column("n").to_numpy()
    return [counts[a:b] for a, b in zip(edges[:-1], edges[1:])]


def own_words(hashes: np.ndarray, first: np.ndarray, items: DataFrame) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Which words are their item's own, and for each size of ``SEED_WORDS`` where n-grams of more than ``MOST_ITEMS`` items
    start. Items with fewer than ``LEAST_WORDS`` words of their own differ in little else, so all of theirs count."""
    grams = [_grams(hashes, first, size) for size in SEED_WORDS]
    known = [np.unique(found) for _, found in grams]
    shared = {}
    for size, (at, found), seen, n in zip(SEED_WORDS, grams, known, item_counts(items, known)):
        shared[size] = np.zeros(len(hashes), bool)
        if len(at):
            shared[size][at] = n[np.searchsorted(seen, found)] > MOST_ITEMS
    cover = np.zeros(len(hashes) + 1, np.int64)
    starts = np.flatnonzero(shared[SEED_WORDS[-1]])
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + SEED_WORDS[-1], -1)
    own = (np.cumsum(cover)[:-1] == 0).astype(np.int64)
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if own[lo:hi].sum() < min(LEAST_WORDS, hi - lo):
            own[lo:hi] = 1
            for places in shared.values():
                places[lo:hi] = False
    return own, shared


def prepare(docs: DataFrame, block: pa.Table, items: DataFrame) -> Items:
    """Choose the seeds of a block of items: n-grams that are rare by the frequency of their words in the corpus and that few
    items have. An item without any gets all its longest n-grams."""
    w = plain_words(block.column("text").combine_chunks())
    hashes = w.hashes()
    own, shared = own_words(hashes, w.first, items)
    cuts = list(zip(w.first[:-1].tolist(), w.first[1:].tolist()))
    vocabulary = np.unique(hashes)
    counts, total = word_counts(docs, vocabulary) if len(vocabulary) else (np.zeros(0, np.int64), 0)
    log_share = np.log((counts[np.searchsorted(vocabulary, hashes)] + 0.5) / max(total, 1))
    sums = np.concatenate([[0.0], np.cumsum(log_share)])
    prefix = _prefix(hashes)
    chosen: dict[int, list[tuple[int, int, int]]] = {}
    for item, (lo, hi) in enumerate(cuts):
        seeds, others = [], []
        for at in range(lo, max(lo, hi - SEED_WORDS[0]) + 1 if hi > lo else lo):
            left = hi - at
            options = [s for s in SEED_WORDS if s <= left] or [left]
            rare = [
                s for s in options
                if np.log(max(total, 1)) + sums[at + s] - sums[at] <= np.log(RARE) and not (s in shared and shared[s][at])
            ]
            (seeds if rare else others).append((rare[0] if rare else options[-1], at))
        for size, at in seeds or others:
            chosen.setdefault(size, []).append((at, item, at - lo))
    out = Items(block.column("id").to_pylist(), [hashes[a:b] for a, b in cuts], [own[a:b] for a, b in cuts], [], [], [], [], [])
    for size, rows in sorted(chosen.items()):
        at, item, place = np.array(rows).T
        seeds = _runs(prefix, at, size)
        order = np.argsort(seeds, kind="stable")
        known = np.zeros(1 << FILTER_BITS, bool)
        known[(seeds >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        for column, value in ((out.sizes, size), (out.seeds, seeds[order]), (out.item, item[order]), (out.place, place[order]), (out.filters, np.packbits(known))):
            column.append(value)
    return out


FOUND = "array<struct<item_id: long, similarity: double, n_equal: int, first_word: int, end_word: int>>"


def with_copies(df: DataFrame, docs: DataFrame, benchmark: DataFrame, name: str, text: str = "text", key: str = "item_id", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Append to every row the copies of test items in its text, one entry per item.

    ``docs (doc_id, text)`` is the corpus whose word frequencies say which
    n-grams are rare; ``df`` has its texts and any further columns. Rare seeds
    of the items are looked up in every text. Where one is found, the passage
    around it is aligned with the whole item, and it is a copy if the score of
    the alignment reaches ``LEAST_SCORE`` of the item's own. So are parts that
    stand apart in one text if their scores together reach it, and a passage of
    ``PASSAGE_WORDS`` words whatever share of the item it is. An edited copy is
    found as long as one seed is left whole.

    Words that more than ``MOST_ITEMS`` items have in common are a prompt. They
    seed nothing and count neither for the score nor for the item's own, so a
    text with the prompt alone is no copy. An item of little else but shared
    words, such as one of many variants, is searched whole.

    Null and empty texts and items have no copies; repeated rows are searched
    each for itself; equal items are one, under their smallest id. Without
    items the list is empty. Long texts are searched whole.
    """
    place = df.columns.index(text)
    entry = pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("n_equal", pa.int32()), ("first_word", pa.int32()), ("end_word", pa.int32())])
    schema = StructType([*df.schema.fields, *StructType.fromDDL(f"`{name}` {FOUND}").fields])
    out = df.withColumn(name, F.expr(f"cast(array() as {FOUND})"))
    table = distinct_items(benchmark, key, "text")
    for block in item_blocks(table, block_chars):
        items = prepare(docs, block, table)

        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            items.filters = [np.unpackbits(f).astype(bool) if f.dtype == np.uint8 else f for f in items.filters]
            for part in slices(batches, place, SLICE_BYTES):
                w = plain_words(part.column(place))
                found = items.matches(w.hashes(), w.first)
                before = part.column(part.num_columns - 1).to_pylist()
                rows = [old + [dict(zip(entry.names, x)) for x in new] for old, new in zip(before, found)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(rows, pa.list_(entry))], names=part.schema.names)

        out = map_batches(out, run, schema)
    return out


def copies(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, similarity, n_equal, first_word, end_word`` for each test item copied into a document.

    Only documents with a copy have rows. Words are counted from 0, the end exclusive.
    """
    docs = documents(docs)
    found = with_copies(docs, docs, benchmark, "found").select("doc_id", F.explode("found").alias("f"))
    return found.select("doc_id", "f.item_id", "f.similarity", "f.n_equal", "f.first_word", "f.end_word")
