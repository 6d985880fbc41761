"""Language-model scoring: cross-entropy difference of matched n-gram models.

The target model counts the texts labelled good, the background model all
others; both have the same vocabulary, weights and, by scale, the same size. A
text is scored without its own counts, so that a text of the target is judged
as any other.

Texts are packed into units. A unit sends each bucket of keys one row with the
words and pairs that it has and how often; the bucket adds up all units and
sends each one the counts it asked for. So counts travel once, packed, and no
table of counts is joined.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage, map_batches, slices
from tallyhouse.llm.words import WORD_BASE, Words, mix, words_in, words_of

#: Texts are packed into units of this many bytes; a longer text is a unit of its own.
UNIT_BYTES = 4 << 20
#: Keys are dealt to buckets of about this many.
BUCKET_KEYS = 1 << 20
#: What the first word of a text follows.
START = np.uint64(0x8F1BBCDCBFA53E0B)
#: Weight of pairs against single words, and what is added to the count of each word.
PAIR_WEIGHT, ADDED = 0.7, 0.5
#: The ids of the target are broadcast up to this many; beyond it they are joined by a shuffle.
BROADCAST_IDS = 1 << 22
ONE = np.uint64(1)


def keys_of(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each word its key, which is odd, and that of the pair it makes with the word before it in its text, which is even."""
    word = w.hashes()
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[w.first[:-1][w.counts > 0]] = START
    return mix(word) | ONE, mix(before * np.uint64(WORD_BASE) + word) & ~ONE


class Unit:
    """The keys of some texts: the distinct ones in order, which one each word and each pair has, and counts by text."""

    def __init__(self, words: Words, target: np.ndarray):
        self.words, self.target = words, target
        self.text = words.text_of()
        self.keys, which = np.unique(np.concatenate(keys_of(words)), return_inverse=True)
        self.word, self.pair = which[: len(self.text)], which[len(self.text) :]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """How often the target's texts and the others have each key."""
        which, own = np.concatenate([self.word, self.pair]), np.tile(self.target[self.text], 2)
        of_target = np.bincount(which[own], minlength=len(self.keys))
        return of_target, np.bincount(which[~own], minlength=len(self.keys))

    def own(self, which: np.ndarray) -> np.ndarray:
        """For each word how often its text has the key."""
        _, at, n = np.unique(self.text * np.int64(max(1, len(self.keys))) + which, return_inverse=True, return_counts=True)
        return n[at]

    def losses(self, counts: tuple[np.ndarray, np.ndarray], sizes: Sizes) -> list[np.ndarray]:
        """Bits per word of each text under the target and the background model, both without the text itself."""
        n = self.words.counts
        word, pair = self.own(self.word), self.own(self.pair)
        first = np.zeros(len(self.text), bool)
        first[self.words.first[:-1][n > 0]] = True
        out = []
        for m, member in enumerate((self.target, ~self.target)):
            mine, count = member[self.text], counts[m]
            single = (sizes.scale(m) * (count[self.word] - word * mine) + ADDED) / (
                sizes.scale(m) * (sizes.words[m] - (n * member)[self.text]) + ADDED * (sizes.vocabulary + 1))
            before = np.empty(len(self.text), np.int64)
            before[1:] = (count[self.word] - word * mine)[:-1]
            before[first] = sizes.texts[m] - mine[first]
            share = np.where(before > 0, (count[self.pair] - pair * mine) / np.maximum(before, 1), single)
            bits = -np.log2(PAIR_WEIGHT * share + (1 - PAIR_WEIGHT) * single)
            out.append(np.bincount(self.text, weights=bits, minlength=len(n)) / np.maximum(n, 1))
        return out


@dataclass
class Sizes:
    """Words and texts with words of the target and of all others, and how many words are different."""

    words: tuple[int, int]
    texts: tuple[int, int]
    vocabulary: int = 0

    def scale(self, model: int) -> float:
        """What counts are multiplied by so that both models weigh as many words as the smaller one has."""
        return min(self.words) / self.words[model] if min(self.words) else 1.0


def _sizes(docs: DataFrame) -> Sizes:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, 2), np.int64)
        for part in slices(batches, 1, UNIT_BYTES):
            n, target = words_of(part.column(1)).counts, part.column(2).to_numpy(zero_copy_only=False)
            for m, own in enumerate((target, ~target)):
                found[m] += n[own].sum(), np.count_nonzero(n[own])
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in found.ravel().tolist()], names=["wt", "tt", "wo", "to"])

    row = map_batches(docs, run, "wt long, tt long, wo long, to long").agg(*[F.sum(c).alias(c) for c in ("wt", "tt", "wo", "to")]).first()
    wt, tt, wo, to = (x or 0 for x in row)
    return Sizes((wt, wo), (tt, to))


def _name(ids: pa.Array, words: Words) -> int:
    mark = xxhash.xxh64(repr(ids.to_pylist()).encode())
    mark.update(words.data.tobytes())
    mark.update(words.offsets.tobytes())
    return mark.intdigest() >> 1


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays byte by byte of their numbers, so that leading zeros lie together."""
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays]
    return zstandard.compress(b"".join(planes), 1)


def _unpacked(packed: bytes, *types: type) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.decompress(packed), np.uint8)
    n, out, at = len(data) // sum(np.dtype(t).itemsize for t in types), [], 0
    for t in types:
        size = np.dtype(t).itemsize
        out.append(np.ascontiguousarray(data[at : at + n * size].reshape(size, n).T).view(t).ravel())
        at += n * size
    return out


def _differences(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


ANSWERS = "unit long, place int, pack binary, n long"


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From asking rows sorted by bucket, for each row the counts of its keys in all texts; and the number of words of each bucket."""

    def solve(bucket: int, units: list[int], packs: list[bytes]) -> pa.RecordBatch:
        asked = [_unpacked(p, np.uint64, np.uint32, np.uint32) for p in packs]
        cuts = np.cumsum([len(a[0]) for a in asked])[:-1]
        keys, which = np.unique(np.concatenate([np.cumsum(a[0], dtype=np.uint64) for a in asked]), return_inverse=True)
        sums = [np.bincount(which, weights=np.concatenate([a[i] for a in asked]), minlength=len(keys)).astype(np.int64)[which] for i in (1, 2)]
        told = [_packed(t, b) for t, b in zip(*(np.split(s, cuts) for s in sums))]
        n = int(np.count_nonzero(keys & ONE))
        return pa.RecordBatch.from_arrays(
            [pa.array([*units, -1]), pa.array([bucket] * (len(units) + 1), pa.int32()), pa.array([*told, b""], pa.binary()), pa.array([0] * len(units) + [n])],
            names=["unit", "place", "pack", "n"])

    current, units, packs = None, [], []
    for batch in batches:
        for bucket, unit, pack in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if bucket != current and units:
                yield solve(current, units, packs)
                units, packs = [], []
            current = bucket
            units.append(unit)
            packs.append(pack)
    if units:
        yield solve(current, units, packs)


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, target_loss, background_loss, difference`` for every row of ``docs (doc_id, text, target)``.

    Losses are bits per word of two models, of the texts marked and of all
    others. A model mixes the share of a word among what followed the word
    before it, where the end of a text is one of the things that may follow,
    with its share among all words; a context that was not seen says nothing.
    The counts of a text are taken out of its own model before it is scored.
    Counts are exact, but for words of equal hashes, and every word and pair of
    every text is counted. ``difference`` is the target's loss less the
    background's: the lower it is, the more a text is like the target. Texts
    without words, null ones included, have losses and difference 0. ``docs``
    is read more than once and has to give the same rows each time.
    """
    sizes = _sizes(docs)
    buckets = 1 << max(4, (sum(sizes.words) // BUCKET_KEYS).bit_length())
    shift = np.uint64(65 - buckets.bit_length())

    def bucket_cuts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of keys in order, and where each begins."""
        bucket = (keys >> shift).astype(np.int64)
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets)) if len(bucket) else np.zeros(1, np.int64)
        return bucket[cuts[:-1]], cuts

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words, np.ndarray]]:
        for part in slices(batches, 1, UNIT_BYTES):
            yield part, words_of(part.column(1)), part.column(2).to_numpy(zero_copy_only=False)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, target in units(batches):
            unit = Unit(words, target)
            number, cuts = bucket_cuts(unit.keys)
            t, b = (c.astype(np.uint32) for c in unit.counts())
            packs = [_packed(_differences(unit.keys[lo:hi]), t[lo:hi], b[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:])]
            names = pa.array(np.full(len(packs), _name(part.column(0), words)), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(number.astype(np.int32)), names, pa.array(packs, pa.binary())], names=["bucket", "unit", "pack"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, target in units(batches):
            ids = part.column(0)
            held = (ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), target, words.offsets, words.data.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([_name(ids, words)]), pa.array([-1], pa.int32()), pa.array([zstandard.compress(pickle.dumps(held), 3)], pa.binary()), pa.array([0])],
                names=["unit", "place", "pack", "n"])

    asked = map_batches(docs, ask, "bucket int, unit long, pack binary").repartition("bucket").sortWithinPartitions("bucket")
    answers = cut_lineage(map_batches(asked, _add_up, ANSWERS))
    sizes.vocabulary = answers.agg(F.sum("n")).first()[0] or 0

    def solve(packed: bytes, told: dict[int, bytes]) -> pa.RecordBatch:
        doc_ids, nulls, target, offsets, data = pickle.loads(zstandard.decompress(packed))
        words = words_in(np.frombuffer(data, np.uint8), offsets)
        unit = Unit(words, target)
        number, cuts = bucket_cuts(unit.keys)
        found = [_unpacked(told[b], np.int64, np.int64) for b in number.tolist()] if number.tolist() == sorted(told) else []
        if [len(f[0]) for f in found] != np.diff(cuts).tolist():
            raise RuntimeError("texts were packed in two ways: the input gives other rows when it is read again; cut its lineage first")
        counts = tuple(np.concatenate([np.zeros(0, np.int64), *(f[i] for f in found)]) for i in range(2))
        t, b = unit.losses(counts, sizes)
        columns = [pa.array(doc_ids, pa.int64(), mask=nulls), *map(pa.array, (words.counts.astype(np.int64), t, b, t - b))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "target_loss", "background_loss", "difference"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, packs, told = None, [], {}
        for batch in batches:
            for unit, place, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if unit != current:
                    for p in packs:
                        yield solve(p, told)
                    current, packs, told = unit, [], {}
                if place < 0:
                    packs.append(packed)
                else:
                    told[place] = packed
        for p in packs:
            yield solve(p, told)

    rows = map_batches(docs, pack, ANSWERS).unionByName(answers.where("unit >= 0"))
    return map_batches(rows.repartition("unit").sortWithinPartitions("unit", "place"), assemble,
                       "doc_id long, n_words long, target_loss double, background_loss double, difference double")


def cross_entropy_difference(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document against documents labelled good.

    The target is every document with a label of quality 1, the background
    every other one; a document is scored by counts that leave it out. Null ids
    are never in the target; repeated rows count and are scored each for
    itself. With no labelled document the target model is that of an empty
    corpus. An empty table gives no rows.
    """
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("good")).where("good is not null").distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    return score(rows.join(good, rows["doc_id"] == good["good"], "left").select("doc_id", "text", F.col("good").isNotNull().alias("target")))
