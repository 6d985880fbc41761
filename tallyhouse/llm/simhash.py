"""SimHash near-duplicates, found with pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyhouse.llm.common import cut_lineage, documents, map_batches, slices
from tallyhouse.llm.components import components, spread_join, with_least
from tallyhouse.llm.words import mix, text_bytes

SHINGLE, DISTANCE, SEED = 4, 4, 42
PIVOTS = 32
#: 64 bits are cut into BLOCKS blocks; two fingerprints that differ in at most
#: BLOCKS - AGREE bits agree on AGREE blocks at least.
BLOCKS, AGREE = 6, 2
SLICE_BYTES = 1 << 20
#: From this many distinct fingerprints on, a bucket is first joined by single flipped bits.
DENSE = 2_048
PAIRS_AT_ONCE = 1 << 22
_LANES = np.uint64(0x0101010101010101)
_REFERENCE = mix(np.arange(1, PIVOTS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have bit 0, 1 .. 63 set."""
    sums = np.zeros((8, 8), np.int64)
    pad = -len(hashes) % 255
    block = np.concatenate([hashes, np.zeros(pad, np.uint64)]).reshape(-1, 255) if pad else hashes.reshape(-1, 255)
    for k in range(8):
        lanes = ((block >> np.uint64(k)) & _LANES).sum(axis=1, dtype=np.uint64)
        sums[:, k] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return sums.reshape(64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a UTF-8 text."""
    words = text.lower().split()  # of bytes: lowers A-Z, splits at the blank and 0x09 to 0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest = xxhash.xxh64_digest
    made = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())])
    hashes = np.frombuffer(made, ">u8").astype(np.uint64)
    bits = bit_sums(hashes) * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """Append the fingerprint of a text column as a signed long. Null counts as an empty text: fingerprint 0."""
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, place, SLICE_BYTES):
            data, offsets = text_bytes(part.column(place))
            found = np.fromiter(
                (fingerprint(data[a:b].tobytes(), shingle) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())),
                np.uint64, part.num_rows)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found.view(np.int64))], names=[*part.schema.names, name])

    return map_batches(df, run, StructType([*df.schema.fields, StructField(name, LongType())]))


def band_keys(blocks: int, agree: int) -> list[Column]:
    """One key for each choice of ``agree`` blocks of the column ``f``: the bits of these blocks and the choice's number."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(blocks)]
    signed = [m - (1 << 64) if m >> 63 else m for m in (sum(masks[i] for i in c) for c in combinations(range(blocks), agree))]
    return [F.xxhash64(F.lit(i), F.col("f").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(signed)]


def _find(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _join_all(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the sets of all pairs; only pairs of different sets are walked through."""
    if not len(a):
        return
    roots = np.arange(len(parent))
    while True:
        up = parent[roots]
        if np.array_equal(up, roots):
            break
        roots = up
    pairs = np.unique(np.stack([roots[a], roots[b]], 1)[roots[a] != roots[b]], axis=0)
    for x, y in pairs.tolist():
        x, y = _find(parent, x), _find(parent, y)
        if x != y:
            parent[max(x, y)] = min(x, y)


def _roots(parent: np.ndarray) -> np.ndarray:
    roots = parent.copy()
    while True:
        up = roots[roots]
        if np.array_equal(up, roots):
            return roots
        roots = up


def bucket_links(f: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all members of a bucket which lie within ``distance`` bits, directly or over others.

    ``f`` holds distinct fingerprints. Every member has a row in the table of
    its distances to the pivots. By the triangle inequality two members whose
    rows differ by more than ``distance`` in any coordinate are further apart,
    so such pairs are discarded; the survivors are verified by their bits.
    Links are (member, smallest member it is joined with), one per member.
    """
    f = np.sort(f)
    table = np.bitwise_count(f[:, None] ^ _REFERENCE[None, :]).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    f, table = f[order], table[order]
    n = len(f)
    parent = np.arange(n)
    seek = np.arange(n)
    if n >= DENSE:
        by_value = np.argsort(f)
        ranked = f[by_value]
        for bit in range(64):
            other = f ^ np.uint64(1 << bit)
            at = np.minimum(np.searchsorted(ranked, other), n - 1)
            hit = np.flatnonzero(ranked[at] == other)
            _join_all(parent, hit, by_value[at[hit]])
        roots = _roots(parent)
        largest = np.bincount(roots).argmax()
        seek = np.flatnonzero(roots != largest)  # members of the largest set are joined already
    first = table[:, 0]
    lo = np.searchsorted(first, first[seek] - distance, side="left")
    if len(seek) == n:
        lo = seek + 1  # every pair once
    hi = np.searchsorted(first, first[seek] + distance, side="right")
    width = np.maximum(hi - lo, 0)
    done = np.cumsum(width)
    at = 0
    while at < len(seek):
        end = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
        w = width[at:end]
        a = np.repeat(seek[at:end], w)
        b = np.arange(len(a)) - np.repeat(np.cumsum(w) - w, w) + np.repeat(lo[at:end], w)
        for p in range(1, PIVOTS):
            if len(a) < 64:
                break
            near = np.abs(table[a, p] - table[b, p]) <= distance
            a, b = a[near], b[near]
        near = np.bitwise_count(f[a] ^ f[b]) <= distance
        _join_all(parent, a[near], b[near])
        at = end
    roots = _roots(parent)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, roots, f)
    to = least[roots]
    moved = f != to
    return f[moved], to[moved]


def links(fingerprints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, agree: int = AGREE) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints ``f`` within ``distance`` bits.

    Fingerprints that close share ``agree`` of ``blocks`` bit blocks whole, so
    each of them goes to one bucket per choice of blocks. A bucket yields one
    link per member at most, never all its pairs.
    """
    if blocks - agree < distance:
        raise ValueError("blocks - agree must be the distance at least, or links would be lost")
    keyed = fingerprints.select("f", F.explode(F.array(*band_keys(blocks, agree))).alias("k"))
    dealt = keyed.repartition("k").sortWithinPartitions("k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_f, held_k = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def solved(f: np.ndarray, k: np.ndarray):
            cuts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]])) if len(k) else np.zeros(1, np.int64)
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi - lo > 1:
                    yield bucket_links(f[lo:hi], distance)

        def rows(found):
            if found:
                a, b = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            f = np.concatenate([held_f, batch.column(0).to_numpy().view(np.uint64)])
            k = np.concatenate([held_k, batch.column(1).to_numpy()])
            cut = int(np.searchsorted(k, k[-1])) if len(k) else 0  # the last bucket may go on in the next batch
            single = np.zeros(cut, bool)
            head = k[:cut]
            if cut:
                single[:] = True
                same = head[1:] == head[:-1]
                single[1:][same] = False
                single[:-1][same] = False
            yield from rows(list(solved(f[:cut][~single], head[~single])))
            held_f, held_k = f[cut:], k[cut:]
        yield from rows(list(solved(held_f, held_k)))

    return map_batches(dealt, run, "a long, b long")


def classes(fingerprints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, agree: int = AGREE) -> DataFrame:
    """``f, root`` for every distinct fingerprint ``f``: ``root`` names its component."""
    found = components(links(fingerprints, distance, blocks, agree))
    joined = fingerprints.join(found, F.col("f") == F.col("node"), "left")
    return joined.select("f", F.coalesce("root", "f").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    ``component_id`` is the smallest id that can be reached over fingerprints
    at most ``distance`` bits apart. Null and empty texts, and texts without a
    word, have fingerprint zero and are linked like any other. A null id is
    never the smallest unless all ids of the component are null. Repeated rows
    and ids each keep their row.
    """
    marked = with_fingerprint(documents(docs), shingle=shingle).select("doc_id", F.col("fingerprint").alias("f"))
    marked = cut_lineage(marked)
    least = marked.groupBy("f").agg(F.min("doc_id").alias("least"))
    rooted = cut_lineage(least.join(classes(least.select("f"), distance), "f"))
    named = with_least(rooted, "root", "f", "least", "component_id").select("f", "component_id")
    shown = F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint")
    return spread_join(marked, named, "f", "doc_id").select("doc_id", shown, "component_id")


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of every group of near-duplicates, with all columns of ``docs``.

    The row with the smallest key stays (nulls last); among rows of equal key
    and fingerprint the one whose columns sort first.
    """
    own = {"f": "_f", "none": "_none", "id": "_id", "place": "_place"}
    while any(c.lower() in own.values() for c in docs.columns):
        own = {k: f"_{v}" for k, v in own.items()}
    marked = with_fingerprint(docs, text, own["f"], shingle)
    keys = marked.select(F.col(f"`{own['f']}`").alias("f"), F.col(f"`{key}`").cast("long").alias("id"))
    least = cut_lineage(keys.groupBy("f").agg(F.min("id").alias("least")))
    rooted = least.join(classes(least.select("f"), distance), "f")
    best = F.min(F.struct(F.col("least").isNull().alias("none"), F.coalesce("least", F.lit(0)).alias("id"), F.col("f")))
    chosen = rooted.groupBy("root").agg(best.alias("b")).select(*(F.col(f"b.{k}").alias(own[k]) for k in ("none", "id", "f")))
    named = marked.withColumn(own["none"], F.col(f"`{key}`").isNull()).withColumn(own["id"], F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(0)))
    on = [own["none"], own["id"], own["f"]]
    kept = named.join(chosen, on, "left_semi")
    order = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.dataType.simpleString().split("<")[0] not in ("map", "variant")]
    place = F.row_number().over(Window.partitionBy(*on).orderBy(*order))
    return kept.withColumn(own["place"], place).where(F.col(own["place"]) == 1).select(*(F.col(f"`{c}`") for c in docs.columns))
