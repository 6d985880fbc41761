"""SentencePiece encoding and decoding as a relational lattice.

Texts are cut into segments that no piece can reach across. Every distinct
segment is encoded once: its substrings of bounded length are exploded and
equi-joined to the piece table, the matches (edges) are grouped by segment, and
a higher-order fold walks them. Only then do the pieces go back to the texts.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyhouse.llm.common import map_batches, slices
from tallyhouse.llm.words import BYTE_BASE, mix, span_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
#: Texts are packed into units of this many bytes; a longer text is a unit of its own.
UNIT_BYTES = 4 << 20
#: Segments are dealt to this many buckets by their hash; what a unit asks of a bucket is one row.
BUCKETS = 1024
#: Bytes of text that are cut into segments at a time.
CUT_BYTES = 1 << 19
#: Edges that are folded at a time.
FOLD_ROWS = 200_000
#: The fold keeps the ends of pieces as bits of a long. Longer segments are merged when they are packed.
LONGEST = 62
#: The piece table is broadcast; a larger one is refused.
MOST_PIECES = 1 << 20
#: Score of a character that is no piece, below that of every piece, as in the library.
NO_PIECE = 10.0
ANSWERS = "unit long, place int, pack binary"


@dataclass
class Model:
    """Pieces, scores and byte pieces of a model; ``unigram`` tells how segments are folded."""

    pieces: list[str]
    scores: list[float]
    normal: list[bool]
    byte_ids: list[int]
    unigram: bool = False
    ids: dict[str, int] = field(init=False)

    def __post_init__(self):
        self.ids = {p: i for i, (p, ok) in enumerate(zip(self.pieces, self.normal)) if ok}

    @property
    def longest(self) -> int:
        return max(map(len, self.ids), default=1)

    def char_ids(self, c: str) -> list[int]:
        """The id of a character, or of its bytes where it is no piece."""
        return [self.ids[c]] if c in self.ids else [self.byte_ids[b] for b in c.encode()]

    def outputs(self) -> list[bytes]:
        """The bytes that each id decodes to."""
        made = [p.replace(BLANK, " ").encode() if ok else b"" for p, ok in zip(self.pieces, self.normal)]
        for b, i in enumerate(self.byte_ids):
            made[i] = bytes([b])
        return made


def load(path: str = MODEL) -> Model:
    """Read a model file of the SentencePiece library. Only the driver reads it."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    kinds = [p.type for p in proto.pieces]
    byte_ids = [0] * 256
    for i, p in enumerate(proto.pieces):
        if p.type == 6:
            byte_ids[int(p.piece[3:5], 16)] = i
    return Model([p.piece for p in proto.pieces], [p.score for p in proto.pieces], [k in (1, 4) for k in kinds], byte_ids, proto.trainer_spec.model_type == 1)


class Cutter:
    """Cuts texts where no piece holds the two characters on either side."""

    def __init__(self, model: Model):
        long = [p for p in model.ids if len(p) > 1]
        letters = sorted({c for p in long for c in p})
        self.letter = np.zeros(0x110000, np.int16)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.together = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        pairs = {p[i : i + 2] for p in long for i in range(len(p) - 1)}
        if pairs:
            at = np.array([[self.letter[ord(c)] for c in p] for p in pairs])
            self.together[at[:, 0], at[:, 1]] = True

    def cut(self, texts: list[str | None]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """All texts as one, its code points, where segments start, and how many each text has."""
        parts = [BLANK + t.replace(" ", BLANK) if t else "" for t in texts]
        whole = "".join(parts)
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(sizes)
        first = np.ones(len(codes), bool)
        kinds = self.letter[codes]
        first[1:] = ~self.together[kinds[:-1], kinds[1:]]
        starts_at = (ends - sizes)[sizes > 0]
        first[starts_at] = True
        starts = np.flatnonzero(first)
        counts = np.diff(np.searchsorted(starts, np.concatenate([[0], ends])))
        return whole, codes, starts, counts


def plain_merges(model: Model, segment: str) -> list[int]:
    """Ids of one segment by the merge order, for segments too long for the fold."""
    if model.unigram:
        return _plain_path(model, segment)
    parts = list(segment)
    before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
    heap: list = []

    def offer(a: int, b: int) -> None:
        if a >= 0 and b < len(parts) and (i := model.ids.get(parts[a] + parts[b])) is not None:
            heapq.heappush(heap, (-model.scores[i], a, b, len(parts[a]) + len(parts[b])))

    for k in range(len(parts) - 1):
        offer(k, k + 1)
    while heap:
        _, a, b, size = heapq.heappop(heap)
        if not parts[a] or not parts[b] or after[a] != b or len(parts[a]) + len(parts[b]) != size:
            continue
        parts[a] += parts[b]
        parts[b] = ""
        after[a] = after[b]
        if after[b] < len(parts):
            before[after[b]] = a
        offer(before[a], a)
        offer(a, after[a])
    return [i for p in parts if p for i in ([model.ids[p]] if p in model.ids else model.char_ids(p))]


def _plain_path(model: Model, segment: str) -> list[int]:
    lowest = min(model.scores, default=0.0) - NO_PIECE
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(segment) + 1):
        options = [(best[s][0] + model.scores[i], s) for s in range(max(0, end - model.longest), end) if (i := model.ids.get(segment[s:end])) is not None]
        if segment[end - 1] not in model.ids:
            options.append((best[end - 1][0] + lowest, end - 1))
        best.append(max(options))
    out, end = [], len(segment)
    while end:
        start = best[end][1]
        out.append(model.char_ids(segment[start:end]) if end - start == 1 else [model.ids[segment[start:end]]])
        end = start
    return [i for ids in reversed(out) for i in ids]


@cache
def _tools() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """Made once in a worker: making them costs more than a small row."""
    return zstandard.ZstdCompressor(level=2), zstandard.ZstdDecompressor()


def _squeeze(value) -> bytes:
    return _tools()[0].compress(pickle.dumps(value, protocol=5))


def _open(packed: bytes):
    return pickle.loads(_tools()[1].decompress(packed))


def _texts(lengths: bytes, joined: str) -> list[str]:
    ends = np.cumsum(np.frombuffer(lengths, np.uint8), dtype=np.int64).tolist()
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


def _packer(model: Model, wanted: str):
    """Units of texts as rows: one row per unit, or one row for each bucket that a unit asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(model)
        values = mix(np.arange(1, 0x110001, dtype=np.uint64))
        for part in slices(batches, 1, UNIT_BYTES):
            mark = xxhash.xxh64(repr(part.column(0).to_pylist()).encode())
            hashes, sizes, counts, known = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [], {}
            listed = np.zeros(0, np.uint64)  # sorted hashes of the segments that have been seen
            for piece in slices(iter([part]), 1, CUT_BYTES):
                whole, codes, starts, count = cutter.cut(piece.column(1).to_pylist())
                ends = np.append(starts[1:], len(codes))[: len(starts)]
                own = span_hashes(values[codes], starts, ends, BYTE_BASE)
                mark.update(codes.tobytes())
                hashes.append(own)
                sizes.append(ends - starts)
                counts.append(count)
                at = np.arange(len(own)) if wanted == "ask" else np.flatnonzero(sizes[-1] > LONGEST)
                fresh, seen = np.unique(own[at], return_index=True)
                if len(listed) and len(fresh):
                    new = listed[np.minimum(np.searchsorted(listed, fresh), len(listed) - 1)] != fresh
                    fresh, seen = fresh[new], seen[new]
                listed = np.sort(np.concatenate([listed, fresh]))
                seen = at[seen]
                known.update(zip(fresh.tolist(), [whole[a:b] for a, b in zip(starts[seen].tolist(), ends[seen].tolist())]))
            hashes, sizes, counts = np.concatenate(hashes), np.concatenate(sizes), np.concatenate(counts)
            mark.update(counts.tobytes())
            unit = mark.intdigest() >> 1
            by_hash = np.argsort(hashes)
            ranked = hashes[by_hash]
            new = np.concatenate([[True], ranked[1:] != ranked[:-1]])[: len(ranked)]
            heads = np.flatnonzero(new)
            order = np.argsort(-np.diff(np.append(heads, len(ranked))), kind="stable")  # the most frequent first
            distinct, size = ranked[heads[order]], sizes[by_hash[heads[order]]]
            bucket = np.where(size <= LONGEST, (distinct % np.uint64(BUCKETS)).astype(np.int64), BUCKETS)  # the last one is not asked
            if wanted == "ask":
                dealt = np.argsort(bucket, kind="stable")[: int((bucket < BUCKETS).sum())]
                cuts = np.flatnonzero(np.diff(bucket[dealt], prepend=-1, append=BUCKETS)) if len(dealt) else np.zeros(1, np.int64)
                rows, segments = [], [known[h] for h in distinct[dealt].tolist()]
                for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    rows.append((int(bucket[dealt[lo]]), _squeeze((size[dealt[lo:hi]].astype(np.uint8).tobytes(), "".join(segments[lo:hi])))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in rows], pa.int32()), pa.array(np.full(len(rows), unit)), pa.array([x for _, x in rows], pa.binary())],
                    names=["bucket", "unit", "pack"])
                continue
            long = {i: plain_merges(model, known[int(distinct[i])]) for i in np.flatnonzero(bucket == BUCKETS).tolist()}
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            places = np.empty(len(ranked), np.uint32)
            places[by_hash] = place[np.cumsum(new) - 1]
            planes = places.view(np.uint8).reshape(-1, 4).T.tobytes()  # low bytes first: they compress apart from high ones
            ids = part.column(0)
            packed = _squeeze((ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), counts, planes, long, bucket.astype(np.uint16)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([unit]), pa.array([-1], pa.int32()), pa.array([packed], pa.binary())], names=["unit", "place", "pack"])

    return run


def _interleaved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From asking rows sorted by bucket: for each row a row per segment that is new to the bucket, and then the row itself."""
    current, seen = None, set()
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            rows: list[tuple] = []
            for bucket, unit, pack in zip(*(batch.column(i).slice(lo, 200).to_pylist() for i in range(3))):
                if bucket != current:
                    current, seen = bucket, set()
                fresh = [t for t in _texts(*_open(pack)) if t not in seen]
                seen.update(fresh)
                rows += [(bucket, t, None, None) for t in fresh]
                rows.append((bucket, None, unit, pack))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary())],
                names=["bucket", "segment", "unit", "pack"])


class _Known:
    """Ids of the segments of one bucket, in arrays that grow."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.begin, self.flat = np.zeros(1024, np.int64), np.zeros(4096, np.int32)

    def add(self, segments: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        n, more = len(self.place), len(segments)
        while n + more + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.begin[n + 1 : n + more + 1] = self.begin[n] + np.cumsum(sizes)
        while self.begin[n + more] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.begin[n] : self.begin[n + more]] = ids
        self.place.update(zip(segments, range(n, n + more)))

    def answer(self, unit: int, bucket: int, pack: bytes) -> pa.RecordBatch:
        place = self.place
        at = np.array([place[t] for t in _texts(*_open(pack))], np.int64)
        many = self.begin[at + 1] - self.begin[at]
        until = np.cumsum(many)
        found = self.flat[np.repeat(self.begin[at] - (until - many), many) + np.arange(int(until[-1]))]
        return pa.RecordBatch.from_arrays(
            [pa.array([unit]), pa.array([bucket], pa.int32()), pa.array([_squeeze((many.astype(np.uint8).tobytes(), found.tobytes()))], pa.binary())],
            names=["unit", "place", "pack"])


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by bucket, first the ids of its segments and then the asking rows, one answer for each of these."""
    current, known = None, _Known()
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4))
        for bucket, unit, pack, segment, ids in rows:
            if bucket != current:
                current, known = bucket, _Known()
            if pack is None:
                known.add([segment], np.array([len(ids)]), ids.values.to_numpy())
            else:
                yield known.answer(unit, bucket, pack)


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """``piece, id, score, ord``; ``ord`` puts the best score first, and equal scores together."""
    if len(model.ids) > MOST_PIECES:
        raise ValueError("the piece table is too large to broadcast")
    ranks = {s: i for i, s in enumerate(sorted(set(model.scores), reverse=True))}
    rows = [(p, i, float(model.scores[i]), ranks[model.scores[i]]) for p, i in model.ids.items()]
    return spark.createDataFrame(rows, "piece string, id int, score double, ord int")


def lattice(segments: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """Each row of ``segments`` once for each substring of its segment that is a piece, with ``from, n, id, score, ord``.

    Every single character has an edge, with a null id where it is no piece. A
    row without a segment stays one row, with ``n`` 0. Explode and broadcast
    join move no row, so the edges of a segment stay together and in order.
    """
    size, none = F.length("segment"), F.col("segment").isNull()
    starts = F.when(none, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), size - 1))
    spots = segments.select("*", F.explode(starts).alias("from"))
    counts = F.when(none, F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.least(F.lit(longest), size - F.col("from"))))
    spans = spots.select("*", F.explode(counts).alias("n"))
    spans = spans.select("*", F.expr("substring(segment, from + 1, n)").alias("piece"))
    return spans.join(F.broadcast(pieces), "piece", "left").where("id is not null or n <= 1").drop("piece")


def best_merges(group: np.ndarray, start: np.ndarray, size: np.ndarray, order: np.ndarray, groups: int, lengths: np.ndarray) -> np.ndarray:
    """Fold all groups of edges at once: which edges are left as parts.

    The state of a group is a number whose bit ``i`` says that a part begins or
    ends at character ``i``. In each step every group takes its best edge that
    spans exactly two parts, and the bit between them goes. Edges are given by
    group, and sorted here by their order and start.
    """
    one = np.uint64(1)
    begin, end = start.astype(np.uint64), (start + size).astype(np.uint64)
    ends, inner = (one << begin) | (one << end), (one << end) - (one << (begin + one))
    state = (one << (lengths.astype(np.uint64) + one)) - one
    live = np.lexsort((start, order, group))
    live = live[size[live] > 1]
    while len(live):
        own = state[group[live]]
        joint = own & inner[live]
        possible = ((own & ends[live]) == ends[live]) & (joint != 0)
        live, joint = live[possible], joint[possible]
        fits = np.flatnonzero((joint & (joint - one)) == 0)
        if not len(fits):
            break
        at = group[live[fits]]
        first = fits[np.concatenate([[True], at[1:] != at[:-1]])]
        state[group[live[first]]] ^= joint[first]
    own = state[group]
    return np.flatnonzero(((own & ends) == ends) & ((own & inner) == 0))


def _solve_merges(model: Model, edges: pa.Table) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The segments whose edges these are, how many ids each has, and all ids."""
    names = edges.column("segment")
    group = np.cumsum(names.is_valid().to_numpy().astype(np.int64)) - 1
    start, size = edges.column("from").to_numpy(), edges.column("n").to_numpy()
    segments = names.drop_null().to_pylist()
    lengths = np.bincount(group[size == 1], minlength=len(segments))
    ids = edges.column("id").fill_null(-1).to_numpy()
    kept = best_merges(group, start, size, edges.column("ord").fill_null(0).to_numpy(), len(segments), lengths)
    kept = kept[np.lexsort((start[kept], group[kept]))]
    counts, found = np.bincount(group[kept], minlength=len(segments)), ids[kept]
    if (found < 0).any():
        of, at = group[kept], start[kept]
        parts = [[i] if i >= 0 else model.char_ids(segments[g][k]) for i, g, k in zip(found.tolist(), of.tolist(), at.tolist())]
        counts = np.bincount(of, weights=np.fromiter(map(len, parts), float, len(parts)), minlength=len(segments)).astype(np.int64)
        found = np.array([i for p in parts for i in p], np.int64)
    return segments, counts, found.astype(np.int32)


def _fold_merges(model: Model):
    """From edges of segments and asking rows, in their order, an answer for each asking row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known = None, _Known()

        def answers(table: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal current, known
            is_edge = table.column("n").to_numpy() > 0
            segments, counts, ids = _solve_merges(model, table.filter(pa.array(is_edge)))
            begin = np.concatenate([[0], np.cumsum(counts)])
            heads = np.flatnonzero(table.column("segment").is_valid().to_numpy())
            asking = np.flatnonzero(~is_edge)
            bucket_of = table.column("bucket").to_numpy()
            asks = table.filter(pa.array(~is_edge))
            done = 0
            upto = [*np.searchsorted(heads, asking).tolist(), len(heads)]
            rows = [*zip(asks.column("bucket").to_pylist(), asks.column("unit").to_pylist(), asks.column("pack").to_pylist()), None]
            for row, end in zip(rows, upto):
                bucket = row[0] if row else (int(bucket_of[heads[done]]) if done < end else current)
                if bucket != current:
                    current, known = bucket, _Known()
                if end > done:
                    known.add(segments[done:end], counts[done:end], ids[begin[done] : begin[end]])
                    done = end
                if row:
                    yield known.answer(row[1], bucket, row[2])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            heads = np.flatnonzero(batch.column("segment").is_valid().to_numpy(zero_copy_only=False) | (batch.column("n").to_numpy() == 0))
            if sum(b.num_rows for b in held) >= FOLD_ROWS and len(heads):
                yield from answers(pa.Table.from_batches([*held, batch.slice(0, heads[-1])]))
                held = [batch.slice(heads[-1])]
            elif batch.num_rows:
                held.append(batch)
        if held:
            yield from answers(pa.Table.from_batches(held))

    return run


def viterbi(edges: Column, size: Column, lowest: float) -> tuple[Column, Column]:
    """Fold a segment by scores: for each end the best sum over the edges that reach it, and the path back.

    The results are these sums, for the column ``best``, and the path's parts
    as (from, id). Of equal sums the one with the shorter last edge is taken.
    """
    start = F.array(F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("from"), F.lit(None).cast("int").alias("id")))

    def step(best: Column, end: Column) -> Column:
        reach = F.transform(
            F.filter(edges, lambda e: e["to"] == end),
            lambda e: F.struct((F.get(best, e["from"])["sum"] + F.coalesce(e["score"], F.lit(lowest))).alias("sum"), e["from"].alias("from"), e["id"].alias("id")))
        return F.concat(best, F.array(F.array_max(reach)))

    best = F.aggregate(F.sequence(F.lit(1), size), start, step)

    def back(path: Column, _: Column) -> Column:
        at = F.get(F.col("best"), path["at"])
        return F.when(path["at"] == 0, path).otherwise(F.struct(
            at["from"].alias("at"), F.concat(F.array(F.struct(at["from"].alias("from"), at["id"].alias("id"))), path["parts"]).alias("parts")))

    none = F.expr("cast(array() as array<struct<from: int, id: int>>)")
    return best, F.aggregate(F.sequence(F.lit(1), size), F.struct(size.alias("at"), none.alias("parts")), back)["parts"]


def best_paths(segments: DataFrame, pieces: DataFrame, model: Model) -> DataFrame:
    """``bucket, segment, ids`` for distinct segments of a unigram model: the edges folded to the path of the best sum."""
    found = lattice(segments, pieces, model.longest)
    edge = F.struct(F.col("from").cast("int").alias("from"), (F.col("from") + F.col("n")).cast("int").alias("to"), "id", "score")
    edges = found.groupBy("bucket", "segment").agg(F.collect_list(edge).alias("edges"))
    best, parts = viterbi(F.col("edges"), F.length("segment"), min(model.scores, default=0.0) - NO_PIECE)
    byte_ids = F.array(*map(F.lit, model.byte_ids))

    def of(p: Column) -> Column:
        raw = F.encode(F.substring(F.col("segment"), p["from"] + 1, F.lit(1)), "UTF-8")
        bytes_of = F.transform(
            F.sequence(F.lit(1), F.octet_length(raw)), lambda k: F.get(byte_ids, F.conv(F.hex(F.substring(raw, k, F.lit(1))), 16, 10).cast("int")))
        return F.when(p["id"].isNotNull(), F.array(p["id"])).otherwise(bytes_of)

    folded = edges.withColumn("best", best).withColumn("parts", parts)
    return folded.select("bucket", "segment", F.flatten(F.transform("parts", of)).alias("ids"))


def merge_answers(asked: DataFrame, pieces: DataFrame, model: Model) -> DataFrame:
    """Answers to asking rows by a merge model (BPE).

    There the path of the best sum is another segmentation than the model's
    own, so the fold is one of merges, best score first. Asking rows pass the
    lattice behind the segments that are new with them, so nothing is dealt twice.
    """
    rows = map_batches(asked.sortWithinPartitions("bucket"), _interleaved, "bucket int, segment string, unit long, pack binary")
    found = lattice(rows, pieces, model.longest)
    name = F.when((F.col("from") == 0) & (F.col("n") == 1), F.col("segment")).alias("segment")
    return map_batches(found.select("bucket", "unit", "pack", name, "from", "n", "id", "ord"), _fold_merges(model), ANSWERS)


def path_answers(asked: DataFrame, pieces: DataFrame, model: Model) -> DataFrame:
    """Answers to asking rows by a unigram model."""
    fresh = map_batches(asked.sortWithinPartitions("bucket"), _interleaved, "bucket int, segment string, unit long, pack binary")
    known = best_paths(fresh.where("segment is not null").select("bucket", "segment"), pieces, model)
    asking = asked.select("bucket", "unit", "pack", F.lit(None).cast("string").alias("segment"), F.lit(None).cast("array<int>").alias("ids"))
    known = known.select("bucket", F.lit(None).cast("long").alias("unit"), F.lit(None).cast("binary").alias("pack"), "segment", "ids")
    both = asking.unionByName(known).repartition("bucket").sortWithinPartitions("bucket", F.col("pack").isNotNull())
    return map_batches(both, _answer, ANSWERS)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by unit and place: the pack of a unit, then the answers of the buckets that it has asked."""

    def solve(packs: list[bytes], answers: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        opened = [(b, *_open(x)) for b, x in dict(answers).items()]
        for doc_ids, nulls, counts, planes, long, bucket in map(_open, packs):
            asked = np.flatnonzero(bucket < BUCKETS)
            asked = asked[np.argsort(bucket[asked], kind="stable")]
            many = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(m, np.uint8) for _, m, _ in opened)]).astype(np.int64)
            if len(many) != len(asked) or sorted({b for b, _, _ in opened}) != np.unique(bucket[asked]).tolist():
                raise RuntimeError("texts were packed in two ways: the input gives other rows when it is read again; cut its lineage first")
            found = np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(x, np.int32) for _, _, x in opened)])
            size, begin = np.zeros(len(bucket), np.int64), np.zeros(len(bucket), np.int64)
            size[asked], begin[asked] = many, np.cumsum(many) - many
            for i, ids in long.items():
                size[i], begin[i] = len(ids), len(found)
                found = np.concatenate([found, np.array(ids, np.int32)])
            places = np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
            bounds = np.concatenate([[0], np.cumsum(counts)])
            step = max(1, len(counts) * 1_000_000 // max(1, len(places)))
            for lo in range(0, len(counts), step):
                hi = min(len(counts), lo + step)
                own = places[bounds[lo] : bounds[hi]]
                lengths = size[own]
                until = np.cumsum(lengths)
                out = found[np.repeat(begin[own] - (until - lengths), lengths) + np.arange(int(until[-1]) if len(until) else 0)]
                offsets = np.concatenate([[0], until])[bounds[lo : hi + 1] - bounds[lo]]
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(out, pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids[lo:hi], pa.int64(), mask=nulls[lo:hi]), lists], names=["doc_id", "ids"])

    current, packs, answers = None, [], []
    for batch in batches:
        for unit, place, pack in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if unit != current:
                if packs or answers:
                    yield from solve(packs, answers)
                current, packs, answers = unit, [], []
            if place < 0:
                packs.append(pack)
            else:
                answers.append((place, pack))
    if answers and not packs:
        raise RuntimeError("texts were packed in two ways: the input gives other rows when it is read again; cut its lineage first")
    yield from solve(packs, answers)


def encode(docs: DataFrame, model: Model, text: bool = False) -> DataFrame:
    """``doc_id, ids`` for every row of ``docs (doc_id, text)``: the ids that the model gives the whole text.

    With ``text``, the text decoded again from the ids follows.

    A blank is put before each text, and blanks are the model's blank sign, as
    the model asks for. Null and empty texts have no ids; a null or repeated id
    keeps its rows. Texts of any length are encoded whole. ``docs`` is read
    more than once and has to give the same rows each time, as a table does.

    Texts stay where they are read. A unit of texts travels once, as the
    numbers of its segments, and so does what it asks and is answered; a
    frequent segment is asked once by each unit.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = map_batches(docs, _packer(model, "ask"), "bucket int, unit long, pack binary").repartition("bucket")
    answers = (path_answers if model.unigram else merge_answers)(asked, piece_table(spark, model), model)
    rows = map_batches(docs, _packer(model, "pack"), ANSWERS).unionByName(answers)
    dealt = rows.repartition("unit").sortWithinPartitions("unit", "place")
    if not text:
        return map_batches(dealt, _assemble, "doc_id long, ids array<int>")

    def both_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for batch in _assemble(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, decoder(batch.column(1))], names=["doc_id", "ids", "text"])

    return map_batches(dealt, both_ways, "doc_id long, ids array<int>, text string")


class Decoder:
    """Texts from lists of ids."""

    def __init__(self, model: Model):
        outputs = model.outputs()
        self.data = np.frombuffer(b"".join(outputs), np.uint8)
        self.size = np.fromiter(map(len, outputs), np.int64, len(outputs))
        self.begin = np.cumsum(self.size) - self.size

    def __call__(self, column: pa.Array) -> pa.Array:
        made = [pa.array([], pa.string())]
        for lo in range(0, len(column), 200):
            part = column.slice(lo, 200).cast(pa.large_list(pa.int32()))
            nulls = part.is_null().to_numpy(zero_copy_only=False)
            counts = np.where(nulls, 0, np.diff(part.offsets.to_numpy()))
            flat = part.flatten().to_numpy(zero_copy_only=False)
            lengths = self.size[flat]
            until = np.cumsum(lengths)
            whole = self.data[np.repeat(self.begin[flat] - (until - lengths), lengths) + np.arange(int(until[-1]) if len(until) else 0)].tobytes()
            bounds = np.concatenate([[0], until])[np.concatenate([[0], np.cumsum(counts)])].tolist()
            texts = [None if n else whole[a:b].removeprefix(b" ").decode("utf-8", "replace") for a, b, n in zip(bounds, bounds[1:], nulls.tolist())]
            made.append(pa.array(texts, pa.string()))
        return pa.concat_arrays(made)


def decode(df: DataFrame, model: Model, ids: str = "ids", name: str = "text") -> DataFrame:
    """Append the text that a list of ids stands for. A null list decodes to null, an empty one to an empty text."""
    place = df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, decoder(batch.column(place))], names=[*batch.schema.names, name])

    return map_batches(df, run, StructType([*df.schema.fields, StructField(name, StringType())]))


def encode_decode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``doc_id, n_pieces, ids, text``: every text encoded whole, and decoded again from its ids."""
    out = encode(docs, load(path), text=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "text")
