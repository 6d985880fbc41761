"""Spelling variants: words one edit apart, found by walking a trie as a table.

The trie of the vocabulary is a table of edges. A state is a pair of places in
it that one edit has led to from the same place; a place is a node, or, below
the last branch, a word and a position in it. Each round joins the states with
the edges and takes both places one letter further. A state whose places both
are words is settled by what is left of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage, map_batches, slices
from tallyhouse.llm.words import text_bytes

SLICE_BYTES = 4 << 20
#: One run in so many loses a letter; shorter and rarer words are left out.
DROP, LEAST_CHARS, LEAST_COUNT = 97, 5, 3
#: Letters of a word that one pass over the vocabulary turns into edges; a node this deep or less is named by its prefix.
LEVELS = 32
#: A frontier of at most so many states and bytes, which are counted first, is sent to the edges; a larger one meets them by a shuffle.
SENT_STATES, SENT_BYTES = 100_000, 8 << 20
#: Tables that move the checksum of what comes before a run of this many bytes at most.
MOVED_BYTES = 48

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


class Moves:
    """What ``n`` bytes do to the checksum before them: ``crc(a + b) = moved(crc(a), len(b)) ^ crc(b)``."""

    def __init__(self):
        self.tables = np.zeros((MOVED_BYTES + 1, 4, 256), np.uint32)
        for n in range(MOVED_BYTES + 1):
            zeros = b"\0" * n
            none = zlib.crc32(zeros)
            bits = [zlib.crc32(zeros, 1 << i) ^ none for i in range(32)]
            for byte in range(4):
                table = self.tables[n, byte]
                for i in range(8):
                    table[1 << i : 2 << i] = table[: 1 << i] ^ np.uint32(bits[8 * byte + i])

    def moved(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        found = self.tables[n, 0, crc & 255]
        for byte in (1, 2, 3):
            found ^= self.tables[n, byte, (crc >> (8 * byte)) & 255]
        return found


def letter_runs(column: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """For each run of letters of the texts the number of its text, and the run with A to Z in lower case.

    In UTF-8 the letters from U+00C0 to U+00FF are the byte 0xC3 and one more.
    """
    data, offsets = text_bytes(column)
    letter = _LETTER[data]
    wide = data == 0xC3
    letter |= wide
    letter[1:] |= wide[:-1]
    before = np.zeros(len(data), bool)
    before[1:] = letter[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = letter[1:]
    if len(data):
        cuts = offsets[:-1]
        before[cuts[cuts < len(data)]] = False
        ends_at = offsets[1:]
        after[ends_at[ends_at > 0] - 1] = False
    starts, ends = np.flatnonzero(letter & ~before), np.flatnonzero(letter & ~after) + 1
    letters = _LOWER[data[letter]]
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    runs = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(letters.tobytes())])
    text = np.searchsorted(offsets, starts, side="right") - 1
    return text, runs.dictionary_encode()


def _without(run: str, h: int) -> str:
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, drop: int = DROP, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the runs of letters of all texts, of which one in ``drop``, by document and run, has lost a letter.

    Words are counted in each slice of texts, then in each task, then over
    all; what is shuffled is one row per task and word. A null id counts as an
    empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves = Moves()
        for part in slices(batches, 1, SLICE_BYTES):
            text, runs = letter_runs(part.column(1))
            if not len(runs):
                continue
            names, which = runs.dictionary.to_pylist(), runs.indices.to_numpy().astype(np.int64)
            size = pc.binary_length(runs.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
            own = np.array([zlib.crc32(w.encode()) for w in names], np.uint32)
            prefixes = [f"{'' if d is None else d}:".encode() for d in part.column(0).to_pylist()]
            before = np.array([zlib.crc32(p) for p in prefixes], np.uint32)
            h = moves.moved(before[text], np.minimum(size[which], MOVED_BYTES)) ^ own[which]
            for i in np.flatnonzero(size[which] > MOVED_BYTES).tolist():
                h[i] = zlib.crc32(names[which[i]].encode(), int(before[text[i]]))
            changed = h % np.uint32(drop) == 0
            counts = np.bincount(which[~changed], minlength=len(names))
            words = pa.array(names, pa.string())
            seen = (counts > 0) & (pc.utf8_length(words).to_numpy(zero_copy_only=False) >= least_chars)
            yield pa.RecordBatch.from_arrays([words.filter(pa.array(seen)), pa.array(counts[seen].astype(np.int64))], names=["word", "n"])
            made = [_without(names[w], x) for w, x in zip(which[changed].tolist(), h[changed].tolist())]
            made = [w for w in made if len(w) >= least_chars]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.string()), pa.array(np.ones(len(made), np.int64))], names=["word", "n"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _node(word: str, length: str) -> str:
    """The name of the node for a prefix: the prefix, or a digest of it, which no prefix can be."""
    prefix = f"substring({word}, 1, {length})"
    return f"CASE WHEN {length} <= {LEVELS} THEN {prefix} ELSE concat('#', {length}, ':', sha2({prefix}, 256)) END"


def trie(vocabulary: DataFrame) -> DataFrame:
    """``node, edges``: the trie of ``vocabulary (word, n)``, one row per prefix that two words or more have.

    An edge has a letter, or an empty one where a word ends, and leads to a
    node, or to the one word below it, its count and what is left of it.
    Prefixes are made for ``LEVELS`` letters at a time, and further ones only
    for words that still share theirs, so a long word costs little by itself.
    """
    active, at, parts = vocabulary, 0, []
    while True:
        last = f"least(length(word), {at + LEVELS - 1})"
        steps = active.selectExpr("word", "n", f"explode(sequence({at}, {last})) AS i") if at else active.selectExpr("word", "n", f"explode(sequence(0, {last})) AS i")
        edges = steps.selectExpr(f"{_node('word', 'i')} AS node", "substring(word, i + 1, 1) AS c", "word", "n", "i")
        parts.append(edges.groupBy("node", "c").agg(F.count(F.lit(1)).alias("words"), F.max("word").alias("word"), F.max("n").alias("n"), F.max("i").alias("i")))
        at += LEVELS
        deep = active.where(F.length("word") >= at).withColumn("prefix", F.expr(f"substring(word, 1, {at})"))
        shared = deep.groupBy("prefix").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("prefix")
        active = cut_lineage(deep.join(shared, "prefix").select("word", "n"))
        if active.isEmpty():
            break
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    single = "words = 1"
    edge = F.struct(
        "c", F.expr(f"CASE WHEN NOT ({single}) THEN {_node('word', '(i + 1)')} END").alias("node"), F.expr(f"CASE WHEN {single} THEN word END").alias("word"),
        F.expr(f"CASE WHEN {single} THEN n END").alias("n"), F.expr(f"CASE WHEN {single} THEN substring(word, i + 2) END").alias("rest"))
    return every.select("node", "words", edge.alias("edge")).groupBy("node").agg(F.sum("words").alias("words"), F.collect_list("edge").alias("edges")).where("words > 1").drop("words")


PLACE = "named_struct('node', {node}, 'word', {word}, 'n', {n}, 'rest', {rest})"
_EDGE_PLACE = {side: PLACE.format(**{f: f"{side}.{f}" for f in ("node", "word", "n", "rest")}) for side in ("x", "y")}


def first_states(nodes: DataFrame) -> DataFrame:
    """The states ``a, b, barred`` after one edit at each node.

    Two letters that replace each other lead to two different edges. A letter
    more on one side leads down one edge and stays on the other side, where
    the next letter has to be another one (``barred``); so each pair of words
    is found once, where they part.
    """
    letters = nodes.selectExpr("node", "filter(edges, e -> e.c <> '') AS edges")
    pairs = letters.selectExpr("edges", "explode(edges) AS x").selectExpr("x", "explode(filter(edges, e -> e.c > x.c)) AS y")
    replaced = pairs.selectExpr(f"{_EDGE_PLACE['x']} AS a", f"{_EDGE_PLACE['y']} AS b", "CAST(NULL AS STRING) AS barred")
    stays = PLACE.format(node="node", word="CAST(NULL AS STRING)", n="CAST(NULL AS BIGINT)", rest="CAST(NULL AS STRING)")
    added = letters.selectExpr("node", "explode(edges) AS x").selectExpr(f"{_EDGE_PLACE['x']} AS a", f"{stays} AS b", "x.c AS barred")
    return replaced.unionByName(added)


def _alive(states: DataFrame) -> DataFrame:
    """Without states of two words that differ in what is left of them."""
    return states.where("a.node IS NOT NULL OR b.node IS NOT NULL OR a.rest = b.rest")


def advance(states: DataFrame, nodes: DataFrame, send: bool) -> DataFrame:
    """States of which a place is a node, one letter further."""
    sent = F.broadcast if send else (lambda df: df)
    one = states.where("a.node IS NULL OR b.node IS NULL")
    one = one.selectExpr("CASE WHEN a.node IS NULL THEN a ELSE b END AS w", "coalesce(a.node, b.node) AS node", "barred")
    letter = "substring(w.rest, 1, 1)"
    met = sent(one.where(f"barred IS NULL OR barred <> {letter}")).join(nodes, "node").selectExpr("w", f"explode(filter(edges, e -> e.c = {letter})) AS y")
    moved = PLACE.format(node="w.node", word="w.word", n="w.n", rest="substring(w.rest, 2)")
    settled = met.selectExpr(f"{moved} AS a", f"{_EDGE_PLACE['y']} AS b", "CAST(NULL AS STRING) AS barred")
    two = states.where("a.node IS NOT NULL AND b.node IS NOT NULL").selectExpr("a.node AS node", "b.node AS other", "barred")
    first = sent(two).join(nodes, "node").selectExpr("other AS node", "filter(edges, e -> barred IS NULL OR e.c <> barred) AS xs")
    both = sent(first).join(nodes, "node").selectExpr("edges", "explode(xs) AS x").selectExpr("x", "explode(filter(edges, e -> e.c = x.c)) AS y")
    walked = both.selectExpr(f"{_EDGE_PLACE['x']} AS a", f"{_EDGE_PLACE['y']} AS b", "CAST(NULL AS STRING) AS barred")
    return settled.unionByName(walked)


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: each pair of words one edit apart, once.

    A node meets at most as many others as one edit makes of its prefix, so no
    key of the joins is hot, however many words lie below it.
    """
    nodes = cut_lineage(trie(vocabulary))
    states = cut_lineage(_alive(first_states(nodes)))
    found = []
    while True:
        ended = states.where("a.node IS NULL AND b.node IS NULL")
        found.append(ended.selectExpr("a.word AS word", "a.n AS n", "b.word AS near", "b.n AS near_n"))
        states = states.where("a.node IS NOT NULL OR b.node IS NOT NULL")
        size = "coalesce(length(a.node), 0) + coalesce(length(b.node), 0) + 2 * coalesce(length(coalesce(a.word, b.word)), 0)"
        count, chars = states.agg(F.count(F.lit(1)), F.sum(F.expr(size))).first()
        if not count:
            break
        states = cut_lineage(_alive(advance(states, nodes, count <= SENT_STATES and 2 * chars <= SENT_BYTES)))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def with_roots(words: DataFrame) -> DataFrame:
    """Append ``root`` to rows with ``word`` and ``form``: forms followed to a word without one.

    Roots go down to the words they are forms of, level by level. A word is
    the form of its near words only, so no key is hot, and counts double from
    a word to its form, so there are few levels.
    """
    words = cut_lineage(words)
    level = words.where("form IS NULL").withColumn("root", F.col("word"))
    links = words.where("form IS NOT NULL")
    every = level
    while True:
        heads = level.select(F.col("word").alias("form"), "root")
        level = cut_lineage(links.join(heads, "form").select(*words.columns, "root"))
        if level.isEmpty():
            return every
        every = every.unionByName(level)


def spelling_variants(docs: DataFrame, drop: int = DROP, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the texts that is long and frequent enough.

    The form of a word is the most frequent word one edit away, if it has
    twice the count; of equal ones the first in code-point order. Null and
    empty texts have no words; repeated rows count again; a null id counts as
    an empty one; further columns are not read. Runs of any length are words.
    """
    vocabulary = cut_lineage(word_counts(docs, drop, least_chars, least_count))
    pairs = neighbours(vocabulary)
    back = pairs.selectExpr("near AS word", "near_n AS n", "word AS near", "n AS near_n")
    alone = vocabulary.selectExpr("word", "n", "CAST(NULL AS STRING) AS near", "CAST(NULL AS BIGINT) AS near_n")
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))))
    grouped = pairs.unionByName(back).unionByName(alone).groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    good = "-best.less >= 2 * n"
    return with_roots(grouped.selectExpr("word", f"CASE WHEN {good} THEN best.near END AS form", "n", "n_near", f"CASE WHEN {good} THEN -best.less END AS form_n"))
