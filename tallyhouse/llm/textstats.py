"""Counts and shares of a text that quality rules and classifiers use."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tallyhouse.llm.common import map_batches, slices
from tallyhouse.llm.words import BYTE_BASE, BYTE_VALUES, WORD_BASE, later_copies, mix, per_text, repeated, span_hashes, words_of

SLICE_BYTES = 1 << 20
REPEAT_WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "mean_word", "symbols_per_word", "repeat_share", "dup_line_share", "distinct_share",
    "upper_share", "digit_share", "stop_share", "bang_share", "words_per_line", "short_share",
)
#: Further shares, for rules: words equal to the word before them, and the vocabulary adjusted to the length of the text.
EXTRA = ("same_share", "vocabulary")


def _marked(characters: str) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[[ord(c) for c in characters]] = True
    return marks


SYMBOL, BANG, STOP = _marked("#*$%&|<>"), _marked("!?"), _marked(".,;:")
UPPER = _marked("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGIT = _marked("0123456789")


def measure_texts(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts (int64) and features (float64) of every text of a column; null counts as empty."""
    w = words_of(column)
    data, offsets, n = w.data, w.offsets, len(column)
    lead = (data & 0xC0) != 0x80
    in_word = np.zeros(len(data) + 1, np.int8)
    np.add.at(in_word, w.starts, 1)
    np.add.at(in_word, w.ends, -1)
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    doc = w.text_of()
    counts = {
        "n_words": w.counts.astype(np.int64),
        "word_chars": per_text(lead & in_word, offsets),
        "n_symbols": per_text(SYMBOL[data], offsets),
    }
    # lines: split at \n and at the ends of texts
    breaks = np.flatnonzero(data == 0x0A)
    begin = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    end = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    line_words = np.searchsorted(w.starts, end) - np.searchsorted(w.starts, begin)
    begin, end, line_words = begin[line_words > 0], end[line_words > 0], line_words[line_words > 0]
    line_doc = np.searchsorted(offsets, begin, side="right") - 1
    line_hash = span_hashes(BYTE_VALUES[data], begin, end, BYTE_BASE)
    copies = later_copies(mix(line_hash ^ mix(line_doc.astype(np.uint64))))
    lines = np.bincount(line_doc, minlength=n)[:n]
    counts["n_dup_lines"] = np.bincount(line_doc[copies], minlength=n)[:n].astype(np.int64)
    # words inside windows that occur more than once in their text
    own = w.hashes()
    at = w.windows(REPEAT_WINDOW)
    window = span_hashes(own, at, at + REPEAT_WINDOW, WORD_BASE)
    hits = at[repeated(mix(window ^ mix(doc[at].astype(np.uint64))))]
    depth = np.zeros(len(own) + 1, np.int64)
    np.add.at(depth, hits, 1)
    np.add.at(depth, hits + REPEAT_WINDOW, -1)
    counts["n_repeat_words"] = per_text(np.cumsum(depth[:-1]) > 0, w.first)
    same = np.zeros(len(own), bool)
    same[1:] = (own[1:] == own[:-1]) & (doc[1:] == doc[:-1])
    distinct = per_text(~later_copies(mix(own ^ mix(doc.astype(np.uint64)))), w.first)

    words = np.maximum(counts["n_words"], 1)
    chars = np.maximum(counts["word_chars"], 1)
    features = {
        "log_words": np.log1p(counts["n_words"]),
        "mean_word": counts["word_chars"] / words,
        "symbols_per_word": counts["n_symbols"] / words,
        "repeat_share": counts["n_repeat_words"] / words,
        "dup_line_share": counts["n_dup_lines"] / np.maximum(lines, 1),
        "distinct_share": distinct / words,
        "upper_share": per_text(UPPER[data], offsets) / chars,
        "digit_share": per_text(DIGIT[data], offsets) / chars,
        "stop_share": per_text(STOP[data], offsets) / words,
        "bang_share": per_text(BANG[data], offsets) / words,
        "words_per_line": np.log1p(counts["n_words"] / np.maximum(lines, 1)),
        "short_share": per_text((w.ends - w.starts) <= 2, w.first) / words,
        "same_share": per_text(same, w.first) / words,
        "vocabulary": np.log1p(distinct) / np.log1p(words),
    }
    return counts | features


def measure(
    df: DataFrame,
    text: str = "text",
    prefix: str = "",
    score: Callable[[dict[str, np.ndarray]], np.ndarray] | None = None,
) -> DataFrame:
    """Append the counts and features of a text column to every row.

    All columns of ``df`` stay as they are; names of the new ones begin with
    ``prefix``, which has to keep them apart. Null and empty texts measure
    zero. Long texts are measured whole; memory is bounded by ``SLICE_BYTES``
    or the longest single text. With ``score``, a number made from the
    measures of each row is appended as ``score``.
    """
    place = df.columns.index(text)
    added = [*COUNTS, *FEATURES, *EXTRA, *(["score"] if score else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, place, SLICE_BYTES):
            found = measure_texts(part.column(place))
            if score:
                found["score"] = score(found)
            arrays = [pa.array(found[c]) for c in added]
            names = [*part.schema.names, *(prefix + c for c in added)]
            yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=names)

    kinds = ", ".join(f"`{prefix}{c}` {'bigint' if c in COUNTS else 'double'}" for c in added)
    return map_batches(df, run, StructType([*df.schema.fields, *StructType.fromDDL(kinds).fields]))
