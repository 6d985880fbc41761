"""Chat formatting by columnar byte assembly."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import map_batches, slices

#: Control strings. A turn is OPEN, its role, MIDDLE, its text, CLOSE.
BEGIN, END, LEFT, RIGHT = "<s>", "</s>", "[INST]", "[/INST]"
OPEN, MIDDLE, CLOSE = f"{BEGIN}{LEFT} ", f" {RIGHT}\n", f"{END}\n"
#: A text's control string gets a backslash after its first character, and one more if it has some already.
ESCAPE = re.compile(r"([<\[])(?=\\*(?:s>|/s>|INST\]|/INST\]))")
UNESCAPE = re.compile(r"([<\[])\\(?=\\*(?:s>|/s>|INST\]|/INST\]))")
TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\]\n(.*?)</s>\n", re.DOTALL)
LOSS_ROLE = "assistant"
SLICE_BYTES = 4 << 20
PART = "conv_id long, part long, text string, loss_starts array<int>, loss_ends array<int>"


def escape(text: str) -> str:
    return ESCAPE.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1", text)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts that a formatted text was made of."""
    return [(unescape(r), unescape(t)) for r, t in TURN.findall(formatted)]


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an escaped text column."""
    made = pa.array([escape(t) if t and ("<" in t or "[" in t) else t or "" for t in column.to_pylist()], pa.large_string())
    _, offsets, data = made.buffers()
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), np.frombuffer(offsets, np.int64)[: len(made) + 1]


def _scatter(out: np.ndarray, to: np.ndarray, source: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
    """Copy ``source[begin:begin + size]`` of every row to ``out[to:]``, all rows by one index array."""
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(to, size) + step] = source[np.repeat(begin, size) + step]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all formatted turns, where each begins (and the end of all), and where its text begins and ends.

    Lengths of all segments are computed first; their running sum says where
    each one goes, and headers and contents are copied into a buffer that is
    allocated once.
    """
    n = len(roles)
    role, role_at = _buffer(roles)
    text, text_at = _buffer(texts)
    fixed = [np.frombuffer(s.encode(), np.uint8) for s in (OPEN, MIDDLE, CLOSE)]
    sizes = np.empty((n, 5), np.int64)
    sizes[:, [0, 2, 4]] = [len(f) for f in fixed]
    sizes[:, 1], sizes[:, 3] = np.diff(role_at), np.diff(text_at)
    ends = np.cumsum(sizes.ravel()).reshape(n, 5)
    begins = ends - sizes
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for column, source in zip((0, 2, 4), fixed):
        _scatter(out, begins[:, column], source, np.zeros(n, np.int64), sizes[:, column])
    _scatter(out, begins[:, 1], role, role_at[:-1], sizes[:, 1])
    _scatter(out, begins[:, 3], text, text_at[:-1], sizes[:, 3])
    return out, np.concatenate([begins[:, 0], [len(out)]]), begins[:, 3], ends[:, 3]


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, part, text, loss_starts, loss_ends``: the formatted turns of each conversation.

    Turns are ordered by their number (nulls first), and turns of one number
    by role and text. A null text or role is an empty one, and a null
    conversation id is a conversation of its own. A conversation is one row,
    or several with running ``part`` numbers if it does not fit one batch, so
    one of any length streams through a task; its parts follow each other.
    ``loss_starts`` and ``loss_ends`` bound the assistant texts, in bytes of the part.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, part = object(), 0
        for rows in slices(batches, 3, SLICE_BYTES):
            ids = rows.column(0).to_pylist()
            out, at, begin, end = assemble(rows.column(2), rows.column(3))
            heads = [i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]]
            offsets = np.append(at[heads], len(out))
            loss = np.array([r == LOSS_ROLE for r in rows.column(2).to_pylist()], bool)
            parts, starts, ends = [], [], []
            for lo, hi in zip(heads, [*heads[1:], len(ids)]):
                part = part + 1 if ids[lo] == current else 0
                current = ids[lo]
                parts.append(part)
                own = np.arange(lo, hi)[loss[lo:hi]]
                starts.append(begin[own] - at[lo])
                ends.append(end[own] - at[lo])
            text = pa.Array.from_buffers(pa.large_string(), len(heads), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in heads], pa.int64()), pa.array(parts, pa.int64()), text.cast(pa.string()),
                 pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))],
                names=["conv_id", "part", "text", "loss_starts", "loss_ends"])

    return map_batches(dealt, run, PART)


def digests(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: turns, the text under the loss mask, and their digests.

    The parts of a conversation have to follow each other in one partition, as
    ``format_conversations`` leaves them; digests run on over them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        state: list | None = None

        def close() -> None:
            if state is not None:
                conv, turns, hashed, chars, loss, size = state
                done.append((conv, turns, hashed.hexdigest(), chars, loss.hexdigest(), size))

        for batch in batches:
            for conv, part, text, starts, ends in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if part == 0:
                    close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_turns(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                raw = text.encode()
                for lo, hi in zip(starts, ends):
                    said = unescape(raw[lo:hi].decode())
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(text)
        close()
        columns = list(zip(*done)) or [[]] * 6
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return map_batches(formatted, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
