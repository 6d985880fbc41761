"""Word positions and measures against plain Python."""

import collections
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhouse.llm import textstats
from tallyhouse.llm.words import words_of

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é#|\n\t \x1f ", max_size=60)), max_size=6)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    w = words_of(pa.array(texts, pa.string()))
    data = w.data.tobytes()
    got = [[data[a:b].decode() for a, b in zip(w.starts[lo:hi], w.ends[lo:hi])] for lo, hi in zip(w.first[:-1], w.first[1:])]
    assert got == [split(t) for t in texts]
    values = w.hashes()
    flat = [x for t in texts for x in split(t)]
    assert len(set(flat)) == len(set(values.tolist()))


def plain_measures(text):
    words = split(text)
    seen, copies = set(), 0
    for line in (text or "").split("\n"):
        if split(line):
            copies += line in seen
            seen.add(line)
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = collections.Counter(runs)
    covered = {j for i, r in enumerate(runs) if often[r] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), copies, len(covered)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_measures(texts):
    got = textstats.measure_texts(pa.array(texts, pa.string()))
    assert list(zip(*(got[c].tolist() for c in textstats.COUNTS))) == [plain_measures(t) for t in texts]


def test_slices_of_arrays_measure_the_same():
    texts = pa.array(["a b", None, "", "x y z é", "a\na\n\na"])
    whole, part = textstats.measure_texts(texts), textstats.measure_texts(texts.slice(3))
    for c in textstats.COUNTS + textstats.FEATURES:
        assert whole[c][3:].tolist() == part[c].tolist()
