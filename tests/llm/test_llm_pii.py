"""Personal data: base rules against the plain patterns, disguises against their sources."""

import hashlib
import re
import time

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhouse.llm import pii


def plain_base(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c in "0123456789"][::-1]
        if 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
            found.append(("phone", *m.span()))
    return found


PIECES = st.sampled_from(["a", "b.c", "@", "x@y.zz", "@d.e", ".", "..", "%", "+", "-", " ", "1", "12", "255", "256", "1.2.3.4", "+49 30 1234567", "(0)",
                          "4111 1111 1111 1111", "4111111111111111", "7", "0", "é", "٣", "\n", "_", "00", "x@y"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    base, every = pii.spans(text)
    assert [(k, a, b) for k in pii.KINDS for a, b in base[k]] == plain_base(text)
    for k in pii.KINDS:
        assert set(base[k]) <= set(every[k])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PIECES, st.sampled_from(["one", "two ", "nine", "zero ", " dot ", " at ", "[at]", "(dot)", "plus ", "＠", "４", "​", "O", "l", ","])), max_size=20).map("".join))
def test_all_spans_lie_in_the_text_and_apart_from_base(text):
    base, every = pii.spans(text)
    extra = [s for k in pii.KINDS for s in every[k] if s not in base[k]]
    assert all(0 <= a < b <= len(text) for a, b in extra)
    taken = sorted(extra)
    assert all(x[1] <= y[0] for x, y in zip(taken, taken[1:]))


@pytest.mark.parametrize("source, kind", [
    ("jane.doe [at] mail (dot) example (dot) org", "email"),
    ("jane at example dot org", "email"),
    ("jane(at)example.org", "email"),
    ("jane@example dot org", "email"),
    ("jane＠example.org", "email"),
    ("j​ane@exa​mple.org", "email"),
    ("jаne@example.org", "email"),  # the second letter is Cyrillic
    ("４１１１ １１１１ １１１１ １１１１", "card"),
    ("four one one one one one one one one one one one one one one one", "card"),
    ("4lll 1111 1111 1111", "card"),
    ("plus four nine three zero one two three four five six seven", "phone"),
    ("one nine two dot one six eight dot zero dot one", "ip"),
    ("１９２.１６８.０.１", "ip"),
])
def test_disguises(source, kind):
    text = f"Ask für: {source}, or not."
    _, every = pii.spans(text)
    at = text.index(source)
    assert every[kind][0] == (at, at + len(source)), [text[a:b] for a, b in every[kind]]


@pytest.mark.parametrize("text", [
    "We met at the dot of noon.", "One two three.", "She came at nine. It was one of two or three.", "Look at this. Point of view", "Ol lI O0", "a dot b",
    "Pay 1,000 or 2,000 dollars at 10.30 or 11.45.",
])
def test_clean_text_is_left_alone(text):
    assert not any(pii.spans(text)[1].values())


def test_long_runs_take_linear_time():
    text = "a" * 300_000 + "@" + "b-" * 100_000 + " " + "1" * 200_000 + "." * 10 + "%" * 100_000 + " one two" * 20_000
    base, _ = pii.spans(text)
    assert not base["email"]


DOCUMENTS = "doc_id long, text string, spans string, kind int"


def test_query_rows(spark):
    text = "é x@y.zz and jane(at)example.org and 10.0.0.1 x@y.zz"
    rows = [(1, text, "a", 1), (2, None, None, None), (None, "", "b", 2), (1, text, "a", 1)]
    got = pii.personal_data(spark.createDataFrame(rows, DOCUMENTS)).collect()
    digest = hashlib.sha256(",".join("%s:%d:%d" % s for s in sorted(plain_base(text), key=lambda s: pii.KINDS.index(s[0]))).encode()).hexdigest()
    full = [r for r in got if r.n_email]
    assert len(got) == 4 and len(full) == 2
    assert (full[0].n_email, full[0].n_ip, full[0].n_card, full[0].n_phone, full[0].base_sha256) == (2, 1, 0, 0, digest)
    assert full[0].spans == "email:2:8,email:13:32,email:46:52,ip:37:45"
    assert {(r.base_sha256, r.spans) for r in got if not r.n_email} == {(hashlib.sha256(b"").hexdigest(), "")}
    assert pii.personal_data(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_redact(spark):
    rows = [(1, "to x@y.zz or +49 30 1234567.", "a", 1), (2, None, None, None), (3, "", "b", 2)]
    got = pii.redact(spark.createDataFrame(rows, DOCUMENTS))
    assert got.columns == ["doc_id", "text", "spans", "kind"]
    assert [tuple(r)[:2] for r in got.orderBy("doc_id").collect()] == [(1, "to [EMAIL] or [PHONE]."), (2, None), (3, "")]


@pytest.mark.parametrize("source, kind", [
    ("alice @ example.com", "email"),
    ("alice @example.com", "email"),
    ("alice at example.com", "email"),
    ("jane at firm dot online", "email"),
    ("+49 30 one two three 4567", "phone"),
    ("+49 30 12345 six 7", "phone"),
    ("+44 seven 700 nine 00 one 23 four", "phone"),
    ("192.168.one.7", "ip"),
])
def test_common_disguises(source, kind):
    text = f"Ask für: {source}, or not."
    at = text.index(source)
    assert (at, at + len(source)) in pii.spans(text)[1][kind]
    assert (0, len(source)) in pii.spans(source)[1][kind]


@pytest.mark.parametrize("text", [
    "Visit us at example.com.", "Read more at www.example.com.", "Apples @ 1.99 each, pears @ 2.50.", "She looked at the dot matrix printer.", "We ended at half.Then we left.",
    "In 2.5 to one point five cases", "One 2.3 4.5", "chapter 12 one",
])
def test_places_prices_and_numbers_are_left_alone(text):
    assert not any(pii.spans(text)[1].values())


TOKENS = (
    "a bob dot at @ [at] (dot) [.] . com host x.y - 12 one punkt arroba www 192 168 1 O l | seven +44 ı i poınt é ﹫ 0O1l|0 ４ five 555-0O11".split() + [" ", "  "]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(TOKENS), max_size=14), st.sampled_from(["", " "]))
def test_the_column_gate_passes_what_the_exact_gate_passes(tokens, between):
    text = between.join(tokens)
    (suspect,) = pii.suspects(pa.array([text]))
    assert suspect or not pii.disguised(text)
    assert pii.spans(text, bool(suspect)) == pii.spans(text)


def test_column_gate_on_given_documents(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    gate = pii.suspects(pa.array([*texts, None, ""]))
    assert not any(pii.disguised(t) and not s for t, s in zip(texts, gate))
    assert not gate[-2:].any() and gate.mean() < 0.2


@pytest.mark.parametrize("text, seconds", [("a dot " * 40_000, 5), ("a dot at dot " * 20_000, 5), ("one two " * 20_000, 8),
                                           (" ".join(f"u{i}@h.com" for i in range(30_000)) + " bob at host dot com", 8)])
def test_many_parts_take_linear_time(text, seconds):
    began = time.process_time()
    pii.spans(text)
    assert time.process_time() - began < seconds


@pytest.mark.parametrize("text", ["192[.]168[.]1[.]1", "192(.)168(.)1(.)1", "192 dot 168 dot 1 dot 1", "192.168 dot 1[.]1"])
def test_disguised_dots_between_numbers(text):
    assert pii.spans(f"see {text}, please")[1]["ip"] == [(4, 4 + len(text))]
    assert pii.spans(f"see 9{text}9, please")[1]["ip"] == []


def test_a_word_for_the_dot_may_be_a_name():
    assert [text[a:b] for text in ["x dot at host.com"] for a, b in pii.spans(text)[1]["email"]] == ["dot at host.com"]
