"""Personal data: offset-preserving deobfuscation before the identifiers are looked for."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.llm.common import documents, map_batches, slices

KINDS = ("email", "ip", "card", "phone")
SLICE_BYTES = 1 << 20

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match starts where a run of digits starts: later starts in the run would fail or end as the first one does.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
NOT_DIGIT = re.compile(r"[^0-9]+")

# Letters of other scripts that look like Latin ones, as pairs.
LOOKALIKES = (
    "аa еe оo рp сc уy хx іi ѕs јj һh ԁd ԛq ԝw ӏl АA ВB ЕE КK МM НH ОO РP СC ТT ХX ІI ЅS ЈJ "
    "αa οo νv ρp υu ιi κk ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX"
).split()
# Characters that show nothing, and other characters for the at sign, full stop, plus and hyphen.
UNSEEN = "­​‌‍⁠﻿"
SIGNS = {"。": ".", "·": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", " ": " ", " ": " ", " ": " "}
# Digits spelled in English, German, French and Spanish.
SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "oh": "0",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
PLUS_WORDS = ("plus", "más")
DOT_WORDS = ("dot", "punkt", "point", "punto")
AT_WORDS = ("at", "arroba", "arobase", "klammeraffe")
#: A row with dots and fewer spelled digits has to be an address as a whole; numbers with few of them are common.
LEAST_SPELLED = 4

_ALT = "|".join(sorted(SPELLED, key=len, reverse=True))
_DIGIT = rf"(?:{_ALT}|[0-9]+)"
_DOTS = "|".join(DOT_WORDS)
_ATS = "|".join(AT_WORDS)
_WORD = r"[A-Za-z0-9_%+-]+"
#: Spelled digits in a row; between them blanks, hyphens, commas or a spelled or plain dot.
SPELLED_ROW = re.compile(
    rf"(?i)(?<![\w])(?:(?:{'|'.join(PLUS_WORDS)})[\x20-]+)?{_DIGIT}(?:(?:[\x20,-]{{1,3}}|[\x20]?[\[(]?(?:{_DOTS})[\])]?[\x20]?|[\x20](?:{_DOTS})[\x20]|\.){_DIGIT})+(?![\w])")
_TOKEN = re.compile(rf"(?i)(?P<plus>(?:{'|'.join(PLUS_WORDS)})[\x20-]+)|(?P<dot>[\x20]*[\[(]?(?:{_DOTS})[\])]?[\x20]*)|(?P<digit>{_ALT})|(?P<number>[0-9]+)|(?P<gap>[\x20,-]+)|(?P<point>\.)")
_BETWEEN = rf"[\x20,.-]+(?:[\[(]?(?:{_DOTS})[\])]?[\x20]+)?"
#: A spelled digit beside another one or beside a number.
_ANY_SPELLED = re.compile(rf"(?i)(?<!\w)(?:{_ALT}){_BETWEEN}(?:(?:{_ALT})(?!\w)|[0-9])|[0-9]{_BETWEEN}(?:{_ALT})(?!\w)")
#: A name, a disguised at sign, and a host with a plain or disguised dot.
_BRACKET_AT = rf"[\x20]?[\[({{<][\x20]?(?:{_ATS}|@)[\x20]?[\])}}>][\x20]?"
_BRACKET_DOT = rf"[\x20]?[\[({{<][\x20]?(?:{_DOTS}|\.)[\x20]?[\])}}>][\x20]?"
_WORD_DOT = rf"[\x20](?:{_DOTS})[\x20]"
NAME = re.compile(rf"(?i)(?<![\w.%+-]){_WORD}(?:(?:\.|{_BRACKET_DOT}|{_WORD_DOT}){_WORD})*+")
SIGN_AND_HOST = re.compile(
    rf"(?i){_BRACKET_AT}[A-Za-z0-9-]+(?:(?:\.|{_BRACKET_DOT}|{_WORD_DOT})[A-Za-z0-9-]+)+"
    rf"|(?:[\x20](?:{_ATS})[\x20]|[\x20]?@[\x20]?)[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?:{_BRACKET_DOT}|{_WORD_DOT})[A-Za-z0-9-]+(?:(?:\.|{_BRACKET_DOT}|{_WORD_DOT})[A-Za-z0-9-]+)*"
    rf"|(?:[\x20](?:{_ATS})[\x20]|[\x20]@[\x20]?|@[\x20])[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Inside names: a word for the dot that is itself a name before an at sign.
_DOT_NAME = re.compile(rf"(?i)(?<=[\x20])(?:{_DOTS})(?=[\x20](?:{_ATS})[\x20])")
#: Four numbers with dots of which some are disguised.
DOTTED_NUMBERS = re.compile(rf"(?i)(?<![\w.])[0-9]++(?:(?:\.|{_BRACKET_DOT}|{_WORD_DOT})[0-9]++){{3}}(?!\w)")
_AT_PART = re.compile(rf"(?i){_BRACKET_AT}|[\x20](?:{_ATS})[\x20]|[\x20]?@[\x20]?")
_DOT_PART = re.compile(rf"(?i){_BRACKET_DOT}|{_WORD_DOT}")
# Last labels with which a bare word may stand for the at sign before a host with plain dots.
TOP_LABELS = (
    "com org net edu gov mil int info biz name io co ai app dev me tv eu uk us ca au nz ie in de at ch fr be lu es pt it nl se no dk fi pl cz ru ua tr "
    "gr ro hu br mx ar cl jp cn kr tw hk sg za example test invalid"
).split()
_TOP = re.compile(rf"(?i)(?<![A-Za-z0-9])(?:{'|'.join(TOP_LABELS)})$")
# Words that are no host of their own, and words before a bare "at" that name a place and no mailbox ("visit us at example.com").
NO_HOSTS = frozenset("a an the this that these those each every any some his her its my our your their der die das dem den le la les el los".split())
NO_NAMES = frozenset(
    "us me it them him her you we they he she i one more here there online available look looked looking visit visited found find website site page pages "
    "information details read see seen shop shopping store stores buy bought sold order sign register registered based located hosted listed posted published "
    "written work works worked working is are was were be been live lives lived stay arrive arrived not and or but also only now today directly out up down over "
    "back in on off this that article blog post video profile account web url link tickets project code source download downloaded research hosting".split())
_HINT = re.compile(
    rf"(?i)(?:[\[({{<][\x20]?(?:{_ATS}|@|{_DOTS}|\.)[\x20]?[\])}}>])|[\x20](?:{_DOTS})[\x20]|[\x20]@[\x20]?[A-Za-z0-9]|@[\x20][A-Za-z0-9]"
    rf"|[\x20](?:{_ATS})[\x20][A-Za-z0-9-]+\.[A-Za-z]")
#: Letters for digits inside a number: at least half of its characters are digits.
_MIXED = re.compile(r"(?<![A-Za-z0-9])[0-9OoIl|](?:[\x20.-]?[0-9OoIl|]){6,}(?![A-Za-z0-9])")
_FOR_DIGITS, _DIGIT_IN = re.compile("[OoIl|]"), re.compile("[0-9]")
_AS_DIGIT = str.maketrans("OoIl|", "00111")


@cache
def lookalikes() -> dict[str, str]:
    """Non-ASCII characters and the ASCII text that they stand for."""
    table = {p[0]: p[1] for p in LOOKALIKES} | SIGNS | dict.fromkeys(UNSEEN, "")
    for lo, hi in ((0xFF01, 0xFF5F), (0xFE52, 0xFE6C), (0x2070, 0x208F), (0x1D400, 0x1D800), (0x2460, 0x2474), (0x0660, 0x066A), (0x06F0, 0x06FA), (0x0966, 0x0970)):
        for c in map(chr, range(lo, hi)):
            plain = unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and not plain.isascii() and unicodedata.decimal(plain, None) is not None:
                plain = str(unicodedata.decimal(plain))
            if len(plain) == 1 and plain.isascii():
                table.setdefault(c, plain)
    return table


@cache
def _odd_characters() -> re.Pattern:
    return re.compile("[" + "".join(map(re.escape, lookalikes())) + "]")


@cache
def _gates() -> tuple[str, ...]:
    """Patterns without look-around, for whole columns at once. Together they let pass all texts that the exact
    patterns let pass, and more: the edges of words and numbers are not asked for. Only Python takes the two
    Turkish letters for an i, so texts that have them pass."""
    odd = "".join(rf"\x{{{ord(c):x}}}" for c in [*lookalikes(), "\u0130", "\u0131"])
    spelled = rf"(?i)(?:{_ALT}){_BETWEEN}(?:{_ALT}|[0-9])|[0-9]{_BETWEEN}(?:{_ALT})"
    mixed = r"[0-9OoIl|](?:[\x20.-]?[0-9OoIl|]){6}"
    letters = r"[0-9][\x20.-]?[OoIl|]|[OoIl|][\x20.-]?[0-9]"
    return f"[{odd}]", _HINT.pattern, spelled, mixed, letters


def suspects(column: pa.Array) -> np.ndarray:
    """Texts that may hold something disguised. All others have base identifiers only."""
    odd, hint, spelled, mixed, letters = (pc.fill_null(pc.match_substring_regex(column, g), False) for g in _gates())
    found = pc.or_(pc.or_(odd, hint), pc.or_(spelled, pc.and_(mixed, letters)))
    return found.to_numpy(zero_copy_only=False)


def disguised(text: str) -> bool:
    """The exact gate: whether a text has anything that a transducer may change."""
    if not text.isascii() and not lookalikes().keys().isdisjoint(text):
        return True
    if _HINT.search(text) or _ANY_SPELLED.search(text):
        return True
    return any(_FOR_DIGITS.search(m.group()) and _DIGIT_IN.search(m.group()) for m in _MIXED.finditer(text))


@dataclass
class Mapped:
    """A normalised text; character ``i`` of it comes from ``start[i]`` to ``end[i]`` of the source."""

    text: str
    start: np.ndarray
    end: np.ndarray

    def rewrite(self, changes: list[tuple[int, int, str]]) -> Mapped:
        """Replace spans, in order and apart, by other text that maps to the whole span."""
        if not changes:
            return self
        text, start, end, at = [], [], [], 0
        for lo, hi, new in changes:
            text += [self.text[at:lo], new]
            start.append(self.start[at:lo])
            end.append(self.end[at:lo])
            if new:
                start.append(np.full(len(new), self.start[lo], np.int64))
                end.append(np.full(len(new), self.end[hi - 1], np.int64))
            at = hi
        text.append(self.text[at:])
        start.append(self.start[at:])
        end.append(self.end[at:])
        return Mapped("".join(text), np.concatenate(start), np.concatenate(end))


def fold_lookalikes(m: Mapped) -> Mapped:
    """The transducer for homoglyphs, full-width forms and unseen characters."""
    table = lookalikes()
    return m.rewrite([(x.start(), x.end(), table[x.group()]) for x in _odd_characters().finditer(m.text)])


def fold_spelled(m: Mapped) -> Mapped:
    """The transducer for spelled digits: words become digits, spelled dots dots, and what stands
    between digits a blank, or nothing in a row with dots, whose digits have to meet."""
    changes = []
    for row in SPELLED_ROW.finditer(m.text):
        parts = list(_TOKEN.finditer(m.text, row.start(), row.end()))
        spelled = sum(p.lastgroup == "digit" for p in parts)
        if not spelled:
            continue
        dotted = any(p.lastgroup in ("dot", "point") for p in parts)
        new = {"plus": "+", "dot": ".", "gap": "" if dotted else " "}
        made = [(p, SPELLED[p.group().lower()] if p.lastgroup == "digit" else new.get(p.lastgroup, p.group())) for p in parts]
        if dotted and spelled < LEAST_SPELLED:
            whole = "".join(x for _, x in made)
            if (0, len(whole)) not in identifiers(whole)["ip"]:
                continue
        changes += [(p.start(), p.end(), x) for p, x in made if x != p.group()]
    return m.rewrite(changes)


def reads_as_address(name: str, sign: str, host: str) -> bool:
    """Whether a name, a sign that may stand for the at sign, and a host make an address.

    Brackets say so. Before a host with plain dots a blank beside the sign
    needs a last label of letters (``3 @ 1.99``), and a bare word one that is
    known and a name that is none of ``NO_NAMES``. After a disguised dot any
    label of three letters will do, unless the host is an article or the like.
    """
    if sign.strip() not in ("@", sign.strip().strip("[({<])}>")):
        return True
    labels = _DOT_PART.sub(".", host).split(".")
    if not sign.strip().isalpha():
        return labels[-1].isalpha() or _DOT_PART.search(host) is not None
    if not _DOT_PART.search(host):
        return _TOP.search(host) is not None and name.lower() not in NO_NAMES and labels[0].lower() != "www"
    return _TOP.search(host) is not None or len(labels[-1]) > 2 and labels[-1].isalpha() and labels[0].lower() not in NO_HOSTS


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Names with a sign for the at sign and a host after them, leftmost first.

    A name is taken as far as it goes, so later starts in it end where it ends
    and need not be tried; but a word for the dot may itself be a name.
    """
    at = 0
    while name := NAME.search(text, at):
        at = name.end()
        rest = SIGN_AND_HOST.match(text, at)
        if rest:
            yield name.start(), rest.end()
            at = rest.end()
            continue
        for inner in _DOT_NAME.finditer(text, name.start(), min(len(text), at + 1)):
            rest = SIGN_AND_HOST.match(text, inner.end())
            if rest:
                yield inner.start(), rest.end()
                at = rest.end()
                break


def fold_signs(m: Mapped) -> Mapped:
    """The transducer for disguised at signs and dots inside what reads as an address."""
    changes = []
    for lo, hi in addresses(m.text):
        at = _AT_PART.search(m.text, lo, hi)
        if not reads_as_address(m.text[lo : at.start()], at.group(), m.text[at.end() : hi]):
            continue
        dots = [d for d in _DOT_PART.finditer(m.text, lo, hi) if d.end() <= at.start() or d.start() >= at.end()]
        changes += sorted([(at.start(), at.end(), "@"), *((d.start(), d.end(), ".") for d in dots)])
    return m.rewrite(changes)


def fold_dotted(m: Mapped) -> Mapped:
    """The transducer for disguised dots between four plain numbers, if they make an address."""
    changes = []
    for row in DOTTED_NUMBERS.finditer(m.text):
        whole = _DOT_PART.sub(".", row.group())
        if whole != row.group() and (0, len(whole)) in identifiers(whole)["ip"]:
            changes += [(d.start(), d.end(), ".") for d in _DOT_PART.finditer(m.text, row.start(), row.end())]
    return m.rewrite(changes)


def fold_mixed(m: Mapped) -> Mapped:
    """The transducer for letters that stand for digits inside a number."""
    changes = []
    for found in _MIXED.finditer(m.text):
        s = found.group()
        digits = sum(c.isdigit() for c in s)
        letters = sum(c in "OoIl|" for c in s)
        if letters and digits >= letters and digits:
            changes += [(found.start() + i, found.start() + i + 1, c.translate(_AS_DIGIT)) for i, c in enumerate(s) if c in "OoIl|"]
    return m.rewrite(changes)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses. A match holds one at sign, so each sign is looked at once, with the name run before it."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > last and text[lo - 1] in LOCAL:
            lo -= 1
        domain = DOMAIN.match(text, at) if lo < at else None
        if domain:
            found.append((lo, domain.end()))
            last = domain.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(at + 1, last))
    return found


def identifiers(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost non-overlapping identifiers of each kind, by the base rules."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = emails(text)
    if re.search("[0-9]", text):
        if "." in text:
            found["ip"] = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split("."))]
        for m in CARD.finditer(text):
            digits = NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())
        if "+" in text:
            found["phone"] = [m.span() for m in PHONE.finditer(text) if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15]
    return found


def overlapping(found: list[tuple[int, int]], lo: int, hi: int) -> list[tuple[int, int]]:
    """Of spans in order and apart, those that overlap another one."""
    at = max(0, bisect_right(found, (lo, lo)) - 1)
    met = []
    while at < len(found) and found[at][0] < hi:
        if found[at][1] > lo:
            met.append(found[at])
        at += 1
    return met


def spans(text: str, suspect: bool = True) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
    """Base spans and all spans, as code points of the source text.

    All spans are the base ones and those found in the normalised text, mapped
    back to the source. A mapped span is added when it overlaps no other span,
    or none but base spans of its kind that are shorter and lie inside of it.
    A text that is no suspect is not normalised.
    """
    base = identifiers(text)
    if not suspect or not disguised(text):
        return base, base
    at = np.arange(len(text), dtype=np.int64)
    m = Mapped(text, at, at + 1)
    if not text.isascii():
        m = fold_lookalikes(m)
    m = fold_mixed(fold_dotted(fold_signs(fold_spelled(m))))
    if m.text == text:
        return base, base
    more = {k: list(base[k]) for k in KINDS}
    hidden = identifiers(m.text)
    added: list[tuple[int, int]] = []
    for kind in KINDS:
        for lo, hi in hidden[kind]:
            a, b = int(m.start[lo]), int(m.end[hi - 1])
            if overlapping(added, a, b) or any(overlapping(base[k], a, b) for k in KINDS if k != kind):
                continue
            if all(a <= x and y <= b and (x, y) != (a, b) for x, y in overlapping(base[kind], a, b)):
                more[kind].append((a, b))
                insort(added, (a, b))
    return base, {k: sorted(v) for k, v in more.items()}


FOUND = "array<struct<kind: string, start: long, `end`: long, base: boolean>>"


def with_spans(df: DataFrame, text: str = "text", name: str = "spans") -> DataFrame:
    """Append all spans of personal data in a text column, by kind and then by start.

    Offsets are code points of the source, the end exclusive; ``base`` marks
    spans that the base rules find in the source itself. Null and empty texts
    have none. Repeated rows are searched each for itself.
    """
    place = df.columns.index(text)
    kind = StructType.fromDDL(f"`{name}` {FOUND}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, place, SLICE_BYTES):
            column = []
            for t, suspect in zip(part.column(place).to_pylist(), suspects(part.column(place)).tolist()):
                base, every = spans(t, suspect) if t else ({}, {})
                column.append([{"kind": k, "start": a, "end": b, "base": (a, b) in base[k]} for k in KINDS for a, b in every.get(k, ())])
            made = pa.array(column, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])))
            yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, name])

    return map_batches(df, run, StructType([*df.schema.fields, *kind.fields]))


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text, for every document."""
    found = with_spans(documents(docs)).drop("text")
    shown = lambda wanted: F.array_join(F.transform(wanted, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, KINDS), F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with every span replaced by its kind in brackets; overlapping spans become one replacement.

    The other columns stay, and so do null texts.
    """
    place = df.columns.index(text)

    def cleaned(t: str | None, suspect: bool) -> str | None:
        if not t:
            return t
        every = spans(t, suspect)[1]
        out, at = [], 0
        for lo, hi, kind in sorted((a, b, k) for k in KINDS for a, b in every[k]):
            if lo >= at:
                out += [t[at:lo], f"[{kind.upper()}]"]
            at = max(at, hi)
        return "".join([*out, t[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, place, SLICE_BYTES):
            column = part.column(place)
            made = pa.array([cleaned(*x) for x in zip(column.to_pylist(), suspects(column).tolist())], part.schema.field(place).type)
            yield part.set_column(place, part.schema.field(place), made)

    return map_batches(df, run, df.schema)
