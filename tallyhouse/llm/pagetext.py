"""HTML extraction: the blocks of a page, and a suffix array over each host that tells which of them its pages share."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage, map_batches, slices
from tallyhouse.operators.joins import sized_join

SLICE_BYTES = 4 << 20
#: Shortest run of words that counts as a repeated substring; most pages, and bytes of them, of a host in one suffix array.
LEAST_RUN, SHARD_PAGES, SHARD_BYTES = 8, 1_000, 16 << 20
#: Level of compression of the streams, which are shuffled twice.
PACKING = 6
#: Least share of a host's distinct pages that have a shared and a common run.
SHARED, COMMON = 0.1, 0.5

RAW = re.compile(r"<(script|style|noscript|template|textarea|title|svg|iframe|noframes|xmp)\b", re.IGNORECASE)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest2>[^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)|(?P<text>[^<]++|<)", re.DOTALL)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that are never the article; words of a class, an id or a role that say so by themselves; words that say so,
#: as the beginning of such a name, of a block that pages of the host share.
NOISE_TAGS = frozenset("nav footer aside form button select menu dialog object applet canvas audio video datalist input".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar footer contentinfo "
    "comment comments respond disqus replies cookie cookies consent gdpr newsletter social share sharing".split())
HINT_WORDS = (
    "advert", "sponsor", "promo", "banner", "navig", "menu", "breadcrumb", "sidebar", "footer", "complementary", "comment", "cookie", "notice", "popup", "modal",
    "overlay", "newsletter", "subscri", "social", "share", "sharing", "related", "recommend", "teaser", "widget", "toolbar", "pagination", "pager", "login", "signin",
    "signup", "search", "form", "dialog", "alert", "skip")
HEADER_WORDS = frozenset("header masthead topbar".split())
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
CONTENT = ("article", "main")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


#: What an element's name says: nothing, that it is none of the article if pages share it, that it is none in any case.
PLAIN, HINTED, NOISE = range(3)
#: Zones besides articles, which are numbered from 1.
OPEN, MAIN = 0, -1


@dataclass
class Page:
    """All blocks of a page in order, as (zone, mark, text)."""

    found: list[tuple[int, int, str]] = field(default_factory=list)

    def zones(self) -> list[int]:
        """The zones the text may be in: the articles, else the main part, else what is in neither."""
        held = {z for z, mark, _ in self.found if mark != NOISE}
        return sorted(z for z in held if z > 0) or ([MAIN] if MAIN in held else [OPEN])

    def blocks(self) -> tuple[bool, list[str]]:
        """Whether the page names its article, and its blocks as far as the page alone tells: of several articles, the longest."""
        sizes = {zone: [b for z, mark, b in self.found if z == zone and mark != NOISE] for zone in self.zones()}
        zone = max(sizes, key=lambda z: sum(map(len, sizes[z])))
        return zone != OPEN, sizes[zone]


def attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in ATTRIBUTE.finditer(rest)}


def mark_of(tag: str, rest: str, inside: bool) -> int:
    """What the name of an element says. A header inside an article holds its title."""
    if tag in NOISE_TAGS or tag == "header" and not inside:
        return NOISE
    if not rest.strip(" /") or tag in ("html", "body", "article", "main"):
        return PLAIN
    known = attributes(rest)
    if "hidden" in known or known.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", known.get("style", "")):
        return NOISE
    words = set(re.split(r"[^a-z0-9]+", " ".join(known.get(k, "") for k in ("class", "id", "role")).lower()))
    if words & NOISE_WORDS or not inside and words & HEADER_WORDS:
        return NOISE
    return HINTED if any(w.startswith(HINT_WORDS) for w in words) else PLAIN


def read_page(source: str) -> Page:
    """Read the blocks of a page, those of menus and the like included. Markup may be unclosed or wrongly nested."""
    page = Page()
    depth = dict.fromkeys(CONTENT, 0)
    text: list[str] = []
    at, article, skip, skip_depth, hint, hint_depth, closes = 0, 0, "", 0, "", 0, {}

    def end_block() -> None:
        block = " ".join("".join(text).split())
        text.clear()
        if block:
            zone = article if depth["article"] else MAIN if depth["main"] else OPEN
            page.found.append((zone, NOISE if skip else HINTED if hint else PLAIN, block))

    lowered = source.lower()
    if len(lowered) != len(source):  # it makes two characters of some, and places would differ
        lowered = source.translate(LOWER)

    def closed(tag: str, rest: str) -> bool:
        """Whether an end tag follows: an element that is never closed hides nothing but its tag."""
        if rest.endswith("/"):
            return False
        end = closes.get(tag)
        if end is None or end < at:
            end = closes[tag] = lowered.rfind(f"</{tag}")
        return end >= at

    while at < len(source):
        m = TOKEN.match(source, at)
        at = m.end()
        said = m["text"]
        if said is not None:
            if skip != "head":
                text.append(html.unescape(said) if "&" in said else said)
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        close, rest = m["close"] or m["close2"], m["rest"] or m["rest2"] or ""
        if not close and RAW.match(m[0]):
            end = lowered.find(f"</{tag}", at)  # what stands inside is no markup
            at = len(source) if end < 0 else end
            continue
        if tag in BLOCKS:
            end_block()
        elif tag == "br":
            text.append(" ")
        if skip:
            if tag == skip and tag not in VOID:
                skip_depth += -1 if close else 1
            if skip_depth == 0 or skip == "head" and tag == "body":
                end_block()
                skip = ""
            continue
        if tag == hint:
            hint_depth += -1 if close else 1
            if not hint_depth:
                end_block()
                hint = ""
        if close:
            if tag in depth and depth[tag]:
                depth[tag] -= 1
            continue
        if tag == "head":
            skip, skip_depth = "head", 1
        elif tag in depth:
            if mark_of("div", rest, True) != NOISE:
                article += tag == "article" and not depth["article"]
                depth[tag] += 1
            else:
                skip, skip_depth = tag, 1
        elif tag not in VOID:
            mark = mark_of(tag, rest, bool(depth["article"] or depth["main"]))
            if mark == NOISE and closed(tag, rest):
                end_block()
                skip, skip_depth = tag, 1
            elif mark == HINTED and not hint and closed(tag, rest):
                end_block()
                hint, hint_depth = tag, 1
    end_block()
    return page


def suffix_ranks(tokens: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """A suffix array by prefix doubling, as far as ``least`` tokens: the order of all suffixes, and the rank of each.

    Suffixes have one rank if and only if their first ``least`` tokens are the same.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < least:
        step = min(width, least - width)
        ahead = np.full(len(rank), -1, np.int64)
        ahead[:-step] = rank[step:]
        rank = np.unique(rank * (len(rank) + 2) + ahead + 1, return_inverse=True)[1].astype(np.int64)
        width += step
    return np.argsort(rank, kind="stable"), rank


def window_counts(tokens: np.ndarray, page: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """One start of each substring of ``least`` tokens, and the number of pages that have it. Pages are parted by tokens of their own."""
    if len(tokens) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order, rank = suffix_ranks(tokens, least)
    ranks, pages = rank[order], page[order]
    first = np.diff(ranks, prepend=-1) != 0  # the order is stable, so pages stand in order within a rank
    new = first | (np.diff(pages, prepend=-1) != 0)
    begin = np.flatnonzero(first)
    return order[begin], np.add.reduceat(new.astype(np.int64), begin)


def tokens_of(blocks: list[str], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and where each block begins. A block of fewer words than a run is filled up to one with their number."""
    out: list[int] = []
    begin = [0]
    for block in blocks:
        words = block.split()
        out += [xxhash.xxh64_intdigest(w) >> 1 for w in words]
        out += [len(words)] * (least - len(words))
        begin.append(len(out))
    return np.array(out, np.int64), np.array(begin, np.int64)


def whole_runs(tokens: np.ndarray, least: int) -> np.ndarray:
    """Whether the ``least`` tokens from each start are words alone, or one whole short block."""
    n = max(0, len(tokens) - least + 1)
    filled = (tokens > 0) & (tokens < least)
    after = np.minimum.accumulate(np.where(filled, np.arange(len(tokens)), len(tokens) + least)[::-1])[::-1][:n]
    ahead = after - np.arange(n)
    return (ahead >= least) | (tokens[np.minimum(after, len(tokens) - 1)] == ahead)


def run_hashes(tokens: np.ndarray, least: int) -> np.ndarray:
    """A hash of each run of ``least`` tokens by its start; the last bit is free."""
    n = max(0, len(tokens) - least + 1)
    out, base = np.zeros(n, np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for i in range(least):
        out = out * base + tokens[i : i + n].astype(np.uint64)
        out ^= out >> np.uint64(29)
    return out.view(np.int64) & ~1


def host_column(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def shared_runs(pages: DataFrame, least: int = LEAST_RUN, shard_pages: int = SHARD_PAGES) -> DataFrame:
    """``host, runs``: hashes of the runs of ``least`` tokens that distinct pages of a host share, packed; odd ones are common.

    The token streams of the distinct pages of a host, with all their zones,
    are concatenated and their suffixes sorted. A run is shared if two pages
    and ``SHARED`` of all have it, common if three and ``COMMON`` of all do.
    Equal streams are one page: a copied page is no boilerplate of itself.

    A host of many pages or bytes is dealt by hash to shards with a suffix
    array each, whose counts are added. A shard counts what half of
    ``SHARED`` of its pages have, so a run that is less frequent in one of
    them counts for less; a host of one shard is counted without that.
    """
    sizes = pages.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.octet_length("html")).alias("bytes"))
    shards = F.greatest(F.ceil(F.col("n") / shard_pages), F.ceil(F.col("bytes") / SHARD_BYTES)).cast("long")
    large = cut_lineage(sizes.select("host", shards.alias("shards")).where("shards > 1"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, SLICE_BYTES):
            texts = ["\n".join(b for _, _, b in read_page(h or "").found).encode() for h in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([xxhash.xxh64_intdigest(t) >> 1 for t in texts], pa.int64()), pa.array([zstandard.compress(t, PACKING) for t in texts], pa.binary())],
                names=["host", "stream", "packed"])

    streams = map_batches(pages.select("host", "html"), pack, "host string, stream long, packed binary")
    distinct = streams.groupBy("host", "stream").agg(F.first("packed").alias("packed"))
    dealt = sized_join(distinct, large, ["host"], "left").withColumn("shards", F.coalesce("shards", F.lit(1)))
    dealt = dealt.select("host", "stream", "packed", "shards", F.pmod("stream", "shards").alias("shard"))

    def sort_suffixes(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tokens = [tokens_of(zstandard.decompress(t).decode().split("\n"), least)[0] for t in table.column("packed").to_pylist()]
        n, several = len(tokens), table.column("shards")[0].as_py() > 1
        joined = np.concatenate([x for i, t in enumerate(tokens) for x in (t, np.array([-1 - i]))])
        starts, counts = window_counts(joined, np.repeat(np.arange(n), [len(t) + 1 for t in tokens]), least)
        ends = np.cumsum(np.append(0, joined < 0))  # no run goes over the end of a page
        held = (counts >= max(1 if several else 2, SHARED * n / (2 if several else 1))) & (starts + least <= len(joined))
        held[held] = (ends[starts[held] + least] == ends[starts[held]]) & whole_runs(joined, least)[starts[held]]
        starts, counts = starts[held], counts[held]
        runs = run_hashes(joined, least)[starts]
        size = len(runs) + 1
        return pa.table({"host": pa.array([key[0].as_py()] * size, pa.string()), "run": pa.array([*runs.tolist(), None], pa.int64()),
                         "pages": pa.array([*counts.tolist(), n], pa.int64())})

    counted = dealt.groupBy("host", "shard").applyInArrow(sort_suffixes, "host string, run long, pages long")
    total = cut_lineage(counted.groupBy("host", "run").agg(F.sum("pages").alias("pages")))
    every = total.where("run is null").select("host", F.col("pages").alias("every"))
    found = sized_join(total.where("run is not null"), every, ["host"], "inner")
    found = found.where((F.col("pages") >= 2) & (F.col("pages") >= F.col("every") * SHARED))
    common = (F.col("pages") >= 3) & (F.col("pages") >= F.col("every") * COMMON)
    marked = found.select("host", F.col("run").bitwiseOR(common.cast("long")).alias("run"))
    return marked.groupBy("host").agg(F.sort_array(F.collect_list("run")).alias("runs"))


def covered(length: int, hit: np.ndarray, least: int) -> np.ndarray:
    """Which of ``length`` tokens lie in a run that is hit."""
    edge = np.zeros(length + 1, np.int64)
    edge[: len(hit)] += hit
    edge[least : least + len(hit)] -= hit
    return np.cumsum(edge)[:-1] > 0


def choose(page: Page, runs: np.ndarray, least: int) -> str:
    """The text of a page, given the runs that pages of its host share, in order. See ``main_text``."""
    blocks = page.found
    if not blocks:
        return ""
    tokens, begin = tokens_of([b for _, _, b in blocks], least)
    own = run_hashes(tokens, least)
    at = np.searchsorted(runs, own).clip(max=max(len(runs) - 1, 0))  # runs are in order, and common ones odd
    hit = (runs[at] & ~1 == own) & whole_runs(tokens, least) if len(runs) else np.zeros(len(own), bool)
    shared = covered(len(tokens), hit, least)
    words = [b.split() for _, _, b in blocks]
    ends = [int(s) + len(w) for s, w in zip(begin, words)]
    fresh = [len(w) - int(shared[s:e].sum()) for w, s, e in zip(words, begin, ends)]
    zones = page.zones()
    left = {z: [i for i, (zone, mark, _) in enumerate(blocks) if zone == z and mark != NOISE] for z in zones}
    zone = max(zones, key=lambda z: (sum(fresh[i] for i in left[z]), sum(len(words[i]) for i in left[z])))
    stays = [i for i in left[zone] if blocks[i][1] == PLAIN or 2 * fresh[i] >= len(words[i])]
    if zone == OPEN:
        cut = [" ".join(w for w, drop in zip(words[i], shared[begin[i] : ends[i]]) if not drop) for i in stays]
        return "\n\n".join(filter(None, cut))
    common = covered(len(tokens), hit & (runs[at] & 1 == 1) if len(runs) else hit, least)
    mostly = [2 * int(common[begin[i] : ends[i]].sum()) > len(words[i]) for i in stays]
    lo, hi = 0, len(stays)
    while lo < hi and mostly[lo]:
        lo += 1
    while hi > lo and mostly[hi - 1]:
        hi -= 1
    kept = stays[lo:hi]
    if 2 * sum(len(words[i]) for i in kept) < sum(len(words[i]) for i in stays):
        kept = stays  # the article itself is what pages share
    return "\n\n".join(blocks[i][2] for i in kept)


def main_text(pages: DataFrame, least: int = LEAST_RUN, shard_pages: int = SHARD_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page: the text of its article.

    The suffix array of a host tells which runs its pages share. Of several
    ``article`` elements the one with the most words in no shared run is the
    article; without one it is ``main``. In it a block goes if its class, id
    or role hints at it and most of it is shared, or if it stands at the
    beginning or end and most of it is common; any other block stays, since
    articles may quote each other, and an article of which less than half
    would stay is a copied one and stays whole. On pages that name no article
    the shared runs are cut out of what the structure leaves, and unique runs stay.

    Null and empty pages have an empty text, pages without a host are one
    host, and repeated rows and ids keep their rows. Pages are read twice,
    once for the array and once for the text.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("host", host_column(F.col("url")))
    joined = sized_join(rows, shared_runs(rows, least, shard_pages), ["host"], "left").select("page_id", "url", "html", "runs")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2, SLICE_BYTES):
            runs = part.column(3)
            values, at = runs.values.to_numpy(zero_copy_only=False), runs.offsets.to_numpy()
            texts = [choose(read_page(h or ""), values[at[i] : at[i + 1]], least) for i, h in enumerate(part.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return map_batches(joined, clean, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
