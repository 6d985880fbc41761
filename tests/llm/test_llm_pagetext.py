"""Main text of pages, and the suffix array against plain windows."""

import numpy as np
import pytest

from tallyhouse.llm import pagetext

PAGES = "page_id long, url string, html string, text int, host string"


def text_of(source):
    named, blocks = pagetext.read_page(source).blocks()
    return "\n\n".join(blocks)


@pytest.mark.parametrize("source, want", [
    ("", ""),
    ("<html><head><title>T</title><style>p{}</style></head><body><nav><p>menu</p></nav><article><h1>A &amp; B</h1><p>one\n two<br>three</article><footer>f</footer>", "A & B\n\none two three"),
    ("<body><header>top</header><main><p>a</p><aside>side</aside><form><p>f</p></form><p>b</main><p>after", "a\n\nb"),
    ("<article><header><h1>Title</h1></header><p>x <b>bold</b> y<!-- <p>no</p> --> z</p><script>if (a < b) '</p>';</script><div class='comments'><p>reader</p></div></article>", "Title\n\nx bold y z"),
    ("<article><p>a<div class=ad>buy</div><p>b</p><section id='share-box'>s</section><p hidden>h</p><p style='display: none'>h</p></article>", "a\n\nb"),
    ("<div class=\"ad\">buy<article><p>kept</article>", "kept"),
    ("<article><p title=\"a > b\">q</p><p>&lt;tag&gt; &#233; &copy;&nbsp;x</p><textarea>t</textarea><button>b</button></article>", "q\n\n<tag> é © x"),
    ("<ARTICLE><P>Upper</P></ARTICLE><div>out</div>", "Upper"),
    ("<article><p>a < b and c<d</p><p>e</article", "a < b and c e"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>", "one\n\ntwo\n\nc1\n\nc2"),
    ("<article class='comment'>not</article><article>yes</article>", "yes"),
])
def test_blocks(source, want):
    if source.endswith("</article"):
        assert text_of(source).startswith("a < b and c")
    else:
        assert text_of(source) == want


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array_counts_the_pages_of_all_windows(seed):
    rng = np.random.default_rng(seed)
    pages = [rng.integers(0, 3, rng.integers(0, 40)).tolist() for _ in range(6)]
    joined = np.array([x for i, p in enumerate(pages) for x in (*p, -1 - i)])
    page = np.repeat(np.arange(6), [len(p) + 1 for p in pages])
    least = 5
    begin = np.cumsum([0, *(len(p) + 1 for p in pages)])
    where = {}
    for i, p in enumerate(pages):
        for k in range(len(p) - least + 1):
            where.setdefault(tuple(p[k : k + least]), []).append((i, begin[i] + k))
    want = {k: len({i for i, _ in found}) for k, found in where.items()}
    starts, counts = pagetext.window_counts(joined, page, least)
    got = {tuple(joined[s : s + least].tolist()): n for s, n in zip(starts.tolist(), counts.tolist()) if s + least <= len(joined)}
    assert {k: n for k, n in got.items() if min(k) >= 0} == want
    assert all(n == 1 for k, n in got.items() if min(k) < 0)


MENU = "Home News Sport Weather Contact About Imprint Privacy Terms"


@pytest.mark.parametrize("shard_pages", [1000, 2])
def test_pages_without_an_article(spark, shard_pages):
    rows = [(i, f"http://Host.example/{i}", f"<div>{MENU}</div><div>n{i} stands only here x{i}</div>", 1, "x") for i in range(9)]
    rows += [(20, "http://other.example/", f"<div>{MENU}</div><p>alone on its host</p>", 1, "x")]
    rows += [(30 + i, "http://copies.example/", "<div>the very same page twice with quite a few words in it</div>", 1, "x") for i in range(2)]
    rows += [(40, None, None, None, None), (41, "", "", 1, "x"), (None, "http://h.example", "<article>a\tb</article>", 1, "x"), (42, "u", "<p>" + "x " * 50000, 1, "x")]
    got = {r.page_id: r for r in pagetext.main_text(spark.createDataFrame(rows, PAGES), shard_pages=shard_pages).collect()}
    assert len(got) == len(rows)
    assert [got[i].text for i in range(9)] == [f"n{i} stands only here x{i}" for i in range(9)]
    assert got[20].text == f"{MENU}\n\nalone on its host"
    assert got[30].text == got[31].text == "the very same page twice with quite a few words in it"
    assert (got[40].text, got[41].text, got[None].text) == ("", "", "a b") and got[42].n_chars == 99999
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_empty_table(spark):
    assert pagetext.main_text(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("n", [1, 3, 40])
def test_characters_that_lower_case_makes_longer(n):
    capital = "\u0130" * n
    source = f"<article><p>{capital}</p><SCRIPT>var x = 1</Script><p>text that follows</p><style>p</style><p>end</p><aside>no</ASIDE></article>"
    assert text_of(source) == f"{capital}\n\ntext that follows\n\nend"


BODY = "This is the body of number {0} and no other page says {0} like it does here, since the words of {0} are its own"


def site(make, n=6):
    return [(i, f"http://h.example/{i}", make(i, BODY.format(f"w{i}")), 1, "x") for i in range(n)]


@pytest.mark.parametrize("shard_pages", [1000, 2])
@pytest.mark.parametrize("make, want", [
    # what no other page has stays, whatever its class is
    (lambda i, b: f"<article><p>alpha{i}</p><section class='search-results'><p>{b}</p></section></article>", lambda i, b: f"alpha{i}\n\n{b}"),
    (lambda i, b: f"<article><h1 class=alert>Title {i}</h1><div class='dialog-scene'>{b}</div><div class=notice>note {i}</div><p>end{i}</p></article>",
     lambda i, b: f"Title {i}\n\n{b}\n\nnote {i}\n\nend{i}"),
    # what pages share goes if its class says so, or at the edge
    (lambda i, b: f"<article><h1>T{i}</h1><p>{b}</p><div class=promobox>Buy now</div><p>more {b}</p><div class=sharethis>Send this on</div><p>last {i}</p></article>",
     lambda i, b: f"T{i}\n\n{b}\n\nmore {b}\n\nlast {i}"),
    (lambda i, b: f"<main><div>{MENU}</div><h1>T{i}</h1><p>{b}</p><p>All rights reserved</p></main>", lambda i, b: f"T{i}\n\n{b}"),
    # and stays in the middle without such a class
    (lambda i, b: f"<article><h1>T{i}</h1><p>{MENU}</p><p>{b}</p></article>", lambda i, b: f"T{i}\n\n{MENU}\n\n{b}"),
    # a passage that two pages quote, at the edge
    (lambda i, b: f"<article><p>{b}</p><p>{MENU if i < 2 else b[::-1]}</p></article>", lambda i, b: f"{b}\n\n{MENU if i < 2 else b[::-1]}"),
    # of several articles the one that is the page's own, even if it is shorter
    (lambda i, b: f"<article><p>{b}</p></article><article><p>{MENU} {MENU} {MENU} {MENU}</p></article>", lambda i, b: b),
    # menus and the like go without evidence
    (lambda i, b: f"<nav>menu of {i}</nav><article><p>{b}</p><div class=comments>reader {i}</div></article><footer>foot {i}</footer>", lambda i, b: b),
])
def test_repetition_decides_on_blocks(spark, make, want, shard_pages):
    rows = site(make)
    got = {r.page_id: r.text for r in pagetext.main_text(spark.createDataFrame(rows, PAGES), shard_pages=shard_pages).collect()}
    assert got == {i: want(i, BODY.format(f"w{i}")) for i in range(len(rows))}


def test_copied_articles_stay_whole(spark):
    long = " ".join(f"word{i}" for i in range(200))
    rows = site(lambda i, b: f"<article><p>{long}</p><p>edit {i}</p></article>") + site(lambda i, b: f"<article><p>{long}</p></article>")
    got = [r.text for r in pagetext.main_text(spark.createDataFrame(rows, PAGES)).collect()]
    assert sorted(got) == sorted([f"{long}\n\nedit {i}" for i in range(6)] + [long] * 6)


def test_runs_are_words_or_whole_short_blocks():
    blocks = ["a b c d e", "f", "g h i j", "k"]
    tokens, begin = pagetext.tokens_of(blocks, 4)
    assert begin.tolist() == [0, 5, 9, 13, 17]
    assert np.flatnonzero(pagetext.whole_runs(tokens, 4)).tolist() == [0, 1, 2, 5, 9, 10, 13]


def plain_text(rows, least):
    """The runs of all pages of a host by plain counting, then the rule for blocks."""
    hosts = {}
    for _, url, html, *_ in rows:
        hosts.setdefault(url.split("/")[2], set()).add(tuple(b for _, _, b in pagetext.read_page(html).found))
    out = {}
    for key, url, html, *_ in rows:
        streams = [pagetext.tokens_of(list(s), least)[0] for s in hosts[url.split("/")[2]]]
        pages = {}
        for s in streams:
            for h in set(pagetext.run_hashes(s, least).tolist()):
                pages[h] = pages.get(h, 0) + 1
        n = len(streams)
        runs = [h | (k >= 3 and 2 * k >= n) for h, k in pages.items() if k >= 2 and 10 * k >= n]
        out[key] = pagetext.choose(pagetext.read_page(html), np.array(sorted(runs), np.int64), least)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_whole_operator_against_plain_counts(spark, seed):
    rng = np.random.default_rng(seed)
    parts = [" ".join(rng.choice(list("abcdefgh"), rng.integers(2, 14))) for _ in range(8)]
    rows = []
    for i in range(60):
        body = "".join(f"<{t}>{parts[rng.integers(8)]}</p></div>" for t in rng.choice(["p", "div", "div class=promo", "div class=related"], rng.integers(0, 6)))
        zone = rng.choice(["article", "main", "div"])
        rows.append((i, f"http://h{rng.integers(3)}.example/{i}", f"<nav>{parts[0]}</nav><{zone}>{body}<p>{'own ' * 5}{i % 40}</p></{zone}>", 1, "x"))
    got = {r.page_id: r.text for r in pagetext.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == plain_text(rows, pagetext.LEAST_RUN)
