import html
import re
import time

import numpy as np
import pytest

from landfall.llm import html_text, packed
from landfall.llm.queries import QUERIES
from tests.llm.conftest import FOLDER


def kept(text):
    return [b for b, place in html_text.parse(text).blocks if place]


def test_all_of_a_page_is_held_against_the_runs_of_its_host():
    notice = "please note that this site is best seen in large windows only thank you"
    sources = [
        f"<article><p>story {notice}</p></article><nav>{notice}</nav>",
        f"<div>{notice}</div><article><p>another story</p></article>",
        f"<main><p>{notice} indeed</p><article>a tale</article></main>",
        f"<p>{notice}</p><p>open text</p>",
        "<p>few words</p>",
        "",
    ]
    streams = [html_text.stream(html_text.parse(s)) for s in sources]
    names = np.sort(html_text.run_places([notice.split()], 8)[0])
    covered = html_text.boilerplate(streams, [names] * len(streams), 8)
    assert [len(c) for c in covered] == [len(s) for s in streams]
    found = [[t for t, c in zip(s, taken.tolist()) if c] for s, taken in zip(streams, covered)]
    assert found == [notice.split() * 2] + [notice.split()] * 3 + [[], []]
    assert not any(c.any() for c in html_text.boilerplate(streams, [names[:0]] * len(streams), 8))


@pytest.mark.parametrize(
    "source, blocks",
    [
        ("", []),
        ("plain &amp; simple &lt;b&gt; &eacute; &#65;", ["plain & simple <b> é A"]),
        ("<p>one<p>two <b>bold<br>three", ["one", "two bold three"]),
        ("<div>a<p>b</p>c</div>", ["a", "b", "c"]),
        ("<ul><li>x</li><li>y</ul>z", ["x", "y", "z"]),
        ("<table><tr><td>1</td><td>2</td></tr><tr><td>3</table>", ["1 2", "3"]),
        ("<p>a</p><script>var t = '</p>';<b></script><style>p{}</style><p>b", ["a", "b"]),
        ("<script>never closed <p>x", []),
        ("a<!-- <p>gone</p> -->b<!-- open", ["ab"]),
        ("<nav>menu<ul><li>x</ul></nav><p>t</p><footer>f</footer>", ["t"]),
        ("<header>h</header><p>t</p><aside>a</aside><form>f<input></form>", ["t"]),
        ("<div class='side-bar sidebar'>s</div><div id=comments><p>c</p></div><p>t</p>", ["t"]),
        ("<div class='cookieNotice'>c</div><div role=navigation>n</div><p class=lead>t", ["t"]),
        ("<p title='a > b'>t</p><p hidden>h</p><p class=overflow-hidden>u</p>", ["t", "u"]),
        ("5 < 6 and 7 > 3", ["5 < 6 and 7 > 3"]),
        ("<DIV CLASS=ad>x</DIV><P>t</P>", ["t"]),
        ("<p>&nbsp; a&nbsp;b \n c</p>", ["a b c"]),
        ("</p></div>x<br/>y<hr/>z", ["x y", "z"]),
        ("<div class=ad><p>unclosed<article><p>t</article>", ["t"]),
    ],
)
def test_blocks(source, blocks):
    assert kept(source) == blocks


def test_headers_of_an_article_stay():
    page = html_text.parse("<body><header>site</header><article><header><h1>T</h1></header><p>x<aside>a</aside></article><p>y")
    assert page.blocks == [("site", 0), ("T", 2), ("x", 2), ("a", 0), ("y", 1)]


def pages_of(session, rows):
    full = [(*r, "clash", 1) for r in rows]
    return session.createDataFrame(full, "page_id long, url string, html string, host string, shard int")


def test_a_hosts_repeats_go_where_no_article_is_declared(session):
    notice = "please note that this site is best seen in large windows only thank you"
    rows = [
        (k, f"http://a.org/{k}", f"<div>{notice}</div><p>story number {k} tells of {'x' * (k + 1)} things</p><div>{notice}</div>")
        for k in range(6)
    ]
    rows += [(10, "http://b.org/1", f"<p>{notice}</p>")]
    rows += [(20 + k, f"http://a.org/p{k}", f"<article><p>{notice}</p></article><p>{notice}</p>") for k in range(2)]
    rows += [(30, None, None), (31, "http://a.org/e", ""), (30, None, None), (32, "nowhere", "<nav>x</nav>")]
    found = {}
    result = html_text.extract(pages_of(session, rows), shard_bytes=1 << 20)
    assert result.columns == ["page_id", "url", "text"]
    for r in result.collect():
        found.setdefault(r["page_id"], []).append(r["text"])
    for k in range(6):
        assert found[k] == [f"story number {k} tells of {'x' * (k + 1)} things"]
    assert found[10] == [notice]
    assert found[20] == found[21] == [notice]
    assert found[30] == ["", ""] and found[31] == [""] and found[32] == [""]


def brute_force(streams, least, run):
    pages = {}
    for p, tokens in enumerate(streams):
        for k in range(len(tokens) - run + 1):
            pages.setdefault(tuple(tokens[k : k + run]), set()).add(p)
    out = []
    for tokens in streams:
        covered = np.zeros(len(tokens), bool)
        for k in range(len(tokens) - run + 1):
            if len(pages[tuple(tokens[k : k + run])]) >= least:
                covered[k : k + run] = True
        out.append(covered.tolist())
    return out


@pytest.mark.parametrize("seed", range(8))
def test_suffix_array_matches_brute_force(seed):
    rng = np.random.default_rng(seed)
    shared = [str(t) for t in rng.integers(0, 4, 30)]
    streams = []
    for _ in range(6):
        tokens = [str(t) for t in rng.integers(0, 9, rng.integers(0, 25))]
        if rng.random() < 0.7:
            a, b = sorted(rng.integers(0, 31, 2))
            tokens += shared[a:b]
        streams.append(tokens)
    for run, least in ((3, 2), (5, 3), (8, 2)):
        assert [c.tolist() for c in html_text.repeated(streams, least, run)] == brute_force(streams, least, run)


def test_query_gives_the_articles(session):
    pages = session.read.parquet(f"{FOLDER}/pages.parquet").collect()
    found = {r["page_id"]: r for r in QUERIES["op7_html_extraction"](session, FOLDER).collect()}
    assert len(found) == len(pages)
    for page in pages:
        article = re.search("<article>(.*)</article>", page["html"], re.S).group(1)
        parts = re.split("</?(?:p|h1)>", article)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in parts]
        row = found[page["page_id"]]
        assert row["text"] == "\n\n".join(b for b in blocks if b)
        assert (row["url"], row["n_chars"]) == (page["url"], len(row["text"]))


def test_no_pages(session):
    assert html_text.extract(pages_of(session, [])).count() == 0


def test_a_host_is_judged_as_a_whole_however_large(session):
    notice = "please note that this site is best seen in large windows only thank you"
    rare = "readers of the spring edition will find the map on the second last page"
    filler = "<!--" + "x" * 400_000 + "-->"  # few pages to a MB
    rows = [
        (k, f"http://big.org/{k}", f"<div>{notice}</div>{filler}<p>story number {k} tells of {'x' * (k + 1)} things</p>")
        for k in range(40)
    ]
    # On 3 of 200 pages: fewer than 2 in 100, however they are spread.
    rows += [
        (1000 + k, f"http://small.org/{k}", f"<p>tale {k} is of {'y' * (k + 1)}</p>" + (f"<p>{rare}</p>" if k < 3 else ""))
        for k in range(200)
    ]
    for shard_bytes in (1 << 12, 1 << 20):
        found = html_text.extract(pages_of(session, rows), shard_bytes=shard_bytes).collect()
        texts = {r["page_id"]: r["text"] for r in found}
        assert all(texts[k] == f"story number {k} tells of {'x' * (k + 1)} things" for k in range(40))
        assert all(texts[1000 + k].endswith(rare) for k in range(3))


def test_host_runs_match_the_suffix_array(session):
    rng = np.random.default_rng(3)
    shared = [f"s{t}" for t in rng.integers(0, 4, 40)]
    streams = []
    for _ in range(12):
        a, b = sorted(rng.integers(0, 41, 2))
        streams.append([f"s{t}" for t in rng.integers(0, 9, 20)] + shared[a:b])
    rows = [(k, f"http://h.org/{k}", "<p>" + " ".join(s) + "</p>") for k, s in enumerate(streams)]
    covered = html_text.repeated(streams, 3, 5)
    found = html_text.extract(pages_of(session, rows), run=5, least_pages=3, page_share=0.0).collect()
    for r in found:
        want = html_text.unique_text([streams[r["page_id"]]], covered[r["page_id"]], 5)
        assert r["text"] == "\n\n".join(want)


def test_repeats_in_main_go_and_articles_stay(session):
    notice = "please note that this site is best seen in large windows only thank you"
    own = [f"story number {k} tells of {'x' * (k + 1)} things" for k in range(8)]
    rows = [(k, f"http://a.org/{k}", f"<main><div>{notice}</div><p>{own[k]}</p></main><p>open {k}</p>") for k in range(4)]
    rows += [
        (k, f"http://a.org/{k}", f"<main><h1>T{k}</h1><article><p>{own[k]}</p><p>{notice}</p></article><p>{notice}</p></main>")
        for k in range(4, 6)
    ]
    # Only articles have it on two of its three pages.
    told = "a line that two articles and one open page of the same host all have"
    rows += [(k, f"http://b.org/{k}", f"<article><p>{told}</p></article>") for k in range(10, 12)]
    rows += [(12, "http://b.org/12", f"<p>{told}</p><p>{own[6]}</p>")]
    texts = {r["page_id"]: r["text"] for r in html_text.extract(pages_of(session, rows)).collect()}
    assert [texts[k] for k in range(4)] == own[:4]
    assert [texts[k] for k in (4, 5)] == [f"T{k}\n\n{own[k]}\n\n{notice}" for k in (4, 5)]
    assert texts[10] == texts[11] == told
    assert texts[12] == own[6]


@pytest.mark.parametrize(
    "source, blocks",
    [
        ('<p>text <span class="ad">Buy now</span> more</p>', ["text more"]),
        ("<p>a <span hidden>secret</span><a class='share'>s</a> <label>l</label><button>b</button>z</p>", ["a z"]),
        ('<div id="comments"><article>reader comment</article></div><article>t</article>', ["t"]),
        ("<aside><article>side</article></aside><article><p>t</article>", ["t"]),
        ('<article>t<article class="comment">c</article><article role=complementary>r</article></article>', ["t"]),
        ('<article><p class="share-price">Shares rose</p><p class="share-buttons">s</p></article>', ["Shares rose"]),
        ("<article class='post has-sidebar'><p class='menu-card'>soup</p></article>", ["soup"]),
        ("<div class='siteNav'>n</div><div class='ad-1 x'>a</div><div id=AD>a</div><p class=adult>t</p>", ["t"]),
        ("<article>a<b>c<p>d</b>e</p>f</article>", ["ac", "de", "f"]),
        ("<article><p>x <i>y</p><p>z</i> w</article>", ["x y", "z w"]),
        ("<nav><span>n</nav><p>t</p></span>u", ["t", "u"]),
    ],
)
def test_what_is_out_takes_its_text_and_nothing_else(source, blocks):
    assert kept(source) == blocks


def test_long_pages_of_nested_and_stray_tags():
    pages = ["<div>" * 60_000 + "x" + "</b>" * 100_000, "<b>" * 90_000 + "<p>" * 90_000 + "</b>" * 90_000]
    pages.append("<div class=ad>" * 20_000 + "<article>t</article>" * 20_000)
    for page in pages:
        begin = time.perf_counter()
        html_text.parse(page)
        assert time.perf_counter() - begin < 5


@pytest.mark.parametrize("seed", range(5))
def test_packed_numbers(seed):
    rng = np.random.default_rng(seed)
    n = [0, 1, 5, 3000, 100_000][seed]
    h = np.sort(rng.integers(0, 1 << 40, n)).astype(np.uint64)
    more = rng.integers(0, [1, 2, 300, 1 << 31, 1 << 40][seed], n)
    found = packed.unpack(packed.pack(h, more), 1)
    assert (found[0] == h).all() and (found[1] == more).all()
    part = packed.part_of(h, 7)
    assert (np.diff(part) >= 0).all() and (part < 7).all()


def test_many_pieces_of_a_host(session, monkeypatch):
    notice = "please note that this site is best seen in large windows only thank you"
    rows = [(k, f"http://a.org/{k}", f"<div>{notice}</div><p>story number {k} tells of {'x' * (k + 1)} things</p>") for k in range(30)]
    for size in (1, 1 << 30):
        monkeypatch.setattr(html_text, "PIECE_BYTES", size)
        texts = {r["page_id"]: r["text"] for r in html_text.extract(pages_of(session, rows), shard_bytes=100).collect()}
        assert texts == {k: f"story number {k} tells of {'x' * (k + 1)} things" for k in range(30)}
