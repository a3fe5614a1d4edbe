"""Main text of web pages, by what repeats over the whole of each host.

A page is parsed into blocks, and the pages of a host make one stream of tokens.
Its suffixes get ranks by prefix doubling, to the depth of a run: tokens, then
pairs, fours and eights, each named by the two halves it is made of. The names
are sorted over the whole host, which is its suffix array to that depth; as a
host may be of any size, the array lies in pieces by ranges of names. Suffixes of
equal name are neighbours there, and the pages that they come from are counted:
runs that many pages have are boilerplate, and longer repeats are where runs
overlap. Then the markup is a check: the text of an <article> is kept even if it
repeats, what is called a menu, a footer, an advert and the like is not kept even
if it does not. Of <main> what is left counts as text beside articles, and of the
rest of a page only where it has neither.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import arrow_map, as_bytes
from landfall.llm.packed import HASH_BITS, groups, pack, short, unpack
from landfall.llm.url_filter import host_of
from landfall.operators.joins import sized_broadcast
from landfall.session import materialize

# Tokens that a repeated run has at least.
RUN = 8
# Pages that have it at least: this many, and this share of the host's.
LEAST_PAGES = 3
PAGE_SHARE = 0.02
# Bytes of HTML whose runs a task adds up before it gives them out. The result
# does not depend on it.
SHARD_BYTES = 16 << 20
# Bytes of HTML of a host for each piece of its suffix array.
PIECE_BYTES = 64 << 20
# Tasks that have them; beyond, tasks get several pieces, one after the other.
MOST_TASKS = 10_000
# Tokens of a block that must be left for it to be text, if some were taken.
LEAST_LEFT = 3

# Element names of HTML and the usual words in class and id names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template textarea title svg math iframe object canvas video audio select".split()
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav"
    " ol p pre section summary table tbody tfoot thead tr ul".split()
)
CLOSES_P = BLOCKS - {"html", "body"}
ALWAYS_OUT = set("nav footer aside form menu dialog button label fieldset head".split())
ALWAYS_OUT_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion"
    " banner nav navigation navbar menu breadcrumb breadcrumbs sidebar aside footer cookie cookies"
    " consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup"
    " login search share sharing social related recommended comment comments reply replies disqus"
    " respond pagination pager skip toolbar widget widgets toc".split()
)
# Words that say where or what kind of a thing something is, beside one of those.
BESIDE_WORDS = set(
    "area bar block body bottom box button buttons center column container content entry form group"
    " header heading icon icons inner item items left link links list main message module outer page"
    " panel post posts primary right row section site slot small thread title top unit wrap wrapper"
    " article articles global mobile desktop sticky fixed a b c d".split()
)
OUT_ROLES = set("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
OUTSIDE_ARTICLE = {"header"}
ARTICLE = {"article", "main"}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^<>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_NAME_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)


@dataclass
class Page:
    """Blocks in page order, with where each stands: 3 main, 2 article, 1 open, 0 out."""

    blocks: list[tuple[str, int]] = field(default_factory=list)


def names_boilerplate(token: str) -> bool:
    """Whether a class or id means what is no main text.

    Whole names count, and compounds of such words with words of place or kind:
    ``share``, ``share-buttons`` and ``cookieNotice``, but not ``share-price``.
    """
    if token.lower() in ALWAYS_OUT_WORDS:
        return True
    parts = [p.lower() for p in _NAME_PART.findall(token)]
    return any(p in ALWAYS_OUT_WORDS for p in parts) and all(
        p in ALWAYS_OUT_WORDS or p in BESIDE_WORDS for p in parts
    )


def is_out(name: str, rest: str, in_article: bool) -> bool:
    """Whether the markup says that an element is not main text."""
    if name in ALWAYS_OUT or name in OUTSIDE_ARTICLE and not in_article:
        return True
    if not rest or name in ("main", "html", "body"):
        return False
    if _HIDDEN.search(rest):
        return True
    for key, value in _ATTRIBUTE.findall(rest):
        value = value.strip("\"'")
        if key.lower() == "role":
            if value.lower() in OUT_ROLES:
                return True
        elif any(names_boilerplate(t) or t.lower() == "header" and not in_article for t in value.split()):
            return True
    return False


class _Open:
    """The elements that are open, with what an end tag closes found at once.

    Elements can end before those that were opened in them, so ``alive`` tells
    which still count; lists by name and of blocks drop the others when they come
    to their end.
    """

    def __init__(self):
        self.names: list[str] = []
        self.gone: list[bool] = []
        self.alive: list[bool] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.unclosed: list[int] = []
        self.out = self.inside = self.articles = 0

    def open(self, name: str, gone: bool, ended: bool) -> None:
        place = len(self.names)
        self.names.append(name)
        self.gone.append(gone)
        self.alive.append(True)
        self.places.setdefault(name, []).append(place)
        if name in CLOSES_P:
            self.blocks.append(place)
        if not ended:
            self.unclosed.append(place)
        self._count(place, 1)

    def _count(self, place: int, sign: int) -> None:
        name = self.names[place]
        self.out += sign * self.gone[place]
        self.inside += sign * (name in ARTICLE)
        self.articles += sign * (name == "article")

    def _leave(self, place: int) -> None:
        if self.alive[place]:
            self.alive[place] = False
            self._count(place, -1)

    def _last(self, places: list[int]) -> int:
        """The last element of a list that is open; -1 if none is."""
        while places and not self.alive[places[-1]]:
            places.pop()
        return places[-1] if places else -1

    def close(self, place: int) -> None:
        """Close an element and all that were opened in it."""
        while len(self.names) > place:
            last = len(self.names) - 1
            self._leave(last)
            for places in (self.places[self.names[last]], self.blocks, self.unclosed):
                if places and places[-1] == last:
                    places.pop()
            for column in (self.names, self.gone, self.alive):
                column.pop()

    def end(self, name: str) -> None:
        """An end tag. Of an element within the line it leaves open blocks alone."""
        place = self._last(self.places.get(name, []))
        if place < 0:
            return
        if name not in BLOCKS and self._last(self.blocks) > place:
            self._leave(place)
        else:
            self.close(place)

    def end_paragraph(self) -> None:
        place = self._last(self.blocks)
        if place >= 0 and self.names[place] == "p":
            self.close(place)

    def end_unclosed(self) -> None:
        """Before an article: elements that no end tag closes end here at the latest."""
        for place in self.unclosed:
            self._leave(place)
        self.unclosed.clear()


def _with_ends(tags: list[tuple[str, bool]]) -> list[bool]:
    """For each start tag whether an end tag belongs to it."""
    open_tags: dict[str, list[int]] = {}
    ended = [False] * len(tags)
    for k, (name, is_end) in enumerate(tags):
        if not is_end:
            open_tags.setdefault(name, []).append(k)
        elif open_tags.get(name):
            ended[open_tags[name].pop()] = True
    return ended


def parse(text: str) -> Page:
    """Blocks of a page, references decoded and white space made single spaces.

    An element that is out takes its text with it, in the middle of a line as
    well; the rest of the line is one block. What is within it is out, an article
    too, unless the element is never closed and the article begins after it.
    """
    page, opened = Page(), _Open()
    held: list[str] = []
    aside: list[str] = []

    def settle(pieces: list[str], place: int) -> None:
        block = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if block:
            page.blocks.append((block, place))

    def flush() -> None:
        if held:
            settle(held, 2 if opened.articles else 3 if opened.inside else 1)
        if aside:
            settle(aside, 0)

    matches = [m for m in _MARKUP.finditer(text)]
    tags = [(m["name"].lower(), bool(m["end"])) if m["name"] else ("", True) for m in matches]
    ended = _with_ends(tags)
    at = 0
    for match, (name, is_end), has_end in zip(matches, tags, ended):
        if match.start() > at:
            (aside if opened.out else held).append(text[at : match.start()])
        at = match.end()
        if not name:
            continue
        if name in BLOCKS:
            flush()
        elif name in ("br", "td", "th", "option"):
            (aside if opened.out else held).append(" ")
        if is_end:
            opened.end(name)
        elif name not in VOID and not match["rest"].endswith("/"):
            if name in ARTICLE and not opened.inside:
                opened.end_unclosed()
            if name in CLOSES_P:
                opened.end_paragraph()
            gone = is_out(name, match["rest"], bool(opened.inside))
            opened.open(name, gone, has_end)
    if at < len(text):
        (aside if opened.out else held).append(text[at:])
    flush()
    return page


# ---------------------------------------------------------------- suffix array


def repeated(streams: list[list[str]], least_pages: int, run: int = RUN) -> list[np.ndarray]:
    """Which tokens of each page lie in a run that enough of the pages have.

    The streams are put one after the other, each with an end of its own. The
    suffixes are ranked by prefix doubling, as deep as a run is long; suffixes
    of equal rank are neighbours in the array and begin with the same ``run``
    tokens. Longer repeats are where such runs overlap.
    """
    lengths = np.array([len(s) for s in streams], np.int64)
    if not lengths.sum():
        return [np.zeros(n, bool) for n in lengths]
    codes, _ = pd.factorize(np.array([t for s in streams for t in s], object))
    page = np.repeat(np.arange(len(streams)), lengths)
    size = int(codes.max()) + 1
    # Behind each page stands an end that no other page has.
    rank = np.empty(len(codes) + len(streams), np.int64)
    spots = np.arange(len(codes)) + page
    rank[spots] = codes
    rank[np.cumsum(lengths + 1) - 1] = size + np.arange(len(streams))
    owner = np.repeat(np.arange(len(streams)), lengths + 1)
    depth = 1
    while depth < run:
        step = min(depth, run - depth)
        ahead = np.full(len(rank), -1, np.int64)
        ahead[:-step] = rank[step:]
        _, rank = np.unique((rank << 32) + ahead + 1, return_inverse=True)
        depth += step
    order = np.lexsort((owner, rank))
    ranks, owners = rank[order], owner[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (ranks[1:] != ranks[:-1]) | (owners[1:] != owners[:-1])
    pages = np.bincount(ranks[fresh], minlength=int(ranks.max()) + 1)
    starts = np.flatnonzero(pages[rank] >= max(2, least_pages))
    change = np.zeros(len(rank) + run + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + run, -1)
    covered = (np.cumsum(change)[: len(rank)] > 0)[spots]
    return np.split(covered, np.cumsum(lengths)[:-1])


def unique_text(blocks: list[list[str]], covered: np.ndarray, run: int = RUN) -> list[str]:
    """Blocks without what is boilerplate in them.

    A block that is covered altogether goes, as the entries of a menu do. Of any
    other, stretches of at least ``run`` covered tokens are cut out; shorter
    ones are where a repeat runs on from a block beside it. One with next to
    nothing left goes as well.
    """
    out, at = [], 0
    for tokens in blocks:
        taken = covered[at : at + len(tokens)]
        at += len(tokens)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], taken, [0]])))
        gone = np.zeros(len(tokens), bool)
        for first, end in edges.reshape(-1, 2):
            gone[first:end] = end - first >= min(run, len(tokens))
        left = [t for t, out_of in zip(tokens, gone.tolist()) if not out_of]
        if left and (len(left) == len(tokens) or len(left) >= LEAST_LEFT):
            out.append(" ".join(left))
    return out


# ---------------------------------------------------------------- runs of a host


def run_places(streams: list[list[str]], run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, stream, position) of every suffix of several streams, to the depth of a run."""
    flat = pa.array([t for s in streams for t in s], pa.string())
    lengths = np.array([len(s) for s in streams], np.int64)
    n = len(flat) - run + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    coded = flat.dictionary_encode()
    known = pd.util.hash_array(np.array(coded.dictionary.to_pylist(), object), categorize=False)
    each = known[coded.indices.to_numpy()]
    # Names of 1, 2, 4 and more tokens: each of the names of its two halves, which
    # overlap where a run's length is no power of two.
    h, depth = each, 1
    while depth < run:
        step = min(depth, run - depth)
        left, right = h[:-step], h[step:]
        h = (left ^ (right * np.uint64(0x9E3779B97F4A7C15) + np.uint64(depth))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        depth += step
    owner = np.repeat(np.arange(len(streams)), lengths)
    at = np.flatnonzero(owner[:n] == owner[run - 1 :])
    begin = np.cumsum(lengths) - lengths
    return short(h[at]).astype(np.int64), owner[at], at - begin[owner[at]]


def host_runs(rows: DataFrame, run: int, least_pages: int, page_share: float, shard_bytes: int) -> DataFrame:
    """(site, runs): names of the runs that enough of a host's pages have.

    ``rows`` have the host's hash ``site`` and ``html``. Each page counts once
    for a run. Tasks sort the names of some megabytes of pages and send them in
    packed pieces, by ranges of names; where a range's pieces meet, equal names
    are counted. A host has as many runs as its pages have on average over
    ``page_share``, at most.
    """
    spark = rows.sparkSession
    least = max(2, least_pages)
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    totals = rows.groupBy("site").agg(F.count(F.lit(1)).alias("pages"), F.sum(size).alias("bytes"))
    totals = totals.select(
        "site",
        F.greatest(F.lit(least), F.ceil(F.col("pages") * F.lit(page_share))).cast("long").alias("least"),
        (1 + F.floor(F.col("bytes") / F.lit(PIECE_BYTES))).cast("long").alias("parts"),
    )
    totals = materialize(spark, totals, "hosts")

    def sort_names(batches):
        def packed(held):
            site, h, least, parts = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((h, site))
            site, h, least, parts = site[order], h[order], least[order], parts[order]
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (site[1:] != site[:-1])]))
            n = np.diff(np.append(new, len(h)))
            site, h, least, parts = site[new], h[new].astype(np.uint64), least[new], parts[new]
            part = (h * parts.astype(np.uint64) >> np.uint64(HASH_BITS)).astype(np.int64)
            cuts = np.flatnonzero(np.concatenate([[True], (site[1:] != site[:-1]) | (part[1:] != part[:-1])]))
            ends = np.append(cuts[1:], len(h))
            return pa.RecordBatch.from_pydict(
                {
                    "site": site[cuts],
                    "part": part[cuts],
                    "least": least[cuts],
                    "names": [pack(h[a:b], n[a:b]) for a, b in zip(cuts, ends)],
                }
            )

        held, size = [], 0
        for batch in batches:
            texts = as_bytes(batch.column("html"))
            size += sum(map(len, texts))
            h, page, _ = run_places([stream(parse(t.decode("utf-8", "replace"))) for t in texts], run)
            order = np.lexsort((h, page))
            h, page = h[order], page[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (page[1:] != page[:-1])
            if len(h):
                facts = [batch.column(c).to_numpy()[page[new]] for c in ("site", "least", "parts")]
                held.append((facts[0], h[new], *facts[1:]))
            if held and size >= shard_bytes:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    def count(batches):
        for (site, _, least), pieces in groups(batches, ("site", "part", "least")):
            lists = [unpack(raw, 1) for piece in pieces for raw in piece["names"].to_pylist()]
            h, n = (np.concatenate(x) for x in zip(*lists))
            order = np.argsort(h, kind="stable")
            h, n = h[order], n[order]
            new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            often = h[new][np.add.reduceat(n, new) >= least].astype(np.int64)
            if len(often):
                yield pa.RecordBatch.from_pydict({"site": np.full(len(often), site), "h": often})

    known = rows.join(sized_broadcast(totals), "site").select("site", "html", "least", "parts")
    sent = known.mapInArrow(sort_names, "site long, part long, least long, names binary")
    pieces = totals.agg(F.sum("parts")).first()[0] or 1
    sent = sent.repartition(min(pieces, MOST_TASKS), "site", "part").sortWithinPartitions("site", "part")
    found = sent.mapInArrow(count, "site long, h long")
    return materialize(spark, found.groupBy("site").agg(F.collect_list("h").alias("runs")), "runs")


# ---------------------------------------------------------------- extraction


def stream(page: Page) -> list[str]:
    """Tokens of what the host decides on, then those of articles and of what is out."""
    blocks = [b for b, place in page.blocks if place in (1, 3)]
    blocks += [b for b, place in page.blocks if place == 2] + [b for b, place in page.blocks if place == 0]
    return [t for b in blocks for t in b.split()]


def boilerplate(streams: list[list[str]], known: list[np.ndarray], run: int) -> list[np.ndarray]:
    """Which tokens of each stream lie in a run of its host; ``known`` has a stream's runs in order."""
    h, page, at = run_places(streams, run)
    bounds = np.searchsorted(page, np.arange(len(streams) + 1))
    out = []
    for k, (tokens, names) in enumerate(zip(streams, known)):
        change = np.zeros(len(tokens) + 1, np.int64)
        if len(names):
            some = slice(bounds[k], bounds[k + 1])
            place = np.minimum(np.searchsorted(names, h[some]), len(names) - 1)
            starts = at[some][names[place] == h[some]]
            np.add.at(change, starts, 1)
            np.add.at(change, starts + run, -1)
        out.append(np.cumsum(change)[:-1] > 0)
    return out


def main_text(page: Page, covered: np.ndarray, run: int) -> str:
    """A page's text, given which tokens of its stream are boilerplate."""
    declared = any(place in (2, 3) for _, place in page.blocks)
    out, at = [], 0
    for block, place in page.blocks:
        if place == 2:
            out.append(block)
        elif place in (1, 3):
            tokens = block.split()
            if place == 3 or not declared:
                out += unique_text([tokens], covered[at : at + len(tokens)], run)
            at += len(tokens)
    return "\n\n".join(out)


def extract(
    pages: DataFrame,
    run: int = RUN,
    least_pages: int = LEAST_PAGES,
    page_share: float = PAGE_SHARE,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``page_id, url, text`` of every row, blocks parted by two line ends.

    A NULL page, and one without text, gives an empty text. Pages without host
    share one. Repeated rows are pages of their own and so make each other
    boilerplate only where they declare no article. What repeats is counted over
    a whole host, so neither its size nor the length of its pages changes what
    share of them it takes. Pages are not grouped: a host's runs are sent to
    its pages, wherever these are. Columns other than ``page_id``, ``url`` and
    ``html`` are left out.
    """
    rows = pages.select("page_id", "url", "html", F.xxhash64(host_of(F.col("url"))).alias("site"))
    repeats = host_runs(rows.select("site", "html"), run, least_pages, page_share, shard_bytes)
    kind = dict(rows.dtypes)["page_id"]

    def decide(batch: pa.RecordBatch):
        found = [parse(raw.decode("utf-8", "replace")) for raw in as_bytes(batch.column("html"))]
        sites, runs = batch.column("site").to_pylist(), batch.column("runs")
        known: dict = {}
        for k, site in enumerate(sites):
            if site not in known:
                known[site] = np.sort(np.array(runs[k].values if runs[k].is_valid else [], np.int64))
        covered = boilerplate([stream(p) for p in found], [known[site] for site in sites], run)
        texts = [main_text(p, c, run) for p, c in zip(found, covered)]
        yield {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string())}

    joined = rows.join(sized_broadcast(repeats), "site", "left").select("page_id", "url", "html", "site", "runs")
    return arrow_map(joined, decide, f"page_id {kind}, url string, text string")
