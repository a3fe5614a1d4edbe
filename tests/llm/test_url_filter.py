import random

import numpy as np
import pytest

from landfall.llm import url_filter as uf
from landfall.llm.queries import QUERIES
from tests.llm.conftest import FOLDER


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    end = min([path.index(c) for c in "?#" if c in path], default=len(path))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, path[:end]


def plain_rule(host, path):
    best = None
    for rule in uf.RULES:
        fits = host == rule.host or host.endswith("." + rule.host)
        if fits and path.startswith(rule.path) and (best is None or len(rule.text) > len(best.text)):
            best = rule
    return best


URLS = [
    "http://www.Example.com/en/1?x#y",
    "http://a.www.example.com/en/",
    "https://blog.example.com/en/2",
    "https://example.com/EN/2",
    "http://xexample.com/en/2",
    "ftp://a.net/es/",
    "ftp://a.net/es",
    "http://net/fr/x",
    "http://a.com?x=/en/",
    "http://a.com",
    "no scheme/com/",
    "://a.com/",
    "x://y://z.com/a\nb/c?d",
    "HTTP://É.COM/En/ä",
    "",
    None,
]


def test_hosts_paths_and_rules(session):
    rows = [(k, u, "x", "y") for k, u in enumerate(URLS)] + [(1, URLS[1], "x", "y"), (None, URLS[0], None, None)]
    pages = session.createDataFrame(rows, "page_id long, url string, rule string, host string")
    found = uf.judge(pages).collect()
    assert len(found) == len(rows)
    for row in found:
        url = URLS[row["page_id"]] if row["page_id"] is not None else URLS[0]
        host, path = plain_parts(url)
        rule = plain_rule(host, path)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule and rule.text)
        assert row["verdict"] in ("allow", "block")
        if rule:
            assert row["verdict"] == ("allow" if rule.allow else "block")


def test_query_covers_every_page(session):
    pages = {r["page_id"]: r["url"] for r in session.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    found = QUERIES["op2_url_filter"](session, FOLDER).collect()
    assert sorted(r["page_id"] for r in found) == sorted(pages)
    for row in found:
        rule = plain_rule(*plain_parts(pages[row["page_id"]]))
        assert row["rule"] == (rule and rule.text)


def plain_probability(texts, context, char, order):
    """Witten-Bell by definition, from the texts themselves."""
    p = 1 / 256
    for size in range(min(order, len(context)) + 1):
        tail = context[len(context) - size :]
        after = [
            t[k : k + 1] for t in texts for k in range(size, len(t)) if t[k - size : k] == tail
        ]
        if not after:
            break
        p = (after.count(char) + len(set(after)) * p) / (len(after) + len(set(after)))
    return p


def test_model_is_the_smoothed_one():
    texts = [b"abcab", b"abd", b"bcd"]
    counts = {}
    for t in texts:
        for gram in uf.grams_of(t, 3):
            counts[gram] = counts.get(gram, 0) + 1
    model = uf.Markov(counts, 3)
    for text in (b"abcd", b"zz", b"", b"abab"):
        want = sum(np.log(plain_probability(texts, text[:k], text[k : k + 1], 3)) for k in range(len(text)))
        assert model.log_likelihood(text) == pytest.approx(want)


def test_held_out_accuracy(session):
    rng = random.Random(5)
    good = [f"https://site{rng.randrange(50)}.org/articles/{rng.randrange(9999)}/read" for _ in range(400)]
    bad = [f"http://x{rng.randrange(50)}.biz/casino-bonus/{rng.randrange(9999)}?win=1" for _ in range(400)]
    rows = [(u, True) for u in good[:300]] + [(u, False) for u in bad[:300]]
    model = uf.fit(session.createDataFrame(rows, "url string, allow boolean"), order=4)
    right = sum(model.score(u.encode()) >= model.threshold for u in good[300:])
    right += sum(model.score(u.encode()) < model.threshold for u in bad[300:])
    assert right >= 196


def test_one_verdict_lets_all_pass(session):
    model = uf.fit(session.createDataFrame([("http://a.com/", True)], "url string, allow boolean"))
    assert model.score(b"http://b.org/") >= model.threshold
    empty = session.createDataFrame([], "page_id long, url string")
    assert uf.judge(empty).count() == 0


def test_calibration():
    scores, allow = np.array([-2.0, -1.0, 1.0, 3.0]), np.array([False, False, True, True])
    assert -1 < uf.calibrate(scores, allow) < 1
    assert uf.calibrate(scores, np.ones(4, bool)) == 0.0


def many_urls(n):
    """Judged by a rule, with a run of characters that one URL of many has."""
    rng = random.Random(11)
    good = [f"http://s{k}.com/a/{rng.randrange(10**6)}" for k in range(n)]
    bad = [f"http://t{k}.net/es/{rng.randrange(10**6)}" for k in range(n)]
    return good, bad


def test_models_count_every_judged_url(session):
    # More of each verdict than the 10,000 that a sample once had.
    good, bad = many_urls(12_500)
    open_urls = ["http://a.org/es/1", "https://s1.org/a/12", "zz", "é://ü.org/ß", ""]
    urls = [*good, *bad, *open_urls, good[0]]
    pages = session.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r["page_id"]: r for r in uf.judge(pages).collect()}
    assert len(found) == len(urls)
    held = {
        r["url"]
        for r in pages.selectExpr("url", f"pmod(xxhash64(url), {uf.HELD_OUT}) = 0 AS held").collect()
        if r["held"]
    }
    models = []
    for side in (good, bad):
        counts = {}
        for url in set(side) - held:
            for gram in uf.grams_of(url.encode()):
                counts[gram] = counts.get(gram, 0) + 1
        models.append(uf.Markov(counts))

    def plain_score(url):
        raw = url.encode()
        return (models[0].log_likelihood(raw) - models[1].log_likelihood(raw)) / max(1, len(raw))

    for k in [*range(0, len(urls), 500), *range(25_000, len(urls))]:
        assert found[k]["score"] == pytest.approx(plain_score(urls[k]), abs=1e-8)


def test_threshold_on_spark_is_that_in_memory(session):
    rng = random.Random(2)
    for n in (2, 7, 400):
        scores = [rng.gauss(0, 1) for _ in range(n)]
        allow = [s + rng.gauss(0, 1) > 0 for s in scores[:-2]] + [True, False]
        rows = [(s, a, not a) for s, a in zip(scores, allow)]
        checks = session.createDataFrame(rows, "score double, accepted boolean, rejected boolean")
        cut, want = uf.threshold_of(checks), uf.calibrate(np.array(scores), np.array(allow))

        def gain(at):
            right = sum(a for s, a in zip(scores, allow) if s >= at) / sum(allow)
            return right + sum(not a for s, a in zip(scores, allow) if s < at) / (n - sum(allow))

        assert gain(cut) == pytest.approx(gain(want))
    one = session.createDataFrame([(1.0, True, False)], "score double, accepted boolean, rejected boolean")
    assert uf.threshold_of(one) == 0.0
