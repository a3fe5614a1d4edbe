import math
from collections import Counter

import pytest

from landfall.llm import cross_entropy as ce
from tests.llm.test_decontamination import plain_words


def brute_force(rows, good, size):
    words = {k: plain_words(t) for k, t in rows}
    total = Counter(w for ws in words.values() for w in ws)
    known = sorted(total, key=lambda w: (-total[w], w))[:size]
    number = {w: k + 1 for k, w in enumerate(known)}
    start, width = len(known) + 1, len(known) + 2
    counts = [[[0.0] * width for _ in range(width)] for _ in range(2)]
    coded = {k: [start, *(number.get(w, 0) for w in ws)] for k, ws in words.items()}
    for k, ids in coded.items():
        for a, b in zip(ids, ids[1:]):
            counts[0 if k in good else 1][a][b] += 1
    sums = [sum(map(sum, c)) for c in counts]
    if all(sums):
        counts[1] = [[x * sums[0] / sums[1] for x in row] for row in counts[1]]

    def loss(table, a, b):
        single = [sum(row[k] for row in table) + 1 for k in range(width - 1)]
        p_single = single[b] / sum(single)
        n = sum(table[a])
        if not n:
            return -math.log(p_single)
        taken = sum(min(x, ce.DISCOUNT) for x in table[a])
        return -math.log(max(table[a][b] - ce.DISCOUNT, 0) / n + taken / n * p_single)

    out = {}
    for k, ids in coded.items():
        n = len(ids) - 1
        pair = [sum(loss(t, a, b) for a, b in zip(ids, ids[1:])) / n if n else None for t in counts]
        out[k] = (n, *pair, pair[0] - pair[1] if n else None)
    return out


ROWS = [
    (1, "the cat sat on the mat. The cat sat!"),
    (2, "the dog sat on the log"),
    (3, "buy cheap pills buy now"),
    (4, None),
    (5, "..."),
    (6, "cheap pills for the cat"),
    (7, "entirely unseen words here"),
]


@pytest.mark.parametrize("good", [{1, 2}, set(), {1, 2, 3, 6, 7}])
def test_scores_match_brute_force(session, docs, good):
    labels = [(k, 1) for k in good] + [(3, 0), (None, 1), (1, None), (999, 1)]
    if 3 in good:
        labels.remove((3, 0))
    frame = session.createDataFrame(labels, "doc_id long, quality int")
    expected = brute_force(ROWS, good, 6)
    found = ce.score(docs(ROWS), frame, size=6).collect()
    assert len(found) == len(ROWS)
    for row in found:
        for got, want in zip(tuple(row)[1:], expected[row["doc_id"]]):
            assert got == (want if want is None else pytest.approx(want, rel=1e-4, abs=1e-4))


def test_target_like_documents_score_low(session, docs):
    rows = [(k, "calm river under old trees") for k in range(20)] + [(k, "win money fast win money") for k in range(20, 60)]
    labels = session.createDataFrame([(k, 1) for k in range(10)], "doc_id long, quality int")
    found = {r["doc_id"]: r["ce_difference"] for r in ce.score(docs(rows), labels).collect()}
    assert found[15] < 0 < found[30]


def test_repeated_and_no_rows(session, docs):
    labels = session.createDataFrame([(1, 1), (1, 1)], "doc_id long, quality int")
    found = ce.score(docs([(1, "a b"), (1, "a b"), (None, "c")]), labels)
    assert found.count() == 3
    assert ce.score(docs([]), labels).count() == 0


def plain_loss(pairs, a, b, scale, n_words):
    single = sum(n for (_, y), n in pairs.items() if y == b) * scale + 1
    single /= sum(pairs.values()) * scale + n_words
    row = [n * scale for (x, _), n in pairs.items() if x == a]
    if not row:
        return -math.log(single)
    kept = max(pairs[a, b] * scale - ce.DISCOUNT, 0)
    return -math.log((kept + sum(min(n, ce.DISCOUNT) for n in row) * single) / sum(row))


def test_every_word_counts_however_many_there_are(session, docs):
    # 3,000 words, each on two documents, are more than a table of 2,048 has.
    rows = [(k, " ".join(f"w{k // 2 * 50 + j}" for j in range(50))) for k in range(120)]
    good = set(range(0, 60, 2))
    pairs = [Counter(), Counter()]
    for k, text in rows:
        words = text.split()
        pairs[k not in good].update(zip([None, *words], words))
    scale = [1, sum(pairs[0].values()) / sum(pairs[1].values())]
    labels = session.createDataFrame([(k, 1) for k in good], "doc_id long, quality int")
    found = {r["doc_id"]: r for r in ce.score(docs(rows), labels).collect()}
    assert len(found) == len(rows)
    for k in (0, 1, 61, 119):
        words = rows[k][1].split()
        for name, counts, by in zip(("ce_target", "ce_background"), pairs, scale):
            losses = [plain_loss(counts, a, b, by, 3001) for a, b in zip([None, *words], words)]
            assert found[k][name] == pytest.approx(sum(losses) / 50, rel=1e-6)
    assert found[0]["ce_difference"] < 0 < found[61]["ce_difference"]


@pytest.mark.parametrize("share", [0.0, 0.05, 1.0])
def test_hot_words_and_parts_do_not_matter(session, docs, monkeypatch, share):
    monkeypatch.setattr(ce, "HOT_SHARE", max(share, 1e-6))
    monkeypatch.setattr(ce, "PART_BYTES", 40)
    rows = [*ROWS, (1, ROWS[0][1]), (None, "the cat sat")]
    labels = session.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    found = ce.score(docs(rows), labels).collect()
    assert len(found) == len(rows)
    whole = {r["doc_id"]: tuple(r)[1:] for r in ce.score(docs(ROWS + ROWS[:1] + [(8, "the cat sat")]), labels).collect()}
    for row in found:
        for got, want in zip(tuple(row)[1:], whole[row["doc_id"] or 8]):
            assert got == (want if want is None else pytest.approx(want))
