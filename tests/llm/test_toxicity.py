import random

import numpy as np
import pytest

from landfall.llm import toxicity

BAD = ["vileword", "grimling", "sludgehead"]


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"word{k}" for k in range(200)]
    rows, labels = [], []
    for k in range(n):
        text = rng.choices(words, k=rng.randint(5, 60))
        bad = k % 5 == 0
        if bad:
            for _ in range(2):
                text[rng.randrange(len(text))] = rng.choice(BAD) + rng.choice(["", "s", "ing"])
        junk = k % 7 == 0
        if junk:
            text = [w + "%%% zzz" for w in text]
        rows.append((k, " ".join(text)))
        labels.append((k, int(not junk), int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def trained(session, docs):
    rows, labels = corpus(500, 1)
    frame = session.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return toxicity.train(docs(rows), frame)


def test_held_out_accuracy(session, docs, trained):
    rows, labels = corpus(300, 2)
    found = {r["doc_id"]: r["toxic"] for r in toxicity.score(docs(rows), trained).collect()}
    right = sum(found[k] == bool(toxic) for k, _, toxic in labels)
    assert right / len(labels) > 0.97


def test_later_models_see_earlier_categories(trained):
    assert [len(m.earlier) for m in trained.models] == [0, 1]
    low, toxic = trained.models
    assert any(f in toxic.features for f in BAD)
    assert "zzz" in low.features


def test_rows_that_pass_keep_their_columns(session, docs, trained):
    rows = [(1, "word1 word2 word3"), (2, "vileword grimling word2"), (3, None), (None, ""), (2, "vileword grimlings")]
    kept = toxicity.keep_clean(docs(rows), trained)
    assert kept.columns == docs([]).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 3, None]
    scored = toxicity.score(docs(rows), trained)
    assert scored.count() == len(rows)
    assert scored.where("not toxic").count() == 3


def test_labels_with_gaps(session, docs):
    rows, _ = corpus(40, 3)
    labels = session.createDataFrame([(None, 1, 1), (1, None, 1), (2, 1, None)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(docs(rows), labels)
    assert toxicity.keep_clean(docs(rows), chain).count() == 40
    one_class = session.createDataFrame([(k, 1, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    assert toxicity.keep_clean(docs(rows), toxicity.train(docs(rows), one_class)).count() == 40
    assert toxicity.score(docs([]), toxicity.train(docs([]), labels)).count() == 0


def test_sample_is_bounded_and_labels_are_joined(session, docs):
    rows, labels = corpus(60, 4)
    labels += [(0, 0, 0), (0, 1, 0), (999, 1, 1)]
    frame = session.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert toxicity.training_sample(docs(rows), frame, rows=10).count() <= 10
    sample = toxicity.training_sample(docs(rows), frame)
    assert sample.count() == 60
    assert sample.where("doc_id = 0").first()["low_quality"] == 1


def test_fit_finds_the_minimum():
    rng = np.random.default_rng(0)
    rows = np.repeat(np.arange(80), 3)
    columns = rng.integers(0, 10, 240)
    before = rng.random((80, 1))
    target = (rng.random(80) < 0.4).astype(float)

    def loss(w):
        z = np.bincount(rows, w[columns], 80) + before @ w[10:-1] + w[-1]
        return np.mean(np.log1p(np.exp(z)) - target * z) + 0.5 / 80 * (w[:-1] ** 2).sum()

    w = toxicity.fit(rows, columns, before, target, 10, steps=3000)
    for k in range(len(w)):
        for step in (-0.01, 0.01):
            other = w.copy()
            other[k] += step
            assert loss(other) > loss(w) - 1e-9


def test_threshold():
    scores, target = np.array([0.9, 0.8, 0.4, 0.1]), np.array([1, 1, 0, 0])
    assert toxicity.best_threshold(scores, target) == pytest.approx(0.6)
    assert toxicity.best_threshold(scores, np.zeros(4)) == float("inf")


def plain_fit(x, target, l2=1.0):
    """Penalised logistic regression by Newton steps; the last column is the bias."""
    n, width = x.shape
    w = np.zeros(width)
    keep = np.append(np.full(width - 1, l2 / n), 0.0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (p - target) / n + keep * w
        curve = (x * (p * (1 - p))[:, None]).T @ x / n + np.diag(keep + 1e-12)
        w = w - np.linalg.solve(curve, slope)
    return w


def plain_chain(texts, targets):
    """Probabilities of each category for each text, the chain fitted in plain numbers."""
    words = [toxicity.distinct_features(t.encode()) for t in texts]
    names = sorted({f for w in words for f in w if sum(f in v for v in words) >= toxicity.LEAST_DOCS})
    x = np.array([[f in w for f in names] for w in words], float)
    fold = np.arange(len(texts)) % toxicity.FOLDS
    out_of_fold, in_turn = np.zeros((len(texts), 0)), np.zeros((len(texts), 0))
    for target in targets:
        one = np.ones((len(texts), 1))
        train, use = np.hstack([x, out_of_fold, one]), np.hstack([x, in_turn, one])
        out = np.zeros(len(texts))
        for k in range(toxicity.FOLDS):
            w = plain_fit(train[fold != k], target[fold != k])
            out[fold == k] = 1 / (1 + np.exp(-train[fold == k] @ w))
        w = plain_fit(train, target)
        in_turn = np.column_stack([in_turn, 1 / (1 + np.exp(-use @ w))])
        out_of_fold = np.column_stack([out_of_fold, out])
    return in_turn


def test_chain_equals_a_plain_one(session, docs):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for k in range(90):
        low, toxic = rng.random() < 0.4, rng.random() < 0.3
        kinds = ["good fine calm"] + ["poor weak thin"] * low + ["awful nasty vile"] * toxic
        rows.append((k, " ".join(rng.choice(" ".join(kinds).split(), 8))))
        labels.append((k, int(not low), int(toxic)))
    frame = session.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = toxicity.train(docs(rows), frame)
    found = {r["doc_id"]: r for r in toxicity.score(docs(rows), chain).collect()}
    targets = [np.array([1.0 - q for _, q, _ in labels]), np.array([float(t) for _, _, t in labels])]
    expected = plain_chain([t for _, t in rows], targets)
    for k, (low, toxic) in enumerate(expected):
        assert found[k]["p_low_quality"] == pytest.approx(low, abs=0.01)
        assert found[k]["p_toxic"] == pytest.approx(toxic, abs=0.01)
        if abs(toxic - chain.threshold) > 0.01:
            assert found[k]["toxic"] == (toxic >= chain.threshold)
