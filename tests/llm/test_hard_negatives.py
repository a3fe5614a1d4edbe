import math
import random

import numpy as np
import pytest

from landfall.llm import hard_negatives as H
from landfall.llm.queries import QUERIES

from .conftest import FOLDER

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, rank int"


def expected(rows):
    """Brute force over (vec_id, embedding, label) with distinct ids."""
    whole = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        whole.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for anchor, label, vector in whole:
        if anchor % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(vector, v)), i, lab) for i, lab, v in whole if i != anchor]
        scored.sort()
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and -50 * p <= -100 * s[0] <= -95 * p]
            for rank, (n, negative, _) in enumerate(fit[:3], 1):
                out.append((anchor, positive, rank, negative, -p, -n))
    return sorted(out)


def mined(session, rows):
    frame = session.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in H.hard_negatives(frame).collect())


def made_up(seed, n, dims, spread):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(5)]
    return [
        (i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.randrange(3)) for i in range(n)
    ]


def test_query_equals_brute_force(session):
    rows = session.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label")
    found = QUERIES["op13_hard_negatives"](session, FOLDER)
    assert found.dtypes == [
        ("anchor_id", "bigint"),
        ("positive_id", "bigint"),
        ("rank", "int"),
        ("negative_id", "bigint"),
        ("positive_score", "bigint"),
        ("negative_score", "bigint"),
    ]
    assert sorted(tuple(r) for r in found.collect()) == expected([tuple(r) for r in rows.collect()])


@pytest.mark.parametrize("spread", [0.0, 0.2, 2.0])
def test_clusters_copies_and_blocks(session, monkeypatch, spread):
    """Many equal vectors, so many ties; blocks of 40 rows and of 2 anchors."""
    rows = made_up(4, 300, 11, spread)
    monkeypatch.setattr(H, "BLOCK_VALUES", 40 * 11)
    monkeypatch.setattr(H, "BLOCK_ANCHORS", 2)
    assert mined(session, rows) == expected(rows)


def test_odd_rows(session):
    rows = made_up(5, 120, 4, 0.3)
    rows += [(k, [0.5, None, 0.1, 0.2], 1) for k in (200, 201)]
    rows += [(250, [float("nan")] * 4, 1), (251, [float("inf")] * 4, 1), (252, None, 1)]
    rows += [(253, [1.0] * 4, None), (None, [1.0] * 4, 1)]
    rows += [(300, [0.0] * 4, 0), (301, [0.0] * 4, 0), (302, [0.0] * 4, 1), (303, [], 1), (304, [1.0] * 6, 2)]
    rows += [(-50, [0.3] * 4, 2), (400, [-0.001] * 4, 1)]
    assert mined(session, rows) == expected(rows)


def test_repeated_rows_count_for_themselves_and_anchors_once(session):
    rows = [(50, [1.0, 0.0], 1), (50, [1.0, 0.0], 1), (1, [0.9, 0.0], 1), (1, [0.9, 0.0], 1), (2, [0.5, 0.0], 2)]
    # Scores: 256 * 230 for both rows of id 1, 256 * 128 for the negative.
    assert mined(session, rows) == [(50, 1, 1, 2, 58880, 32768)] * 2


def test_empty_table_and_no_anchor(session):
    assert mined(session, []) == []
    assert mined(session, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_vectors_too_long_are_an_error(session):
    rows = [(50, [1e6] * 8, 1), (1, [1e6] * 8, 1)]
    with pytest.raises(Exception, match="too long"):
        mined(session, rows)


@pytest.mark.parametrize("seed", range(20))
def test_index_finds_all_pairs_that_reach(seed):
    rng = np.random.default_rng(seed)
    dims = int(rng.integers(1, 40))
    rows = np.floor(rng.normal(0, 1, (200, dims)) * rng.choice([1, 20, 100], dims))
    rows[rng.random(200) < 0.2] = 0
    anchors = np.floor(rng.normal(0, 50, (9, dims)))
    scores = anchors @ rows.T
    low = np.quantile(scores, rng.uniform(0, 1, 9), axis=None)
    i, j, found = H.SuffixIndex(rows).reaching(anchors, low)
    assert (np.diff(i) >= 0).all()
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(scores >= low[:, None]))))
    assert (found == scores[i, j]).all()
