import itertools
import math
import random

import numpy as np
import pytest

from landfall.llm import lattice
from landfall.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, components_of


def brute_force(rows, threshold=0.93):
    """n_links, component_id and kept by id; rows are (vec_id, vector, label)."""
    sound = {}
    for i, v, label in rows:
        if None in (i, v, label) or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        sound.setdefault((i, tuple(v), label))
    sound = list(sound)
    links = []
    for (i, v, x), (j, w, y) in itertools.combinations(sound, 2):
        if x == y and len(v) == len(w):
            a, b = np.array(v, float), np.array(w, float)
            if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold - 1e-12:
                links.append((i, j))
    nodes = [r[0] for r in rows if r[0] is not None]
    root = components_of(links, nodes)
    degree = {n: 0 for n in nodes}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    return {n: (degree[n], root[n], root[n] == n) for n in nodes}


def vectors(seed, n=300, dimension=16):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    while k < n:
        base = rng.normal(size=dimension)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((k, np.float32(base + rng.normal(size=dimension) * 0.15).tolist(), int(rng.integers(0, 2))))
            k += 1
    same = rows[0][1]
    rows += [(k + j, same, rows[0][2]) for j in range(40)]
    return rows


def frame_of(session, rows, kind="float"):
    full = [(*r, 1, b"v", "k") for r in rows]
    schema = f"vec_id long, embedding array<{kind}>, label int, n int, vector binary, key string"
    return session.createDataFrame(full, schema)


def by_id(frame):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in frame.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_recall_against_brute_force(session, seed):
    rows = vectors(seed)
    expected, found = brute_force(rows), by_id(lattice.near_vectors(frame_of(session, rows)))
    assert found.keys() == expected.keys()
    assert all(found[k][0] <= expected[k][0] for k in found)  # none below the threshold
    links = sum(v[0] for v in expected.values())
    assert links > 400 and sum(v[0] for v in found.values()) >= 0.97 * links


def test_each_pair_counts_once_in_split_buckets(session, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.normal(size=8)
    rows = [(k, (base + rng.normal(size=8) * 0.02).tolist(), 1) for k in range(150)]
    monkeypatch.setattr(lattice, "BLOCK", 16)
    found = by_id(lattice.near_vectors(frame_of(session, rows, "double")))
    assert found == brute_force(rows)


def test_odd_rows(session):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1),
        (2, [2.0, 0.0], 1),
        (3, [1.0, 0.0], 2),
        (4, [1.0, 0.0], None),
        (5, None, 1),
        (6, [], 1),
        (7, [0.0, 0.0], 1),
        (8, [1.0, nan], 1),
        (9, [1.0, inf], 1),
        (10, [1.0, None], 1),
        (11, [1.0, 0.0, 0.0], 1),
        (12, [1.0, 0.0], 1),
        (12, [1.0, 0.0], 1),
    ]
    found = lattice.near_vectors(frame_of(session, [*rows, (None, [1.0, 0.0], 1)])).collect()
    assert len(found) == 14
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found}
    assert got.pop(None) == (0, None, None)
    assert got == brute_force(rows)
    assert got[12] == (2, 1, False) and got[11] == (0, 11, True)


def test_no_rows(session):
    assert lattice.near_vectors(frame_of(session, [])).count() == 0


def test_decoding_gives_the_nearest_point():
    rng = np.random.default_rng(1)
    points = lattice.nearest_point(rng.normal(size=(300, 8)) * 2)
    whole = points == np.rint(points)
    assert (whole.all(axis=1) | ~whole.any(axis=1)).all()
    assert (points.sum(axis=1) % 2 == 0).all()
    x = rng.normal(size=(300, 8)) * 2
    best = lattice.nearest_point(x)
    own = ((x - best) ** 2).sum(axis=1)
    for step in lattice.neighbours():
        assert (((x - best - step) ** 2).sum(axis=1) >= own - 1e-9).all()
    assert len(np.unique(lattice.neighbours(), axis=0)) == 240


def test_query_matches_brute_force(session):
    rows = [tuple(r) for r in session.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    random.Random(1).shuffle(rows)
    assert by_id(QUERIES["op6_embedding_near_dedup"](session, FOLDER)) == brute_force(rows)
