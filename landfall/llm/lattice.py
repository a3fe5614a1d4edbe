"""Embedding near-duplicates by lattice hashing, verified by cosine.

Each table projects unit vectors to eight dimensions and decodes them to the
nearest point of the E8 lattice. A vector lies in the bucket of its own cell and
visits those of the nearest neighbouring cells; vectors that meet are compared
exactly. All vectors are indexed; what hashing can miss is a pair that meets in
no table. Two vectors at the threshold meet in one table with a chance of about
0.75, so five tables find over 0.99 of such pairs, and more of closer ones.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import (
    arrow_map,
    components,
    group_bounds,
    split_groups,
    stars,
    whole_groups,
)
from landfall.session import materialize

THRESHOLD = 0.93
TABLES = 5
PROBES = 4
SCALE = 0.55
SEED = 8
# Rows of a bucket that are compared with others in one piece.
BLOCK = 1024


@functools.cache
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8, from one cell's centre to the next ones'."""
    whole = [
        [sign[(i, j).index(k)] if k in (i, j) else 0.0 for k in range(8)]
        for i, j in itertools.combinations(range(8), 2)
        for sign in itertools.product((1.0, -1.0), repeat=2)
    ]
    half = [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array([*whole, *half])


def nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest points of whole numbers with an even sum."""
    point = np.rint(x)
    miss = x - point
    odd = np.flatnonzero(point.sum(axis=1) % 2)
    worst = np.abs(miss[odd]).argmax(axis=1)
    point[odd, worst] += np.where(miss[odd, worst] >= 0, 1.0, -1.0)
    return point


def nearest_point(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8: those above, or the same moved by a half."""
    a, b = nearest_even(x), nearest_even(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


@functools.cache
def projections(dimension: int, tables: int, seed: int = SEED) -> np.ndarray:
    """Random projections to eight dimensions that keep lengths on average."""
    random = np.random.default_rng([seed, dimension])
    out = random.normal(size=(tables, 8, dimension)) / np.sqrt(8)
    for t in range(tables):
        if dimension >= 8:
            out[t] = np.linalg.qr(out[t].T)[0].T * np.sqrt(dimension / 8)
    return out


def cell_codes(
    unit: np.ndarray, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE
) -> np.ndarray:
    """32-bit codes, vector x table x (own cell, then the visited ones).

    Cells with the same code share a bucket.
    """
    codes = np.empty((len(unit), tables, 1 + probes), np.int32)
    for t, matrix in enumerate(projections(unit.shape[1], tables)):
        x = unit @ matrix.T / scale
        own = nearest_point(x)
        # Distances to the neighbouring centres, but for what they share.
        far = -2 * (x - own) @ neighbours().T
        near = np.argsort(far, axis=1, kind="stable")[:, :probes]
        cells = np.concatenate([own[:, None], own[:, None] + neighbours()[near]], axis=1)
        codes[:, t] = _mix(np.rint(2 * cells).astype(np.int64))
    return codes


def _mix(points: np.ndarray) -> np.ndarray:
    """A hash of the last axis."""
    h = np.zeros(points.shape[:-1], np.uint64)
    for k in range(points.shape[-1]):
        h = (h ^ points[..., k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


# ---------------------------------------------------------------- the index


def index_rows(classes: DataFrame, tables: int, probes: int, scale: float) -> DataFrame:
    """(key, rep, n, vector, codes, visits): each vector in all its buckets."""
    width = tables * (1 + probes)

    def run(batch: pa.RecordBatch):
        lengths = np.array([len(v) for v in batch.column("embedding").to_pylist()])
        for size in np.unique(lengths):
            rows = np.flatnonzero(lengths == size)
            some = batch.take(pa.array(rows))
            vectors = some.column("embedding").flatten().to_numpy().reshape(-1, size)
            unit = vectors / np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)
            codes = cell_codes(unit.astype(np.float64), tables, probes, scale)
            blob = [v.tobytes() for v in vectors]
            code_blob = [c.tobytes() for c in codes.reshape(-1, width)]
            # A code that comes twice in a table counts once, as own if it is.
            for t in range(tables):
                for p in range(1 + probes):
                    new = ~(codes[:, t, :p] == codes[:, t, p : p + 1]).any(axis=1)
                    at = np.flatnonzero(new)
                    yield {
                        "label": some.column("label").take(pa.array(at)),
                        "cell": pa.array(codes[at, t, p]),
                        "t": pa.array(np.full(len(at), t, np.int32)),
                        "visits": pa.array(np.full(len(at), p > 0)),
                        "rep": some.column("rep").take(pa.array(at)),
                        "n": some.column("n").take(pa.array(at)),
                        "vector": pa.array([blob[k] for k in at], pa.binary()),
                        "codes": pa.array([code_blob[k] for k in at], pa.binary()),
                    }

    schema = "label long, cell int, t int, visits boolean, rep long, n long, vector binary, codes binary"
    rows = arrow_map(classes, run, schema)
    key = F.xxhash64("label", "t", "cell", F.length("vector"))
    return rows.select(key.alias("key"), "t", "label", "visits", "rep", "n", "vector", "codes")


def links_within(
    frame: pd.DataFrame, kind: np.dtype, tables: int, threshold: float
) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """(left, right, weights) of the near pairs of one bucket, each pair once
    over all buckets: in the first table in which its vectors meet."""
    vectors = np.frombuffer(b"".join(frame["vector"]), kind).reshape(len(frame), -1).astype(np.float64)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    codes = np.frombuffer(b"".join(frame["codes"]), np.int32).reshape(len(frame), tables, -1)
    rep, visits = frame["rep"].to_numpy(), frame["visits"].to_numpy()
    label = frame["label"].to_numpy()
    t = int(frame["t"].iloc[0])
    side = frame["side"].to_numpy()
    mixed = bool(frame["i"].iloc[0] != frame["j"].iloc[0])
    home = np.flatnonzero(~visits)
    lefts, rights = [], []
    for some in np.array_split(home, max(1, -(-len(home) // 256))):
        x, y = np.nonzero(unit[some] @ unit.T >= threshold)
        x = some[x]
        use = (rep[x] != rep[y]) & (label[x] == label[y])
        if mixed:
            use &= side[x] != side[y]
        use &= visits[y] | (rep[x] < rep[y])
        x, y = x[use], y[use]
        # Both may visit each other: the one of the smaller number is host.
        both = visits[y] & (codes[x, t, 1:] == codes[y, t, :1]).any(axis=1)
        use = ~(both & (rep[x] > rep[y]))
        for u in range(t):
            met = (codes[x, u] == codes[y, u, :1]).any(axis=1)
            met |= (codes[y, u] == codes[x, u, :1]).any(axis=1)
            use &= ~met
        lefts.append(x[use])
        rights.append(y[use])
    return lefts, rights, frame["n"].to_numpy()


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    probes: int = PROBES,
    scale: float = SCALE,
) -> DataFrame:
    """Every vector's links and component; columns vec_id, embedding and label.

    Only vectors of the same label link, at a cosine of ``threshold`` or more
    in double precision. Equal vectors of a label are one class that is compared
    once and counts for all its rows. Returns ``vec_id``, ``n_links``,
    ``component_id`` and ``kept``.

    A NULL label, and a vector that is NULL, empty, zero or holds NULL or
    non-finite numbers, links with nothing. So does a NULL id, whose component
    and ``kept`` are NULL. Rows that repeat an id and its vector are one vector
    to others, and each gets its row; an empty table gives none.
    """
    spark = vectors.sparkSession
    short = dict(vectors.dtypes)["embedding"] == "array<float>"
    kind = np.dtype(np.float32 if short else np.float64)
    rows = vectors.select(
        F.col("vec_id").cast("long"),
        F.col("embedding").cast("array<float>" if short else "array<double>"),
        F.col("label").cast("long"),
    )
    x = F.col("embedding")
    sound = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(x, lambda v: v != 0)
    )
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    distinct = rows.where("sound").select("vec_id", "label", "embedding").distinct()
    classes = distinct.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")
    )
    classes = materialize(spark, classes, "classes")

    placed = split_groups(index_rows(classes, tables, probes, scale), "key", "rep", BLOCK)

    def compare(frames):
        keys = ["key", "i", "j"]
        for frame in whole_groups(frames, keys):
            bounds = group_bounds(frame, keys)
            a, b, n, m = [], [], [], []
            for begin, end in itertools.pairwise(bounds.tolist()):
                if end - begin > 1:
                    group = frame.iloc[begin:end]
                    lefts, rights, weights = links_within(group, kind, tables, threshold)
                    rep = group["rep"].to_numpy()
                    left, right = np.concatenate(lefts), np.concatenate(rights)
                    a.append(rep[left])
                    b.append(rep[right])
                    n.append(weights[left])
                    m.append(weights[right])
            if a and sum(map(len, a)):
                left, right = np.concatenate(a), np.concatenate(b)
                ends, place = np.unique(np.concatenate([left, right]), return_inverse=True)
                gained = np.bincount(place, np.concatenate([np.concatenate(m), np.concatenate(n)]))
                yield pd.DataFrame({"a": ends, "b": -1, "n": gained.astype(np.int64)})
                left, right = stars(left, right)
                yield pd.DataFrame({"a": left, "b": right, "n": 0})

    columns = ("key", "i", "j", "side", "t", "label", "visits", "rep", "n", "vector", "codes")
    found = placed.select(*columns).mapInPandas(compare, "a long, b long, n long")
    found = materialize(spark, found, "found")
    degrees = found.where("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("near"))
    roots = components(found.where("n = 0").select("a", "b"), "vectors")
    roots = roots.withColumnRenamed("node", "rep")
    known = (
        classes.join(degrees, "rep", "left")
        .join(roots, "rep", "left")
        .select(
            "label",
            "embedding",
            (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("links"),
            F.coalesce("root", "rep").alias("root"),
        )
    )
    joined = rows.where("sound").join(known, ["label", "embedding"]).select("vec_id", "links", "root")
    alone = rows.where("not sound").select(
        "vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("root")
    )
    every = joined.unionByName(alone)
    return every.select(
        "vec_id",
        F.col("links").alias("n_links"),
        F.col("root").alias("component_id"),
        (F.col("vec_id") == F.col("root")).alias("kept"),
    )
