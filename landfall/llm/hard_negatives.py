"""Hard negatives of anchor vectors, by threshold joins over inverted indexes.

Vectors become whole numbers. Every search is one question: of the rows of the
anchor's label (positives) or of any other (negatives), which are the first k by
inner product within a window of scores? It is answered by a threshold join in
rounds. A round looks for pairs that reach a threshold; windows that hold k of
them are full, as no other row can come before those, and the rest goes on to
the next round with a lower threshold.

Rows and anchors meet in blocks: each block of anchors, a stated query set,
meets each block of rows in a task of its own. There the rows are indexed by
dimension, those with most weight first. A row stands in the lists of a
dimension only as far as what follows can matter: dimensions from the place on
where the norm of the row's rest, times the anchor's norm, is below the
threshold are omitted. Scores add up list by list, pairs whose partial score and
remaining norms cannot reach the threshold go, and what is left is computed
exactly.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.session import materialize

ANCHOR_EVERY = 50
SCALE = 256
POSITIVES = 5
NEGATIVES = 3
# Per cent of the positive's score that a negative's may be.
LOWEST, HIGHEST = 50, 95
# Thresholds of the rounds, as shares of the anchor's squared norm and of the
# positive's score; a last round has the window's own lower end.
POSITIVE_ROUNDS = (0.8, 0.4, 0.2)
NEGATIVE_ROUNDS = (0.8, 0.65)

# Components of one block of rows, and partial scores held at once.
BLOCK_VALUES = 1 << 20
BLOCK_ANCHORS = 1 << 15
CELLS = 1 << 22
# Tasks of one round; beyond, tasks get several blocks, one after the other.
MOST_TASKS = 100_000
# Dimensions whose lists are added up between two rounds of pruning.
STEP = 8
# Squared norms must stay below, so that a hundred times a score is a long.
NORM_LIMIT = 2.0**55
TOP = 1 << 62

HITS = "anchor long, w long, score long, vec_id long"


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """Rows that take part: ``vec_id``, ``label``, and the vector in whole numbers."""
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    )
    return vectors.where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("vector"),
    )


# ---------------------------------------------------------------- one block


class SuffixIndex:
    """Rows of a block, listed by dimension as far as a threshold asks for."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.argsort(-np.square(vectors).sum(axis=0), kind="stable")
        self.rows = vectors[:, self.order]
        self.cuts = [*range(0, vectors.shape[1], STEP), vectors.shape[1]]
        self.rests = self._rests(self.rows)

    def _rests(self, vectors: np.ndarray) -> np.ndarray:
        """The norm of each vector from each cut on."""
        squares = np.square(vectors)
        parts = [squares[:, a:b].sum(axis=1) for a, b in zip(self.cuts[:-1], self.cuts[1:])]
        sums = np.cumsum(np.array([np.zeros(len(vectors)), *parts[::-1]]), axis=0)[::-1]
        return np.sqrt(sums.T)

    def reaching(self, anchors: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (anchor, row) with scores of at least ``low`` of the anchor, by anchor."""
        anchors = anchors[:, self.order]
        rests = self._rests(anchors)
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(rests[:, 0] > 0, low / rests[:, 0], np.where(low > 0, np.inf, -np.inf)).min()
        # Lists of a row: those up to its depth; beyond, its rest is too short.
        depth = (self.rests[:, :-1] * (1 + 1e-9) >= least).sum(axis=1)
        live = np.argsort(-depth, kind="stable")
        live = live[: np.count_nonzero(depth)]
        partial = np.zeros((len(anchors), len(live)))
        floor = low[:, None] - 1
        possible = None
        for g, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:])):
            listed = int(np.searchsorted(-depth[live], -g, side="left"))
            if not listed:
                break
            partial[:, :listed] += anchors[:, a:b] @ self.rows[live[:listed], a:b].T
            done = np.minimum(g + 1, depth[live])
            possible = partial + (1 + 1e-9) * rests[:, done] * self.rests[live, done] >= floor
            kept = possible.any(axis=0)
            if np.count_nonzero(kept) < 0.8 * len(live):
                live, partial, possible = live[kept], partial[:, kept], possible[:, kept]
            if not len(live) or np.count_nonzero(possible) < 0.05 * possible.size:
                break
        if possible is None or not len(live):
            none = np.empty(0, np.int64)
            return none, none, none
        return self._exact(anchors, live, possible, low)

    def _exact(self, anchors, live, possible, low):
        rows = self.rows
        if not _whole_in_floats(self.rests, anchors):
            anchors, rows = anchors.astype(np.int64), rows.astype(np.int64)
        i, j = np.nonzero(possible)
        if len(i) * 8 > possible.size:
            scores = (anchors @ rows[live].T)[i, j].astype(np.int64)
        else:
            scores = np.empty(len(i), np.int64)
            for at in range(0, len(i), 1 << 15):
                part = slice(at, at + (1 << 15))
                scores[part] = np.einsum("nd,nd->n", anchors[i[part]], rows[live[j[part]]])
        kept = scores >= low[i]
        return i[kept], live[j[kept]], scores[kept]


def _whole_in_floats(rests: np.ndarray, anchors: np.ndarray) -> bool:
    """Whether every sum of products is exact in double precision."""
    longest = np.square(anchors).sum(axis=1).max(initial=0)
    return rests[:, 0].max(initial=0) * longest**0.5 < 2.0**52


def _matrix(vectors: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors as rows; one that is shorter than others goes on with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy().astype(np.float64)
    out = np.zeros((len(lengths), dims))
    row = np.repeat(np.arange(len(lengths)), lengths)
    begins = np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, np.arange(len(flat)) - begins] = flat
    if np.square(out).sum(axis=1).max(initial=0) >= NORM_LIMIT:
        raise ValueError("a vector too long for scores in whole numbers")
    return out


class Block:
    """The rows of one block; answers the windows of anchors that come by."""

    def __init__(self, rows: pa.Table, dims: int, k: int, same_label: bool):
        self.ids = rows["vec_id"].to_numpy()
        self.labels = rows["label"].to_numpy()
        self.index = SuffixIndex(_matrix(rows["vector"], dims))
        self.dims, self.k, self.same_label = dims, k, same_label

    def answer(self, anchors: pa.Table) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS // max(1, len(self.ids)))
        for first in range(0, anchors.num_rows, step):
            yield self._answer(anchors.slice(first, step))

    def _answer(self, anchors: pa.Table) -> pa.RecordBatch:
        windows = anchors["windows"].to_pylist()
        low = np.array([min(w["low"] for w in some) for some in windows], np.float64)
        i, j, scores = self.index.reaching(_matrix(anchors["vector"], self.dims), low)
        ids, labels = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
        right = (self.labels[j] == labels[i]) == self.same_label
        if self.same_label:
            right &= self.ids[j] != ids[i]
        i, j, scores = i[right], j[right], scores[right]
        bounds = np.searchsorted(i, np.arange(len(windows) + 1))
        numbers = anchors["anchor"].to_pylist()
        out = {"anchor": [], "w": [], "score": [], "vec_id": []}
        for n, asked in enumerate(windows):
            part = slice(bounds[n], bounds[n + 1])
            found, value = self.ids[j[part]], scores[part]
            order = np.lexsort((found, -value))
            found, value = found[order], value[order]
            for window in asked:
                a = int(np.searchsorted(-value, -window["high"], side="left"))
                b = int(np.searchsorted(-value, -window["low"], side="right"))
                taken = slice(a, min(b, a + self.k))
                size = max(0, taken.stop - a)
                out["anchor"] += [numbers[n]] * size
                out["w"] += [window["w"]] * size
                out["score"] += value[taken].tolist()
                out["vec_id"] += found[taken].tolist()
        return pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in out.items()})


def _search_blocks(
    batches: Iterator[pa.RecordBatch], dims: int, k: int, same_label: bool
) -> Iterator[pa.RecordBatch]:
    """Blocks one after the other, the rows of each before its anchors."""
    key, held, block = None, [], None
    for batch in batches:
        keys = np.array([batch[c].to_numpy(zero_copy_only=False) for c in ("part", "i", "j", "kind")])
        changes = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        cuts = [0, *changes.tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            now = tuple(keys[:3, a].tolist())
            if now != key:
                key, held, block = now, [], None
            some = batch.slice(a, b - a)
            if keys[3, a] == 0:
                held.append(some)
                continue
            if block is None and held:
                block, held = Block(pa.Table.from_batches(held), dims, k, same_label), []
            if block is not None:
                yield from block.answer(pa.Table.from_batches([some]))


# ---------------------------------------------------------------- rounds


def _sizes(rows: DataFrame, anchors: DataFrame, dims: int) -> DataFrame:
    """How many blocks each part's rows and anchors are cut into."""
    block_rows = max(1, BLOCK_VALUES // max(1, dims))
    both = rows.select("part", F.lit(1).alias("r"), F.lit(0).alias("a")).unionByName(
        anchors.select("part", F.lit(0).alias("r"), F.lit(1).alias("a"))
    )
    sums = both.groupBy("part").agg(F.sum("r").alias("r"), F.sum("a").alias("a"))
    return sums.where("r > 0 and a > 0").select(
        "part",
        F.ceil(F.col("r") / F.lit(block_rows)).cast("int").alias("n_i"),
        F.ceil(F.col("a") / F.lit(BLOCK_ANCHORS)).cast("int").alias("n_j"),
    )


def _upto(n: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def _search(
    rows: DataFrame, anchors: DataFrame, asks: DataFrame, dims: int, k: int, same_label: bool
) -> DataFrame:
    """The first k rows of each window within each block of rows."""
    part = F.col("label") if same_label else F.lit(0).cast("long")
    windows = asks.groupBy("anchor").agg(F.collect_list(F.struct("w", "low", "high")).alias("windows"))
    asking = anchors.join(windows, "anchor").withColumn("part", part)
    stored = rows.withColumn("part", part)
    sizes = _sizes(stored, asking, dims)
    # Blocks are small in bytes and large in work, so none should share a task
    # while others idle: as many partitions as there are blocks, within bounds.
    blocks = sizes.agg(F.sum(F.col("n_i").cast("long") * F.col("n_j"))).first()[0] or 1
    if same_label:
        stored, asking = stored.join(sizes, "part"), asking.join(sizes, "part")
    else:  # all rows are one part
        numbers = sizes.first() or {"n_i": 1, "n_j": 1}
        numbers = {n: F.lit(numbers[n]).cast("int") for n in ("n_i", "n_j")}
        stored, asking = stored.withColumns(numbers), asking.withColumns(numbers)
    none = F.lit(None)
    left = stored.select(
        "part",
        F.pmod(F.xxhash64("row"), F.col("n_i")).cast("int").alias("i"),
        _upto("n_j").alias("j"),
        F.lit(0).alias("kind"),
        none.cast("long").alias("anchor"),
        "vec_id",
        "label",
        "vector",
        none.cast("array<struct<w:bigint,low:bigint,high:bigint>>").alias("windows"),
    )
    right = asking.select(
        "part",
        _upto("n_i").alias("i"),
        F.pmod(F.xxhash64("anchor"), F.col("n_j")).cast("int").alias("j"),
        F.lit(1).alias("kind"),
        "anchor",
        "vec_id",
        "label",
        "vector",
        "windows",
    )
    placed = left.unionByName(right).repartition(min(blocks, MOST_TASKS), "part", "i", "j")
    placed = placed.sortWithinPartitions("part", "i", "j", "kind")
    run = functools.partial(_search_blocks, dims=dims, k=k, same_label=same_label)
    return placed.mapInArrow(run, HITS)


def first_in_windows(
    rows: DataFrame,
    anchors: DataFrame,
    asks: DataFrame,
    dims: int,
    k: int,
    same_label: bool,
    rounds: Sequence[float],
) -> DataFrame:
    """The first k rows in each window: ``anchor``, ``w``, ``score``, ``vec_id``, ``rank``.

    ``asks`` has a window a row: ``anchor``, ``w``, its ends ``low`` and
    ``high``, and ``base``, of which ``rounds`` are shares. Thresholds go down
    round by round to ``low``. A window with k hits at or above the threshold is
    full.
    """
    spark = rows.sparkSession
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "vec_id")
    found: list[DataFrame] = []
    for share in [*rounds, None]:
        asked = asks
        if share is not None:
            threshold = F.ceil(F.col("base") * F.lit(share)).cast("long")
            asked = asks.withColumn("low", F.least("high", F.greatest("low", threshold)))
        hits = _search(rows, anchors, asked, dims, k, same_label)
        best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = materialize(spark, best, "hard-hits")
        if share is None:
            found.append(best)
            break
        full = best.where(F.col("rank") == k).select("anchor", "w")
        found.append(best.join(full, ["anchor", "w"], "left_semi"))
        asks = materialize(spark, asks.join(full, ["anchor", "w"], "left_anti"), "hard-asks")
        if asks.isEmpty():
            break
    return functools.reduce(DataFrame.unionByName, found)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """Hard negatives of each anchor and positive, from ``vec_id``, ``label``, ``vector``.

    A row for each negative: ``anchor_id``, ``positive_id``, ``rank``,
    ``negative_id``, ``positive_score``, ``negative_score``. Higher scores come
    first, ties by smaller ``vec_id``. Positives are the first rows of the
    anchor's label with another ``vec_id``; negatives are the first rows of
    other labels whose score is ``lowest`` to ``highest`` per cent of the
    positive's, so a positive below zero has none. Every row counts for itself,
    repeated ones too; anchors that repeat in all columns count once. Vectors of
    differing length go on with zeros. A vector whose squared norm is 2**55 or
    more stops the job. Empty tables give no rows; other columns are left out.
    """
    spark = rows.sparkSession
    rows = rows.select("vec_id", "label", "vector", is_anchor.alias("is_anchor"))
    rows = materialize(spark, rows.withColumn("row", F.monotonically_increasing_id()), "hard-rows")
    anchors = rows.where("is_anchor").select("vec_id", "label", "vector").distinct()
    anchors = materialize(
        spark, anchors.withColumn("anchor", F.monotonically_increasing_id()), "hard-anchors"
    )
    rows = rows.drop("is_anchor")
    dims = max(1, rows.agg(F.max(F.size("vector"))).first()[0] or 0)

    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    asks = anchors.select(
        "anchor",
        F.lit(0).cast("long").alias("w"),
        F.lit(-TOP).alias("low"),
        F.lit(TOP).alias("high"),
        norm.alias("base"),
    )
    near = first_in_windows(rows, anchors, asks, dims, positives, True, POSITIVE_ROUNDS)
    near = near.select(
        "anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    near = materialize(spark, near, "hard-positives")

    score = F.col("positive_score")
    windows = near.where(score >= 0).select(
        "anchor",
        score.alias("w"),
        F.ceil(lowest * score / F.lit(100).cast("decimal(3,0)")).cast("long").alias("low"),
        F.floor(highest * score / F.lit(100).cast("decimal(3,0)")).cast("long").alias("high"),
        score.cast("double").alias("base"),
    )
    asks = materialize(spark, windows.where("low <= high").distinct(), "hard-asks")
    far = first_in_windows(rows, anchors, asks, dims, negatives, False, NEGATIVE_ROUNDS)
    far = far.select(
        "anchor",
        F.col("w").alias("positive_score"),
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    names = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    mined = near.join(far, ["anchor", "positive_score"]).join(names, "anchor")
    return mined.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """``mine`` over ``vec_id``, ``label``, ``embedding``, as the query has it.

    Rows with a NULL ``vec_id``, label or vector, or with a component that is
    NULL or not finite, take no part. Where ``vec_id`` is divisible by 7 the
    label is noisy: it becomes the next of ten. Anchors are the rows whose
    ``vec_id`` is divisible by ``ANCHOR_EVERY``.
    """
    rows = whole_vectors(vectors)
    noisy = F.pmod(F.col("label") + 1, F.lit(10))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, noisy).otherwise(F.col("label")))
    return mine(rows, F.col("vec_id") % ANCHOR_EVERY == 0)


