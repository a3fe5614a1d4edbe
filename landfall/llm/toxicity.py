"""Toxicity by a classifier chain of linear models.

The labels' categories are learned one after the other, low quality first. Each
later model also gets the probabilities of the categories before it, made out of
fold while training, so that it sees them as wrong as they will be on new texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import arrow_map, as_bytes
from landfall.session import materialize

# Labelled documents that a model is fitted on at most, those of smallest hash.
# More than these change it little; fitting is then the same at any size.
SAMPLE_ROWS = 20_000
# Features of a category: those that tell its classes apart best. A bound on the
# model, not on the rows; the README has what it costs.
FEATURES = 2048
LEAST_DOCS = 5
FOLDS = 3
CHAIN = ("low_quality", "toxic")
PREFIXES = (4, 5, 6)
CACHE_WORDS = 500_000

_WORD = re.compile(r"[^\W_]+")


def features_of(word: str) -> list[str]:
    """A word, and its beginnings: one stem has many endings."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


def distinct_features(text: bytes) -> set[str]:
    words = set(_WORD.findall(text.decode("utf-8", "replace").lower()))
    return {f for word in words for f in features_of(word)}


# ---------------------------------------------------------------- linear models


@dataclass
class Linear:
    """Logistic regression over present features and earlier probabilities."""

    features: dict[str, int]
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def margin(self, known: np.ndarray, before: np.ndarray) -> float:
        return float(self.weights[known].sum() + before @ self.earlier + self.bias)


def fit(
    rows: np.ndarray,
    columns: np.ndarray,
    before: np.ndarray,
    target: np.ndarray,
    width: int,
    l2: float = 1.0,
    steps: int = 300,
) -> np.ndarray:
    """Weights of features, earlier probabilities and bias, in this order.

    ``rows`` and ``columns`` name the present features. Accelerated gradient
    steps on the penalised mean log loss, sized by the curvature's bound.
    """
    n, extra = before.shape
    norm = np.ones(n) + (before**2).sum(axis=1) + np.bincount(rows, minlength=n)
    w = np.zeros(width + extra + 1)
    ahead, momentum = w.copy(), 1.0
    step = 1.0 / (0.25 * np.mean(norm) + l2 / n)
    for _ in range(steps):
        z = np.bincount(rows, ahead[columns], n) + before @ ahead[width:-1] + ahead[-1]
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        slope = np.concatenate(
            [np.bincount(columns, error[rows], width), before.T @ error, [error.sum()]]
        ) / n
        slope[:-1] += l2 / n * ahead[:-1]
        new = ahead - step * slope
        next_momentum = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / next_momentum * (new - w)
        w, momentum = new, next_momentum
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Chain:
    models: list[Linear]
    threshold: float

    def __post_init__(self):
        self._known: dict[str, list[tuple[int, ...]]] = {}

    def probabilities(self, text: bytes) -> list[float]:
        """One for each category, in the order of the chain."""
        words = set(_WORD.findall(text.decode("utf-8", "replace").lower()))
        found: list[set[int]] = [set() for _ in self.models]
        for word in words:
            known = self._known.get(word)
            if known is None:
                if len(self._known) >= CACHE_WORDS:
                    self._known.clear()
                own = features_of(word)
                known = [tuple(m.features[f] for f in own if f in m.features) for m in self.models]
                if not any(known):
                    known = ()
                self._known[word] = known
            for numbers, some in zip(found, known):
                numbers.update(some)
        before: list[float] = []
        for model, numbers in zip(self.models, found):
            z = model.margin(np.fromiter(numbers, np.int64, len(numbers)), np.array(before))
            before.append(float(sigmoid(np.array(z))))
        return before


# ---------------------------------------------------------------- training


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Labelled documents with their targets, at most ``rows`` of them.

    Labels of one document are put together, the worse value winning; rows with
    NULLs are no labels. The sample is of the smallest hashes of the id.
    """
    targets = (
        labels.where("doc_id is not null and quality is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(
            (F.min("quality") == 0).cast("int").alias("low_quality"),
            F.max("toxic").cast("int").alias("toxic"),
        )
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # At most ``rows`` rows of three numbers, so the join can broadcast them.
    return docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(targets), "doc_id")


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Chain:
    """Fit the chain on a bounded sample of the labelled documents.

    Spark counts in how many documents of each class a feature occurs and which
    documents have the chosen ones; the fit itself sees only those numbers, a
    size bounded by the sample. Without labels of both classes a category's
    probability is its share, and nothing is rejected if none is toxic.
    """

    def explode(batch: pa.RecordBatch):
        lists = [sorted(distinct_features(t)) for t in as_bytes(batch.column("text"))]
        counts = [len(x) for x in lists]
        again = np.repeat(np.arange(len(lists)), counts)
        yield {
            "feature": pa.array([f for x in lists for f in x], pa.string()),
            **{
                k: pa.array(batch.column(k).to_numpy(zero_copy_only=False)[again])
                for k in ("doc_id", *CHAIN)
            },
        }

    spark = docs.sparkSession
    sample = training_sample(docs, labels, rows)
    pairs = arrow_map(sample, explode, "feature string, doc_id long, low_quality int, toxic int")
    pairs = materialize(spark, pairs, "features")
    heads = sample.select("doc_id", *CHAIN).dropDuplicates(["doc_id"]).toArrow().to_pandas().sort_values("doc_id")
    n = len(heads)
    counts = pairs.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in CHAIN]
    )
    counts = materialize(spark, counts.where(F.col("n") >= LEAST_DOCS), "feature_counts")

    models: list[Linear] = []
    place = pd.Series(np.arange(n), index=heads["doc_id"].to_numpy())
    fold = np.arange(n) % FOLDS
    before = np.zeros((n, 0))
    for category in CHAIN:
        target = heads[category].to_numpy(float)
        chosen = _telling(counts, category, n, int(target.sum()))
        numbers = {f: k for k, f in enumerate(chosen)}
        wanted = spark.createDataFrame(list(numbers.items()), "feature string, number int")
        present = pairs.join(F.broadcast(wanted), "feature").select("doc_id", "number").distinct()
        present = present.toArrow()
        r = place.reindex(present["doc_id"].to_numpy()).to_numpy(np.int64)
        c = present["number"].to_numpy().astype(np.int64)
        width = len(numbers)
        if target.min(initial=1) == target.max(initial=0) or n == 0:
            share = np.clip(target.mean() if n else 0.0, 1e-6, 1 - 1e-6)
            w = np.zeros(width + before.shape[1] + 1)
            w[-1] = np.log(share / (1 - share))
            out = np.full(n, share)
        else:
            out = np.zeros(n)
            for k in range(FOLDS):
                inside = fold != k
                w = _fit_rows(r, c, before, target, width, inside)
                out[~inside] = _predict(r, c, before, w, width, n)[~inside]
            w = _fit_rows(r, c, before, target, width, np.ones(n, bool))
        models.append(Linear(numbers, w[:width], w[width:-1], float(w[-1])))
        before = np.column_stack([before, out])
    chain = Chain(models, best_threshold(before[:, -1], heads[CHAIN[-1]].to_numpy()))
    # A text that shows nothing is not rejected.
    chain.threshold = max(chain.threshold, float(np.nextafter(chain.probabilities(b"")[-1], 1)))
    return chain


def _telling(counts: DataFrame, category: str, n: int, positive: int) -> list[str]:
    """The features with the largest chi-square against a category."""
    a, total = F.col(category).cast("double"), F.col("n").cast("double")
    expected = total * positive / max(n, 1)
    spread = expected * (1 - positive / max(n, 1)) * (1 - total / max(n, 1)) + 1e-9
    score = (a - expected) ** 2 / spread
    rows = counts.select("feature", score.alias("score")).orderBy(F.desc("score"), "feature")
    return [row[0] for row in rows.limit(FEATURES).collect()]


def _fit_rows(r, c, before, target, width, inside) -> np.ndarray:
    number = np.cumsum(inside) - 1
    some = inside[r]
    return fit(number[r[some]], c[some], before[inside], target[inside], width)


def _predict(r, c, before, w, width, n) -> np.ndarray:
    return sigmoid(np.bincount(r, w[c], n) + before @ w[width:-1] + w[-1])


def best_threshold(scores: np.ndarray, target: np.ndarray) -> float:
    """Where the out-of-fold F measure is best, midway between the scores beside it.

    Precision weighs four times as much as recall: labels hold errors, and clean
    documents should stay.
    """
    if not target.any():
        return float("inf")
    order = np.argsort(-scores, kind="stable")
    s, hits = scores[order], np.cumsum(target[order])
    measure = 1.25 * hits / (np.arange(1, len(s) + 1) + 0.25 * target.sum())
    measure[:-1][s[:-1] == s[1:]] = -1
    at = int(np.argmax(measure))
    below = s[at + 1] if at + 1 < len(s) else 0.0
    return float((s[at] + below) / 2)


# ---------------------------------------------------------------- scoring


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, p_low_quality, p_toxic, toxic) of every row; NULL text is empty."""

    def run(batch: pa.RecordBatch):
        values = [chain.probabilities(t) for t in as_bytes(batch.column("text"))]
        table = np.array(values).reshape(-1, len(CHAIN))
        yield {
            "doc_id": batch.column("doc_id"),
            **{f"p_{c}": pa.array(table[:, k]) for k, c in enumerate(CHAIN)},
            "toxic": pa.array(table[:, -1] >= chain.threshold),
        }

    schema = "doc_id long, " + ", ".join(f"p_{c} double" for c in CHAIN) + ", toxic boolean"
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def keep_clean(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows that are not toxic, with all their columns and no shuffle."""

    @F.pandas_udf("boolean")
    def toxic(texts: pd.Series) -> pd.Series:
        column = pa.array(texts, pa.string())
        return pd.Series([chain.probabilities(t)[-1] >= chain.threshold for t in as_bytes(column)])

    return docs.where(~toxic(F.col("text")))
