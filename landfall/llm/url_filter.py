"""URL filters: rules, and beyond them two character language models."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import as_bytes
from landfall.llm.packed import groups
from landfall.session import materialize

# Characters of context at most; windows of one more fit a 64-bit code up to six.
ORDER = 5
# One in HELD_OUT of the judged URLs calibrates the threshold instead.
HELD_OUT = 5
ALPHABET = 256
# Bytes of URLs whose windows are counted, and looked up, together.
CHUNK_BYTES = 1 << 19
# Log-likelihoods add up as whole numbers of this size: exactly, in any order.
UNIT = 2.0**-32
# A code's upper byte has the window's length, the others its characters.
_LENGTH = 56

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """Allows or blocks a host with its subdomains, below a path."""

    text: str  # such as net/es/
    allow: bool

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


RULES = (
    Rule("com/", True),
    Rule("example.com/en/", False),
    Rule("www.example.com/en/", True),
    Rule("net/es/", False),
    Rule("net/fr/", False),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` to the next of ``/?#``, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host to the next of ``?#``; empty without a host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The text of the longest rule that fits, else NULL."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = (host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))
        found = F.when(fits & F.startswith(path, F.lit(rule.path)), rule.text).otherwise(found)
    return found


def allowed(rule: Column, rules: Sequence[Rule] = RULES) -> Column:
    verdict = F.lit(None).cast("boolean")
    for r in rules:
        verdict = F.when(rule == r.text, r.allow).otherwise(verdict)
    return verdict


# ---------------------------------------------------------------- the models


@dataclass
class Markov:
    """Variable-order model: each context's counts, smoothed by the next shorter.

    After a context with ``total`` characters of ``kinds`` kinds, the shorter
    context's estimate weighs as much as ``kinds`` more characters (Witten and
    Bell). Contexts never seen are skipped, so the order varies.
    """

    counts: dict[bytes, int]
    order: int = ORDER
    after: dict[bytes, tuple[int, int]] = field(init=False)

    def __post_init__(self):
        sums: dict[bytes, list[int]] = {}
        for gram, n in self.counts.items():
            entry = sums.setdefault(gram[:-1], [0, 0])
            entry[0] += n
            entry[1] += 1
        self.after = {context: (total, kinds) for context, (total, kinds) in sums.items()}

    def log_likelihood(self, text: bytes) -> float:
        total = 0.0
        for at in range(len(text)):
            p = 1 / ALPHABET
            for size in range(min(self.order, at) + 1):
                seen = self.after.get(text[at - size : at])
                if seen is None:
                    break
                n = self.counts.get(text[at - size : at + 1], 0)
                p = (n + seen[1] * p) / (seen[0] + seen[1])
            total += math.log(p)
        return total


def grams_of(text: bytes, order: int = ORDER):
    for at in range(len(text)):
        for size in range(min(order, at) + 1):
            yield text[at - size : at + 1]


def windows_of(urls: Sequence[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Each character with up to ``order`` before it, as a code; and where each URL begins.

    A character's likelihood depends on its window alone.
    """
    sizes = np.array([len(u) for u in urls], np.int64)
    starts = np.append(0, np.cumsum(sizes))
    data = np.array(bytearray(b"".join(urls)), np.int64)
    at = np.arange(len(data)) - np.repeat(starts[:-1], sizes)
    codes = np.minimum(at, order) + 1 << _LENGTH
    for back in range(order + 1):
        inside = np.flatnonzero(at >= back)
        codes[inside] |= data[inside - back] << 8 * back
    return codes, starts


def _length(code: Column) -> Column:
    return F.shiftright(code, _LENGTH)


def _last(code: Column, size: int) -> Column:
    """The code of a window's last ``size`` characters."""
    return code.bitwiseAND(F.lit((1 << 8 * size) - 1)).bitwiseOR(F.lit(size << _LENGTH))


def _context(code: Column) -> Column:
    """The code of a window without its last character."""
    characters = F.shiftright(code.bitwiseAND(F.lit((1 << _LENGTH) - 1)), 8)
    return characters.bitwiseOR(F.shiftleft(_length(code) - 1, _LENGTH))


def _chunks(urls: DataFrame) -> DataFrame:
    """The URLs with the number of a ``chunk`` of about CHUNK_BYTES that they are in."""

    def run(batches):
        chunk, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            numbers = []
            for url in as_bytes(batch["url"]):
                if size >= CHUNK_BYTES:
                    chunk, size = chunk + 1, 0
                numbers.append(chunk)
                size += len(url)
            columns = {n: batch[n] for n in batch.schema.names}
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(numbers, pa.int64()), **columns})

    return urls.mapInArrow(run, "chunk long, url string, accepted boolean, rejected boolean, held boolean")


def _chunk_windows(urls: DataFrame, order: int) -> DataFrame:
    """(chunk, code, accepted, rejected): each window of a chunk, and in how many
    places of URLs that are learnt from, by verdict; none of them held out."""

    def run(batches):
        for (chunk,), pieces in groups(batches, ("chunk",)):
            rows = pa.Table.from_batches(pieces)
            codes, starts = windows_of(as_bytes(rows["url"]), order)
            kinds, place = np.unique(codes, return_inverse=True)
            made = {"chunk": np.full(len(kinds), chunk), "code": kinds}
            learnt = ~rows["held"].to_numpy()
            for side in ("accepted", "rejected"):
                weight = np.repeat(rows[side].to_numpy() & learnt, np.diff(starts))
                made[side] = np.bincount(place[weight], minlength=len(kinds))
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in made.items()})

    return urls.mapInArrow(run, "chunk long, code long, accepted long, rejected long")


def _gram_counts(windows: DataFrame, order: int) -> DataFrame:
    """(code, accepted, rejected) of all windows and of all that they end with, and
    for each side what follows the characters before the last: places and kinds."""
    code = F.col("code")
    endings = [F.when(_length(code) >= k, _last(code, k)) for k in range(1, order + 2)]
    sides = ("accepted", "rejected")
    whole = windows.groupBy("code").agg(*[F.sum(s).alias(s) for s in sides])
    grams = whole.select(F.explode(F.array_compact(F.array(*endings))).alias("code"), *sides)
    grams = grams.groupBy("code").agg(*[F.sum(s).alias(s) for s in sides])
    grams = materialize(windows.sparkSession, grams.withColumn("context", _context(code)), "grams")
    after = grams.groupBy("context").agg(
        *[F.sum(s).alias(f"{s}_total") for s in sides],
        *[F.count_if(F.col(s) > 0).alias(f"{s}_kinds") for s in sides],
    )
    return materialize(windows.sparkSession, grams.join(after, "context").drop("context"), "counts")


def _differences(counts: DataFrame, order: int) -> DataFrame:
    """(code, difference): log-likelihood of the last character, accepted less rejected.

    Shorter windows first, as each weighs in for those that end with it.
    """
    sides = ("accepted", "rejected")
    levels, shorter = [], None
    for size in range(1, order + 2):
        level = counts.where(_length(F.col("code")) == size)
        if shorter is None:
            before = {s: F.lit(1 / ALPHABET) for s in sides}
        else:
            ends = shorter.select(F.col("code").alias("ending"), *[F.col(s).alias(f"{s}_before") for s in sides])
            level = level.withColumn("ending", _last(F.col("code"), size - 1)).join(ends, "ending")
            before = {s: F.col(f"{s}_before") for s in sides}
        smoothed = []
        for s in sides:
            total, kinds = F.col(f"{s}_total"), F.col(f"{s}_kinds")
            p = (F.col(s) + kinds * before[s]) / (total + kinds)
            smoothed.append(F.when(total > 0, p).otherwise(before[s]).alias(s))
        shorter = materialize(counts.sparkSession, level.select("code", *smoothed), f"likelihoods-{size}")
        levels.append(shorter)
    every = functools.reduce(DataFrame.unionByName, levels)
    difference = (F.log("accepted") - F.log("rejected")) / UNIT
    return every.select("code", F.round(difference).cast("long").alias("difference"))


def _scores(urls: DataFrame, windows: DataFrame, differences: DataFrame, order: int) -> DataFrame:
    """The URLs with their score, chunk by chunk."""
    found = windows.select("chunk", "code").join(differences, "code").select("chunk", "code", "difference")

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        texts = as_bytes(rows["url"])
        codes, starts = windows_of(texts, order)
        kinds, values = known["code"].to_numpy(), known["difference"].to_numpy()
        ascending = np.argsort(kinds)
        each = values[ascending][np.searchsorted(kinds[ascending], codes)] if len(codes) else codes
        sums = np.diff(np.append(0, np.cumsum(each))[starts])
        score = sums * UNIT / np.maximum(1, np.diff(starts))
        return rows.drop_columns("chunk").append_column("score", pa.array(score, pa.float64()))

    schema = "url string, accepted boolean, rejected boolean, held boolean, score double"
    return urls.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(run, schema)


@dataclass
class UrlModel:
    """Both models as counts on Spark, and the scores of all URLs that were given."""

    counts: DataFrame
    scores: DataFrame
    threshold: float
    order: int = ORDER

    @functools.cached_property
    def sides(self) -> tuple[Markov, Markov]:
        """The accepted and the rejected URLs' model, collected."""
        rows = self.counts.select("code", "accepted", "rejected").collect()
        grams = [(r["code"] & (1 << _LENGTH) - 1).to_bytes(r["code"] >> _LENGTH, "big") for r in rows]
        return tuple(
            Markov({g: r[side] for g, r in zip(grams, rows) if r[side]}, self.order)
            for side in ("accepted", "rejected")
        )

    def score(self, url: bytes) -> float:
        """Log-likelihood difference for each character; 0 without any.

        For a look at single URLs, with models that the driver can hold; what
        was fitted on has its ``scores`` already.
        """
        if not url:
            return 0.0
        accepted, rejected = self.sides
        return (accepted.log_likelihood(url) - rejected.log_likelihood(url)) / len(url)


def fit(judged: DataFrame, order: int = ORDER) -> UrlModel:
    """Fit both models on all URLs with a verdict, columns ``url`` and ``allow``.

    Each distinct URL counts once, and those without a verdict are scored only.
    Character runs are counted, smoothed and looked up on Spark, so nothing has a
    size that a task or the driver must hold. The held-out URLs set the threshold
    at which as few of them as possible are misjudged, each verdict counting
    alike. With one verdict only there is nothing to tell apart, and the
    threshold lets everything pass.
    """
    if not 0 <= order <= 6:
        raise ValueError(f"at most six characters of context, not {order}")
    spark = judged.sparkSession
    allow = F.coalesce("allow", F.lit(False)), F.coalesce(~F.col("allow"), F.lit(False))
    urls = judged.where("url is not null").groupBy("url").agg(
        *[F.max(a).alias(s) for a, s in zip(allow, ("accepted", "rejected"))]
    )
    urls = urls.withColumn("held", F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0)
    urls = materialize(spark, _chunks(urls), "urls")
    windows = materialize(spark, _chunk_windows(urls, order), "windows")
    counts = _gram_counts(windows, order)
    scores = materialize(spark, _scores(urls, windows, _differences(counts, order), order), "scores")
    learnt = counts.agg(F.max("accepted"), F.max("rejected")).first()
    threshold = threshold_of(scores.where("held")) if learnt[0] and learnt[1] else -math.inf
    return UrlModel(counts, scores.select("url", "score"), threshold, order)


def threshold_of(checks: DataFrame) -> float:
    """``calibrate`` on Spark: of ``score``, ``accepted``, ``rejected``, equal scores together.

    Scores are sorted in ranges, and each range begins with the sums of those below.
    """
    spark = checks.sparkSession
    sides = ("accepted", "rejected")
    rows = checks.groupBy("score").agg(*[F.count_if(s).alias(s) for s in sides])
    rows = rows.where("accepted + rejected > 0").repartitionByRange("score")
    rows = materialize(spark, rows.withColumn("range", F.spark_partition_id()), "checks")
    ranges = rows.groupBy("range").agg(F.min("score").alias("low"), *[F.sum(s).alias(s) for s in sides])
    below, sums = [], [0, 0]
    for r in sorted(ranges.collect(), key=lambda r: r["low"]):
        below.append((r["range"], *sums))
        sums = [sums[0] + r["accepted"], sums[1] + r["rejected"]]
    if not all(sums):
        return 0.0
    offsets = spark.createDataFrame(below, "range int, lost long, blocked long")
    before = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    so_far = {s: F.coalesce(F.sum(s).over(before), F.lit(0)) for s in sides}
    gain = (F.col("blocked") + so_far["rejected"]) * F.lit(sums[0]) - (F.col("lost") + so_far["accepted"]) * F.lit(sums[1])
    cuts = rows.join(F.broadcast(offsets), "range").select("score", gain.alias("gain"))
    cuts = materialize(spark, cuts, "cuts")
    best = cuts.where(F.col("gain") == F.lit(cuts.agg(F.max("gain")).first()[0]))
    score = best.orderBy("score").offset(best.count() // 2).first()["score"]
    lower = rows.where(F.col("score") < F.lit(score)).agg(F.max("score")).first()[0]
    if lower is None:
        return score - 1e-9
    middle = (lower + score) / 2
    return middle if middle > lower else score


def calibrate(scores: np.ndarray, allow: np.ndarray) -> float:
    """The threshold with the best balanced accuracy, midway between two scores; in memory."""
    if allow.all() or not allow.any():
        return 0.0
    order = np.argsort(scores, kind="stable")
    s, a = scores[order], allow[order]
    cuts = np.concatenate([[s[0] - 1e-9], (s[:-1] + s[1:]) / 2, [s[-1] + 1e-9]])
    blocked = np.concatenate([[0], np.cumsum(~a)]) / (~a).sum()
    lost = np.concatenate([[0], np.cumsum(a)]) / a.sum()
    best = np.flatnonzero(blocked - lost == (blocked - lost).max())
    return float(cuts[best[len(best) // 2]])


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every page's host, path, rule, verdict and score.

    The rules' verdicts on the pages themselves are the examples that the
    models learn from; where no rule fits, the score decides. A URL that is
    NULL or has no ``://`` has empty host and path; a NULL one scores 0.
    Repeated rows repeat, an empty table gives none.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = pages.select(F.col("page_id").cast("long"), "url", host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    parsed = parsed.withColumn("allow", allowed(F.col("rule"), rules))
    model = fit(parsed)
    scored = parsed.join(model.scores, "url", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    passes = F.coalesce("allow", F.col("score") >= F.lit(model.threshold))
    verdict = F.when(passes, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
