"""Helpers the operators of this package share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators.joins import sized_broadcast
from landfall.session import configure, materialize

# Rows that go to a Python worker at once. Texts are whole, as are segments of an
# index, of which so many would be hundreds of megabytes; bytes bound them too.
BATCH_ROWS = 256
# Bytes of such rows, beyond the last one's.
BATCH_BYTES = 4 << 20
# Bytes of text whose words are handled at once.
CHUNK_BYTES = 8 << 20
# Links that go into one file.
FILE_LINKS = 200_000


def prepare(spark: SparkSession) -> SparkSession:
    """The runtime settings of the library, small batches to Python, and its path.

    Python workers look for the package where the driver found it, whatever
    folder the session was started in. A cluster's machines have it from the
    user's own deployment, as any package.
    """
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    frame = prepare(spark).read.parquet(f"{folder}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of each text; a NULL text counts as an empty one."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def arrow_map(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], Iterable[dict]],
    schema: str,
) -> DataFrame:
    """Map batches to dictionaries of columns, each a batch of the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for columns in function(batch):
                    yield pa.RecordBatch.from_pydict(columns)

    return df.mapInArrow(run, schema)


def without(df: DataFrame, drop: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in ``drop``; a NULL key stays.

    The keys are broadcast if their measured size allows it; otherwise the join
    shuffles. ``drop`` should be stored, as measuring reads it.
    """
    return df.join(sized_broadcast(drop.select(key)), key, "left_anti")


# ---------------------------------------------------------------- words

_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
# Every byte that is in no word becomes a space, A-Z lower case.
WORD_BYTES = bytes(
    b if b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased."""
    return text.translate(WORD_BYTES).split()


def word_chunks(
    batches: Iterator[pa.RecordBatch], size: int = CHUNK_BYTES
) -> Iterator[tuple[pa.Table, pa.Array, np.ndarray]]:
    """Rows of about ``size`` bytes with their words, text after text, and the number of words of each."""

    def words(held):
        rows = pa.Table.from_batches(held)
        texts = [t.translate(WORD_BYTES).strip() for t in as_bytes(rows["text"])]
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
        flat = lists.flatten()
        filled = pc.not_equal(flat, "")
        counts = pc.list_value_length(lists).to_numpy().astype(np.int64)
        counts -= np.array([0 if t else n for t, n in zip(texts, counts.tolist())], np.int64)
        return rows, flat.filter(filled), counts

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= size:
            yield words(held)
            held = []
    if held:
        yield words(held)


# ---------------------------------------------------------------- groups


def split_groups(
    rows: DataFrame, key: str, ident: str, block: int = 2048
) -> DataFrame:
    """Deal out rows so that every pair that shares ``key`` meets in a small group.

    A group of n rows is cut into ceil(n / block) blocks by the hash of
    ``ident``, and a row goes to every pair of blocks (``i``, ``j``) that holds
    its own, named in ``side``. No task gets more than about two blocks of one
    group, whatever the group's size; keys with one row are left out. The
    result is partitioned and sorted by (key, i, j), for ``whole_groups``.
    """
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    placed = (
        rows.join(sizes, key)
        .withColumn("_blocks", blocks)
        .withColumn("side", F.pmod(F.xxhash64(F.lit("block"), ident), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("i", F.least("side", "_other"))
        .withColumn("j", F.greatest("side", "_other"))
        .drop("_n", "_blocks", "_other")
    )
    order = [key, "i", "j"]
    return placed.repartition(*order).sortWithinPartitions(*order)


def whole_groups(frames: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Regroup sorted batches so that none ends within a group."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if frame.empty:
            continue
        last = (frame[keys] == frame[keys].iloc[-1]).all(axis=1).to_numpy()
        cut = len(frame) - int(np.argmin(last[::-1])) if not last.all() else 0
        if cut:
            yield pd.concat([*held, frame.iloc[:cut]], ignore_index=True)
            held = []
        elif held and not (held[-1][keys].iloc[-1] == frame[keys].iloc[0]).all():
            yield pd.concat(held, ignore_index=True)
            held = []
        held.append(frame.iloc[cut:])
    if held:
        yield pd.concat(held, ignore_index=True)


def group_bounds(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Where the groups of a sorted frame begin, and its length."""
    new = np.zeros(len(frame), bool)
    new[0] = True
    for key in keys:
        values = frame[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), len(frame))


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as the links (a, b), as links to each one's least node."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        np.minimum.at(after, label[a], least)
        np.minimum.at(after, label[b], least)
        after = after[after]
        if (after == label).all():
            break
        label = after
    linked = label != np.arange(len(nodes))
    return nodes[linked], nodes[label[linked]]


# ---------------------------------------------------------------- components


def in_few_files(links: DataFrame, rows: int) -> DataFrame:
    """In as many parts as so many links need, though one for each core at least.

    A part is a file when it is stored, and a file costs memory and, on a local
    file system, processes to set its mode. Where nothing joins the parts of a
    shuffle, a few links would be written as hundreds of files in every round.
    """
    cores = links.sparkSession.sparkContext.defaultParallelism
    return links.coalesce(max(cores, -(-rows // FILE_LINKS)))


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """Connected components of links (a, b): one row (node, root) for each node.

    Large-star and small-star steps by turns until nothing changes; ``root`` is
    the component's least node. Each step is one aggregate and one join on the
    node; the join's large side holds the links, so a node with very many is
    split by adaptive execution. Every round is written to the shared folder.
    """
    spark = links.sparkSession
    edges = materialize(
        spark,
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a != b")
        .distinct(),
        label,
    )
    before, rows = None, edges.count()
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = _to_least(both, larger_only=True)
        edges = _to_least(edges, larger_only=False).distinct()
        edges = materialize(spark, in_few_files(edges, rows), label)
        state = edges.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
        if state == before:
            break
        before, rows = state, state[0]
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _to_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"), F.xxhash64("a").alias("h"))
    # With the hash as a second key neither side comes as it is partitioned, so
    # adaptive execution may split the links of a node that has very many.
    joined = edges.withColumn("h", F.xxhash64("a")).join(least, ["a", "h"])
    if larger_only:
        pairs = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.where("m < a").select("a", F.col("m").alias("b"))
    else:
        pairs = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.select("a", F.col("m").alias("b"))
    return pairs.unionByName(own).where("a != b")
