"""Near duplicates by SimHash fingerprints, found with pigeonhole blocks."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import (
    arrow_map,
    as_bytes,
    components,
    group_bounds,
    in_few_files,
    split_groups,
    stars,
    whole_groups,
    without,
)
from landfall.session import materialize

SHINGLE = 4
DISTANCE = 4
SEED = 42
# Rows of a block bucket that are worth comparing one by one; decides how many
# blocks fingerprints are split into, never which pairs are found.
BUCKET_ROWS = 4


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is in over half of the shingles' hashes.

    A-Z count as lower case, words are parted by ASCII white space. A text of
    fewer words than a shingle is one shingle; without words it gives zero.
    """
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    hashes = np.array(
        [
            xxh64_intdigest(line[a:b], SEED)
            for a, b in zip(begins[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
        ],
        "<u8",
    )
    ones = np.zeros(64, np.int64)
    for some in np.array_split(hashes, -(-len(hashes) // 65536)):
        bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, mark, fp): a hash of id and text, and the fingerprint.

    The fingerprint is a long of the same 64 bits. A NULL text is an empty one.
    """

    def run(batch: pa.RecordBatch):
        values = [fingerprint(text, shingle) for text in as_bytes(batch.column("text"))]
        yield {
            "doc_id": batch.column("doc_id"),
            "mark": batch.column("mark"),
            "fp": pa.array(np.array(values, np.uint64).view(np.int64)),
        }

    rows = docs.select(F.col("doc_id").cast("long"), row_mark().alias("mark"), "text")
    return arrow_map(rows, run, "doc_id long, mark long, fp long")


def row_mark() -> Column:
    """Tells rows apart by id and text, as an id may stand on several texts."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def block_masks(blocks: int, distance: int = DISTANCE) -> list[int]:
    """Masks of ``blocks - distance`` out of ``blocks`` bit blocks, all choices.

    Two fingerprints that differ in at most ``distance`` bits agree in at least
    that many whole blocks, hence under one mask or more.
    """
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]
    return [sum(chosen) for chosen in itertools.combinations(parts, blocks - distance)]


def blocks_for(count: int, distance: int = DISTANCE) -> int:
    """The fewest blocks with buckets of a few rows, were bits independent."""
    for blocks in range(distance + 1, 2 * distance + 3):
        if count <= BUCKET_ROWS * 2 ** (64 * (blocks - distance) / blocks):
            return blocks
    return blocks


def near_links(prints: DataFrame, distance: int = DISTANCE, block: int = 2048) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``distance``.

    ``prints`` has one row (rep, fp) for each distinct fingerprint. Rows join on
    their masked bits; a bucket is compared in bounded pieces (see
    ``split_groups``), and each piece gives a spanning star of its components
    rather than its pairs, so links never outnumber rows.
    """
    masks = block_masks(blocks_for(prints.count(), distance), distance)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    bits: list[Column] = [F.col("fp").bitwiseAND(F.lit(m)) for m in signed]
    keyed = prints.select("rep", "fp", F.posexplode(F.array(*bits)).alias("mask", "bits"))
    keyed = keyed.select("rep", "fp", F.xxhash64("mask", "bits").alias("key"))
    rows = split_groups(keyed, "key", "rep", block)

    def compare(frames):
        for frame in whole_groups(frames, ["key", "i", "j"]):
            a, b = pairs_within(frame, distance)
            if len(a):
                a, b = stars(a, b)
                yield pd.DataFrame({"a": a, "b": b})

    return rows.select("key", "i", "j", "side", "rep", "fp").mapInPandas(compare, "a long, b long").distinct()


def pairs_within(frame: pd.DataFrame, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one group whose fingerprints are near, groups of a sorted frame.

    Short groups are compared all at once by shifting the columns; of long ones
    each row is compared with those behind it, and near pairs are thinned to
    stars as they come.
    """
    bounds = group_bounds(frame, ["key", "i", "j"])
    sizes = np.diff(bounds)
    fp = frame["fp"].to_numpy().view(np.uint64)
    rep = frame["rep"].to_numpy()
    mixed = frame["i"].to_numpy() != frame["j"].to_numpy()
    side = frame["side"].to_numpy()
    group = np.repeat(np.arange(len(sizes)), sizes)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    small = np.flatnonzero((sizes <= 32)[group])
    for shift in range(1, min(32, sizes.max(initial=0)) if len(small) else 0):
        x, y = small[:-shift], small[shift:]
        alike = group[x] == group[y]
        if not alike.any():
            break
        x, y = x[alike], y[alike]
        near = (np.bitwise_count(fp[x] ^ fp[y]) <= distance) & (~mixed[x] | (side[x] != side[y]))
        found.append((rep[x[near]], rep[y[near]]))

    for g in np.flatnonzero(sizes > 32):
        rows = np.arange(bounds[g], bounds[g + 1])
        if mixed[rows[0]]:
            left, right = rows[side[rows] == side[rows].min()], rows[side[rows] == side[rows].max()]
        else:
            left = right = rows
        if side[left[0]] == side[right[0]] and mixed[rows[0]]:
            continue
        links = []
        for some in np.array_split(left, -(-len(left) // 256)):
            near = np.bitwise_count(fp[some][:, None] ^ fp[right][None, :]) <= distance
            x, y = np.nonzero(near)
            apart = rep[some[x]] != rep[right[y]]
            x, y = x[apart], y[apart]
            if len(x):
                links.append(stars(rep[some[x]], rep[right[y]]))
        found += links
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """Every document with its fingerprint and component.

    Returns ``doc_id``, ``mark``, ``fp``, ``component``, a number of its own, and
    ``component_id``: the smallest doc_id that links of at most ``distance``
    differing bits reach, itself included. Equal fingerprints are one node, however many documents have them. An id on
    several texts is as many documents. Rows with a NULL id get a fingerprint but
    no component, and repeated rows repeat in the result; an empty table gives
    none.
    """
    spark = docs.sparkSession
    prints = materialize(spark, fingerprints(docs, shingle), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("low")).where("low is not null")
    nodes = materialize(spark, nodes, "nodes")
    count = nodes.count()
    roots = components(near_links(nodes.select(F.col("fp").alias("rep"), "fp"), distance), "simhash")
    nodes = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("component")
    )
    nodes = materialize(spark, in_few_files(nodes, count), "linked")
    least = nodes.groupBy("component").agg(F.min("low").alias("component_id"))
    named = nodes.join(least, "component").select("fp", "component", "component_id")
    found = prints.join(named, "fp", "left")
    known = F.col("doc_id").isNotNull()
    return found.select(
        "doc_id",
        "mark",
        "fp",
        *[F.when(known, F.col(c)).alias(c) for c in ("component", "component_id")],
    )


def keep_one(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """One row of each component, of the smallest id; rows with a NULL id stay.

    Of several texts of that id in the component the one of least hash stays, and
    of rows that repeat in id and text one. A row whose id also stands on other
    texts is judged by its own text.
    """
    spark = docs.sparkSession
    found = near_duplicates(docs, distance, shingle).where("doc_id is not null")
    found = found.groupBy("doc_id", "mark", "component").count()
    found = materialize(spark, found, "components")
    kept = found.groupBy("component").agg(F.min(F.struct("doc_id", "mark")).alias("kept"))
    judged = found.join(kept, "component")
    other = F.struct("doc_id", "mark") != F.col("kept")
    own = "__row_mark"
    dropped = materialize(spark, judged.where(other).select(F.col("mark").alias(own)), "dropped")
    again = judged.where(~other & (F.col("count") > 1)).select(F.col("mark").alias(own))
    again = materialize(spark, again, "again")
    rows = docs.withColumn(own, F.when(F.col("doc_id").isNotNull(), row_mark()))
    left = without(rows, dropped, own)
    if not again.isEmpty():
        repeated = left.join(again, own, "left_semi").dropDuplicates([own])
        left = without(left, again, own).unionByName(repeated)
    return left.drop(own)


def hex_print(column: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))

