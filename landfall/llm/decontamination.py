"""Benchmark decontamination with a distributed positional inverted index.

The index is a table of segments. A segment holds some whole documents: its
distinct terms in order and, term after term, the positions at which each
occurs. Segments are built and searched where they lie, so a term that every
document has is spread over all of them, and no posting list meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import arrow_map, as_bytes, without, words_of
from landfall.session import materialize

WINDOW = 13
# Words after which a segment is closed. A longer document is one segment.
SEGMENT_WORDS = 1 << 17
# Bytes of test texts that one search holds in memory; more are searched in turn.
SLICE_BYTES = 8 << 20
# Candidate places that are checked at once.
CANDIDATES = 1 << 20
# A segment is about a megabyte, and Parquet would hold a hundred of them before it
# first looks at how much it holds.
INDEX_FILES = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "4"}

SEGMENTS = (
    "doc_ids array<long>, doc_ends array<int>, terms array<binary>,"
    " counts array<int>, steps array<int>"
)
FOUND = (
    "segment long, nth int, doc_id long, n_words long, spans array<struct<first:int,last:int>>, items array<string>"
)


# ---------------------------------------------------------------- the index


def build_index(docs: DataFrame, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The index as a stored table, one row for each segment.

    ``doc_ends`` are the positions at which documents end, ``counts`` the number
    of positions of each term, ``steps`` the differences of all positions in
    turn. NULL texts are documents without words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[list[bytes]] = []
        size = 0
        for batch in batches:
            for owner, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
                words = words_of(text)
                if ids and size + len(words) > segment_words:
                    yield segment(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(owner)
                texts.append(words)
                size += len(words)
        if ids:
            yield segment(ids, texts)

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SEGMENTS)
    rows = rows.withColumn("segment", F.monotonically_increasing_id())
    return materialize(docs.sparkSession, rows, "index", options=INDEX_FILES)


def segment(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
    flat = pa.array([w for words in texts for w in words], pa.binary())
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy()
    positions = np.argsort(codes, kind="stable").astype(np.int32)
    counts = np.bincount(codes, minlength=len(coded.dictionary)).astype(np.int32)
    ends = np.cumsum([len(words) for words in texts]).astype(np.int32)

    def one(values, kind):
        return pa.array([values], pa.list_(kind))

    return pa.RecordBatch.from_pydict(
        {
            "doc_ids": one(ids, pa.int64()),
            "doc_ends": one(ends, pa.int32()),
            "terms": one(coded.dictionary.to_pylist(), pa.binary()),
            "counts": one(counts, pa.int32()),
            "steps": one(np.diff(positions, prepend=np.int32(0)), pa.int32()),
        }
    )


class Segment:
    """Posting lists of the query's terms in one segment."""

    def __init__(self, batch: pa.RecordBatch, row: int, vocabulary: pa.Array):
        def values(name):
            column = batch.column(name)
            begin, end = column.offsets[row].as_py(), column.offsets[row + 1].as_py()
            return column.values[begin:end]

        self.doc_ids = values("doc_ids").to_pylist()
        self.ends = values("doc_ends").to_numpy().astype(np.int64)
        self.size = int(self.ends[-1]) if len(self.ends) else 0
        counts = values("counts").to_numpy().astype(np.int64)
        positions = np.cumsum(values("steps").to_numpy().astype(np.int64))
        asked = pc.index_in(values("terms"), value_set=vocabulary)
        # Number of each term in the query's vocabulary, -1 for other terms.
        number = pc.fill_null(asked, -1).to_numpy().astype(np.int64)
        self.count = np.zeros(len(vocabulary), np.int64)
        self.count[number[number >= 0]] = counts[number >= 0]
        known = np.repeat(number, counts)
        positions, known = positions[known >= 0], known[known >= 0]
        # (term, position) as one sorted number.
        self.keys = np.sort(known * self.size + positions)
        self.begin = np.concatenate([[0], np.cumsum(self.count)])

    def postings(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All positions of each of the terms, and which term each belongs to."""
        sizes = self.count[terms]
        owner = np.repeat(np.arange(len(terms)), sizes)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.keys[self.begin[terms][owner] + nth] - terms[owner] * self.size, owner

    def occurs(self, terms: np.ndarray, positions: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(terms), bool)
        wanted = terms * self.size + positions
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return self.keys[at] == wanted

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """Which document a position is in."""
        return np.searchsorted(self.ends, positions, "right")


# ---------------------------------------------------------------- the test terms


@dataclass
class Phrases:
    """Distinct phrases of the test items: term numbers, padded with -1."""

    vocabulary: pa.Array
    terms: np.ndarray  # phrase x offset
    lengths: np.ndarray
    items: list[list[str]]  # of each phrase


def windows(words: list[bytes], width: int = WINDOW) -> list[tuple[bytes, ...]]:
    """All runs of ``width`` words; a shorter text that has words is one run."""
    if len(words) <= width:
        return [tuple(words)] if words else []
    return [tuple(words[k : k + width]) for k in range(len(words) - width + 1)]


def phrases_of(rows: list[tuple[str, bytes]], width: int | None = WINDOW) -> Phrases:
    """Windows of the items' texts; whole texts if ``width`` is None."""
    owners: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in rows:
        words = words_of(text)
        for phrase in windows(words, width or max(1, len(words))):
            owners.setdefault(phrase, set()).add(item)
    numbers: dict[bytes, int] = {}
    lengths = np.array([len(p) for p in owners], np.int64)
    terms = np.full((len(owners), max([1, *lengths])), -1, np.int64)
    for row, phrase in enumerate(owners):
        terms[row, : len(phrase)] = [numbers.setdefault(w, len(numbers)) for w in phrase]
    return Phrases(
        pa.array(list(numbers), pa.binary()), terms, lengths, [sorted(s) for s in owners.values()]
    )


def term_counts(index: DataFrame, phrases: Phrases) -> np.ndarray:
    """How often each of the test terms occurs in the whole index."""
    vocabulary = phrases.vocabulary

    def run(batch: pa.RecordBatch):
        total = np.zeros(len(vocabulary), np.int64)
        terms, counts = batch.column("terms"), batch.column("counts")
        number = pc.fill_null(pc.index_in(terms.flatten(), value_set=vocabulary), -1).to_numpy()
        np.add.at(total, number[number >= 0], counts.flatten().to_numpy()[number >= 0])
        some = np.flatnonzero(total)
        yield {"term": pa.array(some), "n": pa.array(total[some])}

    rows = arrow_map(index.select("terms", "counts"), run, "term long, n long")
    total = np.zeros(len(vocabulary), np.int64)
    for term, n in rows.groupBy("term").agg(F.sum("n")).collect():
        total[term] = n
    return total


# ---------------------------------------------------------------- the search


def phrase_starts(
    part: Segment, phrases: Phrases, by_rarity: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrase, start) of all exact occurrences in a segment.

    The rarest term's positions, less its offset, are the candidates; each
    further list in the order of rarity leaves those that it holds too.
    """
    present = np.where(phrases.terms >= 0, part.count[phrases.terms] > 0, True).all(axis=1)
    alive = np.flatnonzero(present)
    if not len(alive):
        return
    first = by_rarity[alive, 0]
    work = np.cumsum(part.count[phrases.terms[alive, first]])
    for chunk in np.split(alive, np.unique(np.searchsorted(work, np.arange(CANDIDATES, work[-1], CANDIDATES)))):
        if not len(chunk):
            continue
        offset = by_rarity[chunk, 0]
        position, owner = part.postings(phrases.terms[chunk, offset])
        phrase, start = chunk[owner], position - offset[owner]
        length = phrases.lengths[phrase]
        fits = (start >= 0) & (start + length <= part.size)
        phrase, start, length = phrase[fits], start[fits], length[fits]
        together = part.owner(start) == part.owner(start + length - 1)
        phrase, start = phrase[together], start[together]
        for rank in range(1, phrases.terms.shape[1]):
            if not len(phrase):
                break
            offset = by_rarity[phrase, rank]
            term = phrases.terms[phrase, offset]
            holds = (term < 0) | part.occurs(np.maximum(term, 0), start + offset)
            phrase, start = phrase[holds], start[holds]
        if len(phrase):
            yield phrase, start


def rarity_order(phrases: Phrases, counts: np.ndarray) -> np.ndarray:
    """Offsets of each phrase from its rarest term to its most frequent."""
    if not phrases.terms.size:
        return phrases.terms
    often = np.where(phrases.terms >= 0, counts[phrases.terms], np.iinfo(np.int64).max)
    return np.argsort(often, axis=1, kind="stable")


def search_phrases(index: DataFrame, phrases: Phrases) -> DataFrame:
    """Each document of the index with the spans that phrases cover, and the items.

    Spans are of word positions, the last one included, merged and in order.
    """
    order = rarity_order(phrases, term_counts(index, phrases))

    def run(batch: pa.RecordBatch):
        for row in range(batch.num_rows):
            part = Segment(batch, row, phrases.vocabulary)
            change = np.zeros(part.size + 1, np.int64)
            items: list[set[str]] = [set() for _ in part.doc_ids]
            for phrase, start in phrase_starts(part, phrases, order):
                np.add.at(change, start, 1)
                np.add.at(change, start + phrases.lengths[phrase], -1)
                for doc, p in np.unique(np.stack([part.owner(start), phrase]), axis=1).T.tolist():
                    items[doc].update(phrases.items[p])
            hit = np.cumsum(change)[: part.size] > 0
            begins = np.concatenate([[0], part.ends[:-1]])
            edge = np.zeros(part.size + 1, bool)
            edge[begins] = True  # a span ends with its document
            new = hit & (edge[:-1] | ~np.concatenate([[False], hit[:-1]]))
            last = hit & (np.concatenate([edge[1:-1], [True]])[: part.size] | ~np.concatenate([hit[1:], [False]]))
            firsts, lasts = np.flatnonzero(new), np.flatnonzero(last)
            spans: list[list] = [[] for _ in part.doc_ids]
            for doc, a, b in zip(part.owner(firsts).tolist(), firsts.tolist(), lasts.tolist()):
                base = int(begins[doc])
                spans[doc].append({"first": a - base, "last": b - base})
            yield {
                "segment": pa.array([batch.column("segment")[row].as_py()] * len(part.doc_ids), pa.int64()),
                "nth": pa.array(range(len(part.doc_ids)), pa.int32()),
                "doc_id": pa.array(part.doc_ids, pa.int64()),
                "n_words": pa.array(part.ends - begins),
                "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                "items": pa.array([sorted(s) for s in items], pa.list_(pa.string())),
            }

    return arrow_map(index, run, FOUND)


def test_slices(benchmark: DataFrame, slice_bytes: int = SLICE_BYTES) -> Iterator[list]:
    """The test items, no more of them in memory at once than the bound says.

    Items are dealt out by the hash of their id and text. Those with a NULL id
    cannot be named in a result and are left out.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where(
        "item is not null and text is not null"
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-size // slice_bytes))
    number = F.pmod(F.xxhash64("item", "text"), F.lit(slices))
    for k in range(slices):
        rows = items.where(number == k).select("item", F.col("text").cast("binary"))
        yield [(item, bytes(text)) for item, text in rows.collect()]


def find_items(docs: DataFrame, benchmark: DataFrame, width: int | None = WINDOW) -> DataFrame:
    """Documents with what they share with the test items, as ``search_phrases``.

    The result has one row for each document row, NULL ids and repeated rows
    included. An empty benchmark leaves all documents without spans. Test items
    beyond one slice are searched slice by slice and the spans put together.
    """
    index = build_index(docs)
    found = [search_phrases(index, phrases_of(rows, width)) for rows in test_slices(benchmark)]
    if len(found) == 1:
        return found[0]
    return combine([materialize(docs.sparkSession, f, "slice") for f in found])


def combine(found: list[DataFrame]) -> DataFrame:
    """Spans and items of the same document rows, searched for in several slices."""
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    grouped = every.groupBy("segment", "nth").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    covered = F.array_distinct(
        F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["last"])))
    )
    single = F.transform(F.array_sort(covered), lambda p: F.struct(p.alias("first"), p.alias("last")))
    return grouped.select("segment", "nth", "doc_id", "n_words", single.alias("spans"), "items")


def n_hit() -> Column:
    """Words that spans cover."""
    return F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1
    )


def is_contaminated(n_words: Column, hits: Column) -> Column:
    """At least one word in twenty is part of a test item's window."""
    return (hits > 0) & (20 * hits >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """Documents that are not contaminated, with all their columns.

    Rows are judged by their text, so rows that share an id, or have none, do not
    share a verdict. A NULL text has no words and stays.
    """
    own = "__text_mark"
    rows = docs.withColumn(own, F.xxhash64("text"))
    found = find_items(rows.select(F.col(own).alias("doc_id"), "text"), benchmark, width)
    bad = found.where(is_contaminated(F.col("n_words"), n_hit()))
    bad = bad.select(F.col("doc_id").alias(own)).distinct()
    return without(rows, materialize(docs.sparkSession, bad, "contaminated"), own).drop(own)


def search_near(index: DataFrame, phrases: Phrases, reach: int) -> DataFrame:
    """Proximity matches: (doc_id, item, position), words in any order.

    A phrase matches at a position of its rarest term if each other term of it
    occurs within ``reach`` words of there, in the same document.
    """
    order = rarity_order(phrases, term_counts(index, phrases))

    def run(batch: pa.RecordBatch):
        for row in range(batch.num_rows):
            part = Segment(batch, row, phrases.vocabulary)
            begins = np.concatenate([[0], part.ends[:-1]])
            out: dict[str, list] = {"doc_id": [], "item": [], "position": []}
            for p in range(len(phrases.lengths)):
                terms = phrases.terms[p, order[p, : phrases.lengths[p]]]
                position, _ = part.postings(terms[:1])
                for term in np.unique(terms[1:]):
                    doc = part.owner(position)
                    low = np.maximum(position - reach, begins[doc])
                    high = np.minimum(position + reach, part.ends[doc] - 1)
                    a = np.searchsorted(part.keys, term * part.size + low)
                    b = np.searchsorted(part.keys, term * part.size + high, "right")
                    position = position[b > a]
                for at in position.tolist():
                    doc = int(part.owner(np.array([at]))[0])
                    for item in phrases.items[p]:
                        out["doc_id"].append(part.doc_ids[doc])
                        out["item"].append(item)
                        out["position"].append(at - int(begins[doc]))
            yield {
                "doc_id": pa.array(out["doc_id"], pa.int64()),
                "item": pa.array(out["item"], pa.string()),
                "position": pa.array(out["position"], pa.int64()),
            }

    return arrow_map(index, run, "doc_id long, item string, position long")
