"""Document scores by the difference of two language models' cross-entropies.

A target model, of documents labelled good, and a background model, of all
others, share all words of the corpus and one smoothing. Background counts are
scaled to the target's number of words, so that the models are matched in size
and neither is surer of itself for having seen more.

The models are counts of all words and of all pairs of words, and grow with the
corpus. A chunk of documents is stored as its distinct words and, word by word,
their numbers. It sends each word and each pair once, with its counts, in packed
pieces by ranges of hashes; where a range's pieces meet the counts are added up,
and each piece is answered in its own order. So a chunk gets back just the counts
that its documents need. Pairs that begin with a very frequent word are dealt out
over all ranges, and their sums over the word's followers put together after.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import word_chunks
from landfall.llm.packed import groups, pack, part_of, planes, short, unpack, values
from landfall.operators.joins import sized_broadcast
from landfall.session import materialize

DISCOUNT = 0.75
# Bits of a word's hash, and the codes of a word that a given vocabulary lacks and
# of a text's start.
WORD_BITS = 48
UNKNOWN, START = 0, 1
# Words at least so often, as a share of all, have their pairs dealt out. There
# can be no more of them than one over it.
HOT_SHARE = 2.0**-10
# Bytes of text of a chunk, and for each range of hashes.
CHUNK_BYTES = 4 << 20
PART_BYTES = 8 << 20
# Tasks of one shuffle; beyond, tasks get several ranges, one after the other.
MOST_TASKS = 10_000

CHUNKS = "doc_ids array<long>, target array<boolean>, counts array<int>, words binary, tokens binary"
PIECES = "part long, chunk long, piece binary"


def vocabulary(docs: DataFrame, size: int) -> list[str]:
    """The most frequent words of all documents, ties in alphabetical order."""

    def count(batches):
        for _, words, _ in word_chunks(batches):
            found = words.value_counts()
            yield pa.RecordBatch.from_pydict(
                {"word": found.field("values").cast(pa.string()), "n": found.field("counts")}
            )

    counts = docs.select("text").mapInArrow(count, "word string, n long")
    top = counts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(size)
    return [row["word"] for row in top.collect()]


# ---------------------------------------------------------------- chunks


def chunks_of(docs: DataFrame, known: pa.Array | None) -> DataFrame:
    """The documents as a stored table of chunks, numbered.

    ``words`` are the codes of a chunk's distinct words in order, that of a
    text's start among them, ``tokens`` the place there of each word in turn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words, counts in word_chunks(batches, CHUNK_BYTES):
            coded = words.dictionary_encode()
            codes = pd.util.hash_array(np.array(coded.dictionary.to_pylist(), object), categorize=False)
            codes = np.maximum(short(codes, WORD_BITS), np.uint64(START + 1))
            if known is not None:
                some = pc.is_in(coded.dictionary, value_set=known).to_numpy(zero_copy_only=False)
                codes = np.where(some, codes, np.uint64(UNKNOWN))
            distinct = np.unique(np.append(codes, np.uint64(START)))
            tokens = np.searchsorted(distinct, codes)[coded.indices.to_numpy()]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_ids": pa.array([rows["doc_id"].to_pylist()], pa.list_(pa.int64())),
                    "target": pa.array([rows["target"].to_pylist()], pa.list_(pa.bool_())),
                    "counts": pa.array([counts], pa.list_(pa.int32())),
                    "words": pa.array([pack(distinct)], pa.binary()),
                    "tokens": pa.array([len(tokens).to_bytes(4, "little") + planes(tokens)], pa.binary()),
                }
            )

    stored = docs.select("doc_id", "text", "target").mapInArrow(run, CHUNKS)
    return materialize(docs.sparkSession, stored.withColumn("chunk", F.monotonically_increasing_id()), "chunks")


class Chunk:
    """A chunk's words, and its pairs in the order of their pieces."""

    def __init__(self, row: dict):
        self.doc_ids, self.counts = row["doc_ids"], np.array(row["counts"], np.int64)
        (self.words,) = unpack(row["words"])
        raw = row["tokens"]
        self.tokens = values(raw, 4, int.from_bytes(raw[:4], "little"))[0].astype(np.int64)
        self.owner = np.repeat(np.arange(len(self.counts)), self.counts)
        self.target = np.array(row["target"], bool)[self.owner]
        before = np.roll(self.tokens, 1)
        first = np.flatnonzero(np.diff(self.owner, prepend=-1))
        before[first] = np.searchsorted(self.words, np.uint64(START))
        self.before = before

    def word_counts(self, of: np.ndarray) -> list[np.ndarray]:
        """How often each word stands in the target's and in the other documents."""
        return [np.bincount(of[side], minlength=len(self.words)) for side in (self.target, ~self.target)]

    def pairs(self, hot: np.ndarray, parts: int):
        """(part, first, second, target, background) of distinct pairs, and the pair of each word."""
        key = self.before * len(self.words) + self.tokens
        pairs, of = np.unique(key, return_inverse=True)
        first, second = pairs // len(self.words), pairs % len(self.words)
        u, v = self.words[first], self.words[second]
        part = part_of(u, parts, WORD_BITS)
        dealt = np.isin(u, hot)
        mixed = (u ^ (v * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(33)
        part[dealt] = parts + (mixed[dealt] % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        counts = [np.bincount(of[side], minlength=len(pairs))[order] for side in (self.target, ~self.target)]
        return part[order], first[order], second[order], *counts, place[of]


def _each_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Chunk]]:
    """The chunks of stored rows with their numbers, one in memory at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            (row,) = batch.slice(k, 1).to_pylist()
            yield row["chunk"], Chunk(row)


def _cut(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    bounds = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(bounds, np.append(bounds[1:], len(part))):
        yield int(part[a]), slice(a, b)


def _pieces(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [(), (), ()]
    kinds = (("part", pa.int64()), ("chunk", pa.int64()), ("piece", pa.binary()))
    return pa.RecordBatch.from_pydict({n: pa.array(c, k) for (n, k), c in zip(kinds, columns)})


def _merged(pieces: list[pa.RecordBatch], more: int):
    """All numbers of a part's pieces, with the chunk and the size of each piece."""
    chunks = [c for p in pieces for c in p["chunk"].to_pylist()]
    lists = [unpack(raw, more) for p in pieces for raw in p["piece"].to_pylist()]
    return chunks, [len(x[0]) for x in lists], [np.concatenate(x) for x in zip(*lists)]


# ---------------------------------------------------------------- words


def word_sums(chunks: DataFrame, parts: int) -> DataFrame:
    """Answers to each chunk: its words' counts in the corpus, as last words and as first.

    Beside the answers, with chunk -1, the number of words of each part, and with
    chunk -2 the words as first words of pairs that may be hot, with their counts.
    """

    def send(batches):
        for number, chunk in _each_chunk(batches):
            part = part_of(chunk.words, parts, WORD_BITS)
            columns = [*chunk.word_counts(chunk.tokens), *chunk.word_counts(chunk.before)]
            yield _pieces(
                [(n, number, pack(chunk.words[some], *[c[some] for c in columns])) for n, some in _cut(part)]
            )

    def add_up(batches):
        for (part,), pieces in groups(batches, ("part",)):
            owners, sizes, (codes, *columns) = _merged(pieces, 4)
            distinct, of = np.unique(codes, return_inverse=True)
            sums = [np.bincount(of, c.astype(float), len(distinct)).astype(np.int64) for c in columns]
            out, at = [], 0
            for owner, size in zip(owners, sizes):
                some = of[at : at + size]
                out.append((part, owner, b"".join(planes(s[some]) for s in sums)))
                at += size
            words = int(np.count_nonzero((distinct > START) & (sums[0] + sums[1] > 0)))
            out.append((part, -1, words.to_bytes(8, "little")))
            heads = sums[2] + sums[3]
            top = np.sort(np.argsort(-heads, kind="stable")[: int(2 / HOT_SHARE)])
            out.append((part, -2, pack(distinct[top], heads[top])))
            yield _pieces(out)

    sent = chunks.mapInArrow(send, PIECES).repartition(min(parts, MOST_TASKS), "part")
    sent = sent.sortWithinPartitions("part")
    return materialize(chunks.sparkSession, sent.mapInArrow(add_up, PIECES), "word-sums")


def hot_words(sums: DataFrame, total: int) -> np.ndarray:
    """Codes of words that begin at least ``HOT_SHARE`` of all pairs."""
    least = max(2.0, HOT_SHARE * total)

    def run(batches):
        for batch in batches:
            for raw in batch["piece"].to_pylist():
                codes, heads = unpack(raw, 1)
                yield pa.RecordBatch.from_pydict({"code": codes[heads >= least].astype(np.int64)})

    found = sums.where("chunk = -2").select("piece").mapInArrow(run, "code long").toArrow()
    return np.sort(found["code"].to_numpy().astype(np.uint64))


# ---------------------------------------------------------------- pairs


def pair_sums(chunks: DataFrame, parts: int, hot: np.ndarray, ratio: float) -> DataFrame:
    """Answers to each chunk: its pairs' counts, and by first word what discounting takes.

    Beside the answers, with chunk -1, the sums of a hot word's pairs of a part.
    """
    shared = chunks.sparkSession.sparkContext.broadcast(hot)

    def send(batches):
        for number, chunk in _each_chunk(batches):
            part, first, second, target, background, _ = chunk.pairs(shared.value, parts)
            out = []
            for n, some in _cut(part):
                u, v = chunk.words[first[some]], chunk.words[second[some]]
                out.append((n, number, pack(u, v, target[some], background[some])))
            yield _pieces(out)

    def add_up(batches):
        for (part,), pieces in groups(batches, ("part",)):
            owners, sizes, (u, v, *columns) = _merged(pieces, 3)
            order = np.lexsort((v, u))
            new = np.ones(len(u), bool)
            new[1:] = (u[order][1:] != u[order][:-1]) | (v[order][1:] != v[order][:-1])
            of = np.empty(len(u), np.int64)
            of[order] = np.cumsum(new) - 1
            sums = [np.bincount(of, c.astype(float), int(new.sum())) for c in columns]
            heads, by = np.unique(u[order][new], return_inverse=True)
            taken = [
                np.bincount(by, np.minimum(s * r, DISCOUNT), len(heads)) for s, r in zip(sums, (1.0, ratio))
            ]
            if part >= parts:
                hot_sums = pack(heads) + b"".join(t.astype("<f8").tobytes() for t in taken)
                yield _pieces([(part, -1, hot_sums)])
            out, at = [], 0
            for owner, size in zip(owners, sizes):
                some = of[at : at + size]
                answer = b"".join(planes(s[some].astype(np.int64)) for s in sums)
                if part < parts:
                    own = np.searchsorted(heads, np.unique(u[at : at + size]))
                    answer += b"".join(t[own].astype("<f4").tobytes() for t in taken)
                out.append((part, owner, answer))
                at += size
            yield _pieces(out)

    sent = chunks.mapInArrow(send, PIECES).repartition(min(2 * parts, MOST_TASKS), "part")
    sent = sent.sortWithinPartitions("part")
    return materialize(chunks.sparkSession, sent.mapInArrow(add_up, PIECES), "pair-sums")


def hot_takings(sums: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """What discounting takes from the pairs of each hot word, in either model."""
    found: dict[int, np.ndarray] = {}
    for row in sums.where("chunk = -1").select("piece").toLocalIterator():
        raw = bytes(row["piece"])
        n = int.from_bytes(raw[:4], "little")
        (heads,) = unpack(raw)
        taken = np.frombuffer(raw[len(raw) - 16 * n :], "<f8").reshape(2, n)
        for k, head in enumerate(heads.tolist()):
            found[head] = found.get(head, np.zeros(2)) + taken[:, k]
    heads = np.array(sorted(found), np.uint64)
    return heads, np.array([found[int(h)] for h in heads]).reshape(-1, 2).T


def with_target(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with ``target``: whether a label calls them good."""
    good = labels.where("quality = 1 and doc_id is not null")
    good = good.select(F.col("doc_id").cast("long").alias("_good")).distinct()
    good = sized_broadcast(materialize(docs.sparkSession, good, "good"))
    joined = docs.join(good, docs["doc_id"] == good["_good"], "left")
    return joined.select("doc_id", "text", F.col("_good").isNotNull().alias("target"))


# ---------------------------------------------------------------- scores


def score(docs: DataFrame, labels: DataFrame, size: int | None = None) -> DataFrame:
    """Every document's losses for each word, and their difference.

    Returns ``doc_id, n_words, ce_target, ce_background, ce_difference`` in
    nats; a low difference speaks for the target. Absolute discounting: what is
    taken off the counts of pairs that occurred goes to the words in general,
    estimated with one count more each, and one for a word that is not known. A
    word that never goes before another in a model, and a model without
    documents, leave the words in general.

    NULL texts and texts without words have no losses. Without good documents, or
    without others, the model that lacks them is uniform. Repeated rows repeat;
    columns other than ``doc_id`` and ``text`` are left out. With ``size``, words
    beyond the so many most frequent ones count as one; else all are told apart.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    known = None if size is None else pa.array(vocabulary(docs, size), pa.large_string())
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + volume // PART_BYTES
    chunks = chunks_of(with_target(docs, labels), known)
    sized = F.arrays_zip("counts", "target")
    sums = [
        F.aggregate(F.filter(sized, own), F.lit(0).cast("long"), lambda n, x: n + x["counts"])
        for own in (lambda x: x["target"], lambda x: ~x["target"])
    ]
    totals = [n or 0 for n in chunks.agg(*[F.sum(x) for x in sums]).first()]
    ratio = totals[0] / totals[1] if all(totals) else 1.0

    words = word_sums(chunks, parts)
    hot = hot_words(words, sum(totals))
    pairs = pair_sums(chunks, parts, hot, ratio)
    counted = words.where("chunk = -1").select("piece").toLocalIterator()
    n_words = 1 + sum(int.from_bytes(bytes(r["piece"]), "little") for r in counted)
    shared = spark.sparkContext.broadcast((hot, *hot_takings(pairs)))
    rates = (1.0, ratio)

    def losses(chunk: Chunk, word_answers: list[bytes], pair_answers: list[bytes]) -> list[np.ndarray]:
        """Of each word, by either model."""
        hot, heads, hot_taken = shared.value
        sizes = [b.stop - b.start for _, b in _cut(part_of(chunk.words, parts, WORD_BITS))]
        answers = [_answer(raw, n, 4) for raw, n in zip(word_answers, sizes)]
        single, head = np.split(np.concatenate([a for a, _ in answers], axis=1), 2)
        part, first, second, *_, of = chunk.pairs(hot, parts)
        sums, taken = [], np.zeros((2, len(chunk.words)))
        for raw, (n, some) in zip(pair_answers, _cut(part)):
            found, at = _answer(raw, some.stop - some.start, 2)
            sums.append(found)
            if n < parts:
                own = np.unique(first[some])
                taken[:, own] = np.frombuffer(raw[at:], "<f4").reshape(2, len(own))
        where = np.searchsorted(chunk.words, heads)
        mine = (where < len(chunk.words)) & (chunk.words[np.minimum(where, len(chunk.words) - 1)] == heads)
        taken[:, where[mine]] = hot_taken[:, mine]
        counts = np.concatenate(sums, axis=1) if sums else np.zeros((2, 0))
        out = []
        for k, rate in enumerate(rates):
            general = (single[k][second] * rate + 1) / (totals[k] * rate + n_words)
            total = head[k][first] * rate
            kept = np.maximum(counts[k] * rate - DISCOUNT, 0.0) + taken[k][first] * general
            p = np.where(total > 0, kept / np.maximum(total, 1e-300), general)
            out.append(-np.log(np.maximum(p, 1e-300))[of])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, pieces in groups(batches, ("chunk",)):
            chunk = Chunk(pieces[0].slice(0, 1).to_pylist()[0])
            answers: list[list[bytes]] = [[], [], []]
            for piece in pieces:
                for kind, raw in zip(piece["kind"].to_pylist(), piece["piece"].to_pylist()):
                    answers[kind].append(raw)
            n = chunk.counts
            found = losses(chunk, *answers[1:]) if len(chunk.tokens) else [np.empty(0)] * 2
            means = [np.bincount(chunk.owner, x, len(n)) / np.maximum(n, 1) for x in found]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(chunk.doc_ids, pa.int64()),
                    "n_words": pa.array(n),
                    **{c: pa.array(x, mask=n == 0) for c, x in zip(("ce_target", "ce_background"), means)},
                }
            )

    def answers_of(sums: DataFrame, kind: int) -> DataFrame:
        blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in chunks.schema if f.name != "chunk"]
        own = sums.where("chunk >= 0").select("chunk", "part", F.lit(kind).alias("kind"), "piece")
        return own.select("*", *blank)

    own = chunks.select(
        "chunk",
        F.lit(0).cast("long").alias("part"),
        F.lit(0).alias("kind"),
        F.lit(None).cast("binary").alias("piece"),
        *[c for c in chunks.columns if c != "chunk"],
    )
    met = own.unionByName(answers_of(words, 1)).unionByName(answers_of(pairs, 2))
    met = met.repartition(min(parts, MOST_TASKS), "chunk").sortWithinPartitions("chunk", "kind", "part")
    found = met.mapInArrow(run, "doc_id long, n_words long, ce_target double, ce_background double")
    return found.withColumn("ce_difference", F.col("ce_target") - F.col("ce_background"))


def _answer(raw: bytes, n: int, columns: int) -> tuple[np.ndarray, int]:
    """Columns of n numbers each, and where what follows begins."""
    out, at = [], 0
    for _ in range(columns):
        found, at = values(raw, at, n)
        out.append(found.astype(np.float64))
    return np.array(out), at
