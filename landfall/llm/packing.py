"""Best-fit packing of token sequences, after a dominance reduction.

Texts become token ids, long ones are cut into pieces of the sequence length,
and pieces are dealt into as few sequences as possible. How many pieces there
are of each length is all the plan needs, and there are at most as many lengths
as the sequence has tokens. So the plan is made from a small histogram however
many documents there are, and each piece finds its place from its length and
its rank among the pieces of that length.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import arrow_map
from landfall.session import materialize

CAPACITY = 4096
END_ID = 1
# Bytes of text that are encoded at once, and so share their distinct words.
ENCODE_BYTES = 4 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of whole texts, by way of the ids of their distinct words.

    The tokenizer drops white space and never joins what it parts, so a text's
    ids are those of its words in turn. Words are parted at ASCII white space
    only; what other white space there is the tokenizer parts itself.

    Of a Latin word with punctuation behind it, the letters are one token
    sequence and the punctuation another, and lower case is all that the
    tokenizer's normalizer does to the letters. So such words are encoded once
    for all their cases and endings, many at a time; any other goes through the
    whole tokenizer. Nothing is remembered from call to call, so memory is
    bounded by the texts of one, however many distinct words there are.
    """

    PLAIN = (
        "\\A(?P<letters>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)"
        "(?P<tail>[!-&(-/:;=>?@\\[-`{-~]*)\\z"
    )

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        # The same model, which is in memory once, behind other steps.
        self.letters = Tokenizer(self.whole.model)
        self.letters.add_tokens([*self.whole.get_added_tokens_decoder().values()])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.whole.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[n for token, n in vocabulary.items() if token.endswith("</w>")]] = True

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, without an end id; none for a NULL."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        counts = pc.list_value_length(words).to_numpy()
        coded = words.flatten().dictionary_encode()
        del words
        if not len(coded):
            return [np.empty(0, np.uint32)] * len(texts)
        pool, lengths = self._distinct(coded.dictionary)
        ids, sizes = _gathered(pool, lengths, coded.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and how many each has."""
        found = pc.extract_regex(words, self.PLAIN)
        plain = found.is_valid()
        found, other = found.filter(plain), words.filter(pc.invert(plain))
        letters = pc.utf8_lower(found.field("letters")).dictionary_encode()
        tails = found.field("tail").dictionary_encode()
        pools = [
            self._encode_letters(letters.dictionary),
            self._encode_whole(tails.dictionary),
            self._encode_whole(other),
        ]
        sizes = [len(p[1]) for p in pools]
        # The last entry is empty, the second part of words that have one only.
        pool, lengths = (np.concatenate(x) for x in zip(*pools, (pools[0][0][:0], np.zeros(1, np.int64))))
        parts = np.empty((len(words), 2), np.int64)
        is_plain = plain.to_numpy(zero_copy_only=False)
        parts[is_plain, 0] = letters.indices.to_numpy()
        parts[is_plain, 1] = tails.indices.to_numpy() + sizes[0]
        parts[~is_plain, 0] = np.arange(sizes[2]) + sizes[0] + sizes[1]
        parts[~is_plain, 1] = sum(sizes)
        ids, both = _gathered(pool, lengths, parts.reshape(-1))
        return ids, both.reshape(-1, 2).sum(axis=1)

    def _encode_whole(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        out, lengths = [np.empty(0, np.uint32)], []
        for first in range(0, len(words), 1000):
            some = words.slice(first, 1000).cast(pa.large_binary()).to_pylist()
            texts = [w.decode("utf-8", "replace") for w in some]
            for code in self.whole.encode_batch_fast(texts, add_special_tokens=False):
                out.append(np.array(code.ids, np.uint32))
                lengths.append(len(out[-1]))
        return np.concatenate(out), np.array(lengths, np.int64)

    def _encode_letters(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        out, lengths = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for first in range(0, len(words), 1000):
            some = words.slice(first, 1000)
            code = self.letters.encode_batch_fast([" ".join(some.to_pylist())], add_special_tokens=False)[0]
            ids = np.array(code.ids, np.uint32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(some):  # not a vocabulary that marks word ends
                ids, sizes = self._encode_whole(some)
            else:
                sizes = np.diff(ends, prepend=0)
            out.append(ids)
            lengths.append(sizes)
        return np.concatenate(out), np.concatenate(lengths)


def _gathered(pool: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What stands in ``pool`` for each of the codes, in turn, and how much."""
    begins = (np.cumsum(lengths) - lengths).astype(np.int32)
    sizes = lengths[codes]
    where = np.repeat(begins[codes] - (np.cumsum(sizes) - sizes), sizes)
    where += np.arange(len(where))
    return pool[where], sizes


def token_pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece: its document, place in it, length and checksum.

    A document's ids are its text's and then the end id; NULL counts as an empty
    text, which leaves the end id alone. ``with_ids`` adds the ids themselves.
    """
    path = tokenizer or default_tokenizer()
    encoders: dict[str, WordEncoder] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in encoders:
            # Spark runs as many tasks as there are cores.
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            encoders[path] = WordEncoder(path)
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= ENCODE_BYTES:
                yield cut(pa.Table.from_batches(held))
                held = []
        if held:
            yield cut(pa.Table.from_batches(held))

    def cut(rows: pa.Table) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        texts = rows["text"].combine_chunks()
        for owner, ids in zip(rows["doc_id"].to_pylist(), encoders[path].ids(texts)):
            ids = np.append(ids, END_ID).astype("<u4")
            for number, start in enumerate(range(0, len(ids), capacity)):
                part = ids[start : start + capacity]
                out["doc_id"].append(owner)
                out["piece"].append(number)
                out["start"].append(start)
                out["length"].append(len(part))
                out["ids_crc32"].append(zlib.crc32(part.tobytes()))
                if with_ids:
                    out["ids"].append(part.astype(np.int32))
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(out["doc_id"], pa.int64()),
                "piece": pa.array(out["piece"], pa.int32()),
                **{k: pa.array(out[k], pa.int64()) for k in ("start", "length", "ids_crc32")},
                **({"ids": pa.array(out["ids"], pa.list_(pa.int32()))} if with_ids else {}),
            }
        )

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


# ---------------------------------------------------------------- the plan


@dataclass
class Plan:
    """Where pieces go: rank ``first`` .. ``last`` - 1 of a length, ``each`` to a
    sequence from ``sequence`` on, the first of each at ``offset``."""

    rows: list[tuple[int, int, int, int, int, int]]
    sequences: int
    fixed: int  # sequences the reduction has fixed

    def arrays(self) -> dict[str, np.ndarray]:
        rows = np.array(sorted(self.rows), np.int64).reshape(-1, 6)
        names = ("length", "first", "last", "sequence", "each", "offset")
        return {name: rows[:, k] for k, name in enumerate(names)}


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Dominance reduction (Martello and Toth), then best fit in falling order.

    The reduction takes the longest length j left, and k, the longest that fits
    beside it. The sequence {j, k} is at least as good as any other that holds
    a j, if j and k fill it, if no two pieces fit beside j, or if the two
    largest that fit there together are no longer than k: they can change
    places with k. {j} alone is fixed where nothing fits beside it. Where none
    of this holds, j is left to best fit. Equal lengths are treated at once.
    """
    left = {int(n): int(c) for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(left, 0)
    plan = Plan([], 0, 0)

    def put(length: int, n: int, sequence: int, each: int, offset: int) -> None:
        plan.rows.append((length, used[length], used[length] + n, sequence, each, offset))
        used[length] += n
        left[length] -= n

    lengths = sorted(left)
    for j in reversed(lengths):
        while left[j]:
            partner, times = _dominant(j, left, lengths, capacity)
            if not times:
                break
            put(j, times, plan.sequences, 1, 0)
            if partner:
                put(partner, times, plan.sequences, 1, j)
            plan.sequences += times
    plan.fixed = plan.sequences

    # Open sequences by the room they have left: runs (first sequence, count).
    rooms: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []

    def leave(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in rooms:
                rooms[room] = []
                bisect.insort(order, room)
            rooms[room].append((first, count))

    for length in reversed(lengths):
        while left[length]:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                room, count = capacity, -(-left[length] // (capacity // length))
                first, plan.sequences = plan.sequences, plan.sequences + count
            else:
                room = order[at]
                first, count = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], order[at]
            each = room // length
            full = min(count, left[length] // each)
            if full:
                put(length, full * each, first, each, capacity - room)
                leave(room - each * length, first, full)
            if full < count:
                rest = left[length]
                if rest:
                    put(length, rest, first + full, rest, capacity - room)
                    leave(room - rest * length, first + full, 1)
                leave(room, first + full + bool(rest), count - full - bool(rest))
    return plan


def _dominant(
    j: int, left: dict[int, int], lengths: list[int], capacity: int
) -> tuple[int, int]:
    """The partner of a fixed sequence (0 for none) and how often; (0, 0) if none."""
    room = capacity - j

    def count(length: int) -> int:
        return left[length] - (length == j)

    fitting = [n for n in lengths[: bisect.bisect_right(lengths, room)] if count(n) > 0]
    if not fitting:
        return 0, left[j]
    k = fitting[-1]
    times = left[j] // 2 if k == j else min(left[j], left[k])
    # Taking pieces away never lets more of them fit, so what holds once holds
    # for all of these times.
    smallest = [n for n in fitting[:3] for _ in range(min(3, count(n)))][:3]
    if k == room or len(smallest) < 2 or sum(smallest[:2]) > room:
        return k, times
    if len(smallest) < 3 or sum(smallest) > room:
        pair = 0
        for n in fitting:
            at = bisect.bisect_right(fitting, room - n) - 1
            while at >= 0 and fitting[at] == n and count(n) < 2:
                at -= 1
            if at >= 0:
                pair = max(pair, n + fitting[at])
        if k >= pair:
            return k, times
    return 0, 0


# ---------------------------------------------------------------- packing


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """Each piece with its ``sequence_id`` and ``offset`` in it.

    Ranks within a length come from two steps, counts by (written part, length)
    and row numbers within those, so that a length which a third of all pieces
    have is numbered in as many tasks as there are parts. The plan, a few rows
    for each length, goes to every task; its size has that bound.

    NULL texts count as empty, repeated rows and NULL ids as documents of their
    own; an empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = token_pieces(docs, tokenizer, capacity, with_ids)
    pieces = materialize(spark, pieces.withColumn("part", F.spark_partition_id()), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(spark, counts, "lengths")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    places = plan_packing(histogram, capacity).arrays()
    keys = (places["length"] << 44) + places["first"]

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("part", "length").orderBy("doc_id", "piece")
    ranked = (
        pieces.withColumn("rank", F.row_number().over(within) - 1)
        .join(counts, ["part", "length"])
        .withColumn("rank", F.col("rank") + F.col("before"))
        .drop("part", "before")
    )

    def place(batch: pa.RecordBatch):
        length = batch.column("length").to_numpy()
        rank = batch.column("rank").to_numpy()
        row = np.searchsorted(keys, (length << 44) + rank, "right") - 1
        nth = rank - places["first"][row]
        each = places["each"][row]
        yield {
            **{n: batch.column(n) for n in batch.schema.names if n != "rank"},
            "sequence_id": pa.array(places["sequence"][row] + nth // each),
            "offset": pa.array(places["offset"][row] + nth % each * length),
        }

    columns = [c for c in pieces.columns if c != "part"]
    types = dict(pieces.dtypes)
    ranked = ranked.select(*columns, F.col("rank").cast("long").alias("rank"))
    schema = ", ".join(f"{c} {types[c]}" for c in columns)
    return arrow_map(ranked, place, f"{schema}, sequence_id bigint, offset bigint")
