"""Byte-level BPE ids of whole texts by replaying merges over a corpus of words.

Texts are split by the tokenizer's pattern. Their distinct words stand one after
the other in one row of symbols, at first single bytes. An inverted index has,
for each merge, the places whose pair of neighbours it joins. Merges are applied
in the order of their ranks, each at all of its places at once, and only the
pairs left and right of a joined place change and are entered anew. Then each
text's ids are those of its words in turn.

A worker replays the words of some megabytes of text at a time, and remembers
the ids of the words it has seen, up to a bound. No text moves between workers.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Bytes of text whose words are replayed together.
REPLAY_BYTES = 32 << 20
# Distinct words whose ids a worker remembers.
CACHE_WORDS = 400_000
NONE = np.int32(2**31 - 1)

ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """A rank file: base64 of each token's bytes and its id, a token a line.

    Read by Spark, so the file may lie on any storage; a vocabulary has a fixed,
    small size.
    """
    lines = spark.read.text(path).where("value != ''").collect()
    return {base64.b64decode(a): int(b) for a, b in (r["value"].split() for r in lines)}


# Characters up to U+017F by Unicode category, as parts of a character class. No
# version of Unicode moves them. Fixed values.
LAST_LATIN = "\u017f"
LATIN = {
    r"\p{L}": "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f",
    r"\p{N}": "0-9\u00b2\u00b3\u00b9\u00bc-\u00be",
    r"\s": "\t-\r \u0085\u00a0",
}
CLASS = re.compile(r"(\[(?:\\.|[^\]\\])*\])")


def latin_pattern(pattern: str) -> str | None:
    """The pattern for texts of Latin letters, without Unicode properties.

    The standard library's engine is three times as fast, but knows none of the
    properties. None where the pattern has others than those of ``LATIN``.
    """
    made = []
    for n, part in enumerate(CLASS.split(pattern)):
        for name, members in LATIN.items():
            part = part.replace(name, members if n % 2 else f"[{members}]")
        if n % 2 == 0:
            part = part.replace(r"\S", f"[^{LATIN[r'\s']}]")
        made.append(part)
    whole = "".join(made)
    return None if re.search(r"\\[pPsSdDwW]", whole) else whole


@functools.cache
def younger_letters() -> str:
    """Letters and numbers, as a character class, that the token library does not know.

    It has an older version of Unicode than the pattern engine used here, which
    takes such characters for letters; asked, it tells by the tokens it makes.
    """
    import regex
    import tiktoken

    known = regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, [*range(0x180, 0xD800), *range(0xE000, 0x110000)])))
    ids = {bytes([b]): b for b in range(256)}
    ids |= {b"\0" + c.encode(): 256 + n for n, c in enumerate(known)}
    probe = tiktoken.Encoding(
        "probe", pat_str=r"\x00[\p{L}\p{N}]|[\s\S]", mergeable_ranks=ids, special_tokens={}
    )
    found = set(probe.encode_ordinary("".join("\0" + c for c in known)))
    codes = [ord(c) for n, c in enumerate(known) if 256 + n not in found]
    bounds = [k for k, c in enumerate(codes) if not k or codes[k - 1] != c - 1]
    spans = [(codes[a], codes[b - 1]) for a, b in zip(bounds, [*bounds[1:], len(codes)])]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


def wide_pattern(pattern: str) -> str:
    """The pattern for any text, by the token library's letters and numbers."""
    younger = younger_letters()
    if not younger:
        return pattern
    for name in (r"\p{L}", r"\p{N}"):
        pattern = pattern.replace(name, f"[{name}--[{younger}]]")
    return "(?V1)" + pattern


class MergeReplay:
    """Ids of words by the merges of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {n: token for token, n in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.width = max(ranks.values()) + 1
        pairs = {
            ranks[token[:k]] * self.width + ranks[token[k:]]: n
            for token, n in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        self.keys = np.array(sorted(pairs), np.int64)
        self.joined = np.array([pairs[k] for k in self.keys.tolist()], np.int32)

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What each pair of ids becomes, or NONE."""
        key = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.joined[at], NONE)

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word. A word that is a token is that token."""
        known = [self.ranks.get(w) for w in words]
        out = [np.array([n], np.int32) if n is not None else None for n in known]
        rest = [k for k, n in enumerate(known) if n is None and words[k]]
        for k, ids in zip(rest, self._replay([words[k] for k in rest])):
            out[k] = ids
        return [np.empty(0, np.int32) if ids is None else ids for ids in out]

    def _replay(self, words: list[bytes]) -> list[np.ndarray]:
        if not words:
            return []
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        ids = self.byte_ids[raw]
        places = np.arange(len(raw))
        after, before = places + 1, places - 1
        after[ends - 1] = -1
        before[np.concatenate([[0], ends[:-1]])] = -1
        pair = np.full(len(raw), NONE, np.int32)
        inner = np.flatnonzero(after >= 0)
        pair[inner] = self.merge_of(ids[inner], ids[inner + 1])
        alive = np.ones(len(raw), bool)
        early: list[np.ndarray] = []

        index: defaultdict[int, list[np.ndarray]] = defaultdict(list)

        def enter(at: np.ndarray) -> None:
            """Add places, each under the merge of its pair."""
            merges = pair[at]
            order = np.argsort(merges, kind="stable")
            merges, at = merges[order], at[order]
            cuts = np.flatnonzero(merges[1:] != merges[:-1]) + 1
            firsts = merges[np.concatenate([[0], cuts])].tolist()
            for merge, some in zip(firsts, np.split(at, cuts) if len(cuts) else [at]):
                index[merge].append(some)

        inner = inner[pair[inner] != NONE]
        if len(inner):
            enter(inner)
        for merge in range(self.width):
            lists = index.pop(merge, None)
            if lists is None:
                continue
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[alive[at] & (pair[at] == merge)]
            if not len(at):
                continue
            # Of pairs that overlap in a run, the first, the third and so on.
            overlaps = after[at[:-1]] == at[1:]
            if overlaps.any():
                steps = np.arange(len(at))
                begins = np.maximum.accumulate(np.where(np.concatenate([[True], ~overlaps]), steps, 0))
                at = at[(steps - begins) % 2 == 0]
            gone = after[at]
            following = after[gone]
            # Between two neighbours joined at once, the first one's pair with
            # what the second began with comes and goes.
            besides = at[:-1][following[:-1] == at[1:]]
            if len(besides):
                passing = self.merge_of(np.full(len(besides), merge), ids[after[after[besides]]])
                if (passing < merge).any():
                    early.append(besides[passing < merge])
            ids[at] = merge
            alive[gone] = False
            after[at] = following
            inner = following >= 0
            before[following[inner]] = at[inner]
            pair[at] = NONE
            left = before[at]
            left = left[left >= 0]
            touched = np.concatenate([at[inner], left])
            if len(touched):
                fresh = self.merge_of(ids[touched], ids[after[touched]])
                pair[touched] = fresh
                if (fresh < merge).any():
                    early.append(touched[fresh < merge])
                kept = fresh != NONE
                if kept.any():
                    enter(touched[kept])
        left_over = np.flatnonzero(alive)
        bounds = np.searchsorted(left_over, np.concatenate([[0], ends]))
        final = ids[left_over]
        out = [final[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        # A word where a merge made a pair of lower rank has its own order.
        for k in np.unique(np.searchsorted(ends, np.concatenate(early), "right")) if early else ():
            out[k] = self._one_by_one(words[k])
        return out

    def _one_by_one(self, word: bytes) -> np.ndarray:
        """Ids of a word, joining the first pair of least rank until none is left."""
        parts = [word[k : k + 1] for k in range(len(word))]
        while True:
            found = [(self.ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]
            if not found:
                return np.array([self.ranks[p] for p in parts], np.int32)
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]


class TextEncoder:
    """Ids of whole texts; remembers words from one call to the next."""

    def __init__(self, ranks: dict[bytes, int], wide: str, latin: str | None):
        import regex

        self.replay = MergeReplay(ranks)
        self.wide = regex.compile(wide).findall
        self.latin = re.compile(latin).findall if latin else None
        self.beyond = re.compile(f"[^\\x00-{LAST_LATIN}]").search
        self.forget()

    def split(self, text: str) -> list[str]:
        """The words of a text: all matches of the pattern."""
        if self.latin is None or self.beyond(text):
            return self.wide(text)
        return self.latin(text)

    def forget(self) -> None:
        self.numbers: defaultdict[str, int] = defaultdict(count().__next__)
        self.begins = np.zeros(1, np.int64)
        self.pool = np.empty(0, np.int32)

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text."""
        if len(self.numbers) > CACHE_WORDS:
            self.forget()
        known, number = len(self.numbers), self.numbers.__getitem__
        codes = [np.fromiter(map(number, self.split(t)), np.int32) for t in texts]
        words = [w.encode() for k, w in enumerate(self.numbers) if k >= known]
        lists = self.replay.encode(words)
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        self.pool = np.concatenate([self.pool, *lists])
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(lengths)])
        for code in codes:
            sizes = self.begins[code + 1] - self.begins[code]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            yield self.pool[np.repeat(self.begins[code] - (ends - sizes), sizes) + np.arange(total)]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.replay.tokens.__getitem__, ids.tolist()))


@functools.lru_cache(maxsize=2)
def _encoder(ranks: tuple, wide: str, latin: str | None) -> TextEncoder:
    """One encoder for each vocabulary in a worker, whatever tasks it runs."""
    return TextEncoder(dict(ranks), wide, latin)


def encode_texts(
    docs: DataFrame,
    function: Callable[[TextEncoder, np.ndarray], tuple],
    schema: str,
    ranks: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """What ``function`` makes of the ids of each row's ``text``, beside its ``doc_id``.

    A NULL text counts as an empty one, which has no ids. Texts are taken whole,
    however long; rows that repeat, or have a NULL ``doc_id``, are each encoded.
    Other columns are left out. ``ranks`` is a rank file, ``pattern`` what splits
    texts into words.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(tuple(read_ranks(spark, ranks or default_ranks()).items()))
    pattern = pattern or default_pattern()
    patterns = wide_pattern(pattern), latin_pattern(pattern)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(table.value, *patterns)

        def encode(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            texts = [t or "" for t in rows["text"].to_pylist()]
            made = [function(encoder, ids) for ids in encoder.ids(texts)]
            columns = [rows["doc_id"].to_pylist(), *zip(*made)]
            return pa.RecordBatch.from_pydict(dict(zip(arrow.names, map(list, columns))), schema=arrow)

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size >= REPLAY_BYTES:
                yield encode(held)
                held, size = [], 0
        if held:
            yield encode(held)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _digests(encoder: TextEncoder, ids: np.ndarray) -> tuple[int, str, str]:
    return (
        len(ids),
        hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
        hashlib.sha256(encoder.decode(ids)).hexdigest(),
    )


def round_trip(docs: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """Count and hash of each text's ids, and the hash of what they decode to."""
    return encode_texts(docs, _digests, ENCODED, ranks, pattern)


def token_ids(docs: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """The ids of each text: ``doc_id``, ``ids``."""
    return encode_texts(
        docs, lambda _, ids: (ids.tolist(),), "doc_id long, ids array<int>", ranks, pattern
    )


def decoded_texts(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """The text of each row's ``ids``: ``doc_id``, ``text``; no ids give an empty one.

    Bytes that are no UTF-8, as ids cut from a longer text may give, become the
    replacement character; an id that is no token stops the job.
    """
    spark = encoded.sparkSession
    table = spark.sparkContext.broadcast(read_ranks(spark, ranks or default_ranks()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {n: token for token, n in table.value.items()}
        for batch in batches:
            texts = [
                b"".join(map(tokens.__getitem__, ids or ())).decode("utf-8", "replace")
                for ids in batch["ids"].to_pylist()
            ]
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
