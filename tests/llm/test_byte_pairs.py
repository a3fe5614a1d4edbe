import base64
import hashlib
import random

import pytest

from landfall.llm import byte_pairs as B
from landfall.llm.queries import QUERIES

from .conftest import FOLDER

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def ranks():
    lines = open(B.default_ranks(), "rb").read().split(b"\n")
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding(
        "own", pat_str=B.default_pattern(), mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary


def encoder(ranks):
    pattern = B.default_pattern()
    return B.TextEncoder(ranks, B.wide_pattern(pattern), B.latin_pattern(pattern))


def digests(ids, text):
    raw = b"".join(n.to_bytes(4, "little") for n in ids)
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


ODD = [
    "",
    " ",
    "\n" * 2000,
    "a" * 100_000,
    "ab" * 3000 + "é" * 3001,
    "<|endoftext|> it's I'LL they've 12 34½ ²x",
    "日本語のテキスト 👩‍👩‍👧 ՘࢏\U0001e6c0 ﻿᠎​",
    "  two  spaces\t\ttabs \x1c\x1f\x85\xa0 end ",
]


def test_query_gives_the_library_s_ids_and_whole_texts(session, library):
    rows = session.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op11_byte_pair_encoding"](session, FOLDER)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    expected = sorted((r["doc_id"], *digests(library(r["text"] or ""), r["text"])) for r in rows)
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_odd_texts_nulls_and_repeated_rows(docs, library):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(3, "same"), (3, "same"), (None, "x"), (9, None)]
    found = B.round_trip(docs(rows)).collect()
    expected = [(k, *digests(library(t or ""), t)) for k, t in rows]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_empty_table(docs):
    assert B.round_trip(docs([])).collect() == []


def test_ids_decode_to_the_texts(docs):
    rows = list(enumerate(ODD))
    back = B.decoded_texts(B.token_ids(docs(rows))).collect()
    assert sorted(map(tuple, back)) == rows


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(ranks, library, seed):
    rng = random.Random(seed)
    ours = encoder(ranks)
    letters = "abcab  '\n\t\r\x0b\x0c\x1c\x85᠎​　aaéeé1²Ⅷ's'LL"
    texts = []
    for _ in range(1500):
        texts.append("".join(rng.choice(letters) for _ in range(rng.randrange(40))))
        codes = [rng.choice([rng.randrange(32, 127), rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)]) for _ in range(30)]
        texts.append("".join(map(chr, codes)))
    for text, ids in zip(texts, ours.ids(texts)):
        assert ids.tolist() == library(text)
        assert ours.decode(ids) == text.encode()


def small_vocabulary(rng):
    """Any set of joins, ranks at random: merges may make pairs of lower rank."""
    made = {bytes([b]): b for b in range(256)}
    tokens = [b"a", b"b", b"c"]
    for _ in range(14):
        joined = rng.choice(tokens) + rng.choice(tokens)
        if joined not in made:
            tokens.append(joined)
            made[joined] = 0
    ranks = rng.sample(range(256, 256 + len(tokens)), len(tokens) - 3)
    return made | dict(zip([t for t in made if len(t) > 1], ranks))


@pytest.mark.parametrize("seed", range(40))
def test_any_vocabulary(seed):
    rng = random.Random(seed)
    ranks = small_vocabulary(rng)
    library = tiktoken.Encoding("x", pat_str=r"[a-c]+|\s+", mergeable_ranks=ranks, special_tokens={})
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))) for _ in range(200)]
    found = B.MergeReplay(ranks).encode([w.encode() for w in words])
    for word, ids in zip(words, found):
        assert ids.tolist() == library.encode_ordinary(word)


def test_words_are_forgotten_and_learned_again(ranks, library, monkeypatch):
    monkeypatch.setattr(B, "CACHE_WORDS", 2)
    ours = encoder(ranks)
    for text in ["one two three", "two three four", "five", "one"]:
        assert next(ours.ids([text])).tolist() == library(text)


def test_latin_pattern_is_given_up_for_other_properties():
    assert B.latin_pattern(r"\p{Lu}+|\s") is None
    assert B.latin_pattern(r" ?[^\s\p{L}]+") is not None
