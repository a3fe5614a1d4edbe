import random
import zlib
from collections import Counter

import numpy as np
import pytest

from landfall.llm import packing

tokenizers = pytest.importorskip("tokenizers")

ODD = [
    "It's a dog's; don't! we'LL <|endoftext|>foo a\x1cb ΣΑΣ İstanbul é ﬁ １２ a1b2 %%% 日本語 x\x85y ŉ ſ ª µ ß ǅ",
    "",
    "  \n\t ",
    "word,\"' (foo) [bar] <tag> a_b `x` ~y {z}| 's 't'",
    "x" * 5000 + " " + "ab " * 6000,
]


@pytest.fixture(scope="module")
def whole():
    return tokenizers.Tokenizer.from_file(packing.default_tokenizer())


def test_word_by_word_ids_are_those_of_whole_texts(whole):
    import pyarrow as pa

    rng = random.Random(3)
    letters = "aAzéÉßñÑ'’.,!<|>_-^`~{}[]()&%$#@ \t\n1٣ΣσİıŁłǅ日́ \x1c\x85"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(50)) for _ in range(500)]
    ids = packing.WordEncoder(packing.default_tokenizer()).ids(pa.array([*texts, None]))
    for text, found in zip(texts, ids):
        assert found.tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(ids[-1]) == 0


def test_encoder_keeps_nothing_between_calls():
    """A worker's memory must not grow with the number of distinct words."""
    import tracemalloc

    import pyarrow as pa

    encoder = packing.WordEncoder(packing.default_tokenizer())
    rng = random.Random(4)
    encoder.ids(pa.array(["warm up!"]))
    tracemalloc.start()
    for _ in range(3):
        words = ["".join(rng.choices("abcdefghijklmnop", k=9)) + "." for _ in range(20_000)]
        encoder.ids(pa.array([" ".join(words)]))
        del words
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 1 << 20


def test_latin_letters_are_encoded_as_in_a_text(whole):
    import pyarrow as pa

    words = [f"a{chr(letter)}B," for letter in range(0xC0, 0x180)]
    ids = packing.WordEncoder(packing.default_tokenizer()).ids(pa.array(words))
    for word, found in zip(words, ids):
        assert found.tolist() == whole.encode(word, add_special_tokens=False).ids


def check_plan(sizes, capacity):
    plan = packing.plan_packing(Counter(sizes), capacity)
    sequences = {}
    for length, first, last, sequence, each, offset in plan.rows:
        for k in range(last - first):
            place = offset + k % each * length
            sequences.setdefault(sequence + k // each, []).append((place, length))
    assert sorted(n for s in sequences.values() for _, n in s) == sorted(sizes)
    for pieces in sequences.values():
        at = 0
        for place, length in sorted(pieces):
            assert place == at
            at += length
        assert at <= capacity
    assert len(sequences) == plan.sequences
    return plan


@pytest.mark.parametrize("seed", range(60))
def test_plans_are_valid_and_near_the_bound(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 50, 100])
    low = rng.choice([1, 1, capacity // 3])
    sizes = [rng.randint(low, capacity) for _ in range(rng.randint(0, 60))]
    plan = check_plan(sizes, capacity)
    assert plan.sequences <= max(1, 1.25 * -(-sum(sizes) // capacity)) + 1 or low > 1


def smallest(sizes, capacity):
    """Fewest sequences, by search."""
    sizes = sorted(sizes, reverse=True)
    best = [len(sizes)]

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(rooms)
            return
        for at in {room: i for i, room in enumerate(rooms) if room >= sizes[k]}.values():
            go(k + 1, rooms[:at] + [rooms[at] - sizes[k]] + rooms[at + 1 :])
        go(k + 1, rooms + [capacity - sizes[k]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(40))
def test_reduction_keeps_an_optimum(seed):
    """What is fixed leaves a rest that still reaches the fewest sequences."""
    rng = random.Random(seed)
    capacity = 20
    sizes = [rng.randint(rng.choice([1, 5]), capacity) for _ in range(9)]
    plan = check_plan(sizes, capacity)
    rest = Counter(sizes)
    for length, first, last, sequence, _, _ in plan.rows:
        if sequence < plan.fixed:
            rest[length] -= last - first
    assert plan.fixed + smallest(list(rest.elements()), capacity) == smallest(sizes, capacity)


def test_counts_in_the_billions_are_no_more_work():
    plan = packing.plan_packing({3000: 10**9, 1096: 10**9, 7: 5 * 10**9, 1: 3})
    assert len(plan.rows) < 20
    assert plan.fixed == 10**9


def test_documents_are_packed_whole(session, docs, whole):
    rows = [(k, text) for k, text in enumerate(ODD)] + [(7, None), (8, "same"), (8, "same"), (None, "no id")]
    found = packing.pack(docs(rows), with_ids=True).toPandas()
    expected = Counter()
    for owner, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start : start + 4096], "<u4")
            expected[owner, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    got = Counter(
        (None if np.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)
        for r in found.itertuples()
    )
    assert got == expected
    for _, group in found.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert (group["offset"] == group["length"].cumsum() - group["length"]).all()
        assert group["length"].sum() <= 4096
    assert found["sequence_id"].nunique() == -(-found["length"].sum() // 4096)
    assert all(len(r.ids) == r.length for r in found.itertuples())


def test_no_documents(session, docs):
    assert packing.pack(docs([])).count() == 0
