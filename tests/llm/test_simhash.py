import random
import re

import pytest
from pyspark.sql import functions as F

from landfall.llm import simhash
from landfall.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, components_of

xxhash = pytest.importorskip("xxhash")


def plain_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows):
    prints = {i: plain_print(t) for i, t in rows}
    ids = list(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    return prints, components_of(links, ids)


def test_query_matches_brute_force(session):
    rows = [(r["doc_id"], r["text"]) for r in session.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    prints, roots = expected(rows)
    found = QUERIES["op8_simhash_near_dedup"](session, FOLDER).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in found} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in found} == roots


def test_words_and_short_texts():
    for text in ("", " \x0b\n", "One", "ONE two three", "a b  c D É", "x " * 70000):
        assert simhash.fingerprint(text.encode()) == plain_print(text)


@pytest.mark.parametrize("count", [1, 10**6, 10**9, 10**12, 10**15])
def test_near_prints_share_a_mask(count):
    masks = simhash.block_masks(simhash.blocks_for(count))
    rng = random.Random(1)
    for _ in range(300):
        change = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not change & m for m in masks)


def test_large_groups_are_split(session):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    prints = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(400)}
    prints |= {rng.getrandbits(64) for _ in range(100)}
    prints = sorted(prints)
    links = [
        (i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4
    ]
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    frame = session.createDataFrame(rows, "rep long, fp long")
    for block in (16, 64, 4096):
        found = [(r["a"], r["b"]) for r in simhash.near_links(frame, block=block).collect()]
        assert components_of(found, range(len(prints))) == components_of(links, range(len(prints)))
        assert len(found) < 40 * len(prints)


def test_odd_rows(session, docs):
    rows = [(5, None), (3, ""), (9, "a b c d e"), (9, "a b c d e"), (4, "A b\tc D e"), (None, "a b c d e"), (None, None)]
    found = simhash.near_duplicates(docs(rows)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(5, 3), (3, 3), (9, 4), (9, 4), (4, 4), (None, None), (None, None)], key=str
    )
    kept = simhash.keep_one(docs(rows)).select("doc_id").collect()
    assert sorted((r[0] for r in kept), key=str) == [3, 4, None, None]
    kept = simhash.keep_one(docs([(1, "x y"), (1, "x y"), (2, "x  y")])).collect()
    assert [(r["doc_id"], r["host"]) for r in kept] == [(1, "x")]


def test_an_id_on_several_texts_is_several_documents(session, docs):
    one, two = " ".join(f"a{k}" for k in range(300)), " ".join(f"b{k}" for k in range(300))
    rows = [(5, one), (5, two), (7, one + " "), (8, two + " "), (5, "other words stand here"), (1, one), (1, one)]
    kept = simhash.keep_one(docs(rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept)) == sorted([(1, one), (5, two), (5, "other words stand here")])
    found = simhash.near_duplicates(docs(rows)).collect()
    assert {r["component_id"] for r in found if r["doc_id"] in (7, 8)} == {1, 5}


def test_no_documents(session, docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.keep_one(docs([])).count() == 0


def test_hex(session):
    frame = session.createDataFrame([(0,), (-1,), (255,)], "fp long")
    shown = [r[0] for r in frame.select(simhash.hex_print().alias("h")).orderBy(F.col("fp")).collect()]
    assert shown == ["f" * 16, "0" * 16, "0" * 14 + "ff"]
