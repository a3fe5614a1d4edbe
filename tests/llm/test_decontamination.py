import hashlib
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from landfall.llm import decontamination as dc
from landfall.llm.common import words_of
from landfall.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import FOLDER

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, width=13):
    grams = {}
    for item, text in items:
        if item is None:
            continue
        words = plain_words(text)
        for k in range(max(1, len(words) - width + 1) if words else 0):
            grams.setdefault(tuple(words[k : k + width]), set()).add(str(item))
    out = []
    for owner, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(words) - n + 1):
                for item in grams.get(tuple(words[k : k + n]), ()):
                    found.add(item)
                    hit.update(range(k, k + n))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        bad = len(hit) > 0 and 20 * len(hit) >= len(words)
        out.append((owner, len(words), len(hit), len(found), digest, bad))
    return sorted(out, key=str)


def found_rows(frame):
    frame = frame.withColumn("n_hit", dc.n_hit()).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items"),
        F.sha2(F.array_join("items", ","), 256),
        dc.is_contaminated(F.col("n_words"), F.col("n_hit")),
    )
    return sorted(map(tuple, frame.collect()), key=str)


def test_query_matches_brute_force(session):
    docs = [(r["doc_id"], r["text"]) for r in session.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in session.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    found = QUERIES["op5_benchmark_decontamination"](session, FOLDER).collect()
    expected = brute_force(docs, items)
    assert sorted(map(tuple, found), key=str) == expected
    assert sum(row[-1] for row in expected) > 0


LONG = " ".join(f"w{k}" for k in range(40))
ITEMS = [
    (1, LONG),
    (2, "Short item, of six words!"),
    (2, "another text of item two"),
    (3, "..."),
    (4, None),
    (None, "no id no result"),
    (5, " ".join(["same"] * 14)),
    (10, " ".join(f"w{k}" for k in range(20, 40))),
]
ROWS = [
    (1, None),
    (2, ""),
    (3, " ".join(f"w{k}" for k in range(5, 18))),
    (3, " ".join(f"w{k}" for k in range(5, 18))),
    (4, " ".join(f"w{k}" for k in range(5, 17))),
    (5, "so SHORT\nitem of-six words " + "pad " * 200),
    (6, "same " * 30),
    (7, "w1 " * 20 + LONG + " " + "w2 " * 9000 + LONG),
    (None, LONG),
    (8, "w0"),
]


def test_spans_and_items(session, docs):
    items = session.createDataFrame(ITEMS, "item_id long, text string")
    assert found_rows(dc.find_items(docs(ROWS), items)) == brute_force(ROWS, ITEMS)


def test_many_small_slices_and_segments_agree(session, docs, monkeypatch):
    items = session.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(dc, "SLICE_BYTES", 60)
    slices = list(dc.test_slices(items, 60))
    assert len(slices) > 3 and sum(map(len, slices)) == 6
    monkeypatch.setattr(dc, "test_slices", lambda benchmark: slices)
    assert found_rows(dc.find_items(docs(ROWS), items)) == brute_force(ROWS, ITEMS)


def test_index_is_split_into_segments(session, docs):
    index = dc.build_index(docs([(k, "a b c " * 50) for k in range(20)]).repartition(1), segment_words=400)
    assert index.count() == 10
    phrases = dc.phrases_of([("x", b"c a b c")], None)
    assert dc.term_counts(index, phrases).tolist() == [1000, 1000, 1000]
    found = dc.search_phrases(index, phrases).withColumn("n_hit", dc.n_hit())
    assert {(r["n_words"], r["n_hit"]) for r in found.collect()} == {(150, 148)}


def test_words_near_each_other(session, docs):
    rows = [(1, "the quick x x fox"), (2, "fox quick"), (3, "quick " + "x " * 9 + "fox"), (4, "quick"), (None, "fox quick")]
    index = dc.build_index(docs(rows))
    found = dc.search_near(index, dc.phrases_of([("q", b"quick fox")], None), reach=4).collect()
    assert {(r["doc_id"], r["item"]) for r in found} == {(1, "q"), (2, "q"), (None, "q")}


def test_clean_documents_stay(session, docs):
    items = session.createDataFrame(ITEMS, "item_id long, text string")
    kept = dc.decontaminate(docs(ROWS), items)
    assert kept.columns == docs([]).columns
    numbered = [(k, text) for k, (_, text) in enumerate(ROWS)]
    bad = {row[0] for row in brute_force(numbered, ITEMS) if row[-1]}
    expected = [row for k, row in enumerate(ROWS) if k not in bad]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(expected, key=str)


def test_rows_of_one_id_and_of_none_are_judged_by_their_texts(session, docs):
    items = session.createDataFrame([(1, "b c d e f g")], "item_id long, text string")
    dirty, clean = "a b c d e f g h", "some other words"
    rows = [(1, dirty), (1, clean), (None, dirty), (None, clean), (2, dirty), (None, None), (3, "")]
    kept = dc.decontaminate(docs(rows), items).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, clean), (None, clean), (None, None), (3, "")], key=str)


def test_nothing_to_search(session, docs):
    empty = session.createDataFrame([], "item_id long, text string")
    assert found_rows(dc.find_items(docs(ROWS[:4]), empty)) == brute_force(ROWS[:4], [])
    items = session.createDataFrame(ITEMS, "item_id long, text string")
    assert dc.find_items(docs([]), items).count() == 0
    assert dc.decontaminate(docs([]), items).count() == 0


def test_words_match_the_pattern():
    text = "A-b 9\u0080 é 日 Z_z\x7f\x00q"
    assert [w.decode() for w in words_of(text.encode())] == plain_words(text)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_names_a_query(name):
    assert name in QUERIES


def test_the_index_is_written_in_small_groups(session):
    """A task does not hold a hundred segments before it writes the first."""
    words = "concat_ws(' ', transform(sequence(1, 16000), x -> hex(xxhash64(id, x)))) AS text"
    index = dc.build_index(session.range(0, 120, 1, 1).selectExpr("id AS doc_id", words), segment_words=16000)
    files = [pq.ParquetFile(Path(f.removeprefix("file:"))).metadata for f in index.inputFiles()]
    assert sum(f.num_rows for f in files) == 120
    assert max(f.row_group(k).num_rows for f in files for k in range(f.num_row_groups)) < 100
