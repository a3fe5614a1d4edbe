"""The pipeline against its stages by brute force."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from landfall.llm import line_dedup, toxicity
from landfall.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import FOLDER
from tests.llm.test_decontamination import brute_force
from tests.llm.test_simhash import expected


@pytest.fixture(scope="module")
def stages(session, tmp_path_factory):
    """Each stage's rows, and those it was given."""
    folder = tmp_path_factory.mktemp("stages")
    docs = session.read.parquet(f"{FOLDER}/documents.parquet")
    out = {"documents": docs}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(session, docs, FOLDER).write.parquet(f"{folder}/{k}")
        docs = out[name] = session.read.parquet(f"{folder}/{k}")
    return out


def test_stages_are_the_five(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert list(stages) == ["documents", *names] and len(names) == 5
    columns = stages["documents"].columns
    assert all(stages[n].columns == columns for n in names[:-1])
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in ORACLES


def test_toxic_documents_go(session, stages):
    before = {r["doc_id"] for r in stages["documents"].collect()}
    after = {r["doc_id"] for r in stages["toxicity"].collect()}
    labels = session.read.parquet(f"{FOLDER}/labels.parquet")
    chain = toxicity.train(stages["documents"], labels)
    toxic = {r["doc_id"] for r in toxicity.score(stages["documents"], chain).where("toxic").collect()}
    assert toxic and after == before - toxic


def test_lines_go(stages):
    before, after = stages["toxicity"].collect(), stages["line dedup"].collect()
    pages, seen = {}, {}
    for r in before:
        pages[r["source"]] = pages.get(r["source"], 0) + 1
        for line in {x.strip(" \t\r") for x in r["text"].split("\n")} - {""}:
            seen[r["source"], line] = seen.get((r["source"], line), 0) + 1
    expect = {}
    for r in before:
        lines = [
            x
            for x in r["text"].split("\n")
            if not x.strip(" \t\r")
            or (n := seen[r["source"], x.strip(" \t\r")]) < line_dedup.LEAST_PAGES
            or n <= line_dedup.RATIO * pages[r["source"]]
        ]
        expect[r["doc_id"]] = "\n".join(lines)
    assert {r["doc_id"]: r["text"] for r in after} == expect
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_one_of_each_near_copy_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["line dedup"].collect()]
    _, roots = expected(rows)
    kept = {r["doc_id"]: r["text"] for r in stages["simhash near-dedup"].collect()}
    assert kept == {i: t for i, t in rows if roots[i] == i}
    assert len(kept) < len(rows)


def test_contaminated_documents_go(session, stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["simhash near-dedup"].collect()]
    items = [(r["item_id"], r["text"]) for r in session.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    bad = {row[0] for row in brute_force(rows, items) if row[-1]}
    kept = {r["doc_id"] for r in stages["benchmark decontamination"].collect()}
    assert bad and kept == {i for i, _ in rows} - bad


def test_what_is_left_is_packed(stages):
    left = {r["doc_id"] for r in stages["benchmark decontamination"].collect()}
    packed = stages["best-fit packing"]
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == left
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert fill.where("n > 4096").count() == 0


def test_query_runs_all_stages(session, stages):
    found = QUERIES["pipeline"](session, FOLDER)
    packed = stages["best-fit packing"]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, packed.select(columns).collect()))


def test_odd_documents_pass_all_stages(session, tmp_path):
    rows = [(1, None, None, None, None, 1), (None, "x y", "en", "s", 3, 1), (2, "", "en", "s", 0, 1), (2, "", "en", "s", 0, 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_lines int"
    for given in (rows, []):
        docs = session.createDataFrame(given, schema)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{len(given)}-{k}"
            stage(session, docs, FOLDER).write.parquet(path)
            docs = session.read.parquet(path)
        # The two empty texts and the NULL one are near copies; the NULL id stays.
        assert sorted((r["doc_id"] for r in docs.collect()), key=str) == ([1, None] if given else [])


def test_no_query_names_part_of_its_table():
    source = open(corpus_pipeline.__file__).read()
    assert not re.search(r"\.limit\(|\.sample\(", source)
