"""The subpackage's queries against their check SQL, and the pipeline against a brute-force version."""

import os
import re

import pytest

from stayline.llm.queries import QUERIES, SQL
from tools.check import compare, oracle_connection

FOLDER = f"/root/testdata/sf{os.environ.get('STAYLINE_SF', '0.001')}"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


def test_leaks_against_verbatim_search(spark):
    norm = lambda t: " ".join(re.findall(r"[^\W_]+", (t or "").casefold()))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if norm(i.text) in norm(d.text)}
    assert {(r.doc_id, r.item_id) for r in QUERIES["op3_benchmark_leaks"](spark, FOLDER).collect()} >= want


def test_pipeline(spark):
    import corpus_pipeline as pipe
    from tests.llm.test_similar import brute

    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs, results = source, []
    for _, stage in pipe.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        results.append({r.doc_id: r for r in docs.collect()})
    spoken, exact, near, clean, coded = results
    assert len(spoken) >= 0.97 * source.count()
    first = {}
    for i in sorted(spoken):
        first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", spoken[i].text or ""), i)
    assert set(exact) == set(first.values())
    groups = brute([(i, r.text) for i, r in exact.items()], pipe.SHINGLE, pipe.PERCENT)
    assert set(near) == {i for i, (_, root) in groups.items() if i == root}
    norm = lambda t: " ".join(re.findall(r"[^\W_]+", (t or "").casefold()))
    items = [norm(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert set(clean) == {i for i, r in near.items() if not any(t in norm(r.text) for t in items)}
    assert set(coded) == set(clean) and all(r.round_trip for r in coded.values())
    assert all(r.asDict().keys() == set(source.columns) for r in clean.values())
    assert {r.doc_id for r in pipe.run(spark, FOLDER).collect()} == set(coded)


def test_stages_on_odd_tables(spark):
    import corpus_pipeline as pipe

    rows = [(1, None, None), (2, "", None), (3, "12 34", None), (4, "one two three four five six", "en"), (4, "one two three four five six", "en"), (None, "one two three four five six seven", "en")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'s' AS source", "0L AS n_chars", "1 AS score", "'x' AS row_key", "2 AS keep_id")
    for table, left in ((odd, None), (odd.limit(0), 0)):
        docs = table
        for _, stage in pipe.STAGES[:-1]:
            docs = stage(spark, docs, FOLDER)
            assert docs.columns == odd.columns
        final = pipe.STAGES[-1][1](spark, docs, FOLDER).collect()
        assert left is None or len(final) == left
    ids = [r.doc_id for r in pipe.exact_copies(spark, odd, FOLDER).collect()]
    assert sorted(ids, key=str) == [1, 3, 4, None]
