import hashlib

import pytest

from stayline.llm import exact
from stayline.llm.common import Staged, unique_name


def test_equal_up_to_white_space(docs, got):
    table = docs((5, "a \t b"), (3, "a b"), (9, " a b"), (4, None), (2, ""), (8, "a\x0b\x0c\r\nb"), (7, "a b"))
    found = got(exact.deduplicated(table), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert {k: v[:3] for k, v in found.items()} == {
        5: (3, 3, False), 3: (3, 3, True), 8: (3, 3, False), 9: (9, 1, True), 2: (2, 2, True), 4: (2, 2, False), 7: (7, 1, True)
    }
    assert found[3][3] == hashlib.sha256(b"a b").hexdigest()


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    table = spark.createDataFrame([(1, "x", "k"), (1, "x", "k"), (None, "x", "k"), (None, "y", "k")], "doc_id long, text string, keep_id string")
    rows = sorted(exact.deduplicated(table).select("doc_id", "keep_id", "group_size", "kept").collect(), key=str)
    assert [tuple(r) for r in rows] == [(1, 1, 3, True), (1, 1, 3, True), (None, 1, 3, False), (None, None, 1, True)]


def test_empty_table(docs):
    assert exact.deduplicated(docs()).count() == 0


def test_a_second_batch_meets_the_first_in_the_index(spark, docs, got):
    staged = Staged(spark, "test")
    index = exact.DigestIndex(spark, unique_name("digest_index"), buckets=4, path=staged.path("index"))
    exact.deduplicate(docs((7, "a"), (8, "b")), index, Staged(spark, "test")).collect()
    second = exact.deduplicate(docs((1, "a"), (2, "c"), (3, "c")), index, Staged(spark, "test"))
    assert got(second, "doc_id", "keep_id", "kept") == {1: (7, False), 2: (2, True), 3: (2, False)}
    assert index.read().count() == 3
    plan = index.unseen(spark.createDataFrame([("x", 1)], "text_sha256 string, keep_id long"))._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") <= 2
    index.drop()


@pytest.mark.parametrize("size", [2_000_000])
def test_long_text(docs, got, size):
    table = docs((1, "w " * size), (2, "w  " * size))
    assert got(exact.deduplicated(table), "doc_id", "keep_id") == {1: (1,), 2: (1,)}


def test_stage_moves_texts_once(spark, docs):
    import corpus_pipeline

    table = docs((3, "a  b"), (1, "a b"), (1, "a b"), (None, "c"), (None, "c"), (5, None), (4, ""))
    kept = corpus_pipeline.exact_copies(spark, table, None)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("LeftSemi")[0]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 4), (True, 0)]


def test_a_batch_writes_a_file_a_bucket_however_keys_are_dealt(spark, docs, got, monkeypatch):
    from pathlib import Path

    dealt = type(spark.range(0)).repartition  # a session that deals keys over more partitions than asked for
    monkeypatch.setattr(type(spark.range(0)), "repartition", lambda self, n, *cols: dealt(self, max(n, 13) if cols else n, *cols))
    staged = Staged(spark, "test")
    index = exact.DigestIndex(spark, unique_name("digest_index"), buckets=4, path=staged.path("index"))
    for first in (0, 300):
        found = exact.deduplicate(docs(*((i, f"text {i % 250}") for i in range(first, first + 300))), index, Staged(spark, "test"))
        assert all(keep == doc_id % 250 for doc_id, (keep,) in got(found, "doc_id", "keep_id").items())
    files = [p.name for p in Path(staged.paths["index"].removeprefix("file:")).glob("part-*")]
    assert len({name.split("_")[1][:5] for name in files}) == 4 and len(files) == 4  # the second batch has no new text
    index.drop()
