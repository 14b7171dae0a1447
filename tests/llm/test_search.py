"""Ranked lexical search (op11) against a brute-force scorer of the contract."""

import math
import re
from collections import Counter

from stayline.llm import search

WORD = re.compile(search.TERMS)


def words(text):
    return WORD.findall((text or "").translate(str.maketrans(search.UPPER, search.LOWER)))


def brute(docs, items, top=10):
    rows = [(doc_id, Counter(words(text)), len(words(text))) for doc_id, text in docs]
    big_n = sum(1 for _, _, n in rows if n)
    big_l = sum(n for _, _, n in rows)
    df = Counter(t for _, tf, _ in rows for t in tf)
    out = []
    for item_id, text in items:
        scored = []
        for at, (doc_id, tf, n) in enumerate(rows):
            if not n:
                continue
            m = 10 + (90 * n * big_n) // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                        for t in set(words(text)) if t in tf)
            if score > 0:
                scored.append((-score, doc_id if doc_id is not None else 2**63, at, doc_id, score))
        out += [(item_id, rank, doc_id, score) for rank, (_, _, _, doc_id, score) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


DOCS = [
    (1, "The quick brown fox jumps over the lazy dog"),
    (2, "the the the fox"),
    (3, None),
    (4, ""),
    (5, "Über café naïve FOX fox Fox; 42 foxes"),
    (6, "quick quick quick brown"),
    (7, "quick quick quick brown"),  # a tie with 6
    (7, "quick quick quick brown"),  # a repeated row
    (8, "lazy " * 3000 + "dog"),  # a very long text
    (9, "!!! ??? ..."),
] + [(100 + i, f"filler text number {i} about nothing in particular") for i in range(30)]
ITEMS = [(1, "quick brown fox"), (2, "lazy dog"), (3, "café über"), (4, None), (5, "..."), (6, "filler nothing")]


def test_against_brute_force(spark, docs):
    frame = docs(*DOCS)
    frame = frame.withColumn("score", frame["doc_id"])  # a clashing extra column
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(tuple(r) for r in search.search(frame, items).collect())
    assert got == brute(DOCS, ITEMS)
    assert len(got) >= 15


def test_small_sketch_changes_nothing(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(tuple(r) for r in search.search(docs(*DOCS), items, buckets=2).collect())
    assert got == brute(DOCS, ITEMS)


def test_empty_tables(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search.search(docs((1, None), (2, "")), items).collect() == []
    assert search.search(docs(*DOCS), spark.createDataFrame([], "item_id long, text string")).collect() == []


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert sorted(tuple(r) for r in search.ranked_search(spark, folder).collect()) == brute(docs, items)
