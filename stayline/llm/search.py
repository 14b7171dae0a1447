"""Ranked lexical search over hashed max-sketches, with exact rescoring in descending order of the bound.

A term's share of a score factors into a weight of the term (``w``, from its document frequency) and an impact in
the document (``g = 10**9*tf div (1000*tf+8*m)``, from the term's count and the document's length). Weights are not
negative, so an item's score on a document is at most the sum, over the item's terms, of the term's weight times the
largest impact of any of the document's terms in the term's hash bucket.

Index (query-independent, no shuffle). One pass gives every row, in its own task, its sorted terms with their counts
and the sketch: the counts folded into their maxima per hash bucket. Impacts grow with the count, so the sketch's
impact in a bucket is the largest impact of its terms once N and L (read from the index) fix the length norm.

Search (batched). Items go in blocks of bounded size to the executors. The document frequencies of a block's terms
are counted over the index (a filter and a partial count, one row per term), which gives their weights; the block
becomes a matrix of weights per bucket, so the bounds of all items on a batch of rows are one matrix product. Each
task takes, per item, its rows in descending bound and scores them exactly until the bound falls below its tenth
best; the tasks' lists of ten meet per item, which is ten rows a task.

Scoring, as the contract fixes it (64-bit integers, ``div`` rounding down; weights in doubles):
``w = floor(1000*ln((2N+2)/(2df+1)))``, ``m = 100-90+(90*n*N div L)``, ``score = sum w*(10**9*tf div (1000*tf+8*m))``
over the item's distinct terms.

Defined results: a null text has no terms; a row without terms counts in neither N nor L and is never found. Each row
is a document, so a repeated row is found as often as it repeats, in the order of doc_id. A null doc_id sorts after all
others among equal scores. An item without terms finds nothing. Only ``doc_id`` and the text are read, however long.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.llm.common import Staged, slices, table

# Fixed values of the contract: the term pattern, the case rule, the constants of the score.
TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = 10

#: Hash buckets of a sketch.
BUCKETS = 1024
#: Items of a block sent to the executors: at most so many, and at most so many bytes of their terms.
BLOCK_ITEMS, BLOCK_BYTES = 4096, 8 << 20
SLICE = 4 << 20
LAST = 2**63 - 1
_CASE = str.maketrans(UPPER, LOWER)
_TERM = re.compile(TERMS)


def terms(text: str | None) -> list[str]:
    return _TERM.findall((text or "").translate(_CASE))


def bucket(term: str, buckets: int = BUCKETS) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) % buckets


def weight(big_n: int, df: int) -> int:
    return math.floor(1000.0 * math.log((2.0 * big_n + 2) / (2.0 * df + 1)))


def build(docs: DataFrame, staged: Staged, buckets: int = BUCKETS) -> tuple[DataFrame, int, int]:
    """The index (row, doc_id, n, terms sorted, tf, sketch buckets and their largest tf), N and L.

    ``g`` grows with tf, so the largest tf of a bucket gives its largest impact once N and L are known; the index
    needs no corpus statistics, and N and L are read from it.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        seen = 0
        for batch in slices(batches, "text", SLICE):
            vocab: dict[str, int] = {}
            rows, ids, counts, sizes, doc_ids = [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seen += 1
                found = terms(text)
                if not found:
                    continue
                counted = sorted(Counter(found).items())
                rows.append(first + seen)
                doc_ids.append(doc_id)
                sizes.append(len(found))
                ids.append([vocab.setdefault(t, len(vocab)) for t, _ in counted])
                counts.append([c for _, c in counted])
            where = np.array([bucket(t, buckets) for t in vocab], np.int64)
            lengths = np.array([len(i) for i in ids], np.int64)
            owner = np.repeat(np.arange(len(ids)), lengths)
            flat_ids = np.fromiter((i for one in ids for i in one), np.int64, int(lengths.sum()))
            flat_tf = np.fromiter((c for one in counts for c in one), np.int64, int(lengths.sum()))
            top = np.zeros(len(ids) * buckets, np.int64)
            np.maximum.at(top, owner * buckets + where[flat_ids], flat_tf)
            filled = np.nonzero(top)[0]
            per_row = np.bincount(filled // buckets, minlength=len(ids))
            offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
            names = list(vocab)
            yield pa.RecordBatch.from_arrays([
                pa.array(rows, pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(sizes, pa.int64()),
                pa.array([[names[i] for i in one] for one in ids], pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64())),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array((filled % buckets).astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(top[filled])),
            ], schema=INDEX)

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    written = staged.write(read.mapInArrow(index, INDEX_DDL), "index")
    got = written.agg(F.count("*"), F.sum("n")).first()
    return written, int(got[0] or 0), int(got[1] or 0)


INDEX = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.string())), ("tf", pa.list_(pa.int64())),
                   ("sketch_bucket", pa.list_(pa.int32())), ("sketch_tf", pa.list_(pa.int64()))])
INDEX_DDL = "row long, doc_id long, n long, terms array<string>, tf array<long>, sketch_bucket array<int>, sketch_tf array<long>"


def lengths_norm(n: np.ndarray, big_n: int, big_l: int) -> np.ndarray:
    """m = 10 + (90*n*N div L), exact also where 90*n*N passes 64 bits."""
    if len(n) and 90 * int(n.max()) * big_n >= 2**63:
        return np.array([10 + (90 * int(x) * big_n) // big_l for x in n], np.int64)
    return 10 + (90 * n * big_n) // big_l


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and its distinct terms (in the JVM, by the same pattern)."""
    found = F.regexp_extract_all(F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER), F.lit(TERMS), 0)
    return items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.array_distinct(found)).alias("term"))


def blocks(wanted: DataFrame) -> Iterator[list[tuple[int, list[str]]]]:
    """Items with their terms, in blocks of at most ``BLOCK_ITEMS`` items and about ``BLOCK_BYTES``."""
    grouped = wanted.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("t")).orderBy("item_id")
    block, size = [], 0
    for row in grouped.toLocalIterator():
        block.append((row.item_id, list(row.t)))
        size += sum(len(t) + 8 for t in row.t)
        if len(block) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def frequencies(index: DataFrame, words: list[str]) -> dict[str, int]:
    """Rows of the index holding each of ``words`` (a bounded list): a filter and a partial count in each task."""
    shared = index.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(shared.value, pa.string())
        for batch in batches:
            flat = batch.column("terms").flatten()
            counted = pa.compute.value_counts(flat.filter(pa.compute.is_in(flat, value_set=wanted)))
            yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], ["term", "df"])

    counted = index.select("terms").mapInArrow(count, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r.term: int(r.df) for r in counted.collect()}  # at most one row per word of the block


def search_block(index: DataFrame, block: list[tuple[int, list[str]]], big_n: int, big_l: int, buckets: int = BUCKETS, top: int = TOP) -> DataFrame:
    """item_id, row, doc_id, score: each task's ``top`` best rows of each item of ``block`` with a score above 0."""
    vocab = sorted({t for _, words in block for t in words})
    df = frequencies(index, vocab)
    weights = np.array([weight(big_n, df[t]) if t in df else 0 for t in vocab], np.int64)  # absent terms weigh nothing here
    place = {t: i for i, t in enumerate(vocab)}
    bound_weights = np.zeros((buckets, len(block)), np.float64)
    member_item, member_term = [], []
    for j, (_, words) in enumerate(block):
        for t in words:
            bound_weights[bucket(t, buckets), j] += weights[place[t]]
            member_item.append(j)
            member_term.append(place[t])
    order = np.argsort(np.array(member_term, np.int64), kind="stable")
    items_of = np.array(member_item, np.int64)[order]
    starts = np.searchsorted(np.array(member_term, np.int64)[order], np.arange(len(vocab) + 1))
    shared = index.sparkSession.sparkContext.broadcast(([b[0] for b in block], vocab, weights, bound_weights, items_of, starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, words, w, bounds_of, items_by_term, term_starts = shared.value
        value_set = pa.array(words, pa.string())
        best: list[list[tuple[int, int, int]]] = [[] for _ in item_ids]  # min-heaps of (score, -doc, -row)
        for batch in batches:
            count = batch.num_rows
            m = lengths_norm(batch.column("n").to_numpy(), big_n, big_l)
            places = batch.column("sketch_bucket")
            offsets = places.offsets.to_numpy()
            owner = np.repeat(np.arange(count), np.diff(offsets))
            most = np.zeros((count, buckets), np.int64)
            most[owner, places.values.to_numpy()[offsets[0] : offsets[-1]]] = batch.column("sketch_tf").values.to_numpy()[offsets[0] : offsets[-1]]
            sketch = np.where(most > 0, impact(most, m[:, None]), 0).astype(np.float64)
            bound = sketch @ bounds_of  # rows x items; exact in doubles, far below 2**53
            floors = np.array([heap[0][0] if len(heap) == top else 1 for heap in best], np.float64)
            wanted = np.nonzero((bound >= floors).any(axis=1))[0]
            if not len(wanted):
                continue
            # exact scores of the rows whose bound reaches some item's threshold, by one scatter of their hits
            listed, counts = batch.column("terms").take(pa.array(wanted)), batch.column("tf").take(pa.array(wanted))
            hit = pa.compute.index_in(listed.flatten(), value_set=value_set).to_numpy(zero_copy_only=False)
            row_of = np.repeat(np.arange(len(wanted)), np.diff(listed.offsets.to_numpy()))
            found = ~np.isnan(hit) if hit.dtype.kind == "f" else np.ones(len(hit), bool)
            term = np.nan_to_num(hit).astype(np.int64)[found]
            row_of = row_of[found]
            tf = counts.flatten().to_numpy()[found]
            share = w[term] * impact(tf, m[wanted][row_of])
            fan = term_starts[term + 1] - term_starts[term]
            items = items_by_term[np.repeat(term_starts[term], fan) + (np.arange(int(fan.sum())) - np.repeat(np.cumsum(fan) - fan, fan))]
            exact = np.zeros(len(wanted) * len(item_ids), np.int64)
            np.add.at(exact, np.repeat(row_of, fan) * len(item_ids) + items, np.repeat(share, fan))
            exact = exact.reshape(len(wanted), len(item_ids))
            docs = np.where(batch.column("doc_id").is_null().to_numpy(zero_copy_only=False), LAST, batch.column("doc_id").fill_null(0).to_numpy())[wanted]
            rows = batch.column("row").to_numpy()[wanted]
            limits = bound[wanted]
            for j in range(len(item_ids)):
                heap = best[j]
                column = limits[:, j]
                candidates = np.nonzero(column >= floors[j])[0]
                for at in candidates[np.argsort(-column[candidates], kind="stable")]:  # descending bound, until the threshold
                    if len(heap) == top and column[at] < heap[0][0]:
                        break
                    score = int(exact[at, j])
                    if score <= 0:
                        continue
                    key = (score, -int(docs[at]), -int(rows[at]))
                    if len(heap) < top:
                        heapq.heappush(heap, key)
                    elif key > heap[0]:
                        heapq.heapreplace(heap, key)
        found_rows = [(item_ids[j], -r, -d, s) for j, heap in enumerate(best) for s, d, r in heap]
        yield pa.RecordBatch.from_pylist([{"item_id": i, "row": r, "doc_id": None if d == LAST else d, "score": s} for i, r, d, s in found_rows],
                                         schema=pa.schema([("item_id", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]))

    return index.mapInArrow(run, "item_id long, row long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, buckets: int = BUCKETS) -> DataFrame:
    """item_id, rank (1.. by score, then doc_id), doc_id, score: the ``top`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    staged = Staged(spark, "search")
    index, big_n, big_l = build(docs, staged, buckets)
    found = spark.createDataFrame([], "item_id long, row long, doc_id long, score long")
    if big_n:
        for n, block in enumerate(blocks(item_terms(items))):
            found = found.unionByName(staged.write(search_block(index, block, big_n, big_l, buckets, top), f"found-{n}"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERMS}') AS t
  FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(t) > 0) AS big_n, sum(len(t)) AS big_l FROM d),
o AS (SELECT r, doc_id, unnest(t) AS term FROM d),
p AS (SELECT r, doc_id, term, count(*) AS tf FROM o GROUP BY r, doc_id, term),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
w AS (SELECT term, CAST(floor(1000.0::DOUBLE * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM f, s),
m AS (SELECT r, 10 + CAST((90::HUGEINT * len(t) * big_n) // big_l AS BIGINT) AS m FROM d, s WHERE len(t) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERMS}')) AS term FROM benchmark),
sc AS (
  SELECT q.item_id, p.r, p.doc_id, sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * m.m))) AS score
  FROM q JOIN p ON q.term = p.term JOIN w ON w.term = p.term JOIN m ON m.r = p.r
  GROUP BY q.item_id, p.r, p.doc_id),
k AS (SELECT item_id, doc_id, CAST(score AS BIGINT) AS score,
             row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST, r) AS rank
      FROM sc WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= {TOP}
"""
