"""Benchmark passages in training texts: counted words as a filter without loss, then Smith-Waterman alignment.

A passage that reaches the threshold has a certain number of the item's words in a certain width (``bounds``), so at
least some of any choice of its words that is large enough. One pass over the texts looks up the rarer words of the test
items, and stretches with enough of them are aligned where they lie. Items are handled in blocks of bounded
size, which are broadcast one after the other, so a benchmark of any size is searched whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import Staged, row_key, slices, table

WORD = re.compile(r"[^\W_]+")
#: An item with fewer words must be there verbatim.
SHORT = 5
#: Of the words that a passage must have, the share that must be among the item's rarer ones. It moves cost, not results.
RARER = 0.5
#: Part of an item's own alignment score that a passage must reach.
SIMILARITY = 0.5
MATCH, OTHER, GAP = 2, -1, -1
#: Bytes of test items that are broadcast at once.
BLOCK = 8 << 20
SLICE = 4 << 20
#: Pairs of a word's place and an item that are sorted at once.
PAIRS = 2_000_000
#: Stretches that are looked over at once before the alignment.
STRETCHES = 4096
ALIGNED = "row_key long, doc_id long, item_id long, similarity double, first_word long, last_word long"


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits, case folded."""
    return WORD.findall((text or "").casefold())


def bounds(n: int, similarity: float) -> tuple[int, int, float]:
    """How many of an item's ``n`` words a passage has that reaches the threshold, its greatest width, and the least score.

    With m matches and e other steps, 2m - e >= 2sn and m <= n. So m >= sn, and the passage has at most
    m + e <= 3m - 2sn <= (3 - 2s)n words.
    """
    if n < SHORT:
        return n, n, MATCH * n
    return max(1, math.ceil(similarity * n - 1e-9)), max(1, math.floor((3 - 2 * similarity) * n + 1e-9)), similarity * MATCH * n


class Items:
    """The words of a block of test items, and for each word the items that have it among their rarer ones."""

    def __init__(self, rows: list[tuple[int, str | None]], similarity: float):
        self.vocabulary: dict[str, int] = {}
        split = [(name, words_of(text)) for name, text in rows]
        split = [(name, words) for name, words in split if words]
        self.names = [name for name, _ in split]
        self.words = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], np.int64) for _, words in split]
        limits = [bounds(len(words), similarity) for words in self.words]
        self.need, self.width = (np.array([x[i] for x in limits], np.int64) for i in (0, 1))
        self.least = np.array([x[2] for x in limits], np.float64)
        self.widest = int(self.width.max(initial=1))
        kinds = [np.unique(words) for words in self.words]
        often = np.bincount(np.concatenate([*kinds, np.empty(0, np.int64)]), minlength=len(self.vocabulary))
        self.enough = np.ones(len(split), np.int64)
        word, item = [], []
        for number, words in enumerate(self.words):
            # A passage leaves out at most n - need words, so of so many more it has the rest at least.
            rest = math.ceil(RARER * self.need[number])
            rarer = words[np.argsort(often[words], kind="stable")][: len(words) - self.need[number] + rest]
            # A word left out here may stand at a chosen place too; then all its places count, which only adds hits.
            rarer = np.unique(rarer)
            self.enough[number] = rest
            word.append(rarer)
            item.append(np.full(len(rarer), number))
        word, item = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (word, item))
        self.item = item[np.argsort(word, kind="stable")]
        self.ptr = np.concatenate(([0], np.cumsum(np.bincount(word, minlength=len(self.vocabulary)))))
        #: Which words an item has, as one ascending number for item and word.
        own = [number * (len(self.vocabulary) + 1) + words for number, words in enumerate(kinds)]
        self.held = np.concatenate([*own, np.empty(0, np.int64)]).astype(np.int64)

    def stretches(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) of every stretch that may hold a passage; unknown words are -1.

        A passage of an item lies whole in one of its stretches, which have at most four times the passage's width.
        """
        places = np.flatnonzero(ids >= 0)
        count = self.ptr[ids[places] + 1] - self.ptr[ids[places]]
        places, count = places[count > 0], count[count > 0]
        ends = np.cumsum(count)
        big = len(ids) + 2 * self.widest + 2
        found: list[np.ndarray] = []
        at = 0
        while at < len(places):
            done = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
            # Hits that follow within the width belong to a stretch that starts here.
            far = int(np.searchsorted(places, places[stop - 1] + self.widest, "right"))
            here, n = places[at:far], count[at:far]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            item = self.item[np.repeat(self.ptr[ids[here]], n) + step]
            key = np.sort(item * big + np.repeat(here, n))
            item = key // big
            last = np.arange(len(key)) + self.enough[item] - 1
            inside = last < len(key)
            key, item, last = key[inside], item[inside], key[last[inside]]
            good = (last - key < self.width[item]) & (key - item * big <= places[stop - 1])
            key, item, last = key[good], item[good], last[good]
            found.append(np.stack((item, last - item * big - self.width[item] + 1, key - item * big + self.width[item])))
            at = stop
        if not found:
            return
        item, low, high = np.concatenate(found, axis=1)
        low, high = np.maximum(low, 0), np.minimum(high, len(ids))
        order = np.lexsort((low, item))
        item, low, high = item[order].tolist(), low[order].tolist(), high[order].tolist()
        i = 0
        while i < len(item):
            number, a, b = item[i], low[i], high[i]
            i += 1
            while i < len(item) and item[i] == number and low[i] <= b:
                b = max(b, high[i])
                i += 1
            width = int(self.width[number])
            while b - a > 4 * width:
                yield number, a, a + 4 * width
                a += 3 * width
            yield number, a, b

    def promising(self, ids: np.ndarray, found: list[tuple[int, int, int]]) -> np.ndarray:
        """Which of the stretches may hold a passage that reaches the threshold.

        In an alignment a word of the item adds ``MATCH`` at most and another one takes one away, so no passage scores
        more than the largest sum of such steps over consecutive words. All stretches are summed at once.
        """
        item, low, high = np.array(found, np.int64).T
        size = high - low
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) + np.repeat(low - first, size)
        word = ids[place]
        key = np.repeat(item * (len(self.vocabulary) + 1), size) + np.where(word < 0, len(self.vocabulary), word)
        own = self.held[np.minimum(np.searchsorted(self.held, key), len(self.held) - 1)] == key
        step = np.where(own, MATCH, max(OTHER, GAP))
        total = np.cumsum(step)
        # Sums of a later stretch lie below all of an earlier one, so the running minimum starts anew in each.
        shift = np.repeat(np.arange(len(found)) * (2 * (MATCH + 1) * len(step) + 1), size)
        gain = total - shift - np.minimum.accumulate(total - step - shift)
        return np.flatnonzero(np.maximum.reduceat(gain, first) >= self.least[item])

    def passages(self, ids: np.ndarray) -> Iterator[tuple[int, float, int, int]]:
        """(item, similarity, first word, last word) of the best passage of each stretch, if it reaches the threshold."""
        every = self.stretches(ids)
        while found := list(islice(every, STRETCHES)):
            for number, low, high in (found[i] for i in self.promising(ids, found).tolist()):
                item = self.words[number]
                best, first, last = align(item, ids[low:high])
                if best >= self.least[number]:
                    yield number, best / (MATCH * len(item)), low + first, low + last


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: best local score of a passage against an item, and the passage's first and last aligned word."""
    m = len(passage)
    steps = np.arange(m + 1) * -GAP
    score = np.zeros((len(item) + 1, m + 1), np.int32)
    for i, word in enumerate(item, 1):
        row = score[i]
        row[1:] = np.maximum(score[i - 1, :-1] + np.where(passage == word, MATCH, OTHER), score[i - 1, 1:] + GAP)
        np.maximum(row, 0, out=row)
        # A gap in the item costs the same at every step, so the best one to the left is a running maximum.
        row[:] = np.maximum.accumulate(row + steps) - steps
    i, j = np.unravel_index(int(score.argmax()), score.shape)
    best, last = int(score[i, j]), int(j) - 1
    while i and j and score[i, j]:
        if score[i, j] == score[i - 1, j - 1] + (MATCH if passage[j - 1] == item[i - 1] else OTHER):
            i, j = i - 1, j - 1
        elif score[i, j] == score[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return best, int(j), last


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """Items in blocks of about ``BLOCK`` bytes, each small enough to be broadcast."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // BLOCK)
    for number in range(count):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number)
        yield [(r.item_id, r.text) for r in block.orderBy("item_id", "text").collect()]


def matches(docs: DataFrame, benchmark: DataFrame, staged: Staged, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs of a document and a test item that one of its passages copies, verbatim, edited or paraphrased.

    Columns row_key, doc_id, item_id, similarity (the best passage's share of the item's own score), first_word and
    last_word (that passage in the words of the text), passages (how many reach the threshold). Null and empty texts
    and items match nothing; items with equal texts each get their pairs; repeated rows of a document give one row
    per pair; an empty table on either side gives no pairs.
    """
    spark = docs.sparkSession
    keyed = row_key(docs)
    aligned = spark.createDataFrame([], ALIGNED)
    for number, rows in enumerate(_blocks(benchmark)):
        shared = spark.sparkContext.broadcast(rows)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(shared.value, similarity)
            number_of = items.vocabulary.get
            for batch in slices(batches, "text", SLICE):
                out: list[tuple] = []
                # All texts of a slice are looked through at once; no stretch reaches over the gaps between them.
                gap = np.full(2 * items.widest + 2, -1, np.int64)
                parts = [np.fromiter(map(number_of, words_of(text), repeat(-1)), np.int64) for text in batch.column("text").to_pylist()]
                starts = np.concatenate(([0], np.cumsum([len(p) + len(gap) for p in parts])))
                docs, keys = batch.column("doc_id").to_pylist(), batch.column("row_key").to_pylist()
                for number, share, first, last in items.passages(np.concatenate([x for p in parts for x in (p, gap)])):
                    row = int(np.searchsorted(starts, first, "right")) - 1
                    out.append((keys[row], docs[row], items.names[number], share, first - int(starts[row]), last - int(starts[row])))
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [c.split()[0] for c in ALIGNED.split(", ")])

        aligned = aligned.union(staged.write(keyed.mapInArrow(search, ALIGNED), f"aligned-{number}"))
        shared.unpersist()
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("back"), "last_word")).alias("best")
    pairs = aligned.groupBy("row_key", "doc_id", "item_id").agg(best, F.countDistinct("first_word").alias("passages"))
    return pairs.select("row_key", "doc_id", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("first_word"), F.col("best.last_word").alias("last_word"), "passages")


def benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, item_id, similarity, first_word, last_word, passages of every copied test item."""
    staged = Staged(spark, "leaks")
    return matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"), staged).drop("row_key")
