"""Importance resampling towards a target distribution: hashed n-gram weights, then a distributed LSD radix sort.

Weights. A text's features are its runs of 1 to 3 words; each falls into one of ``BUCKETS`` buckets by its CRC-32.
Bucket counts of the corpus and of the target texts (the benchmark) are counted in each task and merged, at most
``BUCKETS`` rows; their log ratio is the gain of a bucket, an array of fixed size sent to every task. A document's
weight is the sum of the gains of its features: one gather over the array of its buckets (numpy).
Its score adds Gumbel noise from a hash of its doc_id, so the highest scores are a draw without replacement.

Ranking (LSD radix sort). Eligible documents are keyed by (score descending, doc_id ascending) as two unsigned
numbers, cut into ``DIGIT`` bits. Each pass is a stable counting sort on one digit, least significant first:
rows sit in blocks of at most ``BLOCK_ROWS`` positions; a histogram of (block, digit) gives each block and digit its
global first destination (all smaller digits, then the same digit in earlier blocks), and a row's destination is that
plus its place among the rows of its block and digit in the previous order. The histogram has at most blocks x radix
rows, so it is broadcast with that bound; every pass is written to the shared folder, which ends its lineage. After
the last pass a destination is the rank minus one.

Defined results: words are the maximal runs of ``WORDS`` after lower-casing A-Z only; a null or empty text has none,
no features and weight 0. Documents with at least ``MIN_WORDS`` words and a doc_id are eligible; rows without doc_id
get a score but are never drawn. Of N eligible documents floor(5N/100) are drawn; rows equal in score and doc_id
(repeated rows) take consecutive ranks in the order they are read. Only ``doc_id`` and the text are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.llm.common import Staged, slices, table

# Fixed values of the contract: word pattern, case rule, buckets, seed, share drawn and the length to be eligible.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 10000
SEED = 42
PERCENT = 5
MIN_WORDS = 20

#: Bits of a digit of the radix sort, and the rows of a block (raised so that there are at most ``MAX_BLOCKS``).
DIGIT = 8
BLOCK_ROWS = 1 << 20
MAX_BLOCKS = 2048
#: Bytes of text a Python batch holds.
SLICE = 4 << 20


_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_WORD = re.compile(WORDS.encode())


def feature_buckets(text: str | None) -> tuple[int, np.ndarray]:
    """Words and the bucket of each 1-, 2- and 3-word feature of a text, repeats kept.

    The pattern excludes only ASCII, so on UTF-8 bytes it finds the same words as on characters. A longer feature's
    CRC-32 continues its prefix's over a space and the next word, so no feature text is built.
    """
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    one = [zlib.crc32(w) for w in words]
    spaced = [b" " + w for w in words]
    two = [zlib.crc32(s, c) for s, c in zip(spaced[1:], one, strict=False)]
    three = [zlib.crc32(s, c) for s, c in zip(spaced[2:], two, strict=False)]
    return len(words), np.array(one + two + three, np.int64) % BUCKETS


def histogram(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Features per bucket (``BUCKETS`` counts) and their total; each task sends one count per bucket it saw."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, "text", SLICE):
            for text in batch.column("text").to_pylist():
                counts += np.bincount(feature_buckets(text)[1], minlength=BUCKETS)
        seen = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], ["b", "n"])

    read = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "b int, n long")
    counts = np.zeros(BUCKETS, np.int64)
    for row in read.groupBy("b").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        counts[row["b"]] = row["n"]
    return counts, int(counts.sum())


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000*ln((t+1)*(S+B)/((s+1)*(T+B)))) per bucket, in doubles."""
    big_s, big_t = float(corpus.sum()), float(target.sum())
    ratio = (target + 1.0) * (big_s + BUCKETS) / ((corpus + 1.0) * (big_t + BUCKETS))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight: the sum of the gains of each row's features, one gather a text."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_of_gains = shared.value
        for batch in slices(batches, "text", SLICE):
            found = [feature_buckets(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([n for n, _ in found], pa.int64()), pa.array([len(b) for _, b in found], pa.int64()),
                 pa.array([int(table_of_gains[b].sum()) for _, b in found], pa.int64())],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: F.Column) -> F.Column:
    """floor(-1000*ln(-ln((h+0.5)/2**32))), h the first 8 hex digits of sha256('42:<doc_id>')."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def radix_ranks(staged: Staged, keyed: DataFrame, total: int) -> DataFrame:
    """row and rank (1..) of ``keyed`` (row, a, b: non-negative longs) in ascending (a, b), by LSD radix sort."""
    spark = keyed.sparkSession
    bounds = keyed.agg(F.max("a").alias("a"), F.max("b").alias("b")).first()
    widths = [("b", max(1, int(bounds["b"] or 0).bit_length())), ("a", max(1, int(bounds["a"] or 0).bit_length()))]
    block_rows = max(BLOCK_ROWS, -(-total // MAX_BLOCKS))
    radix = 1 << DIGIT
    # blocks and places as read, written once so that histogram and join see the same ones
    current = staged.write(keyed.select("row", "a", "b", F.spark_partition_id().cast("long").alias("block"), F.monotonically_increasing_id().alias("pos")), "pass-start")
    step, previous = 0, "pass-start"
    for name, width in widths:
        for shift in range(0, width, DIGIT):
            digit = F.shiftright(F.col(name), shift).bitwiseAND(radix - 1).cast("int")
            marked = current.withColumn("digit", digit)
            counts = marked.groupBy("block", "digit").agg(F.count("*").alias("c"))  # at most blocks x radix rows
            per_digit = np.zeros(radix, np.int64)
            for row in counts.groupBy("digit").agg(F.sum("c").alias("c")).collect():  # at most radix rows
                per_digit[row["digit"]] = row["c"]
            base = np.concatenate([[0], np.cumsum(per_digit)[:-1]])
            earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
            starts = counts.select(
                "block", "digit",
                (F.element_at(F.array(*[F.lit(int(v)) for v in base]), F.col("digit") + 1) + F.coalesce(F.sum("c").over(earlier), F.lit(0))).alias("start"),
            )
            place = F.row_number().over(Window.partitionBy("block", "digit").orderBy("pos")) - 1
            moved = marked.join(F.broadcast(starts), ["block", "digit"]).withColumn("dest", F.col("start") + place)
            following = staged.write(moved.select("row", "a", "b", F.floor(F.col("dest") / F.lit(block_rows)).cast("long").alias("block"), F.col("dest").alias("pos")), f"pass-{step}")
            staged.drop(previous)
            current, step, previous = following, step + 1, f"pass-{step}"
    return current.select("row", (F.col("pos") + 1).alias("rank"))


def resample(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score and rank (1.. in drawn order, null if not drawn) of every row of ``docs``."""
    spark = docs.sparkSession
    staged = Staged(spark, "resample")
    corpus, _ = histogram(docs)
    target, _ = histogram(targets)
    scored = weights(docs, gains(corpus, target)).withColumn("score", F.col("weight") + noise(F.col("doc_id")))
    kept = staged.write(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    eligible = kept.where((F.col("n_words") >= MIN_WORDS) & F.col("doc_id").isNotNull())
    stats = eligible.agg(F.count("*").alias("n"), F.max("score").alias("top"), F.min("doc_id").alias("low")).first()
    drawn = (PERCENT * int(stats["n"])) // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if drawn == 0:
        return kept.select(*columns, F.lit(None).cast("long").alias("rank"))
    keyed = eligible.select("row", (F.lit(int(stats["top"])) - F.col("score")).alias("a"), (F.col("doc_id") - F.lit(int(stats["low"]))).alias("b"))
    ranks = radix_ranks(staged, keyed, int(stats["n"])).where(F.col("rank") <= drawn)
    return kept.join(ranks, "row", "left").select(*columns, "rank")


def importance_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's weight towards the benchmark's n-grams, score and rank of the 5 % drawn."""
    return resample(table(spark, folder, "documents"), table(spark, folder, "benchmark").withColumnRenamed("item_id", "doc_id"))
