"""Token counts without a shuffle of pre-tokens.

A text is cut at ASCII white space. No token, special string or normalised character of the tokenizers reaches
over it, so a text's count is the sum of its pre-tokens' counts. Two tiers of look-up give them: a broadcast
table of the corpus's frequent pre-tokens, and behind it a bounded cache in each worker; only what misses both is
encoded, in batches, by the tokenizer's own library.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import slices, table, worker_store

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
#: A task reports a pre-token if at least one in so many of its own is that one, so it reports no more than this.
TASK_SHARE = 5000
#: Entries of the broadcast table.
FREQUENT = 16_384
#: Entries of a worker's cache, in each of two generations.
CACHE = 300_000
SLICE = 4 << 20


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def library(content: str):
    """The library's tokenizer of a tokenizer file's content, without truncation or padding."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_str(content)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def lengths(tokenizer, chunks: list[bytes]) -> list[int]:
    """Tokens of each pre-token, as the library counts it on its own."""
    texts = [chunk.decode("utf-8") for chunk in chunks]
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def frequent(docs: DataFrame) -> DataFrame:
    """The corpus's most frequent pre-tokens, at most ``FREQUENT``.

    Every task counts all of its texts and reports those that make up 1/``TASK_SHARE`` of its pre-tokens or more,
    so at most ``TASK_SHARE`` rows a task are merged, whatever the number of documents. What the table leaves out
    costs a look-up in the cache and never a count.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        total = 0
        for batch in slices(batches, "text", SLICE):
            for text in batch.column("text").to_pylist():
                chunks = (text or "").encode().split()
                total += len(chunks)
                seen.update(chunks)
            if len(seen) > 2 * CACHE:  # keeps the table bounded; what is rare so far may come back
                seen = Counter(dict(seen.most_common(CACHE)))
        floor = max(2, total // TASK_SHARE)
        kept = [(k, v) for k, v in seen.items() if v >= floor]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in kept], pa.binary()), pa.array([v for _, v in kept], pa.int64())], ["chunk", "n"])

    counted = docs.select("text").mapInArrow(count, "chunk binary, n long")
    return counted.groupBy("chunk").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "chunk").limit(FREQUENT)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    Null and empty texts have no bytes and no tokens. Special strings inside a text count as the library counts
    them (one token). Repeated rows are counted again; other columns are not read.
    """
    spark = docs.sparkSession
    with open(path or tokenizer_path(), encoding="utf-8") as file:
        content = file.read()
    common = [bytes(r.chunk) for r in frequent(docs).collect()]  # at most FREQUENT rows
    table_of_lengths = dict(zip(common, lengths(library(content), common), strict=True))
    shared = spark.sparkContext.broadcast((content, table_of_lengths))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content, known = shared.value
        tokenizer = library(content)
        kept = worker_store().setdefault(("token counts", hash(content)), [{}, {}])
        young, old = kept
        for batch in slices(batches, "text", SLICE):
            per_text = [(text or "").encode().split() for text in batch.column("text").to_pylist()]
            misses = set()
            for chunks in per_text:
                misses.update(c for c in chunks if c not in known and c not in young)
            for chunk in misses & old.keys():
                young[chunk] = old[chunk]
            misses -= young.keys()
            new = list(misses)
            for at in range(0, len(new), 4096):
                part = new[at : at + 4096]
                young.update(zip(part, lengths(tokenizer, part), strict=True))
            counts = [sum(known[c] if c in known else young[c] for c in chunks) for chunks in per_text]
            if len(young) > CACHE:
                young, old = {}, young
                kept[:] = young, old
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = read.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def token_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"))
