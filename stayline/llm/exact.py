"""Exact duplicates by a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to one row per digest, anti-joined
with the index by sort-merge (the index side is read bucket by bucket, without an exchange) and its new digests
are appended. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import SPACE, Staged, table, unique_name


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the SHA-256 of the text, each run of white space as one space; a null text counts as empty."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " ")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias("text_sha256"))


class DigestIndex:
    """Digests seen so far: ``text_sha256`` and ``keep_id``, the document that stays for it.

    Every batch appends one sorted file per bucket at most, as its rows are dealt by their bucket whatever the
    session's number of shuffle partitions; ``buckets`` is fixed when the table is made.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int = 64, path: str | None = None):
        self.spark, self.name, self.buckets, self.path = spark, name, buckets, path

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Groups whose digest the index doesn't hold."""
        if not self.exists():
            return groups
        return groups.hint("merge").join(self.read().hint("merge"), "text_sha256", "left_anti")

    def append(self, groups: DataFrame) -> None:
        bucket = F.pmod(F.hash("text_sha256"), F.lit(self.buckets))  # as Spark's bucketed writer computes it
        writer = (
            groups.select("text_sha256", "keep_id")
            .repartitionById(self.buckets, bucket)
            .write.format("parquet")
            .mode("append")
            .bucketBy(self.buckets, "text_sha256")
            .sortBy("text_sha256")
        )
        (writer.option("path", self.path) if self.path else writer).saveAsTable(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def deduplicate(docs: DataFrame, index: DigestIndex, staged: Staged) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size (rows of this batch), kept, text_sha256.

    Of equal texts the smallest doc_id stays, or the document that an earlier batch put into the index. A row
    is kept if its doc_id is the one that stays: repeated rows with one doc_id and one text are all marked kept.
    Rows without doc_id stay only if every row of their text has none. An empty batch gives no rows.
    """
    hashed = staged.write(digests(docs), "hashed")
    groups = staged.write(
        hashed.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups"
    )
    index.append(staged.write(index.unseen(groups), "unseen"))
    stays = groups.drop("keep_id").hint("merge").join(index.read().hint("merge"), "text_sha256")
    stays = staged.write(stays, "stays")
    # Both sides are shuffled here, so adaptive execution splits a digest that very many documents share.
    return hashed.join(stays, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents against a new index."""
    return deduplicated(table(spark, folder, "documents"))


def deduplicated(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    staged = Staged(spark, "exact")
    index = DigestIndex(spark, unique_name("digest_index"), path=staged.path("index"))
    out = deduplicate(docs, index, staged)
    index.drop()
    staged.drop("groups", "unseen", "index")
    return out


SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
