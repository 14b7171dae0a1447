"""The documents' way to a training corpus: five stages, each written and read again by the next one.

Every stage but the last returns the columns of ``documents`` and fewer rows; the last one adds the encoding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import decontaminate, exact, langid, pieces, similar_sets
from stayline.llm.common import Staged, table

#: A document is rejected if it has no letter or if no language has this share of it.
LEAST_SHARE = 0.4
#: Near copies have this percentage of common shingles of so many words.
SHINGLE, PERCENT = 5, 80
#: Part of a test item's own alignment score from which a document counts as a leak.
LEAK = 0.5


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("stayline_row_key", row_key_of(docs))


def row_key_of(docs: DataFrame):
    return F.xxhash64(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.coalesce(docs["text"], F.lit("")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages. Without any labelled document nothing is rejected but texts without letters.

    A null or empty text is rejected. Repeated rows are judged alike; extra columns are kept.
    """
    model = langid.fit(langid.sample(docs.where(~langid.held_out())))
    columns = docs.columns
    inner = docs.select(F.struct(*[docs[c] for c in columns]).alias("doc"), docs["text"].alias("text"))
    judged = langid.predict(inner, model)
    if model.languages:
        kept = judged.where((F.col("lang_pred") != langid.NONE) & (F.col("score") >= LEAST_SHARE))
    else:
        kept = judged.where(F.col("text").rlike("\\p{L}"))
    return kept.select("doc.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest doc_id; of rows that repeat in whole, one."""
    # One key of both, so the texts move once: the join and the choice of one row are dealt alike.
    key = lambda doc_id, sha: F.concat_ws(" ", sha, F.coalesce(doc_id.cast("long").cast("string"), F.lit("null"))).alias("stayline_key")
    kept = exact.deduplicated(docs.select("doc_id", "text")).where("kept").select(key(F.col("doc_id"), F.col("text_sha256"))).distinct()
    text = F.regexp_replace(F.coalesce(docs["text"], F.lit("")), exact.SPACE, " ")
    keyed = docs.withColumn("stayline_key", key(docs["doc_id"], F.sha2(text, 256)))
    return keyed.join(kept.hint("merge"), "stayline_key", "left_semi").dropDuplicates(["stayline_key"]).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest doc_id. Texts without words all stay."""
    staged = Staged(spark, "near")
    found = similar_sets.similar(docs.select("doc_id", "text"), staged, SHINGLE, PERCENT)
    goes = found.where("n_shingles > 0 AND component_id IS NOT NULL AND NOT (doc_id <=> component_id)").select(F.col("row_key").alias("stayline_row_key")).distinct()
    return _keyed(docs).join(goes, "stayline_row_key", "left_anti").select(*docs.columns)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that copies a test item, verbatim or edited."""
    staged = Staged(spark, "decontaminate")
    found = decontaminate.matches(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"), staged, LEAK)
    goes = found.select(F.col("row_key").alias("stayline_row_key")).distinct()
    return _keyed(docs).join(goes, "stayline_row_key", "left_anti").select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with piece_ids, n_pieces and round_trip."""
    return pieces.encode(docs)


STAGES = [
    ("language", language),
    ("exact copies", exact_copies),
    ("near copies", near_copies),
    ("benchmark leaks", leaks),
    ("encoding", encoding),
]

#: SQL can express neither the learned stage nor the tokenizer; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is staged in the shared folder and read again."""
    staged = Staged(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = staged.write(stage(spark, docs, sf_dir), str(number))
        if number:
            staged.drop(str(number - 1))
    return STAGES[-1][1](spark, docs, sf_dir)
