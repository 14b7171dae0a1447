"""The queries of the subpackage by name, and their check SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stayline.llm import archive, byte_bpe, decontaminate, exact, langid, licences, pieces, repeats, resample, search, similar_sets, token_counts, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": exact.exact_dedup,
    "op2_piece_codes": pieces.piece_codes,
    "op3_benchmark_leaks": decontaminate.benchmark_leaks,
    "op4_repeated_passages": repeats.repeated_passages,
    "op5_languages": langid.languages,
    "op6_web_archive": archive.web_archive,
    "op7_token_counts": token_counts.token_lengths,
    "op8_licence_scan": licences.licence_scan,
    "op9_similar_documents": similar_sets.similar_documents,
    "op10_toxicity": toxicity.toxicity_scores,
    "op11_ranked_search": search.ranked_search,
    "op12_importance_sample": resample.importance_sample,
    "op13_byte_bpe": byte_bpe.byte_bpe,
}

SQL: dict[str, str] = {
    "op1_exact_dedup": exact.SQL,
    "op4_repeated_passages": repeats.SQL,
    "op6_web_archive": archive.SQL,
    "op8_licence_scan": licences.SQL,
    "op9_similar_documents": similar_sets.SQL,
    "op11_ranked_search": search.SQL,
}
