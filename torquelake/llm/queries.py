"""The numbered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from torquelake.config import prepare_session
from torquelake.llm import alignment, decontaminate, importance, licenses, line_dedup, lm, mixing, ngram_join, packing, quality, secret_scan, token_files, toxicity
from torquelake.llm.common import in_fold, table

#: The tokenizer files of the contracts.
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_digest(table(spark, folder, "documents"), min_docs=10, keep="none", min_chars=1)


def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_digest(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, folder, "documents"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.quality_filter(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.drop("reasons")


def op7_benchmark_contamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.contamination_digest(documents, items, size=10)


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_digest(table(spark, folder, "documents"), table(spark, folder, "labels"), fold=0)


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.component_digest(table(spark, folder, "documents"), ngram_join.Similar(3, 90, 100))


def op3_ngram_links(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.link_digest(table(spark, folder, "documents"), ngram_join.Similar(3, 90, 100))


def op8_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return lm.score_texts(docs, in_fold("doc_id", 1), public_tokenizers.path(TOKENIZER), end_id=50256)


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    documents, target = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return importance.resample_digest(documents, target, importance.Resampling(max_n=1, buckets=10_000, seed=2024, min_words=20, num=10, den=100))


def op12_sequence_packing(spark: SparkSession, folder: str) -> DataFrame:
    rule = packing.Sequences(capacity=1024, end_id=2)
    return packing.packing_digest(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), rule)


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES)
    return alignment.align_digest(table(spark, folder, "documents"), *paths)


REGISTERED: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_source_mix": op2_source_mix,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op3_ngram_links": op3_ngram_links,
    "op4_toxicity": op4_toxicity,
    "op5_license_scan": op5_license_scan,
    "op6_quality_rules": op6_quality_rules,
    "op7_benchmark_contamination": op7_benchmark_contamination,
    "op8_lm_score": op8_lm_score,
    "op9_secret_scan": op9_secret_scan,
    "op10_token_files": op10_token_files,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_sequence_packing": op12_sequence_packing,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}


def registered_queries() -> dict[str, Query]:
    def prepared(query: Query) -> Query:
        return lambda spark, folder: query(prepare_session(spark), folder)

    return {name: prepared(query) for name, query in REGISTERED.items()}
