"""Registered queries of the subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.llm.bpe_automaton import encode_decode
from segflow.llm.common import sha_hex, table
from segflow.llm.decontaminate import find_contaminated
from segflow.llm.exact_dedup import exact_dedup
from segflow.llm.fill_middle import fill_in_middle, restore
from segflow.llm.lexical_search import lexical_search
from segflow.llm.line_dedup import line_dedup
from segflow.llm.near_dedup import near_dedup
from segflow.llm.quality import fit_quality, score_quality
from segflow.llm.secret_scan import secret_scan
from segflow.llm.substring_dedup import substring_dedup
from segflow.llm.token_counts import token_counts
from segflow.llm.toxicity import fit_toxicity, score_toxicity
from segflow.llm.url_filter import filter_urls, rule_table

PIECE_MODEL = "piece_bpe_32k.model"
WORD_MODEL = "word_bpe_49k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), rule_table(spark))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def fold(folds: int) -> Column:
    """Fold of a document: CRC-32 of its id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


def judged(scores: DataFrame, held_out: Column, threshold: float = 0.7) -> DataFrame:
    return scores.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def training_labels(spark: SparkSession, sf_dir: str, column: str, folds: int, left_out: int) -> DataFrame:
    rows = table(spark, sf_dir, "labels")
    return rows.where(fold(folds) != left_out).select("doc_id", F.col(column).alias("label"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, training_labels(spark, sf_dir, "quality", 4, 2))
    return judged(score_quality(docs, model), fold(4) == 2)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, training_labels(spark, sf_dir, "toxic", 3, 1))
    return judged(score_toxicity(docs, model), fold(3) == 1)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), percent=85)


def op9_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path(WORD_MODEL))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="max")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha_hex(F.col("output")).alias("output_sha256"),
                       sha_hex(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents"), min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", sha_hex(F.col("text")).alias("kept_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=50)


QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_url_filters": op2_url_filters,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_token_counts": op5_token_counts,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_toxicity": op8_toxicity,
    "op9_bpe_encode_decode": op9_bpe_encode_decode,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_line_dedup": op12_line_dedup,
    "op13_lexical_search": op13_lexical_search,
}
