"""Corpus pipeline: five stages over `documents`, each written and read again.

toxicity -> exact dedup -> near dedup -> benchmark decontamination -> BPE.
A stage works on all rows that the one before it kept.  The first four return the
columns of documents; the last returns the encoded corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from segflow.llm.bpe_automaton import encode_decode
from segflow.llm.common import table
from segflow.llm.decontaminate import find_contaminated
from segflow.llm.exact_dedup import exact_dedup
from segflow.llm.near_dedup import near_dedup
from segflow.llm.queries import WORD_MODEL, tokenizer_path, training_labels
from segflow.llm.toxicity import drop_toxic, fit_toxicity
from segflow.session import work_path

# No SQL expresses learned scores or the tokenizer; tests/llm compares run()
# with a brute-force version.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the toxicity model rejects (score of 0.7 or more)."""
    model = fit_toxicity(docs, training_labels(spark, sf_dir, "toxic", 3, 1))
    return drop_toxic(docs, model, threshold=0.7)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keeps the smallest doc_id; rows without an id stay."""
    gone = exact_dedup(docs, keep="min").where("NOT kept AND doc_id IS NOT NULL")
    return docs.join(gone.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (5-word shingles, similarity of 0.8 or more)
    keeps the smallest doc_id; rows without an id stay."""
    gone = near_dedup(docs, percent=80, bands=30, rows=4).where("NOT kept AND doc_id IS NOT NULL")
    return docs.join(gone.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage, with up to a fifth of its
    words substituted."""
    gone = find_contaminated(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(gone.select("doc_id"), "doc_id", "left_anti").select(docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes what is left: doc_id, n_tokens, digests of ids and decoded text, ids."""
    return encode_decode(docs, tokenizer_path(WORD_MODEL), with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", decontaminate),
    ("bpe", bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; between two, rows are written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
