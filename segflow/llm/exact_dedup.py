"""Exact dedup: group by 128-bit content hash, compare bytes inside groups.

Texts are grouped by (MD5, text): the hash spreads the work and the text itself
is part of the grouping key, so two texts of one hash that differ in any byte
stay apart.  Partial aggregation folds the copies of a hot text inside every map
task before anything is shuffled.  Decisions travel back to the documents over
narrow rows only (ids and hashes), never over texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.llm.common import sha_hex, texts


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "min") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    `keep` is "min" (smallest id stays) or "max" (largest).  Defined cases: null
    text counts as empty; empty texts form a group like any other; rows with a
    null id count in group_size but are kept only if the whole group has no id;
    rows repeated with the same id are all counted and share one decision; an
    empty table gives no rows; extra columns are ignored.
    """
    if keep not in ("min", "max"):
        raise ValueError(f"keep must be 'min' or 'max', not {keep!r}")
    pick = F.min if keep == "min" else F.max
    src = texts(docs, id_col, text_col)
    # Inside one hash the text is a grouping key: equal means equal bytes.
    same = (src.groupBy(F.unhex(F.md5("text")).alias("h"), "text")
            .agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    # A second digest names each text of a hash; two texts under one pair of
    # digests would be a collision of both and stops the job.
    groups = (same.select("h", F.unhex(sha_hex(F.col("text"))).alias("s"), "keep_id", "group_size")
              .groupBy("h", "s")
              .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
                   F.count(F.lit(1)).alias("n_texts"))
              .withColumn("keep_id", F.when(F.col("n_texts") == 1, F.col("keep_id")).otherwise(
                  F.raise_error(F.lit("different texts share both digests")).cast("long")))
              .drop("n_texts"))
    # Dealt by another key first, so the join below gets plain shuffles on both
    # sides and AQE may split the partition of a hot group.
    groups = groups.repartition("keep_id")
    rows = src.select("doc_id", F.unhex(F.md5("text")).alias("h"),
                      F.unhex(sha_hex(F.col("text"))).alias("s"))
    return (rows.join(groups, ["h", "s"])
            .select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("s")).alias("text_sha256")))
