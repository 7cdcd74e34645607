"""S3 as a clustered document store: (key, json) rows sorted by key.

A key/value store scans a key pattern by walking its keys in order.  Here documents
are written in key ranges, sorted inside each, in row groups of a bounded size.  Parquet
keeps the least and largest key of every file and row group, so a prefix scan, written
as an interval of keys, reads only those that can hold the prefix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.operators.dedupe import distinct_rows
from segflow.sources.envelope import ENVELOPE, parse_documents

ROW_GROUP_BYTES = 8 << 20


def write_document_store(docs: DataFrame, path: str, key_col: str = "key", partitions: int | None = None,
                         row_group_bytes: int = ROW_GROUP_BYTES, mode: str = "errorifexists") -> None:
    """Write documents in key order.  `partitions` key ranges are cut by a sample of the
    keys; by default Spark chooses their number.  Equal keys stay together, and a range
    that gets too large is one file with many row groups, never a failure."""
    parts = [partitions] if partitions else []
    (docs.repartitionByRange(*parts, key_col).sortWithinPartitions(key_col)
     .write.mode(mode).option("parquet.block.size", row_group_bytes)
     .option("parquet.page.row.count.limit", 2000).parquet(path))


def after_prefix(prefix: str) -> str | None:
    """The least text that is larger than all texts with `prefix`; None if there is none."""
    for i in range(len(prefix) - 1, -1, -1):
        following = ord(prefix[i]) + 1
        if 0xD800 <= following < 0xE000:        # no code points there
            following = 0xE000
        if following <= 0x10FFFF:
            return prefix[:i] + chr(following)
    return None


def scan_prefix(spark: SparkSession, path: str, prefix: str, key_col: str = "key") -> DataFrame:
    """Documents whose key starts with `prefix` (literal, no wildcard).

    UTF-8 sorts like code points, so the prefix is the interval from itself to
    `after_prefix`; both ends are pushed to the scan."""
    rows = spark.read.parquet(path)
    if prefix:
        rows = rows.where(F.col(key_col) >= prefix)
        end = after_prefix(prefix)
        if end is not None:
            rows = rows.where(F.col(key_col) < end)
    return rows


def scan_store(spark: SparkSession, path: str, prefix: str = "pid_", key_col: str = "key", json_col: str = "json",
               schema=ENVELOPE, dedupe: bool = True) -> DataFrame:
    """S3 on a store: envelopes under a key prefix; see `envelope.scan_documents`."""
    parsed, _ = parse_documents(scan_prefix(spark, path, prefix, key_col), json_col, schema)
    return distinct_rows(parsed) if dedupe else parsed
