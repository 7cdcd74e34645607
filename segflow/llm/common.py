"""Helpers shared by the operators: table access, lineage cuts, bounded samples."""

from __future__ import annotations

import gc
import itertools
import os
import tempfile
import time
import zipfile

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.session import checkpoint_dir, remove_path, work_path


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so tasks can
    import it wherever the driver was started."""
    import segflow

    sc = spark.sparkContext
    if getattr(sc, "_segflow_sent", False):
        return
    top = os.path.dirname(os.path.abspath(segflow.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="segflow-code-"), "segflow_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("segflow", os.path.relpath(full, top)))
    sc.addPyFile(path)
    sc._segflow_sent = True


_OWNER: str | None = None
_MODELS: dict = {}


def worker_models(owner: str) -> dict:
    """Models that a Python worker keeps for the next tasks of one operator.

    Workers are reused; when another operator's task starts in one, what the
    operator before it kept is dropped, so that idle models take no memory.
    """
    global _OWNER
    if _OWNER != owner:
        _MODELS.clear()
        _OWNER = owner
    return _MODELS


def arrow_map(df: DataFrame, owner: str, function: Callable, schema) -> DataFrame:
    """mapInArrow for operator `owner`; a worker gives back Arrow's spare memory
    after each task."""
    def run(batches):
        worker_models(owner)
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; read by Spark only, so any store Spark reaches works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """For loops: a function that writes a frame to the shared folder and reads it back.

    A checkpoint keeps the size that was estimated for its plan, and joins multiply
    such estimates: over some rounds they become numbers of millions of digits and
    planning stands still.  A written table has its own size.  All of them are removed
    at the end of the block, so what leaves it must be cut before.
    """
    base, numbers = work_path(spark, name), itertools.count()

    def keep(df: DataFrame) -> DataFrame:
        path = f"{base}/{next(numbers)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        remove_path(spark, base)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that a cut has replaced.

    Spark removes them when the driver's garbage is collected, which otherwise
    may be long after the next step has filled the disks.  The first round makes
    the Python side give up its handles, the second frees what they held.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.7)


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) under fixed names, null text as empty; other columns go.

    Only the two named columns are read, so extra columns with any names
    (also ones the operators use internally) cannot clash.
    """
    ship(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def sha_hex(col: Column) -> Column:
    """Lower-case hex SHA-256 of a string's UTF-8 bytes."""
    return F.sha2(col, 256)


def bounded_sample(labels: DataFrame, max_rows: int) -> DataFrame:
    """At most `max_rows` (doc_id, label) rows, by smallest hash of doc_id.

    The choice depends on the id alone, never on file order, so it is stable
    across runs and sizes.  Null ids and labels are left out; of repeated ids
    the one with the largest label counts.
    """
    one = (labels.where("doc_id IS NOT NULL AND label IS NOT NULL")
           .groupBy("doc_id").agg(F.max("label").alias("label")))
    return (one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
