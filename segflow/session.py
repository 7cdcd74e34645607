"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameReader, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "segflow") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC)."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.debug.maxToStringFields", "1000")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(input_bytes: int, partition_bytes: int = 256 << 20,
                     min_partitions: int = 200, max_partitions: int = 20_000,
                     max_splits: int = 100_000) -> dict[str, str]:
    """Suggested session settings for a run over `input_bytes` of envelopes.

    A shuffle has splits x partitions blocks, and the driver keeps a map status
    of about one bit per block, so both counts are bounded and partitions grow
    instead: 100 TB gives 100,000 splits of 1 GB and 20,000 partitions of 5 GB
    (2e9 blocks, about 250 MB of map status).  Sorts and aggregates spill, so a
    large partition costs disk, not memory; AQE merges small partitions and
    splits skewed ones at run time.
    """
    parts = min(max_partitions, max(min_partitions, -(-input_bytes // partition_bytes)))
    split = max(128 << 20, -(-input_bytes // max_splits))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def shuffle_blocks(input_bytes: int, settings: dict[str, str]) -> int:
    """Blocks of one full shuffle under `settings`: scan splits x partitions."""
    splits = -(-input_bytes // int(settings["spark.sql.files.maxPartitionBytes"]))
    return splits * int(settings["spark.sql.shuffle.partitions"])


ROWS_PER_TASK = 100_000     # messages of some KB: a task's share stays in memory and keeps no core waiting long
FEW_PER_TASK = 20_000       # below this a task costs more than it saves


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks for `rows` messages: two a core if there is work for them, more for large inputs."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, -(-rows // ROWS_PER_TASK), min(2 * cores, -(-rows // FEW_PER_TASK)))


def require_local(master: str) -> None:
    """Raise unless driver and executors are one process on one machine."""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"master {master}: set spark.checkpoint.dir to a folder that the driver "
                           "and all executors share")


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (`spark.checkpoint.dir`).

    Only on a local master without one (tests) is a private folder created and
    registered.  On a cluster every executor would write to its own disk there,
    so a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        require_local(sc.master)
        current = tempfile.mkdtemp(prefix="segflow-ckpt-")
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/segflow-{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder that this library wrote, in whatever store it is; False if it
    was not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The rows of `df`, computed once and read from the shared folder.

    For work that needs them more than once and ends inside the block; the copy is
    removed after it, also when the block fails.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield DataFrameReader(spark).schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)
