"""K4: the raw archive as a table of files that can be compacted.

Nightly runs leave small files in each day.  The archive's manifest names the files that
count, so a day's small files can be packed into larger ones and swapped in one commit:
a reader takes the files of one manifest and sees the day before or after, never between.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.session import remove_path
from segflow.sinks.commitlog import CommitLog
from segflow.sinks.tables import archive_frame

TARGET_BYTES = 128 << 20
FILE = "y int, m int, d int, path string, bytes long"


def _plain(path: Column) -> Column:
    """A file's path with one slash behind the scheme, however it was spelt."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def pack(sizes: list[int], target: int) -> list[list[int]]:
    """Bins of file numbers, each of at most `target` bytes unless one file is larger:
    largest first, into the first bin with room."""
    bins: list[tuple[int, list[int]]] = []
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        for at, (held, files) in enumerate(bins):
            if held + sizes[i] <= target:
                bins[at] = (held + sizes[i], [*files, i])
                break
        else:
            bins.append((sizes[i], [i]))
    return [files for _, files in bins]


class Archive:
    """One writer at a time.  A read or a compaction names the files of its days, so both
    are asked for by date prefix (`yyyy`, `yyyy/M` or `yyyy/M/d`).  `compression` is that of
    the files written from now on (a codec of Spark's text writer); files of any are read."""

    def __init__(self, spark: SparkSession, path: str, compression: str = "none"):
        self.spark, self.path, self.compression = spark, path.rstrip("/"), compression
        self.log = CommitLog(spark, self.path)

    def files(self, prefix: str = "", version: int | None = None) -> DataFrame:
        """The manifest: one row a file that counts."""
        head = self.log.head() if version is None else next(e for e in self.log.entries() if e.version == version)
        if head is None:
            return self.spark.createDataFrame([], FILE)
        out = self.spark.read.schema(FILE).parquet(f"{self.path}/{head.folder}")
        for name, part in zip(("y", "m", "d"), prefix.split("/") if prefix else ()):
            out = out.where(F.col(name) == int(part))
        return out

    def _written(self, folder: str) -> DataFrame:
        try:
            found = self.spark.read.format("binaryFile").option("basePath", folder).load(folder)
        except AnalysisException as error:              # nothing was written
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return self.spark.createDataFrame([], FILE)
        if "d" not in found.columns:
            return self.spark.createDataFrame([], FILE)
        days = [F.col(c).cast("int").alias(c) for c in ("y", "m", "d")]
        return found.where("length > 0").select(*days, _plain(F.col("path")).alias("path"), F.col("length").alias("bytes"))

    def _commit(self, run: str, version: int, files: DataFrame) -> None:
        folder = f"manifest/version={version}"
        files.repartition(1).write.mode("overwrite").parquet(f"{self.path}/{folder}")
        self.log.commit(run, folder)

    def _next(self) -> int:
        head = self.log.head()
        return head.version + 1 if head else 1

    def append(self, envelopes: DataFrame, run: str, updated: str = "updatedAt") -> bool:
        """Add a run's raw envelopes; False if they are in.  Messages without a readable
        time stand under the day NULL and are read with an empty prefix only."""
        if self.log.find(run):
            return False
        version = self._next()
        folder = f"{self.path}/data/version={version}"
        (archive_frame(envelopes, updated).hint("rebalance", "y", "m", "d")
         .write.mode("overwrite").partitionBy("y", "m", "d").text(folder, compression=self.compression))
        self._commit(run, version, self.files().unionByName(self._written(folder)))
        return True

    def read(self, prefix: str = "", version: int | None = None) -> DataFrame:
        """(value, y, m, d) of the files of one version under a date prefix."""
        paths = [r.path for r in self.files(prefix, version).select("path").collect()]
        if not paths:
            return self.spark.createDataFrame([], "value string, y int, m int, d int")
        rows = self.spark.read.text(paths)
        day = [F.regexp_extract(F.col("_metadata.file_path"), f"/{c}=([0-9]+)/", 1).try_cast("int").alias(c) for c in ("y", "m", "d")]
        return rows.select("value", *day)

    def compact(self, prefix: str, target_bytes: int = TARGET_BYTES) -> int:
        """Pack the small files (under half of `target_bytes`) of each day under the prefix;
        returns how many files fewer there are.  The old ones stay until `vacuum`."""
        days: dict[tuple, list] = {}
        for r in self.files(prefix).where((F.col("bytes") * 2 < target_bytes) & F.col("d").isNotNull()).orderBy("path").collect():
            days.setdefault((r.y, r.m, r.d), []).append(r)
        places, number = [], 0
        for files in days.values():
            for found in pack([r.bytes for r in files], target_bytes):
                if len(found) > 1:
                    places += [(files[i].path, number) for i in found]
                    number += 1
        if not places:
            return 0
        version = self._next()
        folder = f"{self.path}/data/version={version}"
        bins = self.spark.createDataFrame(places, "path string, bin int")       # files of the days asked for
        rows = self.spark.read.text([p for p, _ in places])
        day = [F.regexp_extract(F.col("_metadata.file_path"), f"/{c}=([0-9]+)/", 1).cast("int").alias(c) for c in ("y", "m", "d")]
        rows = rows.select("value", _plain(F.col("_metadata.file_path")).alias("path"), *day).join(F.broadcast(bins), "path").drop("path")
        rows.repartition(number, "bin").write.mode("overwrite").partitionBy("y", "m", "d", "bin").text(folder, compression=self.compression)
        left = self.files().join(bins, "path", "left_anti").select("y", "m", "d", "path", "bytes")
        self._commit(f"compact-{version}", version, left.unionByName(self._written(folder)))
        return len(places) - number

    def vacuum(self) -> int:
        """Remove files that the newest version does not name; readers of older versions
        must be done.  Returns their number."""
        entries = self.log.entries()
        older = None
        for e in entries[:-1]:
            part = self.spark.read.schema(FILE).parquet(f"{self.path}/{e.folder}").select("path")
            older = part if older is None else older.unionByName(part)
        if older is None:
            return 0
        gone = older.distinct().join(self.files().select("path"), "path", "left_anti").collect()
        return sum(remove_path(self.spark, r.path) for r in gone)
