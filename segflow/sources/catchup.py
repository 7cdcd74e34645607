"""A large relational catch-up that can stop and go on.

The key's range is cut once into ranges of about equal depth by a bounded histogram, so
a skewed key does not leave one reader with most rows.  The cuts are stored, and ranges
are read in waves; a wave's rows are written to a folder of their own and committed in
a log, which is the ledger of finished ranges.  A run that stops, by failure or on
purpose, leaves whole waves; the next one reads only what the ledger does not hold.
"""

from __future__ import annotations

import re
from typing import Callable, NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.sinks import tables
from segflow.sinks.commitlog import CommitLog
from segflow.sources.envelope import segments_from_blob

WAVE = 64               # ranges read in one job, at most
ACCURACY = 200          # the histogram's rank error: a 200th of a range's depth



class Range(NamedTuple):
    """Rows with lo <= key < hi (None is open), or those without a key."""

    number: int
    lo: int | None = None
    hi: int | None = None
    missing: bool = False


def equal_depth(rows: DataFrame, key: str, ranges: int) -> list[int]:
    """At most `ranges` - 1 rising cut points of an integer key.

    One aggregate over the key alone, with a sketch of bounded size in every task.  A
    single value that is more frequent than a range is deep has a range to itself.
    """
    shares = [k / ranges for k in range(1, ranges)]
    if not shares:
        return []
    found = rows.agg(F.percentile_approx(F.col(key).cast("long"), shares, ACCURACY * ranges).alias("c")).first().c
    return sorted({c + 1 for c in found or []})


def predicate(r: Range, key: str) -> str:
    """A range as SQL text, for any source that takes predicates."""
    if r.missing:
        return f"{key} IS NULL"
    ends = [f"{key} >= {r.lo}"] * (r.lo is not None) + [f"{key} < {r.hi}"] * (r.hi is not None)
    return " AND ".join(ends) or f"{key} IS NOT NULL"


def jdbc_reader(spark: SparkSession, url: str, table: str, properties: dict, key: str) -> Callable[[list[Range]], DataFrame]:
    """Reads ranges of a relational table, each as one partition."""
    return lambda ranges: spark.read.jdbc(url, table, predicates=[predicate(r, key) for r in ranges], properties=properties)


def table_reader(rows: DataFrame, key: str) -> Callable[[list[Range]], DataFrame]:
    """Reads ranges of a stored table; neighbours are joined into one interval, which
    the scan uses to skip files and row groups."""
    def read(ranges: list[Range]) -> DataFrame:
        spans: list[Range] = []
        for r in sorted(ranges, key=lambda x: x.number):
            last = spans[-1] if spans else None
            if last and not r.missing and last.hi is not None and last.hi == r.lo:
                spans[-1] = last._replace(hi=r.hi)
            else:
                spans.append(r)
        return rows.where(" OR ".join(f"({predicate(r, key)})" for r in spans))

    return read


class CatchUp:
    """A catch-up into the table at `path`.

    keys: a frame that holds the key column (read once, for the plan); read: gives the
    rows of some ranges (`jdbc_reader`, `table_reader`).  The key is an integer; rows
    without one have a range of their own.  One run at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keys: DataFrame, read: Callable[[list[Range]], DataFrame], key: str,
                 ranges: int = 256, blob_col: str = "hl7"):
        self.spark, self.path, self.keys, self.read = spark, path.rstrip("/"), keys, read
        self.key, self.ranges, self.blob_col = key, ranges, blob_col
        self.ledger = CommitLog(spark, self.path)

    def plan(self) -> list[Range]:
        """All ranges in key order, the one of rows without a key last; made by the
        first run and kept."""
        place = f"{self.path}/plan"
        try:
            cuts = sorted(r.cut for r in self.spark.read.schema("cut long").parquet(place).collect())
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            cuts = equal_depth(self.keys, self.key, self.ranges)
            self.spark.createDataFrame([(c,) for c in cuts], "cut long").coalesce(1).write.parquet(place)
        spans = [Range(k, lo, hi) for k, (lo, hi) in enumerate(zip([None, *cuts], [*cuts, None]))]
        return [*spans, Range(len(spans), missing=True)]

    def pending(self) -> list[Range]:
        done: set[int] = set()
        for e in self.ledger.entries():
            first, last = map(int, re.fullmatch(r"ranges-(\d+)-(\d+)", e.run).groups())
            done.update(range(first, last + 1))
        return [r for r in self.plan() if r.number not in done]

    def _number(self, wave: list[Range]) -> Column:
        out = F.lit(wave[-1].number)
        for r in reversed(wave[:-1]):
            out = F.when(F.expr(predicate(r, self.key)), F.lit(r.number)).otherwise(out)
        return out.cast("int")

    def run(self, max_waves: int | None = None, wave: int = WAVE) -> int:
        """Read what is pending, `wave` ranges a job; returns the ranges done now."""
        todo, done, waves = self.pending(), 0, 0
        while todo and (max_waves is None or waves < max_waves):
            part = [r for k, r in enumerate(todo[:wave]) if r.number == todo[0].number + k]     # neighbours
            rows = self.read(part).withColumn("range", self._number(part))
            env = segments_from_blob(rows, self.blob_col, extra=("range",))
            tables.append_once(env, self.path, f"ranges-{part[0].number}-{part[-1].number}", partition_by=["range"], compression="zstd")
            todo, done, waves = todo[len(part):], done + len(part), waves + 1
        return done

    def envelopes(self) -> DataFrame:
        """Envelopes read so far, with `repeated` and `range`; segments as rows come from
        the same copy (`envelope.envelope_segments`)."""
        return tables.read_committed(self.spark, self.path)
