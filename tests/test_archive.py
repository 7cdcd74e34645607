"""K4: archive runs, compaction by bin packing, swap in one commit."""

import os

import pytest
from pyspark.sql import functions as F

from segflow.sinks.archive import Archive, pack
from segflow.sinks.commitlog import CommitLog
from segflow.sources import derived
from tests.conftest import SF001


def rows_of(df):
    return sorted(map(str, df.select("value", "y", "m", "d").collect()))


def test_pack():
    sizes = [5, 9, 1, 4, 4, 12, 3]
    bins = pack(sizes, 10)
    assert sorted(i for b in bins for i in b) == list(range(7))
    assert all(sum(sizes[i] for i in b) <= 10 or len(b) == 1 for b in bins) and len(bins) == 4
    assert pack([], 10) == []


def test_compaction_swaps_in_one_commit(spark, tmp_dir, monkeypatch):
    env = derived.derived_envelopes(spark, SF001).where("updatedAt LIKE '1995-0%'")
    one = env.withColumn("updatedAt", F.lit("bad time")).limit(1)
    archive = Archive(spark, os.path.join(tmp_dir, "a"))
    for k in range(3):
        assert archive.append(env.where(F.pmod(F.xxhash64("id"), F.lit(3)) == k), f"r{k}")
    assert not archive.append(env, "r1")
    archive.append(one, "bad")
    before, files = rows_of(archive.read()), archive.files().count()
    assert len(before) == env.count() + 1
    march = rows_of(archive.read("1995/3"))
    assert 0 < len(march) < len(before) and all(", y=1995, m=3," in r for r in march)
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            archive.compact("1995/3")
    assert rows_of(archive.read()) == before and archive.files().count() == files
    version = archive.log.head().version
    during = archive.read("1995/3", version)                            # a reader that began before the swap
    fewer = archive.compact("1995/3")
    assert fewer > 0 and archive.files().count() == files - fewer
    assert rows_of(during) == march == rows_of(archive.read("1995/3")) and rows_of(archive.read()) == before
    per_day = archive.files("1995/3").groupBy("d").count().collect()
    assert all(r["count"] == 1 for r in per_day)
    other = archive.files("1995/4").groupBy("d").count().collect()
    assert any(r["count"] > 1 for r in other)                            # days that were not asked for
    assert archive.compact("1995/3") == 0
    assert archive.vacuum() > 0 and rows_of(archive.read()) == before


def test_bins_keep_to_the_target(spark, tmp_dir):
    archive = Archive(spark, os.path.join(tmp_dir, "a"))
    for k in range(6):
        rows = spark.range(5).select(F.concat(F.lit(f"{k}-"), F.col("id")).alias("id"), F.lit("1995-03-15 10:00").alias("updatedAt"),
                                     F.repeat(F.lit("x"), 1000).alias("PID"))
        archive.append(rows.coalesce(1), f"r{k}")
    size = archive.files().first().bytes
    assert archive.compact("1995", target_bytes=3 * size + 10) == 4
    assert sorted(r.bytes for r in archive.files().collect()) == [3 * size, 3 * size]
    assert archive.read("1995/3/15").count() == 30 and archive.read("1996").count() == 0
    assert Archive(spark, os.path.join(tmp_dir, "none")).read().count() == 0
