"""Digest dedupe, restartable catch-up, and replay of dead letters."""

import json
import os

import pytest
from pyspark.sql import functions as F

from segflow.operators import deadletter, dedupe
from segflow.operators.replay import DeadLetterStore, letters_of
from segflow.sinks import tables
from segflow.sources import catchup, derived, envelope
from segflow.sources.catchup import CatchUp, Range, equal_depth, predicate, table_reader
from tests.conftest import SF001


def rows_of(df):
    return sorted(map(str, df.collect()))


def shuffled(spark, action):
    """Bytes that an action's stages write to shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def total():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(None, *[getattr(store, f"stageList$default${k}")() for k in range(2, 6)])
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = total()
    action()
    return total() - before


def test_digest_dedupe_is_exact(spark, monkeypatch):
    rows = [("1", "a", None), ("1", None, "a"), (None, "1", "a"), ("1", "a", None), (None, None, None), (None, None, None),
            ("1", "a", ""), ("", "", ""), ("x", "y", "z")] + [("copy", "c", "c")] * 40 + [(str(i), "u", "v") for i in range(300)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    want = rows_of(df.dropDuplicates())
    assert rows_of(dedupe.dedupe_by_digest(df)) == want
    assert rows_of(dedupe.dedupe_by_digest(df, max_bits=64)) == want           # a filter that is far too small
    assert rows_of(dedupe.dedupe_by_digest(df.where("false"))) == []
    monkeypatch.setattr(dedupe, "MIN_BITS", 64)
    monkeypatch.setattr(dedupe, "digest", lambda c: [F.lit(5).cast("long").alias("_d1"), F.lit(6).cast("long").alias("_d2")])
    assert rows_of(dedupe.dedupe_by_digest(df)) == want                         # every digest collides


def test_digest_dedupe_shuffles_little(spark, tmp_dir):
    path = os.path.join(tmp_dir, "env")
    env = derived.derived_envelopes(spark, SF001)
    env.write.parquet(path)
    stored = spark.read.parquet(path)
    whole = shuffled(spark, lambda: stored.dropDuplicates().write.format("noop").mode("overwrite").save())
    little = shuffled(spark, lambda: dedupe.dedupe_by_digest(stored).write.format("noop").mode("overwrite").save())
    copies = stored.count() - stored.dropDuplicates().count()
    assert copies / stored.count() > 0.1 and little < 0.5 * whole
    assert rows_of(dedupe.dedupe_by_digest(stored)) == rows_of(stored.dropDuplicates())


def skewed(spark, n=6000):
    """Keys that lie closely at one end, some rows without a key, one key a hundred times."""
    ids = spark.range(n).select(F.when(F.col("id") % 500 == 0, None).otherwise((F.col("id") * F.col("id") * F.col("id")) / 1000)
                                .cast("long").alias("k"), F.concat(F.lit("MSH|x\rPID|"), F.col("id")).alias("hl7"),
                                F.col("id").cast("string").alias("id"))
    return ids.unionByName(spark.range(100).select(F.lit(-7).cast("long").alias("k"), F.lit("EVN|a\rEVN|b").alias("hl7"),
                                                   F.concat(F.lit("m"), F.col("id")).alias("id")))


def test_ranges_have_equal_depth(spark):
    rows = skewed(spark)
    cuts = equal_depth(rows, "k", 16)
    ranges = [Range(i, a, z) for i, (a, z) in enumerate(zip([None, *cuts], [*cuts, None]))]
    sizes = [rows.where(predicate(r, "k")).count() for r in ranges]
    assert sum(sizes) == rows.where("k IS NOT NULL").count() and len(sizes) == 16
    assert max(sizes) <= 2 * min(sizes)
    assert equal_depth(rows.where("false"), "k", 16) == [] and equal_depth(rows, "k", 1) == []
    assert equal_depth(rows.where("k = -7"), "k", 4) == [-6]                     # one value is not cut
    assert predicate(Range(0), "k") == "k IS NOT NULL"


def reader(rows, log):
    read = table_reader(rows, "k")

    def logged(ranges):
        log.append([r.number for r in ranges])
        return read(ranges)

    return logged


def test_catch_up_goes_on_where_it_stopped(spark, tmp_dir, monkeypatch):
    src = os.path.join(tmp_dir, "src")
    skewed(spark).repartitionByRange(4, "k").sortWithinPartitions("k").write.parquet(src)
    rows, out, log = spark.read.parquet(src), os.path.join(tmp_dir, "out"), []

    def job():
        return CatchUp(spark, out, rows.select("k"), reader(rows, log), "k", ranges=10)

    assert job().run(max_waves=1, wave=4) == 4 and log == [[0, 1, 2, 3]]
    with monkeypatch.context() as m:
        m.setattr(catchup.tables, "append_once", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job().run(wave=3)
    log.clear()
    done = job()
    assert [r.number for r in done.pending()] == [4, 5, 6, 7, 8, 9, 10]
    assert done.run(wave=5) == 7 and log == [[4, 5, 6, 7, 8], [9, 10]] and job().run() == 0
    got = done.envelopes()
    assert got.count() == rows.count() and got.select("id").distinct().count() == rows.count()
    assert got.where("range = 10").count() == rows.where("k IS NULL").count()
    plain = envelope.blob_segments(rows, meta=("id",))
    assert rows_of(envelope.envelope_segments(got, meta=("id",)).select(*plain.columns)) == rows_of(plain)


def test_catch_up_of_an_empty_table(spark, tmp_dir):
    rows = skewed(spark).where("false")
    job = CatchUp(spark, os.path.join(tmp_dir, "o"), rows.select("k"), table_reader(rows, "k"), "k", ranges=10)
    assert job.run() == 2 and job.run() == 0 and job.envelopes().count() == 0


def test_pending_ranges_are_pushed_to_the_scan(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    skewed(spark).write.parquet(src)
    read = table_reader(spark.read.parquet(src), "k")([Range(3, 5, 9), Range(4, 9, 20), Range(7, 40, None)])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,5)" in plan and "LessThan(k,20)" in plan and "LessThan(k,9)" not in plan


def test_replay_keeps_every_letter(spark, tmp_dir):
    docs = [json.dumps({"patientId": "1", "id": "1", "PID": "PID|1"}), "{broken", json.dumps({"id": "2"}), "{still broken",
            json.dumps({"patientId": "3", "id": "3", "PID": "PV1|x"})]
    frame = spark.createDataFrame([(f"k{i}", d) for i, d in enumerate(docs)], "key string, json string")
    _, dead = deadletter.route_dead_letters(frame)
    store = DeadLetterStore(spark, os.path.join(tmp_dir, "s"), max_attempts=2)

    def counts():
        return store.good().count(), store.waiting().count(), store.parked().count()

    assert counts() == (0, 0, 0) and store.add(dead, "n1") and not store.add(dead, "n1")
    assert counts() == (0, 4, 0)
    mend = lambda letters: letters.withColumn(
        "body", F.when(F.col("body") == "{broken", F.lit('{"patientId": "9", "id": "9"}')).otherwise(F.col("body")))
    assert store.replay("r1", mend) and not store.replay("r1", mend)
    assert counts() == (1, 3, 0) and [r.id for r in store.good().collect()] == ["9"]
    waiting = {r.body: (r.reason, r.attempts) for r in store.waiting().collect()}
    assert waiting["{still broken"] == ("invalid json", 1) and waiting[docs[2]] == ("no patientId", 1)
    store.add(spark.createDataFrame([("4", None, "no patientId")], "id string, patientId string, reason string"), "n2")
    assert counts() == (1, 4, 0)
    store.replay("r2")
    assert counts() == (1, 1, 3)                                        # good + waiting + parked = 5 letters
    assert {(r.added, r.attempts) for r in store.parked().collect()} == {("n1", 2)}
    assert [r.body for r in store.waiting().collect()] == ['{"id":"4"}']


def test_failed_replay_changes_nothing(spark, tmp_dir, monkeypatch):
    store = DeadLetterStore(spark, os.path.join(tmp_dir, "s"), max_attempts=1)
    store.add(spark.createDataFrame([("{x", "invalid json")], "_corrupt_record string, reason string"), "n1")
    before = rows_of(store.waiting())
    with monkeypatch.context() as m:
        m.setattr(tables.CommitLog, "commit", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.replay("r1")
    assert rows_of(store.waiting()) == before and store.parked().count() == 0
    store.replay("r1")
    assert store.waiting().count() == 0 and store.parked().count() == 1


def test_letters_keep_their_text(spark):
    env = spark.createDataFrame([("7", "{bad", "invalid json"), ("8", None, "no patientId")], "id string, _corrupt_record string, reason string")
    assert {r.reason: r.body for r in letters_of(env).collect()} == {"invalid json": "{bad", "no patientId": '{"id":"8"}'}
