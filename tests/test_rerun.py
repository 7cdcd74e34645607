"""Runs that are repeated: commit log, idempotent appends, patient merges, one parse a run."""

import glob
import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from segflow import session
from segflow.operators import patients
from segflow.plans import etl
from segflow.sinks import tables
from segflow.sinks.commitlog import CommitLog, first_seen
from segflow.sinks.patient_table import PatientTable, buckets_for
from segflow.sources import derived
from segflow.sources.envelope import ENVELOPE
from tests.conftest import SF001
from tests.test_restart import shuffled


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_append_once_survives_a_failure_between_write_and_commit(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t")
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "patientid string, pt_gender string")

    def fail(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", fail)
        with pytest.raises(OSError):
            tables.append_once(a, path, "r1")
    assert tables.read_committed(spark, path).count() == 0 and glob.glob(f"{path}/data/*r1/*.parquet")
    assert tables.append_once(a.limit(1), path, "r0") == 1
    assert tables.append_once(a, path, "r1") == 2
    assert tables.append_once(a, path, "r1") == 2                        # a rerun writes nothing
    assert tables.read_committed(spark, path).count() == 3
    assert tables.read_committed(spark, path, runs=["r1"]).count() == 2
    assert [e.run for e in CommitLog(spark, path).entries()] == ["r0", "r1"]
    with pytest.raises(ValueError):
        tables.append_once(a, path, "../r")


def test_columns_come_from_the_log(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    a = spark.createDataFrame([("1", "x")], "patientid string, pt_gender string")
    b = spark.createDataFrame([("z", "2")], "pt_email string, patientid string")
    tables.append_once(a, path, "a")
    tables.append_once(b, path, "b")
    assert tables.append_once(a.where("false"), path, "c", skip_empty=True) == 0
    got = tables.read_committed(spark, path)
    assert got.columns == ["patientid", "pt_gender", "pt_email"]
    assert rows_of(got) == rows_of(spark.createDataFrame([("1", "x", None), ("2", None, "z")], got.schema))
    assert sorted(map(tuple, tables.committed_columns(spark, path).collect())) == [
        ("patientid", "a", 1), ("pt_email", "b", 2), ("pt_gender", "a", 1)]
    assert "c" not in [e.run for e in CommitLog(spark, path).entries()]
    with pytest.raises(ValueError):
        first_seen([a.schema, spark.createDataFrame([(1,)], "patientid long").schema])


def test_publish_statements_leave_one_copy():
    """The relational half, run in this process's own in-memory database."""
    con = duckdb.connect()
    con.execute("CREATE TABLE v4_acme (patientid text, pt_gender text)")

    def publish(run, rows):
        con.execute("CREATE OR REPLACE TABLE v4_acme_stage (patientid text, pt_gender text)")
        con.executemany("INSERT INTO v4_acme_stage VALUES (?, ?)", rows)
        con.execute("BEGIN")
        for s in tables.publish_statements("v4_acme", run, ["patientid", "pt_gender"]):
            con.execute(s)
        con.execute("COMMIT")

    for run in ("r1", "r1", "r2", "r1"):
        publish(run, [(run, "x"), (run, "y")])
    assert con.execute("SELECT patientid, count(*) FROM v4_acme GROUP BY 1 ORDER BY 1").fetchall() == [("r1", 2), ("r2", 2)]
    with pytest.raises(ValueError):
        tables.publish_statements("v4_acme", "x'; DROP TABLE v4_acme; --", ["patientid"])


def test_feed_run_repeated(spark, tmp_dir):
    env = derived.derived_envelopes(spark, SF001)
    broken = env.withColumn("patientId", F.when(F.col("tenantId") != "5-LOW", F.col("patientId")))
    path = os.path.join(tmp_dir, "feeds")
    first = etl.run_feeds_parquet(broken, ["acme", "road-runner"], path, run="n1")
    assert etl.run_feeds_parquet(broken, ["acme", "road-runner"], path, run="n1") == first
    kept = etl.patient_rows(broken.where("patientId IS NOT NULL")).count()
    assert first == {"v4_acme": kept, "v4_road_runner": kept}
    back = tables.read_committed(spark, path)
    assert {r.table_name: r["count"] for r in back.groupBy("table_name").count().collect()} == first
    assert tables.read_committed(spark, f"{path}_dead").count() == broken.where("patientId IS NULL").count()
    assert etl.run_feeds_parquet(broken, ["acme"], os.path.join(tmp_dir, "none"), run="n1", states=("ZZ",)) == {}


def counted(spark, df):
    """The frame, and an accumulator of its rows as they are computed."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema), seen


@pytest.mark.parametrize("run", [None, "n1"])
def test_a_feed_run_reads_its_source_once(spark, tmp_dir, run):
    env = derived.derived_envelopes(spark, SF001)
    n = env.count()
    damaged = env.withColumn("PID", F.when(F.col("tenantId") == "5-LOW", F.col("PV1")).otherwise(F.col("PID")))
    source, seen = counted(spark, damaged)
    etl.run_feeds_parquet(source, ["acme"], os.path.join(tmp_dir, "feeds"), run=run)
    assert seen.value == n


def test_written_copy_is_removed(spark):
    with session.written(spark.range(5).toDF("x"), "copy") as copy:
        folder = copy.inputFiles()[0]
        assert copy.count() == 5
    assert not os.path.exists(folder.removeprefix("file://"))


def batches(spark):
    env = etl.prepared(derived.derived_envelopes(spark, SF001))
    return env, [env.where(F.pmod(F.xxhash64("id"), F.lit(3)) == k) for k in range(3)]


def bucket_files(path):
    return {os.path.relpath(f, path) for f in glob.glob(f"{path}/data/version=*/bucket=*/*.parquet")}


def test_patient_merge_equals_batch(spark, tmp_dir):
    env, parts = batches(spark)
    table = PatientTable(spark, os.path.join(tmp_dir, "p"), buckets=8)
    assert [table.merge(b, f"b{k}") for k, b in enumerate(parts)] == [1, 2, 3]
    assert table.merge(parts[1], "b1") == 2                              # replayed
    want = patients.latest_per_patient(env)
    assert rows_of(table.read().select(*want.columns)) == rows_of(want)
    older = patients.latest_per_patient(parts[0])
    assert rows_of(table.read(version=1).select(*older.columns)) == rows_of(older)
    files = len(bucket_files(table.path))
    assert table.vacuum() == 16 and table.vacuum() == 0 and len(bucket_files(table.path)) < files
    assert rows_of(table.read().select(*want.columns)) == rows_of(want)


def test_merge_rewrites_touched_buckets_only(spark, tmp_dir):
    env, _ = batches(spark)
    table = PatientTable(spark, os.path.join(tmp_dir, "p"), buckets=8)
    table.merge(env, "all")
    before, places = bucket_files(table.path), table.manifest()
    one = env.limit(1)
    update = one.withColumn("updatedat", F.lit("2099-01-01 00:00")).withColumn("new_column", F.lit("n"))
    table.merge(update, "one")
    after, now = bucket_files(table.path), table.manifest()
    assert before < after and len({b for b in now if now[b] != places[b]}) == 1
    row = table.read().where("updatedat = '2099-01-01 00:00'").collect()
    assert len(row) == 1 and row[0].new_column == "n" and table.read().count() == env.select("patientid").distinct().count()
    late = one.withColumn("updatedat", F.lit("1970-01-01 00:00")).withColumn("id", F.lit("late"))
    table.merge(late, "late")                                           # an older record does not win
    assert table.read().where("id = 'late'").count() == 0
    table.merge(env.where("false"), "empty")
    table.merge(one.withColumn("patientid", F.lit(None).cast("string")), "nobody")
    assert table.manifest() == {**now, **{b: 3 for b in now if now[b] == 2}}


def patient_lots(spark, lots=5, patients_=40, n=300):
    """Batches of wide rows: several records of a patient, equal orders, missing ids and
    times, rows without a patient."""
    text = F.concat_ws(" ", *[F.sha2(F.concat_ws("-", F.lit(i), "id", "lot"), 512) for i in range(4)])
    rows = spark.range(lots * n).select(
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("p"), F.pmod(F.xxhash64("id"), F.lit(patients_)))).alias("patientid"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("2020-01-0"), 1 + F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(9)), F.lit(" 10:00"))).alias("updatedat"),
        F.when(F.col("id") % 11 != 0, F.col("id").cast("string")).alias("id"), (F.col("id") % lots).alias("lot"))
    rows = rows.withColumn("text", text).drop("lot").withColumn("lot", F.pmod(F.xxhash64("text"), F.lit(lots)))
    return [rows.where(F.col("lot") == k).drop("lot") for k in range(lots)]


def test_merges_keep_the_newest_of_every_patient(spark, tmp_dir, monkeypatch):
    """Also where buckets of many parts are dealt anew, and with rows in one word of bits."""
    from segflow.sinks import patient_table

    monkeypatch.setattr(patient_table, "PARTS", 2)
    lots = patient_lots(spark, patients_=400, n=900)
    table = PatientTable(spark, os.path.join(tmp_dir, "p"), buckets=3)
    seen = None
    for k, lot in enumerate(lots):
        table.merge(lot, f"lot-{k}")
        seen = lot if seen is None else seen.unionByName(lot)
        want = seen.where("patientid IS NOT NULL").groupBy("patientid").agg(F.max(patients.record_order()).alias("o")).select("patientid", "o.*")
        got = table.read().select("patientid", patients.record_order().alias("o")).select("patientid", "o.*")
        assert rows_of(got) == rows_of(want)
    assert table.read().exceptAll(seen).count() == 0                     # whole rows, as they came
    files = [len(glob.glob(f"{table._folder(v, b)}/*.parquet")) for b, v in table.manifest().items()]
    assert len(files) == 3 and {n for _, n in table._manifest().values()} == {1} and set(files) == {1}


def test_merge_shuffles_the_rows_that_win(spark, tmp_dir):
    """Wide rows that stay, or lose, are not shuffled."""
    table = PatientTable(spark, os.path.join(tmp_dir, "p"), buckets=4)
    key, text = F.concat(F.lit("p"), F.col("id")).alias("patientid"), F.concat_ws(" ", *[F.sha2(F.concat_ws("-", F.lit(i), "id"), 512) for i in range(16)])
    def lot(time, every):
        return spark.range(4000).where(F.col("id") % every == 0).select(key, F.lit(time).alias("updatedat"), F.col("id").cast("string"), text.alias("text"))
    whole = shuffled(spark, lambda: table.merge(lot("2020-01-02 10:00", 1), "first"))
    older = shuffled(spark, lambda: table.merge(lot("2020-01-01 10:00", 1), "older"))
    few = shuffled(spark, lambda: table.merge(lot("2020-01-03 10:00", 40), "few"))
    assert whole > 4_000_000 and older < 0.2 * whole and few < 0.2 * whole
    assert {r.updatedat: r["count"] for r in table.read().groupBy("updatedat").count().collect()} == {"2020-01-02 10:00": 3900, "2020-01-03 10:00": 100}


def test_merge_stream_query_reads_compressed_files(spark, tmp_dir, monkeypatch):
    from segflow.plans import queries

    monkeypatch.setattr(session, "work_path", lambda _, name: os.path.join(tmp_dir, f"{name}-{os.urandom(4).hex()}"))
    assert queries.adt_latest_stream_dead_letter(spark, SF001).where("kind = 'dead'").count() > 0
    files = glob.glob(os.path.join(tmp_dir, "merge-in-*", "part-*"))
    assert files and all(f.endswith(".txt.gz") for f in files)


def test_failed_merge_is_not_seen(spark, tmp_dir, monkeypatch):
    env, parts = batches(spark)
    table = PatientTable(spark, os.path.join(tmp_dir, "p"), buckets=4)
    table.merge(parts[0], "b0")
    before = rows_of(table.read())
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.merge(parts[1], "b1")
    assert rows_of(table.read()) == before
    table.merge(parts[1], "b1")
    want = patients.latest_per_patient(parts[0].unionByName(parts[1]))
    assert rows_of(table.read().select(*want.columns)) == rows_of(want)


def test_buckets_follow_size():
    assert buckets_for(1) == 1 and buckets_for(100 << 40, 1 << 30) == 102_400


def test_merge_stream_with_dead_letters(spark, tmp_dir):
    from segflow.streaming.stream import read_latest, start_latest_stream, start_merge_stream

    env = derived.derived_envelopes(spark, SF001)
    damaged = env.withColumn("patientId", F.when(F.col("tenantId") != "5-LOW", F.col("patientId")))
    src = os.path.join(tmp_dir, "in")
    damaged.repartition(3).write.json(src)
    with open(os.path.join(src, "bad.json"), "w") as f:
        f.write("{broken\n")
    table = PatientTable(spark, os.path.join(tmp_dir, "p"), buckets=4)
    for _ in range(2):                                                  # the second start finds nothing new
        start_merge_stream(spark, src, table, os.path.join(tmp_dir, "c1"), max_files_per_trigger=1).awaitTermination()
    start_latest_stream(spark, src, os.path.join(tmp_dir, "l"), os.path.join(tmp_dir, "c2"), max_files_per_trigger=2).awaitTermination()
    want = patients.latest_per_patient(etl.prepared(damaged.where("patientId IS NOT NULL")))
    assert rows_of(table.read().select(*want.columns)) == rows_of(want)
    assert rows_of(read_latest(spark, os.path.join(tmp_dir, "l")).select(*want.columns)) == rows_of(want)
    for dead in (f"{table.path}_dead", os.path.join(tmp_dir, "l_dead")):
        reasons = spark.read.parquet(dead).groupBy("reason").count().collect()
        assert {r.reason: r["count"] for r in reasons} == {"invalid json": 1, "no patientId": damaged.where("patientId IS NULL").count()}


def test_a_micro_batch_is_parsed_once(spark, tmp_dir, monkeypatch):
    """Rows that a batch's source gives, counted over everything the batch does."""
    from segflow.streaming import stream

    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.writelines(json.dumps({"patientId": str(i), "id": str(i), "PID": "PV1|x" if i % 3 else "PID|1"}) + "\n" for i in range(30))
    plain = stream.tag_envelopes
    counters = []

    def tag(batch):
        source, seen = counted(spark, batch)
        counters.append(seen)
        return plain(source)

    monkeypatch.setattr(stream, "tag_envelopes", tag)
    stream.start_patient_stream(spark, src, os.path.join(tmp_dir, "o"), os.path.join(tmp_dir, "c"), states=None).awaitTermination()
    assert [c.value for c in counters] == [30]
    assert spark.read.parquet(os.path.join(tmp_dir, "o_dead")).count() == 20 and set(ENVELOPE.names) >= {"PID"}
