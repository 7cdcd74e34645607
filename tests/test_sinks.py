"""Sinks: Parquet twin of the relational append, schema evolution, feed
fan-out, archive partitions, DDL generation, dead letters, other sources."""

import json
import os

from pyspark.sql import functions as F

from segflow import layout
from segflow.operators import deadletter
from segflow.plans import etl
from segflow.sinks import tables
from segflow.sources import derived, envelope
from tests.conftest import SF001


def test_append_parquet_and_evolving_read(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    a = spark.createDataFrame([("1", "x")], "patientid string, pt_gender string")
    b = spark.createDataFrame([("2", "y", "z")], "patientid string, pt_gender string, pt_email string")
    assert tables.append_parquet(a, path) == 1
    assert tables.append_parquet(b, path) == 1
    got = {r.patientid: r.asDict() for r in tables.read_evolving(spark, path).collect()}
    assert got["1"]["pt_email"] is None and got["2"]["pt_email"] == "z"


def test_union_evolving(spark):
    a = spark.createDataFrame([("1",)], "patientid string")
    b = spark.createDataFrame([("2", "z")], "patientid string, pt_email string")
    got = sorted((r.patientid, r.pt_email) for r in tables.union_evolving([a, b]).collect())
    assert got == [("1", None), ("2", "z")]


def test_missing_columns_ddl():
    ddl = tables.missing_columns_ddl("v4_acme", ["patientid", "pt_email", "PT_GENDER"], ["patientid", "pt_gender"])
    assert ddl == ["CREATE TABLE IF NOT EXISTS v4_acme ();",
                   "ALTER TABLE v4_acme ADD COLUMN IF NOT EXISTS pt_email text;"]


def test_feeds_parquet_one_job(spark, tmp_dir):
    env = derived.derived_envelopes(spark, SF001)
    out = etl.run_feeds_parquet(env, ["acme", "road-runner"], os.path.join(tmp_dir, "feeds"))
    expected = etl.patient_rows(env).count()
    assert out == {"v4_acme": expected, "v4_road_runner": expected}
    back = spark.read.parquet(os.path.join(tmp_dir, "feeds"))
    assert {r.table_name: r["count"] for r in back.groupBy("table_name").count().collect()} == out


def test_fan_out_by_tenant(spark):
    df = spark.createDataFrame([("a", "acme"), ("b", "other")], "patientid string, tenantid string")
    out = tables.fan_out(df, ["acme", "other"], tenant_col="tenantid").collect()
    assert {(r.patientid, r.table_name) for r in out} == {("a", "v4_acme"), ("b", "v4_other")}


def test_archive_partitioned_and_pruned(spark, tmp_dir):
    env = derived.derived_envelopes(spark, SF001)
    path = os.path.join(tmp_dir, "archive")
    tables.write_archive(env, path)
    back = spark.read.text(path)
    assert back.count() == env.count()
    one_day = back.where("y = 1995 AND m = 3 AND d = 15")
    assert "PartitionFilters: [isnotnull(y" in one_day._jdf.queryExecution().executedPlan().toString()
    for r in one_day.limit(5).collect():
        assert json.loads(r.value)["updatedAt"].startswith("1995-03-15")


def test_date_prefix(spark):
    df = spark.createDataFrame([("2023-09-01 05:54:56",)], "u string")
    from segflow.operators.patients import parse_updated

    r = df.select(envelope.date_prefix(parse_updated("u")).alias("p"),
                  envelope.date_prefix(parse_updated("u"), padded=True).alias("q")).first()
    assert (r.p, r.q) == ("2023/9/1", "2023/09/01")


def test_dead_letters(spark):
    good = json.dumps({"patientId": "1", "PID": "PID|1||x", "PV1": "PV1|||a"})
    docs = spark.createDataFrame([
        ("k1", good),
        ("k2", "{not json"),
        ("k3", json.dumps({"PID": "PID|1"})),
        ("k4", json.dumps({"patientId": "2", "PID": "PV1|||a"})),
        ("k5", json.dumps(good)),                         # double-encoded, still good
    ], "key string, json string")
    ok, dead = deadletter.route_dead_letters(docs)
    assert ok.count() == 2
    assert {(r.key, r.reason) for r in dead.collect()} == {
        ("k2", "invalid json"), ("k3", "no patientId"), ("k4", "segment PID holds PV1")}


def test_document_scan_literal_prefix(spark):
    docs = spark.createDataFrame([("pid_1", json.dumps({"patientId": "1"})),
                                  ("pidX1", json.dumps({"patientId": "2"})),
                                  ("other_1", json.dumps({"patientId": "3"}))], "key string, json string")
    got = [r.patientId for r in envelope.scan_documents(docs).collect()]
    assert got == ["1"]


def test_blob_segments_last_wins(spark):
    rows = spark.createDataFrame([("1", "MSH|x\rPID|1||a\nOBX|1|A\r\nOBX|2|B\rPV1")],
                                 "patientId string, hl7 string")
    r = envelope.segments_from_blob(rows, meta=("patientId",)).first()
    assert (r.PID, r.OBX, r.PV1, r.EVN) == ("PID|1||a", "OBX|2|B", "PV1", None)


def test_blob_keeps_repeated_segments(spark):
    rows = spark.createDataFrame([("1", "MSH|x\rDG1|1|a\rOBX|1|A\rDG1|2|b\rDG1|3|c^d"), ("2", None), ("3", "")],
                                 "patientId string, hl7 string")
    r = {x.patientId: x for x in envelope.segments_from_blob(rows, meta=("patientId",)).collect()}
    assert r["1"].DG1 == "DG1|3|c^d" and r["2"].DG1 is None and r["3"].DG1 is None
    assert [tuple(x) for x in r["1"].repeated] == [("dg1", 1, "DG1|1|a"), ("dg1", 2, "DG1|2|b")]
    got = sorted((x.seg, x.occurrence, x.text) for x in envelope.blob_segments(rows, meta=("patientId",)).collect())
    assert got == [("dg1", 1, "DG1|1|a"), ("dg1", 2, "DG1|2|b"), ("dg1", 3, "DG1|3|c^d"), ("obx", 1, "OBX|1|A")]


BAD = ["{not json", '{"patientId": "7"', "[]", "17", '"text"', "{}", "null", '{"unknown": 1}']


def test_no_empty_envelope_leaves_a_reader(spark, tmp_dir):
    good = json.dumps({"patientId": 5, "PID": "PID|1"})
    path = os.path.join(tmp_dir, "lines.json")
    with open(path, "w") as f:
        f.write("\n".join([good, *BAD]))
    for schema in (envelope.ENVELOPE, None):
        ok, dead = envelope.read_json_routed(spark, path, schema, multiline=False)
        assert [r.patientId for r in ok.collect()] == ["5"] or schema is None
        assert all(any(v is not None for v in r) for r in ok.collect())
    docs = spark.createDataFrame([(f"pid_{i}", t) for i, t in enumerate([good, *BAD, None])], "key string, json string")
    ok, dead = envelope.scan_documents_routed(docs)
    assert [r.patientId for r in ok.collect()] == ["5"] and dead.count() == len(BAD) + 1
    ok, dead = envelope.read_message_table_routed(docs, "json")
    assert [r.patientId for r in ok.collect()] == ["5"] and dead.count() == len(BAD) + 1


def test_feeds_write_dead_letters_beside_the_tables(spark, tmp_dir):
    rows = [("1", "PID|1||||A^B||||||1 RD^^C^CA^1"), (None, "PID|1||||C"), ("3", "PV1|||X")]
    env = spark.createDataFrame(rows, "patientId string, PID string").withColumn("dob", F.lit(None).cast("string"))
    path = os.path.join(tmp_dir, "feeds")
    assert etl.run_feeds_parquet(env, ["acme"], path) == {"v4_acme": 1}
    assert sorted(r.reason for r in spark.read.parquet(path + "_dead").collect()) == ["no patientId", "segment PID holds PV1"]


def test_only_a_missing_table_is_created():
    assert tables.missing_table(RuntimeError('ERROR: relation "v4_roles" does not exist; SQLState 42P01'))
    assert not tables.missing_table(RuntimeError('FATAL: role "etl" does not exist'))
    assert not tables.missing_table(RuntimeError('FATAL: database "x" does not exist'))
    assert not tables.missing_table(RuntimeError("Connection refused"))


def test_message_table_both_encodings(spark):
    body = json.dumps({"patientId": "1", "PID": "PID|1"})
    df = spark.createDataFrame([(body,), (json.dumps(body),)], "patientjson string")
    got = envelope.read_message_table(df, dedupe=False).collect()
    assert [(r.patientId, r.PID) for r in got] == [("1", "PID|1")] * 2


def test_table_names():
    assert layout.table_name("adt-feed1") == "v4_adt_feed1"


def test_run_feeds_jdbc_control_flow(spark, monkeypatch):
    """K1-K3 + F2 + P5 on the relational path, with the JDBC calls stubbed
    (no database can run here): one checkpointed frame, one append per feed,
    names truncated, nothing written for an empty result."""
    calls = []

    def fake_append(df, url, table, props):
        calls.append((table, df.count(), max(len(c.encode()) for c in df.columns)))
        return calls[-1][1]

    monkeypatch.setattr(tables, "append_jdbc", fake_append)
    env = derived.derived_envelopes(spark, SF001)
    out = etl.run_feeds_jdbc(env, ["acme", "road-runner"], "jdbc:none", {})
    expected = etl.patient_rows(env).count()
    assert out == {"v4_acme": expected, "v4_road_runner": expected}
    assert [c[0] for c in calls] == ["v4_acme", "v4_road_runner"]
    assert all(c[2] <= 63 for c in calls)

    calls.clear()
    assert etl.run_feeds_jdbc(env, ["acme"], "jdbc:none", {}, states=("ZZ",)) == {}
    assert calls == []


def test_run_feeds_jdbc_evolving_ddl(spark, monkeypatch):
    ddl_seen = []
    monkeypatch.setattr(tables, "append_jdbc", lambda df, url, table, props: 0)

    class FakeReader:
        def jdbc(self, *a, **k):
            raise RuntimeError("no such table")

    monkeypatch.setattr(type(spark), "read", property(lambda self: FakeReader()))
    env_df = spark.createDataFrame([("1", "1990-01-01", "PID|1||||A^B||||||1 RD^^C^CA^1")],
                                   "patientId string, dob string, PID string")
    etl.run_feeds_jdbc(env_df, ["acme"], "jdbc:none", {}, evolve_ddl=ddl_seen.extend)
    assert ddl_seen[0] == "CREATE TABLE IF NOT EXISTS v4_acme ();"
    assert "ALTER TABLE v4_acme ADD COLUMN IF NOT EXISTS pt_address_state_prov text;" in ddl_seen
