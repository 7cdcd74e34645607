"""Clustered document store, VARIANT inference, observed columns."""

import os

import pytest
from pyspark.sql import functions as F

from segflow.operators import extract, shape
from segflow.plans import etl
from segflow.sinks import tables
from segflow.sources import derived, documents, envelope
from segflow.sources.inferred import _names, read_json_variant
from tests.conftest import SF001


def rows_of(df):
    return sorted(map(str, df.collect()))


def scanned(df):
    """Rows that the scan of a plan gave, from its metrics."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_prefix_scan_reads_few_row_groups(spark, tmp_dir):
    docs = spark.range(40_000).select(F.format_string("pid_%05d_%d", F.col("id") % 800, F.col("id")).alias("key"),
                                      F.repeat(F.sha2(F.col("id").cast("string"), 256), 6).alias("json"))
    path = os.path.join(tmp_dir, "store")
    documents.write_document_store(docs.orderBy(F.rand(3)), path, partitions=4, row_group_bytes=256 << 10)
    got = documents.scan_prefix(spark, path, "pid_00123_")
    assert got.count() == 50 == docs.where(F.col("key").startswith("pid_00123_")).count()
    assert 50 <= scanned(got) < 4_000                       # of 40,000
    assert "GreaterThanOrEqual(key,pid_00123_)" in got._jdf.queryExecution().executedPlan().toString()
    assert scanned(documents.scan_prefix(spark, path, "nothing")) == 0


@pytest.mark.parametrize("prefix", ["a", "a￿", "\U0010ffff", "a\U0010ffff", "", "pid_", "퟿"])
def test_prefix_is_an_interval(spark, tmp_dir, prefix):
    keys = ["", "a", "aa", "a￿", "a￿z", "b", "pid_", "pid_1", "pidx", "pid`", "\U0010ffff", "\U0010ffffx",
            "a\U0010ffff", "a\U0010ffffb", "퟿k", ""]
    path = os.path.join(tmp_dir, "s")
    documents.write_document_store(spark.createDataFrame([(k, "{}") for k in keys], "key string, json string"), path)
    got = sorted(r.key for r in documents.scan_prefix(spark, path, prefix).collect())
    assert got == sorted(k for k in keys if k.startswith(prefix))


def test_variant_inference_equals_two_passes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in")
    os.makedirs(path)
    with open(os.path.join(path, "a.json"), "w") as f:
        f.write('{"patientId": 12, "PID": "PID|1", "ZZ9": "ZZ9|unlisted"}\n{broken\n\n{"id": "7", "dob": null, "PID": "P\\"q"}\n'
                '{"id": true}\n')
    good, dead = read_json_variant(spark, path)
    want, bad = envelope.read_json_routed(spark, path, schema=None, multiline=False)
    assert sorted(good.columns) == sorted(want.columns) and "ZZ9" in good.columns
    assert rows_of(good.select(*want.columns)) == rows_of(want)
    assert rows_of(dead.select("_corrupt_record", "reason")) == rows_of(bad.select("_corrupt_record", "reason"))


def test_variant_values_as_text(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in")
    os.makedirs(path)
    with open(os.path.join(path, "a.json"), "w") as f:
        f.write('{"a.b": 1, "n": {"x": [1, "y"]}, "q\\"": "t"}\n[1, 2]\n"text"\n')
    good, dead = read_json_variant(spark, path)
    row = good.first().asDict()
    assert row == {"a.b": "1", "n": '{"x":[1,"y"]}', 'q"': "t"} and dead.count() == 2
    with open(os.path.join(path, "b.json"), "w") as f:
        f.write('{"A.B": 2}\n')
    with pytest.raises(ValueError):
        read_json_variant(spark, path)
    assert _names(None) == [] and _names("OBJECT<`a b`: BIGINT, c: OBJECT<d: VARIANT>>") == ["a b", "c"]


def test_variant_files_are_read_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in")
    _numeric = derived.derived_envelopes(spark, SF001).limit(500)
    _numeric.write.json(path)
    good, _ = read_json_variant(spark, path)
    assert good.count() == 500
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Scan ExistingRDD" in plan       # names and values come from the parsed copy


def test_observed_places_and_columns(spark):
    env = spark.createDataFrame(
        [("1", "d", "PID|1||||A^B~ ^C||| ", "PV1", "ZZ"), ("2", "d", None, "PV1||||x|^|~", "NK1|a^^b"),
         ("3", "d", "PV1|wrong", " ", None)], "patientid string, dob string, pid string, pv1 string, nk1 string")
    assert extract.observed_places(env) == [("nk1", 1, 1), ("nk1", 1, 3), ("pid", 1, 1), ("pid", 5, 1), ("pid", 5, 2), ("pv1", 4, 1)]
    got = extract.flatten_observed(env)
    want = shape.observed_wide(extract.flatten_wide(env, extras=True))
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
    assert extract.flatten_observed(env.where("false")).columns == ["patientid", "dob"]


def test_observed_appends_name_their_columns(spark, tmp_dir):
    env = etl.prepared(derived.derived_envelopes(spark, SF001))
    path = os.path.join(tmp_dir, "t")
    parts = [env.where("id % 10 <> 4"), env.where("id % 10 = 4")]
    for k, part in enumerate(parts):
        tables.append_once(extract.flatten_observed(part), path, f"r{k}")
    got, want = tables.read_committed(spark, path), extract.flatten_observed(env)
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got.select(*want.columns)) == rows_of(want)
    seen = {r.column: r.run for r in tables.committed_columns(spark, path).collect()}
    assert seen["pt_last_name"] == "r0" and seen["insured_ssn"] == "r1"


def test_numbered_extras_rows_equal_the_map(spark):
    env = shape.lower_case_names(derived.derived_envelopes(spark, SF001)).dropDuplicates()
    odd = spark.createDataFrame([("1", "x", "PID|1||a^b~ ~c^^^^MR~d~e^f||~|||~G"), ("2", "y", "PID|"), ("3", "z", None)],
                                "patientid string, id string, pid string")
    for frame in (env, odd):
        wide = extract.flatten_wide(frame, keep=("patientid", "id"), numbered=True, extras=True)
        want = extract.extras_long(wide, keep=("patientid", "id"))
        assert rows_of(extract.extras_rows(frame, numbered=True)) == rows_of(want)
