"""Work that must not grow with a task's rows: whole-row dedupe, packed input, MinHash blocks."""

import contextlib
import io
import os
import re
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from segflow import session
from segflow.functions import hl7
from segflow.llm import near_dedup
from segflow.operators import deadletter, dedupe, extract, patients
from segflow.plans import etl, queries
from segflow.sinks import patient_table, tables
from segflow.sinks.archive import Archive
from segflow.sources import derived, envelope
from tests.conftest import SF001


def _rows(spark):
    text = "CASE WHEN id % 7 = 0 THEN NULL ELSE concat('PID|', id) END AS text"
    some = spark.range(300).selectExpr("CASE WHEN id % 11 = 0 THEN NULL ELSE id END AS id", text, "array(id % 3, NULL) AS parts")
    return some.unionByName(some.where("id % 5 = 0 OR id IS NULL"))


def test_distinct_rows_as_whole_rows(spark):
    """Both ways give what the whole-row aggregate gives, NULLs and copies too."""
    df = _rows(spark)
    want = sorted(map(str, df.dropDuplicates().collect()))
    for few in (0, 10_000):
        assert sorted(map(str, dedupe.distinct_rows(df, few=few).collect())) == want
        assert dedupe.distinct_rows(df.where("false"), few=few).collect() == []


def test_dedupe_reads_stored_rows(spark, monkeypatch):
    """what comes after the dedupe does not build the envelopes again,
    and large inputs shuffle suspects only."""
    monkeypatch.setattr(dedupe.distinct_rows, "__defaults__", (0,))
    df = etl.prepared(_rows(spark))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan
    assert "_suspect" in plan


def test_json_input_is_packed(spark):
    """Compressed JSON, read as before."""
    path = queries._json_dir(spark, SF001)
    files = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    assert files and all(f.endswith(".json.gz") for f in files)
    plain = queries._json_dir(spark, SF001, packed=False)
    names = envelope.ENVELOPE.names
    got, want = (sorted(map(str, envelope.read_json_envelopes(spark, p, multiline=False).select(names).collect())) for p in (path, plain))
    assert got == want


def test_signatures_in_bounded_memory():
    """Pipeline: permutations of a block of shingles, not of a whole chunk; same signatures."""
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64)) for n in (0, 1, 3, 40, 30_000, 0, 700, 25_000, 2)] + \
           [np.unique(rng.integers(0, 1 << 60, 100).astype(np.uint64)) for _ in range(500)]
    want = near_dedup._super_minhash(sets, 120)
    for block in (1, 500, 1 << 13, 1 << 30):
        assert (near_dedup.super_minhash(sets, 120, block) == want).all()
    assert near_dedup.super_minhash([], 120).shape == (0, 120)
    small = [s for s in sets if len(s) <= 1000] * 2
    tracemalloc.start()
    near_dedup.super_minhash(small, 120)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 << 20, peak


def test_messages_are_dealt_by_rows(spark, monkeypatch):
    """Few bytes of orders do not put all messages into few tasks, and
    the method that builds them is one the JVM compiles (8,000 bytes of code at most)."""
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    env = derived.derived_envelopes(spark, SF001)
    assert env.select(F.spark_partition_id()).distinct().count() >= 8
    assert session.tasks_for(spark, 0) == 1 and session.tasks_for(spark, 10_000) == 100
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100_000)
    few = derived.derived_envelopes(spark, SF001)
    assert sorted(map(str, env.collect())) == sorted(map(str, few.collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as text:
            derived.derived_envelopes(spark, SF001).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000, sizes


def test_suspects_are_dealt_before_they_are_aggregated(spark, monkeypatch):
    """no task aggregates all suspects of a large split as whole rows; copies
    of a frequent row do not meet in one task before they are folded."""
    df = _rows(spark)
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    want = sorted(map(str, df.dropDuplicates().collect()))
    for frequent, salted in ((10_000, False), (1, True)):
        monkeypatch.setattr(dedupe, "FREQUENT", frequent)
        got = dedupe.dedupe_by_digest(df)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        dealt = plan[plan.index("RepartitionByExpression"):].split("\n")[0]
        assert plan.index("Aggregate") < plan.index("RepartitionByExpression") and ("_salt" in dealt) == salted
        assert sorted(map(str, got.collect())) == want


def test_extras_by_place_numbers(spark):
    """fields are split once and compared by number; values as the map gives them."""
    env = spark.createDataFrame([
        ("1", "a", "PID|1|x^y^|A^B~C^ ~^^Z|  |p^~ ^q|^^|||||||||" + "|" * 30 + "far^ ^away~b"),
        ("2", None, "PID||~|^~^|a~|~b| ~ ^c"), ("3", "c", "PID"), (None, "d", None), ("5", "e", "NK1|1|x")],
        "patientid string, id string, pid string")
    for numbered in (False, True):
        got = extract.extras_rows(env, numbered=numbered)
        want = extract.extras_long(extract.flatten_wide(env, keep=("patientid", "id"), extras=True, numbered=numbered), ("patientid", "id"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []
    plan = extract.extras_rows(env)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan


def test_archive_files_are_compressed(spark, tmp_dir):
    """raw messages are kept and packed compressed, and read as before."""
    rows = spark.range(40).selectExpr("CAST(id AS STRING) AS id", "'1995-03-15 10:00' AS updatedAt", "repeat('x', 2000) AS PID")
    plain, packed = Archive(spark, f"{tmp_dir}/a"), Archive(spark, f"{tmp_dir}/b", compression="gzip")
    for archive in (plain, packed):
        for k in (0, 1):
            archive.append(rows.where(f"id % 2 = {k}"), f"r{k}")
        assert archive.compact("1995") == 1 and archive.vacuum() == 2
    assert sorted(map(str, plain.read("1995").collect())) == sorted(map(str, packed.read("1995").collect()))
    assert 4 * packed.files().first().bytes < plain.files().first().bytes


def test_extras_map_is_built_once(spark, tmp_dir):
    """no filter inferred from the explode builds the map a second time; same rows."""
    env = spark.createDataFrame([("1", "a", "PID|1|x^y^|A^B~C^ ~^^Z|  |p^~ ^q"), ("2", None, None), ("3", "c", "PID"), (None, "d", "PV1|x")],
                                "patientid string, id string, pid string")
    env.write.parquet(f"{tmp_dir}/env")
    stored = spark.read.parquet(f"{tmp_dir}/env")
    got = extract.extras_long(extract.flatten_wide(stored, keep=("patientid", "id"), extras=True), ("patientid", "id"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_from_entries") == 1
    assert sorted(map(str, got.collect())) == sorted(map(str, extract.extras_rows(env).collect())) != []


def test_last_repetition_is_split_before_others_are_searched(spark):
    """a value of the last repetition is read from its parts; a regex runs only where
    that one is blank.  Values as the readable definition gives them."""
    texts = [None, "", " ", "a", "a^b", "~", "a~", "~a", "a^b~c", "a^b~^ ", "a^b^c^d~ ^x~^^y", "a~b~ ", " a ~^", "a\nb^c\n~d\n^\n", "^~^b~", "a^b~c^d^e"]
    env = spark.createDataFrame([(str(i), None if t is None else f"PID|1||{t}||{t}||||||{t}") for i, t in enumerate(texts)], "id string, pid string")
    wide = extract.flatten_wide(env, segments=["pid"], keep=("id",), rename=False)
    assert "substring_index(" in wide._jdf.queryExecution().optimizedPlan().toString()
    places = [(c.raw, c.pos) for c in extract.layout.wide_columns(["pid"]) if c.pos.field in (3, 5, 11)]
    want = env.selectExpr("id", *[f"{hl7.last_component_hof_sql(f'get(split(pid, {hl7.sql_str(hl7.FIELD_SEP)}), {p.field})', p.component)} AS `{raw}`"
                                  for raw, p in places])
    got = wide.select("id", *[f"`{raw}`" for raw, _ in places])
    assert len(places) > 10 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def _query_paths(monkeypatch):
    """Folders that a query asks for, by name."""
    paths, work_path = {}, session.work_path

    def recorded(spark, name):
        paths[name] = work_path(spark, name)
        return paths[name]

    monkeypatch.setattr(session, "work_path", recorded)
    return paths


def _names(path):
    return [f for _, _, files in os.walk(path.removeprefix("file:")) for f in files if f.startswith("part-")]


def test_stream_input_and_output_are_packed(spark, monkeypatch):
    """arriving documents are compressed files of a bounded number of messages, rows
    are written as zstd; every message is good or dead, as it is read without a stream."""
    monkeypatch.setitem(queries.PACKED, "maxRecordsPerFile", 300)
    paths = _query_paths(monkeypatch)
    got = queries.adt_stream_dead_letter(spark, SF001)
    good, dead = deadletter.route_dead_letters(queries._damaged_documents(spark, SF001))
    assert got.where("kind = 'good'").count() == good.count() > 0 and got.where("kind = 'dead'").count() == dead.count() > 0
    sent = _names(paths["dead-in"])
    assert len(sent) > 1 and all(f.endswith(".txt.gz") for f in sent)
    assert all(f.endswith(".zstd.parquet") for f in _names(paths["dead-out"]))


def test_written_archive_is_compressed(spark, monkeypatch, tmp_dir):
    """raw messages by date are kept compressed and read by prefix as before."""
    rows = spark.range(40).selectExpr("CAST(id AS STRING) AS id", "concat('1995-03-1', id % 3, ' 10:00') AS updatedAt", "repeat('x', 2000) AS PID")
    for name, options in (("a", {}), ("b", {"compression": "gzip"})):
        tables.write_archive(rows, f"{tmp_dir}/{name}", **options)
    plain, packed = (sorted(map(str, tables.read_archive(spark, f"{tmp_dir}/{n}", "1995/3/11").collect())) for n in "ab")
    assert plain == packed and len(plain) == 13
    paths = _query_paths(monkeypatch)
    assert queries.adt_archive_written(spark, SF001).count() > 0
    assert _names(paths["archive"]) and all(f.endswith(".txt.gz") for f in _names(paths["archive"]))


def test_caught_up_envelopes_are_packed_and_shuffle_suspects(spark, monkeypatch):
    """the twin and the waves are zstd files; of many envelopes only digests and
    suspects are shuffled, with the rows of the whole-row aggregate."""
    df = _rows(spark).withColumn("repeated", F.expr("array(struct(id % 2 AS seg, text))"))
    want = sorted(map(str, df.dropDuplicates().collect()))
    for few in (0, 10_000):
        assert sorted(map(str, dedupe.distinct_stored(df, few=few).collect())) == want
    few = [sorted(map(str, q(spark, SF001).collect())) for q in (queries.adt_catchup_ranges, queries.adt_catchup_range_segments)]
    monkeypatch.setattr(dedupe.distinct_stored, "__defaults__", (0,))
    paths = _query_paths(monkeypatch)
    for query, rows in zip((queries.adt_catchup_ranges, queries.adt_catchup_range_segments), few):
        got = query(spark, SF001)
        assert "_suspect" in got._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(str, got.collect())) == rows
        for folder in (paths["blobs"], f"{paths['catch-up']}/data"):
            assert _names(folder) and all(".zstd.parquet" in f for f in _names(folder))


def test_latest_stream_packs_and_moves_winners_only(spark, monkeypatch, tmp_dir):
    """a batch's newest rows are those of `latest_per_patient`, found on narrow rows;
    input files, still few, and update batches are compressed."""
    rows = [("1", "5", "1995-01-01 10:00", "a"), ("1", "5", "1995-01-01 10:00", "a"), ("1", "40", "1995-01-01 10:00:00", "b"), ("1", "7", None, "c"),
            ("2", None, "bad", "d"), ("2", "x", "bad", "e"), (None, "1", "1995-01-01 10:00", "f"), ("3", None, None, None)] + \
           [(f"p{i % 50}", str(i), f"199{i % 7}-01-01 10:00", "z") for i in range(400)]
    batch = spark.createDataFrame(rows, "patientid string, id string, updatedat string, PID string")
    patient_table.numbered(batch).write.parquet(f"{tmp_dir}/batch")
    patient_table.write_newest(spark.read.parquet(f"{tmp_dir}/batch"), f"{tmp_dir}/new")
    want = patients.latest_per_patient(batch)
    assert sorted(map(str, spark.read.parquet(f"{tmp_dir}/new").select(want.columns).collect())) == sorted(map(str, want.collect()))
    paths = _query_paths(monkeypatch)
    assert queries.adt_stream_latest(spark, SF001).count() == derived.derived_envelopes(spark, SF001).select("patientId").distinct().count()
    sent, kept = _names(paths["json"]), _names(paths["latest-out"])
    assert 0 < len(sent) <= queries.FILES and all(f.endswith(".json.gz") for f in sent)
    assert kept and all(f.endswith(".zstd.parquet") for f in kept)


def test_parsed_variants_are_not_stored_again(spark, monkeypatch):
    """F8: the dedupe reads the parsed copy; no second one is written, rows as before."""
    monkeypatch.setattr(dedupe.distinct_stored, "__defaults__", (0,))
    paths = _query_paths(monkeypatch)
    monkeypatch.setattr(dedupe, "work_path", session.work_path)
    got = queries.adt_json_variant(spark, SF001)
    assert list(paths) == ["json"] and "_suspect" in got._jdf.queryExecution().optimizedPlan().toString()
    want = envelope.read_json_envelopes(spark, paths["json"], multiline=False)
    names = [c for c in want.columns if c.lower() in got.columns]
    assert len(names) == len(got.columns) > 15
    assert sorted(map(str, got.select(*[c.lower() for c in names]).collect())) == \
        sorted(map(str, want.select(*[F.col(c).alias(c.lower()) for c in names]).collect()))
