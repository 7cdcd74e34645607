"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query starts from the envelopes Spark derives from the driver's
`orders` and `customer` tables (whole tables, see `sources/derived.py`) and
runs one reference operator (or the whole job) on them.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow import session
from segflow.operators import deadletter, dedupe, extract, filters, patients, shape
from segflow.operators.known_patients import KnownPatients
from segflow.operators.replay import DeadLetterStore
from segflow.plans import etl
from segflow.plans.oracle import (ARCHIVE_YEAR, DECLARED_SEGMENTS, EVOLUTION_CUTOFF, FEEDS, LAST_REP_COLUMNS,
                                  KNOWN_CUTOFFS, REFERRAL_CUTOFF)
from segflow.sinks import tables
from segflow.sinks.archive import Archive
from segflow.sinks.patient_table import PatientTable
from segflow.sources import derived, documents, envelope
from segflow.sources.catchup import CatchUp, table_reader
from segflow.sources.inferred import read_json_variant


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated, lower-cased envelopes."""
    return etl.prepared(derived.derived_envelopes(spark, sf_dir))


def adt_flatten(spark, sf_dir):
    return extract.flatten_wide(_envelopes(spark, sf_dir))


def adt_state_filter(spark, sf_dir):
    return etl.patient_rows(derived.derived_envelopes(spark, sf_dir))


def adt_state_filter_sql(spark, sf_dir):
    wide = extract.flatten_wide(_envelopes(spark, sf_dir))
    return filters.keep_states_sql(spark, wide)


def adt_envelope_dedupe(spark, sf_dir):
    return _envelopes(spark, sf_dir)


def adt_digest_dedupe(spark, sf_dir):
    """S4 on stored envelopes: only digests and the rows suspected of a copy are shuffled."""
    path = session.work_path(spark, "stored")
    derived.derived_envelopes(spark, sf_dir).write.parquet(path)
    return shape.lower_case_names(dedupe.dedupe_by_digest(spark.read.parquet(path)))


def adt_segment_long(spark, sf_dir):
    return extract.segments_long(_envelopes(spark, sf_dir))


def adt_ignore_lists(spark, sf_dir):
    return extract.apply_ignore_lists(extract.segments_long(_envelopes(spark, sf_dir)))


def adt_last_repetition(spark, sf_dir):
    wide = extract.flatten_wide(_envelopes(spark, sf_dir), keep=("patientid", "id"))
    return wide.select("patientid", "id", *LAST_REP_COLUMNS)


def adt_numbered_repetitions(spark, sf_dir):
    return extract.flatten_wide(_envelopes(spark, sf_dir), keep=("patientid", "id"), numbered=True)


def adt_full_messages(spark, sf_dir):
    """Every mapped column of every message; full ones are found by what they hold
    (a value in each of the 170 columns), the oracle builds them without any parsing."""
    wide = extract.flatten_wide(_envelopes(spark, sf_dir), keep=("patientid", "id"))
    names = [c for c in wide.columns if c not in ("patientid", "id")]
    filled = reduce(and_, [F.col(c).isNotNull() for c in names])
    return wide.withColumn("full", filled)


def adt_numbered_extras(spark, sf_dir):
    """X13 + X11: in numbered mode, repetitions without a name reach `extras`."""
    return extract.extras_rows(_envelopes(spark, sf_dir), numbered=True)


def adt_extras(spark, sf_dir):
    return extract.extras_rows(_envelopes(spark, sf_dir))


def adt_extras_map(spark, sf_dir):
    wide = extract.flatten_wide(_envelopes(spark, sf_dir), keep=("patientid", "id"), extras=True)
    return extract.extras_long(wide, keep=("patientid", "id"))


def adt_observed_wide(spark, sf_dir):
    # Copies of an envelope fill the same places, so these are found before the dedupe.
    raw = shape.lower_case_names(derived.derived_envelopes(spark, sf_dir))
    return extract.flatten_observed(raw.dropDuplicates(), places=extract.observed_places(raw))


def adt_truncate_names(spark, sf_dir):
    return shape.truncate_names(extract.flatten_wide(_envelopes(spark, sf_dir), rename=False))


def adt_document_scan(spark, sf_dir):
    docs = derived.derived_documents(derived.derived_envelopes(spark, sf_dir))
    return shape.lower_case_names(envelope.scan_documents(docs, prefix="pid_"))


def adt_document_store(spark, sf_dir):
    """S3 on a store in key order: the prefix is an interval of keys."""
    path = session.work_path(spark, "store")
    documents.write_document_store(derived.derived_documents(derived.derived_envelopes(spark, sf_dir)), path)
    return shape.lower_case_names(documents.scan_store(spark, path, "pid_"))


def _damaged_documents(spark, sf_dir):
    """(key, json) documents of which some have a foreign PID segment, no
    patient, or text that is no JSON."""
    env = derived.derived_envelopes(spark, sf_dir)
    key = F.when(F.col("tenantId") == "5-LOW", F.concat(F.lit("other_"), F.col("id"))) \
        .otherwise(F.concat(F.lit("pid_"), F.col("patientId"), F.lit("_"), F.col("id")))
    damaged = env.withColumn("_key", key).withColumn("PID", F.when(F.col("PID").isNull() & F.col("PV1").isNotNull(),
                                           F.col("PV1")).otherwise(F.col("PID"))) \
        .withColumn("patientId", F.when(F.col("PV1") == "PV1", F.lit(None))
                    .otherwise(F.col("patientId")))
    body = F.to_json(F.struct(*[F.col(c) for c in env.columns]))
    return damaged.select(F.col("_key").alias("key"), F.when(F.col("EVN").contains("|REG_P|"),
                                                   F.concat(F.lit("<"), body)).otherwise(body)
                          .alias("json"))


def adt_dead_letter(spark, sf_dir):
    _, dead = deadletter.route_dead_letters(_damaged_documents(spark, sf_dir))
    return dead.select("key", "reason")


def adt_dead_letter_good(spark, sf_dir):
    good, _ = deadletter.route_dead_letters(_damaged_documents(spark, sf_dir))
    return shape.lower_case_names(good)


def adt_dead_letter_replay(spark, sf_dir):
    """K5: two lots of dead letters, two replays with other repairs, a limit of two
    attempts; where every letter stands after that."""
    _, dead = deadletter.route_dead_letters(_damaged_documents(spark, sf_dir))
    store = DeadLetterStore(spark, session.work_path(spark, "letters"), max_attempts=2)
    number = F.regexp_extract("json", '"id":"([0-9]+)"', 1).cast("bigint")

    def untag(letters):
        return letters.withColumn("body", F.regexp_replace("body", "^<", ""))

    def no_foreign_pid(letters):
        return untag(letters).withColumn("body", F.regexp_replace("body", '"PID":"PV1[^"]*",', ""))

    with session.written(dead, "dead") as rows:
        store.add(rows.where(number % 2 == 1), "night-1")
        store.replay("morning-1", untag)
        store.replay("morning-1", untag)                                # repeated
        store.add(rows.where(number % 2 == 0), "night-2")
    store.replay("morning-2", no_foreign_pid)
    text_id = F.regexp_extract("body", '"id":"([0-9]+)"', 1)
    out = store.good().select("id", F.lit("good").alias("kind"), F.lit(None).cast("string").alias("reason"), "attempts", "added")
    for kind, letters in (("waiting", store.waiting()), ("parked", store.parked())):
        out = out.unionByName(letters.select(text_id.alias("id"), F.lit(kind).alias("kind"), "reason", "attempts", "added"))
    return out


def adt_stream_dead_letter(spark, sf_dir):
    """W1 + K5: damaged documents arrive as files; every message is either in the
    stream's rows or among its dead letters."""
    from segflow.streaming.stream import start_patient_stream

    src, out, ckpt = (session.work_path(spark, n) for n in ("dead-in", "dead-out", "dead-ckpt"))
    _damaged_documents(spark, sf_dir).select("json").write.options(**PACKED).text(src)
    start_patient_stream(spark, src, out, ckpt, states=None, dedupe=False, keep=("patientid", "id"),
                         dead_path=f"{out}_dead").awaitTermination()
    return _good_and_dead(spark.read.parquet(out), spark.read.parquet(f"{out}_dead"))


def _good_and_dead(good: DataFrame, dead: DataFrame) -> DataFrame:
    """(kind, id, reason) of a run's two outputs; unparsed text still shows its id."""
    text_id = F.regexp_extract("_corrupt_record", '"id":"([0-9]+)"', 1)
    return (good.select(F.lit("good").alias("kind"), "id", F.lit(None).cast("string").alias("reason"))
            .unionByName(dead.select(F.lit("dead").alias("kind"), F.coalesce("id", text_id).alias("id"), "reason")))


def adt_latest_stream_dead_letter(spark, sf_dir):
    """W1 + K6 + K5: damaged documents arrive as files; a stream merges each batch
    into the patient table and writes what is dead in the same run."""
    from segflow.streaming.stream import start_merge_stream

    src, out, ckpt = (session.work_path(spark, n) for n in ("merge-in", "merge-out", "merge-ckpt"))
    _damaged_documents(spark, sf_dir).select("json").coalesce(FILES).write.option("compression", "gzip").text(src)
    table = PatientTable(spark, out, buckets=16)
    start_merge_stream(spark, src, table, ckpt, max_files_per_trigger=2).awaitTermination()
    return _good_and_dead(table.read(), spark.read.parquet(f"{out}_dead"))


def adt_patient_merge(spark, sf_dir):
    """K6 as a merge: three batches with updates of the same patients, the second of
    them replayed; then the table."""
    table = PatientTable(spark, session.work_path(spark, "patients"), buckets=16)
    env = shape.lower_case_names(derived.derived_envelopes(spark, sf_dir))
    for k in (0, 1, 1, 2):
        table.merge(env.where(F.pmod(F.xxhash64("id"), F.lit(3)) == k), f"night-{k}")
    return extract.flatten_wide(table.read(), keep=("patientid", "id", "updatedat", "dob"))


def adt_append_once(spark, sf_dir):
    """K1 for jobs that are rerun: one run fails between its write and its commit and
    is repeated, another is repeated after its success; every row is there once."""
    path = session.work_path(spark, "once")
    rows = extract.flatten_wide(_envelopes(spark, sf_dir), keep=("patientid", "id", "dob"))
    odd = F.pmod(F.xxhash64("id"), F.lit(2)) == 1
    tables.stage_run(rows.where(odd), path, "night-1")                  # fails before the commit
    for run, part in (("night-2", ~odd), ("night-1", odd), ("night-2", ~odd)):
        tables.append_once(rows.where(part), path, run)
    return tables.read_committed(spark, path)


def adt_latest_patient(spark, sf_dir):
    # No dedupe first: a max is unchanged by exact duplicates, so the
    # per-patient aggregate is the only shuffle.
    env = shape.lower_case_names(derived.derived_envelopes(spark, sf_dir))
    latest = patients.latest_per_patient(env)
    return extract.flatten_wide(latest, keep=("patientid", "id", "updatedat", "dob"))


def adt_new_referrals(spark, sf_dir):
    # The known side needs only distinct patient ids, so it skips the
    # whole-row dedupe: column pruning leaves a shuffle of ids only.  The
    # batch side is deduplicated because it counts messages.
    raw = shape.lower_case_names(derived.derived_envelopes(spark, sf_dir))
    is_batch = patients.parse_updated("updatedat") >= patients.wall_clock(REFERRAL_CUTOFF)
    batch = raw.dropDuplicates().where(is_batch)
    known = raw.where(~is_batch | is_batch.isNull())
    return patients.new_patients(batch, known)


def adt_known_patients(spark, sf_dir):
    """K7 over three batches in order of time: each one's new patients against an index
    that the batches before have filled; the second batch is added twice."""
    index = KnownPatients(spark, session.work_path(spark, "known"), buckets=16)
    raw = shape.lower_case_names(derived.derived_envelopes(spark, sf_dir)).select("patientid", "id", "updatedat")
    ts = patients.parse_updated("updatedat")
    cuts = [patients.wall_clock(c) for c in KNOWN_CUTOFFS]
    number = F.when(ts < cuts[0], 0).when(ts < cuts[1], 1).otherwise(2)
    out = None
    with session.written(raw.dropDuplicates().withColumn("batch", number), "batches") as rows:
        for k in (0, 1, 1, 2):
            batch = rows.where(F.col("batch") == k)
            if not index.log.find(f"batch-{k}"):
                found = index.new_patients(batch).withColumn("batch", F.lit(k)).checkpoint(eager=True)
                out = found if out is None else out.unionByName(found)
            index.add(batch, f"batch-{k}")
    return out


def adt_feed_count(spark, sf_dir):
    rows = etl.patient_rows(derived.derived_envelopes(spark, sf_dir))
    fanned = tables.fan_out(rows.select("patientid"), FEEDS)
    return fanned.groupBy("feed", "table_name").agg(F.count(F.lit(1)).alias("rows"))


def adt_schema_evolution(spark, sf_dir):
    env = _envelopes(spark, sf_dir)
    early_flag = patients.parse_updated("updatedat") < patients.wall_clock(EVOLUTION_CUTOFF)
    early = extract.flatten_wide(env.where(early_flag), segments=DECLARED_SEGMENTS)
    late = extract.flatten_wide(env.where(~early_flag | early_flag.isNull()))
    return tables.union_evolving([early, late])


def _numeric(env: DataFrame) -> DataFrame:
    """As feeds write them: `id` and `patientId` are JSON numbers."""
    return env.withColumn("id", F.col("id").cast("bigint")).withColumn("patientId", F.col("patientId").cast("bigint"))


# Compressed files cannot be split, so each holds a bounded number of messages.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 100_000}


FILES = 16          # of a feed that a stream reads file by file: its batches do not grow in number


def _json_dir(spark, sf_dir, packed: bool = True) -> str:
    """Derived envelopes written once as compressed JSON lines under the shared folder;
    `packed` as many files of a bounded number of messages, else as at most `FILES`."""
    path = session.work_path(spark, "json")
    env = _numeric(derived.derived_envelopes(spark, sf_dir))
    options = PACKED if packed else {**PACKED, "maxRecordsPerFile": 0}
    (env if packed else env.coalesce(FILES)).write.options(**options).mode("overwrite").json(path)
    return path


def adt_json_documents(spark, sf_dir):
    """S1 on files that hold one JSON document over many lines each (here an array
    of up to 500 envelopes)."""
    path = session.work_path(spark, "json-documents")
    env = _numeric(derived.derived_envelopes(spark, sf_dir))
    text = F.to_json(F.struct(*[F.col(c) for c in env.columns]), {"pretty": "true"})
    files = env.groupBy(F.expr("id div 500").alias("file")).agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list(text), ",\n"), F.lit("\n]")).alias("value"))
    # The groups are dealt by file already, one row each.
    files.write.option("compression", "gzip").partitionBy("file").text(path)
    env = envelope.read_json_envelopes(spark, f"{path}/*/", multiline=True)
    return shape.lower_case_names(env)


def adt_json_scan(spark, sf_dir):
    path = _json_dir(spark, sf_dir)
    return shape.lower_case_names(envelope.read_json_envelopes(spark, path, multiline=False))


def adt_declared_schema(spark, sf_dir):
    """S1 with the 11-field declared schema: only EVN, PID and PV1 reach the
    flattener, so the other segments' columns stay NULL (then the job's filter)."""
    path = _json_dir(spark, sf_dir)
    env = envelope.read_json_envelopes(spark, path, schema=envelope.DECLARED, multiline=False)
    return etl.patient_rows(env, dedupe=False)


def adt_json_inferred(spark, sf_dir):
    path = _json_dir(spark, sf_dir)
    return shape.lower_case_names(
        envelope.read_json_envelopes(spark, path, schema=None, multiline=False))


def adt_json_variant(spark, sf_dir):
    """S2 with one parse: names and values from VARIANT."""
    good, _ = read_json_variant(spark, _json_dir(spark, sf_dir))
    return shape.lower_case_names(dedupe.distinct_stored(good))         # the parsed copy is stored already


def adt_message_table(spark, sf_dir):
    env = derived.derived_envelopes(spark, sf_dir)
    body = F.to_json(F.struct(*[F.col(c) for c in env.columns]))
    # Half the rows double-encoded (a JSON string holding the JSON text).
    encoded = F.to_json(F.array(body)).substr(F.lit(2), F.length(F.to_json(F.array(body))) - 2)
    messages = env.select(F.when(F.col("updatedAt").endswith(":00"), body)
                          .otherwise(encoded).alias("patientjson"))
    return shape.lower_case_names(envelope.read_message_table(messages))


def _blob_rows(spark, sf_dir):
    """Relational rows with a raw blob; messages with a DG1 or OBX segment carry
    an earlier one of the same id."""
    env = derived.derived_envelopes(spark, sf_dir)
    texts = []
    for s in ["MSH"] + list(envelope.SUPERSET_SEGMENTS):
        if s in ("DG1", "OBX"):
            texts.append(F.when(F.col(s).isNotNull(), F.concat(F.lit(f"{s}|0|EARLIER|E"), F.col("id"), F.lit("^FIRST~SECOND"))))
        texts.append(F.col(s))
    return env.select(*envelope.METADATA, F.encode(F.concat_ws("\r", *texts), "UTF-8").alias("hl7"))


def adt_catchup_blob(spark, sf_dir):
    rows = envelope.segments_from_blob(_blob_rows(spark, sf_dir)).drop("repeated")
    return shape.lower_case_names(dedupe.distinct_rows(rows))


def _catch_up_twin(spark, sf_dir) -> CatchUp:
    """A relational table's Parquet twin with a skewed key, caught up in two runs: the
    first stops after one wave, the second reads what the ledger does not hold."""
    path = session.work_path(spark, "blobs")
    key = F.expr("CAST(id AS BIGINT) * CAST(id AS BIGINT) div 1000")
    _blob_rows(spark, sf_dir).withColumn("row_key", key) \
        .repartitionByRange("row_key").sortWithinPartitions("row_key").write.option("compression", "zstd").parquet(path)
    out = session.work_path(spark, "catch-up")
    rows = spark.read.parquet(path)
    for waves in (1, None):
        job = CatchUp(spark, out, rows.select("row_key"), table_reader(rows, "row_key"), "row_key", ranges=24)
        job.run(max_waves=waves, wave=8)
    return job


def adt_catchup_ranges(spark, sf_dir):
    """S6 that stops and goes on: envelopes of all ranges."""
    env = _catch_up_twin(spark, sf_dir).envelopes().drop("repeated", "range")
    return shape.lower_case_names(dedupe.distinct_stored(env))


def adt_catchup_range_segments(spark, sf_dir):
    """S6 + X12 from the same copy: every segment of every blob in long form."""
    rows = _catch_up_twin(spark, sf_dir).envelopes()
    segs = envelope.envelope_segments(dedupe.distinct_stored(rows.drop("range")), meta=("patientId", "id"))
    return extract.occurrences_long(shape.lower_case_names(segs), keep=("patientid", "id"))


def adt_catchup_segments(spark, sf_dir):
    """S6 + X12: every segment of every blob, repeated ones too, in long form."""
    rows = dedupe.distinct_rows(_blob_rows(spark, sf_dir))
    segs = shape.lower_case_names(envelope.blob_segments(rows, meta=("patientId", "id")))
    return extract.occurrences_long(segs, keep=("patientid", "id"))


def adt_feed_tables(spark, sf_dir):
    """K1 + K3: the whole job writes one table per feed; all are read back."""
    path = session.work_path(spark, "feeds")
    etl.run_feeds_parquet(derived.derived_envelopes(spark, sf_dir), FEEDS, path)
    return spark.read.parquet(path)


def adt_evolving_append(spark, sf_dir):
    """K2: two appends to one table, the second with more columns, read as one; the
    columns come from the commit log, not from the files."""
    path = session.work_path(spark, "evolving")
    env = _envelopes(spark, sf_dir)
    early_flag = patients.parse_updated("updatedat") < patients.wall_clock(EVOLUTION_CUTOFF)
    tables.append_once(extract.flatten_wide(env.where(early_flag), segments=DECLARED_SEGMENTS), path, "early")
    tables.append_once(extract.flatten_wide(env.where(~early_flag | early_flag.isNull())), path, "late")
    return tables.read_committed(spark, path)


def adt_observed_append(spark, sf_dir):
    """P6 + K2: each append has the columns that its own rows hold; the table's columns
    are the first-seen log, no pass over the table finds them."""
    path = session.work_path(spark, "observed")
    env = _envelopes(spark, sf_dir)
    early_flag = F.coalesce(patients.parse_updated("updatedat") < patients.wall_clock(EVOLUTION_CUTOFF), F.lit(False))
    with session.written(env.withColumn("early", early_flag), "batches") as rows:
        for run, part in (("early", rows.where("early")), ("late", rows.where("NOT early"))):
            tables.append_once(extract.flatten_observed(part), path, run)
    return tables.read_committed(spark, path)


def adt_archive_written(spark, sf_dir):
    """K4 + S5: the archive written by date, then one year of it read by prefix."""
    path = session.work_path(spark, "archive")
    tables.write_archive(derived.derived_envelopes(spark, sf_dir), path, compression="gzip")
    rows = tables.read_archive(spark, path, str(ARCHIVE_YEAR))
    return rows.select(F.get_json_object("value", "$.id").alias("id"),
                       F.get_json_object("value", "$.EVN").alias("evn"), "y", "m", "d")


def adt_archive_compacted(spark, sf_dir):
    """K4 + S5: two nightly runs, then one year packed into fewer files and read."""
    archive = Archive(spark, session.work_path(spark, "archive-files"), compression="gzip")
    env = derived.derived_envelopes(spark, sf_dir)
    for k in (0, 1):
        archive.append(env.where(F.pmod(F.xxhash64("id"), F.lit(2)) == k), f"night-{k}")
    archive.compact(str(ARCHIVE_YEAR))
    archive.vacuum()
    rows = archive.read(str(ARCHIVE_YEAR))
    return rows.select(F.get_json_object("value", "$.id").alias("id"),
                       F.get_json_object("value", "$.EVN").alias("evn"), "y", "m", "d")


def adt_empty_result(spark, sf_dir):
    """a job whose filter keeps nothing writes no table."""
    from pyspark.errors import AnalysisException

    path = session.work_path(spark, "empty")
    env = derived.derived_envelopes(spark, sf_dir)
    written = etl.run_feeds_parquet(env, FEEDS, path, states=("ZZ",))
    try:
        spark.read.parquet(path)
        there = True
    except AnalysisException:
        there = False
    return env.agg(F.count(F.lit(1)).alias("messages")).select(
        "messages", F.lit(len(written)).cast("bigint").alias("tables_written"), F.lit(there).alias("folder_written"))


def adt_archive_prefix(spark, sf_dir):
    """K4 + S5: archive rows (raw JSON + y/m/d partition values) and the
    date prefix of each message, read back out of the archived JSON."""
    arch = tables.archive_frame(derived.derived_envelopes(spark, sf_dir))
    updated = patients.parse_updated(F.get_json_object("value", "$.updatedAt"))
    return arch.select(F.get_json_object("value", "$.id").alias("id"), "y", "m", "d",
                       envelope.date_prefix(updated).alias("prefix"))


def adt_stream_flatten(spark, sf_dir):
    """Envelopes land as JSON files; an availableNow stream flattens and
    filters them batch by batch; the written table is returned."""
    from segflow.streaming.stream import start_patient_stream

    src = _json_dir(spark, sf_dir)
    out = session.work_path(spark, "stream-out")
    ckpt = session.work_path(spark, "stream-ckpt")
    q = start_patient_stream(spark, src, out, ckpt, available_now=True)
    q.awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


def adt_stream_latest(spark, sf_dir):
    """W1 + K6: a streaming max_by keeps the newest envelope per patient over
    arriving files (one file per trigger); the resolved table is flattened."""
    from segflow.streaming.stream import read_latest, start_latest_stream

    src = _json_dir(spark, sf_dir, packed=False)         # a file is a batch here
    out = session.work_path(spark, "latest-out")
    ckpt = session.work_path(spark, "latest-ckpt")
    start_latest_stream(spark, src, out, ckpt, available_now=True,
                        max_files_per_trigger=1).awaitTermination()
    return extract.flatten_wide(read_latest(spark, out), keep=("patientid", "id", "updatedat", "dob"))


QUERIES = {
    "adt_flatten": adt_flatten,
    "adt_state_filter": adt_state_filter,
    "adt_envelope_dedupe": adt_envelope_dedupe,
    "adt_digest_dedupe": adt_digest_dedupe,
    "adt_segment_long": adt_segment_long,
    "adt_ignore_lists": adt_ignore_lists,
    "adt_last_repetition": adt_last_repetition,
    "adt_numbered_repetitions": adt_numbered_repetitions,
    "adt_full_messages": adt_full_messages,
    "adt_numbered_extras": adt_numbered_extras,
    "adt_extras": adt_extras,
    "adt_extras_map": adt_extras_map,
    "adt_observed_wide": adt_observed_wide,
    "adt_truncate_names": adt_truncate_names,
    "adt_document_scan": adt_document_scan,
    "adt_document_store": adt_document_store,
    "adt_json_variant": adt_json_variant,
    "adt_observed_append": adt_observed_append,
    "adt_dead_letter": adt_dead_letter,
    "adt_dead_letter_good": adt_dead_letter_good,
    "adt_dead_letter_replay": adt_dead_letter_replay,
    "adt_stream_dead_letter": adt_stream_dead_letter,
    "adt_latest_stream_dead_letter": adt_latest_stream_dead_letter,
    "adt_patient_merge": adt_patient_merge,
    "adt_append_once": adt_append_once,
    "adt_latest_patient": adt_latest_patient,
    "adt_new_referrals": adt_new_referrals,
    "adt_known_patients": adt_known_patients,
    "adt_feed_count": adt_feed_count,
    "adt_schema_evolution": adt_schema_evolution,
    "adt_stream_flatten": adt_stream_flatten,
    "adt_stream_latest": adt_stream_latest,
    "adt_json_scan": adt_json_scan,
    "adt_json_documents": adt_json_documents,
    "adt_json_inferred": adt_json_inferred,
    "adt_declared_schema": adt_declared_schema,
    "adt_message_table": adt_message_table,
    "adt_catchup_blob": adt_catchup_blob,
    "adt_catchup_segments": adt_catchup_segments,
    "adt_catchup_ranges": adt_catchup_ranges,
    "adt_catchup_range_segments": adt_catchup_range_segments,
    "adt_feed_tables": adt_feed_tables,
    "adt_evolving_append": adt_evolving_append,
    "adt_archive_written": adt_archive_written,
    "adt_archive_compacted": adt_archive_compacted,
    "adt_empty_result": adt_empty_result,
    "adt_archive_prefix": adt_archive_prefix,
    "adt_state_filter_sql": adt_state_filter_sql,
}
