"""Envelope sources: JSON files, key/document tables, raw message tables and
relational catch-up rows.  Each returns a DataFrame of envelope rows (all
strings); none of them pulls data to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from segflow.operators.dedupe import distinct_rows

METADATA = ("patientId", "tenantId", "dob", "id", "updatedAt", "createdAt", "visitNumber")
# Segments the declared (three-segment) schema carries, after MSH.
DECLARED_SEGMENTS = ("EVN", "PID", "PV1")
SUPERSET_SEGMENTS = ("EVN", "PID", "PV1", "PV2", "PD1", "IN1", "IN2", "OBX", "AL1", "GT1",
                     "ZPV", "DG1", "NK1")


def _schema(names) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# The declared schema (11 fields) and the superset we default to.
DECLARED = _schema(METADATA + ("MSH",) + DECLARED_SEGMENTS)
ENVELOPE = _schema(METADATA + ("MSH",) + SUPERSET_SEGMENTS)


# Column that Spark's JSON readers fill with text that does not parse.
CORRUPT = "_corrupt_record"


def with_corrupt(schema: StructType) -> StructType:
    return StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])


def _parse_reason(columns, corrupt: Column) -> Column:
    """Why a parsed row is no envelope: its text did not parse, or holds nothing."""
    empty = F.lit(True)
    for c in columns:
        empty = empty & c.isNull()
    return F.when(corrupt.isNotNull(), F.lit("invalid json")).when(empty, F.lit("empty envelope"))


def read_json_routed(spark: SparkSession, path, schema: StructType | None = ENVELOPE,
                     multiline: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1/S2 with dead letters: (envelopes, rows that are none with `reason`).

    Each text of the input is in exactly one of the two; the dead ones keep
    their text in `_corrupt_record`.
    """
    reader = (spark.read.option("multiLine", multiline).option("primitivesAsString", True)
              .option("columnNameOfCorruptRecord", CORRUPT))
    if schema is not None:
        reader = reader.schema(with_corrupt(schema))
    df = reader.json(path)
    names = [c for c in df.columns if c != CORRUPT]
    if CORRUPT not in df.columns:       # inference met no bad text
        df = df.withColumn(CORRUPT, F.lit(None).cast("string"))
    tagged = df.withColumn("reason", _parse_reason([F.col(c) for c in names], F.col(CORRUPT)))
    return tagged.where("reason IS NULL").select(*names), tagged.where("reason IS NOT NULL")


def read_json_envelopes(spark: SparkSession, path, schema: StructType | None = ENVELOPE,
                        multiline: bool = True, dedupe: bool = True) -> DataFrame:
    """Scan JSON envelopes (any Hadoop path or glob).

    `multiline=True` reads one document per file, as the feed writes them;
    JSON-lines input should pass False so files split.  `schema=None` opts
    into inference of the names (one extra pass over the data); every value
    stays text, as with a declared schema, so a numeric `id` or `patientId`
    cannot change a column's type.  Exact duplicates are removed unless
    `dedupe=False`.  Text that is no envelope is left out here and returned by
    `read_json_routed`.
    """
    df, _ = read_json_routed(spark, path, schema, multiline)
    return distinct_rows(df) if dedupe else df


def date_prefix(ts: Column | str, padded: bool = False) -> Column:
    """Object-store prefix of a timestamp, `yyyy/M/d` (or `yyyy/MM/dd`).
    Built from the date fields, so a TIMESTAMP_NTZ is not moved through the
    session time zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    parts = [F.year(ts), F.month(ts), F.dayofmonth(ts)]
    if padded:
        parts = [F.lpad(parts[0].cast("string"), 4, "0")] + \
                [F.lpad(x.cast("string"), 2, "0") for x in parts[1:]]
    return F.when(ts.isNotNull(), F.concat_ws("/", *[x.cast("string") for x in parts]))


def tag_documents(docs: DataFrame, json_col: str, schema: StructType = ENVELOPE, more_reasons=None) -> DataFrame:
    """Input columns, the parsed struct `_e`, and `reason` (NULL for an envelope).

    The text is parsed once, behind a one-row generator: the routing filters
    read the generated column, so Catalyst cannot push them under the parse and
    run `from_json` again for each field they mention.  `more_reasons` maps the
    parsed struct's name to a Column with further reasons.
    """
    parsed_struct = F.from_json(unwrap_json(json_col), with_corrupt(schema),
                                {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = docs.select("*", F.inline(F.array(F.struct(parsed_struct.alias("_e")))))
    reason = F.coalesce(F.when(F.col("_e").isNull(), F.lit("invalid json")),
                        _parse_reason([F.col(f"_e.`{f.name}`") for f in schema.fields], F.col(f"_e.{CORRUPT}")))
    if more_reasons is not None:
        reason = F.coalesce(reason, more_reasons("_e"))
    return parsed.withColumn("reason", reason)


def parse_documents(docs: DataFrame, json_col: str, schema: StructType = ENVELOPE, more_reasons=None
                    ) -> tuple[DataFrame, DataFrame]:
    """Parse a text column: (envelopes, dead rows = input columns + `reason`).

    Two lazy frames: a job that uses both parses twice, unless it writes
    `tag_documents` first and takes them from the copy.
    """
    tagged = tag_documents(docs, json_col, schema, more_reasons)
    good = tagged.where("reason IS NULL").select(*[F.col(f"_e.`{f.name}`").alias(f.name) for f in schema.fields])
    return good, tagged.where("reason IS NOT NULL").drop("_e")


def scan_documents_routed(docs: DataFrame, prefix: str = "pid_", key_col: str = "key", json_col: str = "json",
                          schema: StructType = ENVELOPE) -> tuple[DataFrame, DataFrame]:
    """S3 with dead letters: (envelopes, documents that are none with `reason`)."""
    return parse_documents(docs.where(F.col(key_col).startswith(prefix)), json_col, schema)


def scan_documents(docs: DataFrame, prefix: str = "pid_", key_col: str = "key",
                   json_col: str = "json", schema: StructType = ENVELOPE,
                   dedupe: bool = True) -> DataFrame:
    """S3: documents whose key starts with `prefix` (literal, no wildcard), parsed.

    Text that is no envelope is left out here and returned by
    `scan_documents_routed`."""
    parsed, _ = scan_documents_routed(docs, prefix, key_col, json_col, schema)
    return distinct_rows(parsed) if dedupe else parsed


def unwrap_json(text: Column | str) -> Column:
    """JSON text that may itself be JSON-encoded as a string: returns the object text."""
    t = F.col(text) if isinstance(text, str) else text
    return F.when(F.ltrim(t).startswith('"'), F.get_json_object(t, "$")).otherwise(t)


def read_message_table_routed(messages: DataFrame, json_col: str = "patientjson",
                              schema: StructType = ENVELOPE) -> tuple[DataFrame, DataFrame]:
    """S8 with dead letters: (envelopes, message rows that are none with `reason`)."""
    return parse_documents(messages, json_col, schema)


def read_message_table(messages: DataFrame, json_col: str = "patientjson",
                       schema: StructType = ENVELOPE, dedupe: bool = True) -> DataFrame:
    """A table of raw JSON documents (possibly double-encoded) -> envelopes.

    Text that is no envelope is left out here and returned by
    `read_message_table_routed`."""
    parsed, _ = read_message_table_routed(messages, json_col, schema)
    return distinct_rows(parsed) if dedupe else parsed


def read_jdbc_catchup(spark: SparkSession, url: str, table: str, properties: dict,
                      partition_column: str, lower: int, upper: int,
                      num_partitions: int) -> DataFrame:
    """S6 (read side): a relational message table read in parallel ranges."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=num_partitions,
                           properties=properties)


def _blob_matches(rows: DataFrame, blob_col: str, meta, segments) -> DataFrame:
    """meta columns and, for each segment id, `__m_<id>`: its segments in order.

    Line breaks are normalised and the blob is split once; the arrays are read
    from that projection (they are used more than once, so it stays apart).
    """
    text = f"decode(`{blob_col}`, 'UTF-8')" if dict(rows.dtypes)[blob_col] == "binary" \
        else f"`{blob_col}`"
    cols = [f"`{m}`" for m in meta if m in rows.columns]
    norm = f"split(replace(replace({text}, '\\r\\n', '\\r'), '\\n', '\\r'), '\\r') AS __parts"
    parts = rows.selectExpr(*cols, norm)
    return parts.selectExpr(*cols, *[
        f"filter(__parts, p -> startswith(p, '{s}|') OR p = '{s}') AS `__m_{s}`" for s in segments])


def segments_from_blob(rows: DataFrame, blob_col: str = "hl7", meta=METADATA,
                       segments=("MSH",) + SUPERSET_SEGMENTS, extra=()) -> DataFrame:
    """Metadata + raw HL7 blob (segments split by CR, LF or CRLF) -> envelope columns.

    The envelope holds one text per segment id, the last one.  Earlier ones of a
    segment that occurs more than once are kept in `repeated`
    (array<struct<seg,occurrence,text>>), so nothing is lost; `blob_segments` or,
    from a written copy, `envelope_segments` gives all of them as rows.  `extra`
    names further columns to keep.
    """
    meta = (*meta, *extra)
    m = _blob_matches(rows, blob_col, meta, segments)
    cols = [f"`{c}`" for c in meta if c in rows.columns]
    earlier = ", ".join(
        f"IF(size(`__m_{s}`) > 1, transform(slice(`__m_{s}`, 1, greatest(size(`__m_{s}`) - 1, 0)), (t, i) -> "
        f"named_struct('seg', '{s.lower()}', 'occurrence', i + 1, 'text', t)), "
        f"CAST(array() AS array<struct<seg:string,occurrence:int,text:string>>))" for s in segments)
    return m.selectExpr(*cols, *[f"try_element_at(`__m_{s}`, -1) AS `{s}`" for s in segments],
                        f"concat({earlier}) AS repeated")


def blob_segments(rows: DataFrame, blob_col: str = "hl7", meta=METADATA,
                  segments=SUPERSET_SEGMENTS) -> DataFrame:
    """S6 as rows: metadata, seg (lower-case id), occurrence (1-based) and text of
    every segment of every blob.  Two generators, no shuffle."""
    m = _blob_matches(rows, blob_col, meta, segments)
    cols = [f"`{c}`" for c in meta if c in rows.columns]
    by_id = ", ".join(f"named_struct('seg', '{s.lower()}', 'texts', `__m_{s}`)" for s in segments)
    return (m.selectExpr(*cols, f"inline(array({by_id}))")
            .selectExpr(*cols, "seg", "posexplode(texts) AS (_i, text)")
            .selectExpr(*cols, "seg", "_i + 1 AS occurrence", "text"))


def envelope_segments(envelopes: DataFrame, meta=METADATA, segments=SUPERSET_SEGMENTS) -> DataFrame:
    """The rows of `blob_segments` from envelopes with `repeated`, so a blob that was
    read and split once gives both forms."""
    cols = [f"`{c}`" for c in meta if c in envelopes.columns]
    last = ", ".join(
        f"named_struct('seg', '{s.lower()}', 'occurrence', size(filter(repeated, r -> r.seg = '{s.lower()}')) + 1, 'text', `{s}`)"
        for s in segments)
    listed = ", ".join(f"'{s.lower()}'" for s in segments)
    return (envelopes.selectExpr(*cols, f"inline(concat(filter(repeated, r -> r.seg IN ({listed})), array({last})))")
            .where("text IS NOT NULL"))


def catch_up(spark: SparkSession, url: str, table: str, properties: dict, partition_column: str,
             lower: int, upper: int, num_partitions: int, blob_col: str = "hl7") -> tuple[DataFrame, DataFrame]:
    """S6 as one flow: the relational table read in parallel ranges, as
    (envelopes, all segments as rows).

    The database is read once: envelopes are checkpointed into the shared folder and
    both frames come from there.  `sources.catchup` has the form for large tables,
    which can stop and go on.
    """
    from segflow.session import checkpoint_dir

    checkpoint_dir(spark)
    rows = read_jdbc_catchup(spark, url, table, properties, partition_column, lower, upper, num_partitions)
    env = segments_from_blob(rows, blob_col).checkpoint(eager=True)
    return env, envelope_segments(env)
