"""ADT envelopes derived from the driver's `orders` and `customer` tables.

One message per order (patient = customer), built with Spark SQL expressions
so the amount of work grows with the tables.  The same expression text, with
the four date-formatting snippets swapped, is the DuckDB oracle's input (see
`oracle.py`), so both engines start from identical messages.

Shapes covered: repeated fields (PID-3, PID-11, PV1-3, AL1-2, AL1-5, DG1-3),
a blank last repetition (PID-11.4), NULL segments (PID), id-only segments
(PV1), unmapped values (PID-6, IN1-5.2, NK1), ignored components (CX_5,
XTN_2, XTN_3, XPN_3) and exact duplicate envelopes.

One order in ten (`FULL_RULE`) gets a full message instead: every place of
`FULL_PLACES` holds a text of its own, some fields repeat up to four times, and
all ignored components and fields are present.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.session import tasks_for

# Date snippets per engine: 14/12/8-digit HL7 times, both `updatedAt` formats,
# `createdAt` and the date of birth.
# Spark snippets are built from the NTZ-to-string cast (no `date_format`),
# which keeps them independent of the session time zone: formatting casts a
# TIMESTAMP_NTZ to the session zone and would move wall-clock times that fall
# in a daylight-saving gap.
_TS = "substr(CAST(ts AS STRING), 1, 19)"
_DOB = "CAST(date_add(DATE'1940-01-01', CAST(c_custkey % 20000 AS INT)) AS STRING)"
SPARK_DATES = {
    "ts14": f"translate({_TS}, '- :', '')",
    "ts12": f"substr(translate({_TS}, '- :', ''), 1, 12)",
    "d8": "translate(substr(CAST(o_orderdate AS STRING), 1, 10), '-', '')",
    "upd_long": _TS,
    "upd_short": "substr(CAST(ts AS STRING), 1, 16)",
    "created": "substr(CAST(o_orderdate AS STRING), 1, 19)",
    "dob": _DOB,
    "dob8": f"translate({_DOB}, '-', '')",
}

DUCKDB_DATES = {
    "ts14": "strftime(ts, '%Y%m%d%H%M%S')",
    "ts12": "strftime(ts, '%Y%m%d%H%M')",
    "d8": "strftime(o_orderdate, '%Y%m%d')",
    "upd_long": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    "upd_short": "strftime(ts, '%Y-%m-%d %H:%M')",
    "created": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
    "dob": "strftime(DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%Y-%m-%d')",
    "dob8": "strftime(DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%Y%m%d')",
}

_STATE = ("CASE c_nationkey % 6 WHEN 0 THEN 'CA' WHEN 1 THEN 'OR' WHEN 2 THEN 'WA' "
          "WHEN 3 THEN 'NY' WHEN 4 THEN 'UT' ELSE '' END")
_CUST = "CAST(o_custkey AS STRING)"
_KEY = "CAST(o_orderkey AS STRING)"
_NAT = "CAST(c_nationkey AS STRING)"

# Envelope column -> SQL expression over orders ⨝ customer (+ ts).
ENVELOPE_SQL = {
    "patientId": _CUST,
    "tenantId": "o_orderpriority",
    "dob": "{dob}",
    "id": _KEY,
    "updatedAt": "CASE WHEN o_orderkey % 2 = 0 THEN {upd_long} ELSE {upd_short} END",
    "createdAt": "{created}",
    "visitNumber": _KEY,
    "MSH": "'MSH|^~&|SEGFLOW|' || o_orderpriority || '|||' || {ts14} || '||ADT^A08^ADT_A01|' || "
           + _KEY + " || '|P|2.3'",
    "EVN": "'EVN|A08|' || {ts14} || '||REG_' || o_orderstatus || '|S' || " + _CUST
           + " || '^' || c_mktsegment || '^CLERK^^^^^^FAC' || " + _NAT + " || '^^^^^SITE' || " + _NAT
           + " || '|' || CASE WHEN o_orderkey % 3 = 0 THEN {d8} ELSE '' END || '|SITE' || " + _NAT
           + " || '^' || CAST(c_custkey + 1000000000 AS STRING) || '^NPI'",
    "PID": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE 'PID|1||' || " + _CUST
           + " || '^^^^EPI~' || " + _KEY + " || '^^^^MRN||' || c_name || '^' || c_mktsegment"
           " || '|MAIDEN' || " + _NAT + " || '^ANN^B|' || {dob8} || '|'"
           " || CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END || '|||'"
           " || CASE WHEN o_orderkey % 11 = 0 THEN '9 OLD RD^^OLDTOWN^NV^00000^USA~' ELSE '' END"
           " || " + _KEY + " || ' MAIN ST^^CITY' || " + _NAT + " || '^' || " + _STATE
           + " || '^12345^USA^P^^CNTY||555' || " + _CUST + " || '^PRN^PH^p' || " + _CUST
           + " || '@example.org' END",
    "PV1": "CASE WHEN o_orderkey % 13 = 0 THEN 'PV1' ELSE 'PV1||O|' || o_orderpriority || ' ~'"
           " || o_orderstatus || '^^^' || c_mktsegment || '||||||||||||||||' || " + _KEY
           + " || repeat('|', 25) || {ts12} END",
    "PV2": "CAST(NULL AS STRING)",
    "PD1": "CAST(NULL AS STRING)",
    "IN1": "CASE WHEN o_orderkey % 5 = 0 THEN 'IN1|1|PLAN' || CAST(o_custkey % 7 AS STRING)"
           " || '^' || c_mktsegment || ' PLAN|INS' || " + _NAT + " || '^7|INSURER ' || " + _NAT
           + " || '|PO BOX ' || " + _CUST + " || '^SUITE ' || " + _NAT + " || '^INSCITY^' || "
           + _STATE + " || '^98111||555' || " + _KEY + " || '^WPN|G' || " + _NAT
           + " || '|' || c_mktsegment END",
    "IN2": "CAST(NULL AS STRING)",
    "OBX": "CAST(NULL AS STRING)",
    "AL1": "CASE WHEN o_orderkey % 4 = 0 THEN 'AL1|1|DA~FA|ALG' || CAST(o_custkey % 50 AS STRING)"
           " || '^ALLERGEN ' || CAST(o_custkey % 50 AS STRING) || '^L|'"
           " || CASE WHEN o_orderkey % 8 = 0 THEN 'SV' ELSE 'MI' END || '|HIVES~RASH|' || {d8} END",
    "GT1": "CAST(NULL AS STRING)",
    "ZPV": "CAST(NULL AS STRING)",
    "DG1": "CASE WHEN o_orderkey % 6 = 0 THEN 'DG1|1|I10|R' || CAST(o_custkey % 100 AS STRING)"
           " || '^DIAG TEXT^I10~^^I9|DIAGNOSIS ' || CAST(o_custkey % 100 AS STRING) || '|' || {ts14}"
           " || '|A' END",
    "NK1": "CASE WHEN o_custkey % 3 = 0 THEN 'NK1|1|KIN' || " + _CUST + " || '^' || c_mktsegment"
           " || '|SPO|' || " + _NAT + " || ' KIN RD^^KINCITY^' || " + _STATE + " || '|555' || "
           + _NAT + " END",
}

# Full messages: field.component places of each segment that hold a value.  The
# table is written out here, apart from the column layout, so that a wrong
# position in the layout shows up against it.
FULL_RULE = "o_orderkey % 10 = 4"
FULL_PLACES = {
    "EVN": "1.1 2.1 4.1 5.1 5.2 5.3 5.4 5.9 5.14 6.1 7.1 7.2 7.3",
    "PID": "1.1 2.1 2.4 2.5 3.1 3.2 3.4 3.5 4.1 4.4 5.1 5.2 5.3 5.5 6.1 6.3 7.1 8.1 9.1 9.2 9.3 10.1 10.2 11.1 11.2 "
           "11.3 11.4 11.5 11.6 11.7 11.9 11.13 12.1 13.1 13.2 13.3 13.4 13.5 13.6 13.7 13.9 14.1 14.2 15.1 15.2 16.1 "
           "17.1 18.1 18.4 18.5 19.1 20.1 22.1 22.2 25.1 27.1 28.1 29.1 30.1",
    "PV1": "1.1 2.1 3.1 3.2 3.3 3.4 3.5 3.6 3.7 3.9 3.11 4.1 6.1 6.2 6.3 6.4 6.7 7.1 7.2 7.3 7.4 7.9 7.13 8.1 8.2 8.3 "
           "8.4 8.9 8.13 9.1 9.4 10.1 11.4 14.1 17.1 17.2 17.4 17.10 17.12 18.1 19.1 19.4 20.1 36.1 37.1 41.1 44.1 45.1 "
           "47.1 50.1 50.5 52.4 52.5",
    "PV2": "2.1 8.1 9.1 10.1 12.1 21.1 22.1 32.1 38.1 40.1",
    "PD1": "3.1 3.3 4.1 4.2 4.3 4.4 4.9 4.13 15.1 15.2",
    "IN1": "1.1 2.1 2.2 3.1 3.2 3.4 4.1 5.1 5.2 5.3 5.4 5.5 6.3 7.1 7.2 8.1 9.1 16.1 16.2 16.3 17.1 18.1 19.1 19.3 19.4 "
           "19.5 19.6 19.9 22.1 25.1 35.1 36.1 42.1 43.1 47.1",
    "IN2": "2.1 5.1 6.1 61.1 61.5 63.1 63.2 64.1 64.7 70.1",
    "OBX": "1.1 2.1 3.1 4.1 5.1 11.1",
    "AL1": "1.1 2.1 3.1 3.2 3.3 4.1 5.1 6.1",
    "GT1": "1.1 2.1 2.4 3.1 3.2 3.3 6.1 6.2 46.1 46.6 49.1",
    "ZPV": "15.1 39.1",
    "DG1": "1.1 2.1 3.1 3.2 4.1 5.1 6.1",
    "NK1": "1.1 2.1 2.2",
}
# Fields of a full message that repeat; earlier repetitions hold other texts.
FULL_REPEATS = {("PID", 3): 4, ("PID", 11): 2, ("PID", 13): 4, ("PID", 18): 3, ("AL1", 2): 4, ("AL1", 5): 2,
                ("EVN", 5): 3, ("PV1", 3): 2}
FULL_STATE = ("PID", 11, 4)


def full_value(seg: str, field: int, comp: int, rep: int | None = None) -> str:
    """Template text of one place; # stands for the order key.  `rep` numbers an
    earlier repetition, None is the last one."""
    if (seg, field, comp) == FULL_STATE:
        return "@" if rep is None else "NV"
    return f"{seg.lower()} {field} {comp}" + (f" r{rep}" if rep else "") + " #"


def full_template(seg: str) -> str:
    """Text of a full segment with # for the order key and @ for the state."""
    places: dict[int, list[int]] = {}
    for place in FULL_PLACES[seg].split():
        f, c = place.split(".")
        places.setdefault(int(f), []).append(int(c))
    out = [seg]
    for f in range(1, max(places) + 1):
        reps = FULL_REPEATS.get((seg, f), 1)
        texts = []
        for r in range(1, reps + 1):
            rep = r if r < reps else None
            texts.append("^".join(full_value(seg, f, c, rep) if c in places.get(f, []) else ""
                                  for c in range(1, max(places.get(f, [0])) + 1)))
        out.append("~".join(texts))
    return "|".join(out)


def full_segment_sql(seg: str) -> str:
    text = f"replace('{full_template(seg)}', '#', {_KEY})"
    return f"replace({text}, '@', {_STATE})" if seg == FULL_STATE[0] else text


for _seg in FULL_PLACES:
    ENVELOPE_SQL[_seg] = f"CASE WHEN {FULL_RULE} THEN {full_segment_sql(_seg)} ELSE {ENVELOPE_SQL[_seg]} END"

# Messages the feed delivers twice (urgent orders are re-sent), so the dedupe
# has exact copies to remove.
DUPLICATE_RULE = "o_orderpriority = '1-URGENT'"


BUILT_AT_ONCE = 4


def envelope_exprs(dates: dict[str, str]) -> dict[str, str]:
    return {k: v.format(**dates) for k, v in ENVELOPE_SQL.items()}


def derived_envelopes(spark: SparkSession, sf_dir: str, duplicates: bool = True) -> DataFrame:
    """Envelope rows (superset schema, all strings) from orders ⨝ customer."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).withColumn(
        "ts", F.expr("timestampadd(MINUTE, o_orderkey % 1440, o_orderdate)"))
    if duplicates:
        joined = joined.unionByName(joined.where(DUPLICATE_RULE))
    # A message is many times the size of its order: tasks are counted by rows, as the
    # few bytes of the tables would put millions of messages into one task.
    tasks = tasks_for(spark, orders.count())
    # Neighbours stay together: their texts are alike and compress better.
    joined = joined.repartition(tasks, F.expr("shiftright(coalesce(o_orderkey, o_custkey), 6)")) if tasks > 1 else joined
    exprs = envelope_exprs(SPARK_DATES)
    # The built columns pass through one-row generators so they behave like a
    # scanned source: later filters on envelope columns stop above them
    # instead of being inlined (with the whole message-building expression)
    # into the join condition, where generated code would rebuild the text
    # per use.  Each generator builds a few columns: in one, the generated
    # method is larger than the JVM compiles, and every message is interpreted.
    names, rows = list(exprs), joined
    for at in range(0, len(names), BUILT_AT_ONCE):
        now = names[at:at + BUILT_AT_ONCE]
        rows = rows.select("*", *[F.expr(exprs[k]).alias(f"_b_{k}") for k in now])
        rows = rows.selectExpr(*[f"`{c}`" for c in rows.columns if c not in {f"_b_{k}" for k in now}],
                               "inline(array(struct(" + ", ".join(f"`_b_{k}` AS `_e_{k}`" for k in now) + ")))")
    return rows.select(*[F.col(f"_e_{k}").alias(k) for k in names])


def derived_documents(envelopes: DataFrame) -> DataFrame:
    """(key, json) documents: `pid_<patient>_<id>` for patient messages, and
    `other_<id>` for messages whose tenant is `5-LOW` (kept in the store under
    another prefix, so a key scan must skip them)."""
    key = F.when(F.col("tenantId") == "5-LOW", F.concat(F.lit("other_"), F.col("id"))) \
        .otherwise(F.concat(F.lit("pid_"), F.col("patientId"), F.lit("_"), F.col("id")))
    return envelopes.select(key.alias("key"), F.to_json(F.struct(*envelopes.columns)).alias("json"))
