"""DuckDB SQL for the correctness oracle.

Each query in `queries.py` has an independent DuckDB formulation here: the
same derived envelopes (shared input text, see `sources/derived.py`), then
the operator written with DuckDB list functions, `unnest`, window functions
and `NOT EXISTS`.  Names and places come from `places.py`, not from the layout;
only raw names and the names of numbered mode are shared.
"""

from __future__ import annotations

from segflow import layout
from segflow.plans.places import IGNORED_FIELDS, IGNORED_PLACES, NUMBERED, PLACES
from segflow.sources.derived import (DUCKDB_DATES, DUPLICATE_RULE, FULL_RULE, envelope_exprs)
from segflow.sources.envelope import ENVELOPE

ENV_COLS = [f.name for f in ENVELOPE.fields]
SEGMENTS = [s for s in layout.HL7_SEGMENTS]


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def derived_cte(dedupe: bool = True) -> str:
    """CTEs `base`, `env_all` (with duplicates) and `env` (lower-case names,
    deduplicated unless `dedupe=False`)."""
    exprs = envelope_exprs(DUCKDB_DATES)
    sel = ",\n    ".join(f"{e} AS {_q(k)}" for k, e in exprs.items())
    low = ", ".join(f"{_q(k)} AS {_q(k.lower())}" for k in exprs)
    distinct = "DISTINCT " if dedupe else ""
    return f"""base AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
         c_custkey, c_name, c_nationkey, c_mktsegment,
         o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) AS ts
  FROM orders JOIN customer ON o_custkey = c_custkey
),
base2 AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE {DUPLICATE_RULE}),
env_all AS (
  SELECT
    {sel}
  FROM base2
),
env AS (SELECT {distinct}{low} FROM env_all)"""


def _fields(seg: str, src: str = "") -> str:
    s = f"{src}{_q(seg)}"
    sid = seg.upper()
    return f"CASE WHEN starts_with({s}, '{sid}|') OR {s} = '{sid}' THEN string_split({s}, '|') END"


def _last(field_expr: str, comp: int) -> str:
    return (f"list_filter(list_transform(string_split({field_expr}, '~'), "
            f"lambda r: string_split(r, '^')[{comp}]), lambda v: trim(v) <> '')[-1]")


def _nth(field_expr: str, comp: int, rep: int) -> str:
    x = f"string_split(string_split({field_expr}, '~')[{rep}], '^')[{comp}]"
    return f"CASE WHEN trim({x}) <> '' THEN {x} END"


def split_cte(source: str = "env", keep=("patientid", "dob"), name: str = "split",
              present=SEGMENTS) -> str:
    ks = ", ".join(_q(k) for k in keep)
    fs = ", ".join((f"{_fields(s)}" if s in present else "CAST(NULL AS VARCHAR[])") + f" AS f_{s}"
                   for s in SEGMENTS)
    return f"{name} AS (SELECT {ks}, {fs} FROM {source})"


def wide_select(keep=("patientid", "dob"), numbered: bool = False, rename: bool = True,
                segments=SEGMENTS, source: str = "split") -> str:
    parts = [_q(k) for k in keep]
    if not numbered and rename:
        for name, place in PLACES.items():
            seg, _, at = place.partition("-")
            f, c = at.split(".")
            if seg in segments:
                parts.append(f"{_last(f'f_{seg}[{int(f) + 1}]', int(c))} AS {_q(name)}")
    else:
        for c in layout.wide_columns(segments, numbered=numbered):
            fe = f"f_{c.pos.segment}[{c.pos.field + 1}]"
            v = _nth(fe, c.pos.component, c.pos.rep or 1) if numbered else _last(fe, c.pos.component)
            name = c.name if rename else layout.truncated_name(c.raw)
            parts.append(f"{v} AS {_q(name)}")
    return "SELECT " + ",\n  ".join(parts) + f"\nFROM {source}"


def q_flatten() -> str:
    return f"WITH {derived_cte()},\n{split_cte()}\n{wide_select()}"


def q_state_filter() -> str:
    states = ", ".join(f"'{s}'" for s in layout.STATES)
    return (f"WITH {derived_cte()},\n{split_cte()},\nwide AS ({wide_select()})\n"
            f"SELECT * FROM wide WHERE pt_address_state_prov IN ({states})")


def q_dedupe() -> str:
    cols = ", ".join(_q(c.lower()) for c in ENV_COLS)
    return f"WITH {derived_cte()}\nSELECT {cols} FROM env"


def long_cte(keep=("patientid", "id")) -> str:
    ks = ", ".join(_q(k) for k in keep)
    unions = "\n  UNION ALL ".join(
        f"SELECT {ks}, '{s}' AS seg, {_fields(s)} AS fields FROM env" for s in SEGMENTS)
    return f"""segs AS (
  {unions}
),
fld AS (SELECT {ks}, seg, fields, unnest(generate_series(2, len(fields))) AS fi
        FROM segs WHERE fields IS NOT NULL),
fld2 AS (SELECT {ks}, seg, fi - 1 AS field, string_split(fields[fi], '~') AS reps FROM fld),
rp AS (SELECT {ks}, seg, field, reps, unnest(generate_series(1, len(reps))) AS rep FROM fld2),
rp2 AS (SELECT {ks}, seg, field, rep, string_split(reps[rep], '^') AS comps FROM rp),
cp AS (SELECT {ks}, seg, field, rep, comps, unnest(generate_series(1, len(comps))) AS comp FROM rp2),
long AS (SELECT {ks}, seg, CAST(field AS INTEGER) AS field, CAST(rep AS INTEGER) AS rep,
                CAST(comp AS INTEGER) AS comp, comps[comp] AS value
         FROM cp WHERE trim(comps[comp]) <> '')"""


def q_long() -> str:
    return f"WITH {derived_cte()},\n{long_cte()}\nSELECT * FROM long"


def _values(keys) -> str:
    return "VALUES " + ", ".join(f"('{k}')" for k in sorted(set(keys)))


def q_ignore_lists() -> str:
    return f"""WITH {derived_cte()},
{long_cte()},
ig_field(k) AS ({_values(IGNORED_FIELDS)}),
ig_comp(k) AS ({_values(IGNORED_PLACES)})
SELECT * FROM long l
WHERE NOT EXISTS (SELECT 1 FROM ig_field g WHERE g.k = l.seg || '_' || l.field)
  AND NOT EXISTS (SELECT 1 FROM ig_comp g WHERE g.k = l.seg || '_' || l.field || '_' || l.comp)"""


def q_full_messages() -> str:
    """Full messages without parsing: each place holds a text of its own.  The other
    messages are split like elsewhere."""
    keep = ("patientid", "id")
    parts = []
    for name, place in PLACES.items():
        seg, _, at = place.partition("-")
        f, c = at.split(".")
        value = f"'{seg} {f} {c} ' || CAST(o_orderkey AS VARCHAR)"
        if place == "pid-11.4":     # the state; where it is blank the first repetition stands
            value = ("CASE c_nationkey % 6 WHEN 0 THEN 'CA' WHEN 1 THEN 'OR' WHEN 2 THEN 'WA' "
                     "WHEN 3 THEN 'NY' WHEN 4 THEN 'UT' ELSE 'NV' END")
        parts.append(f"{value} AS {_q(name)}")
    names = ", ".join(_q(n) for n in PLACES)
    return (f"WITH {derived_cte()},\n{split_cte(keep=keep)},\nparsed AS ({wide_select(keep=keep)})\n"
            "SELECT CAST(o_custkey AS VARCHAR) AS patientid, CAST(o_orderkey AS VARCHAR) AS id,\n  "
            + ",\n  ".join(parts) + f", true AS \"full\"\nFROM orders JOIN customer ON o_custkey = c_custkey WHERE {FULL_RULE}\n"
            f"UNION ALL BY NAME\nSELECT patientid, id, {names}, false AS \"full\" FROM parsed\n"
            f"WHERE NOT ({FULL_RULE.replace('o_orderkey', 'CAST(id AS BIGINT)')})")


LAST_REP_COLUMNS = ("pt_address_st_1", "pt_address_city", "pt_address_state_prov",
                    "pt_address_zip_postal", "pt_loc_poc_1", "pt_loc_facility_1",
                    "pt_allergy_allergen_type_code_1", "pt_allergy_reaction_code_identifier",
                    "pt_diag_code_identifier", "pt_diag_code_text_1")


def q_last_repetition() -> str:
    return (f"WITH {derived_cte()},\n{split_cte(keep=('patientid', 'id'))},\n"
            f"wide AS ({wide_select(keep=('patientid', 'id'))})\n"
            f"SELECT patientid, id, {', '.join(LAST_REP_COLUMNS)} FROM wide")


def q_numbered() -> str:
    return (f"WITH {derived_cte()},\n{split_cte(keep=('patientid', 'id'))}\n"
            f"{wide_select(keep=('patientid', 'id'), numbered=True)}")


def _mapped_keys() -> set[str]:
    return {p.replace("-", "_").replace(".", "_") for p in PLACES.values()}


_EXTRAS_BODY = """SELECT patientid, id, seg || '_' || field || '_' || comp AS key, arg_max(value, rep) AS value
FROM long l
WHERE NOT EXISTS (SELECT 1 FROM ex_field g WHERE g.k = l.seg || '_' || l.field)
  AND NOT EXISTS (SELECT 1 FROM ex_key g WHERE g.k = l.seg || '_' || l.field || '_' || l.comp)
GROUP BY patientid, id, seg, field, comp"""


def q_extras() -> str:
    return f"""WITH {derived_cte()},
{long_cte()},
ex_field(k) AS ({_values(IGNORED_FIELDS)}),
ex_key(k) AS ({_values(_mapped_keys() | set(IGNORED_PLACES))})
{_EXTRAS_BODY}"""


def q_numbered_extras() -> str:
    """Unmapped places as before; of mapped ones, repetitions without a name."""
    keys = (_mapped_keys() | set(NUMBERED)) - set(IGNORED_PLACES)
    taken = {f"{k}_{r}" for k in keys for r in NUMBERED.get(k, [1])}
    taken |= {f"{s}_{f}_{c}_{r}" for s, f, c, r in layout.ignore_rules().names if r is not None}
    return f"""WITH {derived_cte()},
{long_cte()},
ex_field(k) AS ({_values(IGNORED_FIELDS)}),
ex_key(k) AS ({_values(_mapped_keys() | set(NUMBERED) | set(IGNORED_PLACES))}),
mapped(k) AS ({_values(keys)}),
taken(k) AS ({_values(taken)})
{_EXTRAS_BODY}
UNION ALL
SELECT patientid, id, seg || '_' || field || '_' || comp || '_' || rep AS key, value
FROM long l
WHERE NOT EXISTS (SELECT 1 FROM ex_field g WHERE g.k = l.seg || '_' || l.field)
  AND EXISTS (SELECT 1 FROM mapped g WHERE g.k = l.seg || '_' || l.field || '_' || l.comp)
  AND NOT EXISTS (SELECT 1 FROM taken g WHERE g.k = l.seg || '_' || l.field || '_' || l.comp || '_' || l.rep)"""


# Columns the derived messages populate (mapped names and extras keys): the
# observed-widening oracle is a fixed SELECT of exactly these.
OBSERVED_MAPPED = tuple(PLACES)
OBSERVED_EXTRAS = (
    "dg1_3_3", "in1_5_2", "nk1_1_1", "nk1_2_1", "nk1_2_2", "nk1_3_1", "nk1_4_1", "nk1_4_3",
    "nk1_4_4", "nk1_5_1", "pid_11_2", "pid_20_1", "pid_25_1", "pid_3_2", "pid_6_1", "pid_6_2", "pv1_9_1",
)


def q_observed_wide() -> str:
    names = sorted(set(OBSERVED_MAPPED) | set(OBSERVED_EXTRAS))
    parts = ["patientid", "dob"]
    for n in names:
        if n in PLACES:
            seg, _, at = PLACES[n].partition("-")
            f, c = at.split(".")
            parts.append(f"{_last(f'f_{seg}[{int(f) + 1}]', int(c))} AS {_q(n)}")
        else:
            s, f, c = n.split("_")
            parts.append(f"{_last(f'f_{s}[{int(f) + 1}]', int(c))} AS {_q(n)}")
    return f"WITH {derived_cte()},\n{split_cte()}\nSELECT " + ",\n  ".join(parts) + "\nFROM split"


def q_truncate_names() -> str:
    return f"WITH {derived_cte()},\n{split_cte()}\n{wide_select(rename=False)}"


def q_document_scan() -> str:
    cols = ", ".join(_q(c.lower()) for c in ENV_COLS)
    return f"WITH {derived_cte()}\nSELECT {cols} FROM env WHERE tenantid <> '5-LOW'"


def q_dead_letter() -> str:
    return f"""WITH {derived_cte(dedupe=False)}
SELECT CASE WHEN tenantid = '5-LOW' THEN 'other_' || id ELSE 'pid_' || patientid || '_' || id END AS key,
       CASE WHEN evn LIKE '%|REG\\_P|%' ESCAPE '\\' THEN 'invalid json'
            WHEN pv1 = 'PV1' THEN 'no patientId'
            ELSE 'segment PID holds PV1' END AS reason
FROM env
WHERE evn LIKE '%|REG\\_P|%' ESCAPE '\\' OR pv1 = 'PV1' OR (pid IS NULL AND pv1 IS NOT NULL)"""


_DAMAGE = """CASE WHEN evn LIKE '%|REG\\_P|%' ESCAPE '\\' THEN 'invalid json'
            WHEN pv1 = 'PV1' THEN 'no patientId'
            WHEN pid IS NULL AND pv1 IS NOT NULL THEN 'segment PID holds PV1' END"""


def q_dead_letter_good() -> str:
    cols = ", ".join(_q(c.lower()) for c in ENV_COLS)
    return f"WITH {derived_cte(dedupe=False)}\nSELECT {cols} FROM env WHERE ({_DAMAGE}) IS NULL"


def q_stream_dead_letter() -> str:
    return f"""WITH {derived_cte(dedupe=False)},
tagged AS (SELECT id, {_DAMAGE} AS reason FROM env)
SELECT CASE WHEN reason IS NULL THEN 'good' ELSE 'dead' END AS kind, id, reason FROM tagged"""


def q_dead_letter_replay() -> str:
    """First lot (odd ids): replayed with the text mended, then with foreign PIDs taken
    out too.  Second lot: the second replay only."""
    return f"""WITH {derived_cte(dedupe=False)},
dead AS (SELECT id, CAST(id AS BIGINT) % 2 = 1 AS early, pv1 = 'PV1' AS nobody,
                pid IS NULL AND pv1 IS NOT NULL AS foreign_pid
         FROM env WHERE ({_DAMAGE}) IS NOT NULL),
x AS (SELECT id, early, coalesce(nobody, false) AS nobody, early AND NOT coalesce(nobody, false) AND foreign_pid AS second_try
      FROM dead)
SELECT id, CASE WHEN NOT nobody THEN 'good' WHEN early THEN 'parked' ELSE 'waiting' END AS kind,
       CASE WHEN nobody THEN 'no patientId' END AS reason,
       CAST(CASE WHEN early AND (nobody OR second_try) THEN 2 ELSE 1 END AS INTEGER) AS attempts,
       CASE WHEN early THEN 'night-1' ELSE 'night-2' END AS added
FROM x"""


def q_latest_stream_dead_letter() -> str:
    return f"""WITH {derived_cte(dedupe=False)},
tagged AS (SELECT *, {_DAMAGE} AS reason FROM env),
ranked AS (
  SELECT id, row_number() OVER (PARTITION BY patientid
      ORDER BY {_updated_ts()} DESC NULLS LAST, TRY_CAST(id AS BIGINT) DESC NULLS LAST,
               id DESC NULLS LAST) AS rn
  FROM tagged WHERE reason IS NULL)
SELECT 'good' AS kind, id, CAST(NULL AS VARCHAR) AS reason FROM ranked WHERE rn = 1
UNION ALL SELECT 'dead', id, reason FROM tagged WHERE reason IS NOT NULL"""


def q_append_once() -> str:
    keep = ("patientid", "id", "dob")
    return f"WITH {derived_cte()},\n{split_cte(keep=keep)}\n{wide_select(keep=keep)}"


def _updated_ts(col: str = "updatedat") -> str:
    return (f"coalesce(try_strptime({col}, '%Y-%m-%d %H:%M:%S'), "
            f"try_strptime({col}, '%Y-%m-%d %H:%M'))")


def q_latest_patient() -> str:
    keep = ("patientid", "id", "updatedat", "dob")
    return f"""WITH {derived_cte()},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY patientid
      ORDER BY {_updated_ts()} DESC NULLS LAST, TRY_CAST(id AS BIGINT) DESC NULLS LAST,
               id DESC NULLS LAST) AS rn
  FROM env),
latest AS (SELECT * FROM ranked WHERE rn = 1),
{split_cte(source='latest', keep=keep)}
{wide_select(keep=keep)}"""


REFERRAL_CUTOFF = "1998-01-01 00:00:00"


def q_new_referrals() -> str:
    ts = _updated_ts()
    return f"""WITH {derived_cte()},
b AS (SELECT patientid FROM env WHERE {ts} >= TIMESTAMP '{REFERRAL_CUTOFF}' AND patientid IS NOT NULL),
k AS (SELECT patientid FROM env WHERE NOT ({ts} >= TIMESTAMP '{REFERRAL_CUTOFF}') OR {ts} IS NULL)
SELECT patientid, count(*) AS n_messages FROM b
WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.patientid = b.patientid)
GROUP BY patientid"""


# The first lies before most patients' first message.
KNOWN_CUTOFFS = ("1993-01-01 00:00:00", "1997-01-01 00:00:00")


def q_known_patients() -> str:
    ts = _updated_ts()
    return f"""WITH {derived_cte()},
b AS (SELECT patientid, CASE WHEN {ts} < TIMESTAMP '{KNOWN_CUTOFFS[0]}' THEN 0
                             WHEN {ts} < TIMESTAMP '{KNOWN_CUTOFFS[1]}' THEN 1 ELSE 2 END AS batch FROM env),
n AS (SELECT patientid, batch, count(*) AS n_messages FROM b WHERE patientid IS NOT NULL GROUP BY patientid, batch)
SELECT patientid, n_messages, CAST(batch AS INTEGER) AS batch FROM n
WHERE NOT EXISTS (SELECT 1 FROM n e WHERE e.patientid = n.patientid AND e.batch < n.batch)"""


FEEDS = ("acme", "road-runner")


def q_feed_count_full() -> str:
    feeds = ", ".join(f"('{f}', '{layout.table_name(f)}')" for f in FEEDS)
    states = ", ".join(f"'{s}'" for s in layout.STATES)
    return (f"WITH {derived_cte()},\n{split_cte()},\nwide AS ({wide_select()}),\n"
            f"kept AS (SELECT * FROM wide WHERE pt_address_state_prov IN ({states})),\n"
            f"feeds(feed, table_name) AS (VALUES {feeds})\n"
            f"SELECT feed, table_name, (SELECT count(*) FROM kept) AS rows FROM feeds")


EVOLUTION_CUTOFF = "1995-01-01 00:00:00"
DECLARED_SEGMENTS = ("evn", "pid", "pv1")


def q_schema_evolution() -> str:
    ts = _updated_ts()
    return f"""WITH {derived_cte()},
early AS (SELECT * FROM env WHERE {ts} < TIMESTAMP '{EVOLUTION_CUTOFF}'),
late AS (SELECT * FROM env WHERE NOT ({ts} < TIMESTAMP '{EVOLUTION_CUTOFF}') OR {ts} IS NULL),
{split_cte(source='early', name='s1')},
{split_cte(source='late', name='s2')},
w1 AS ({wide_select(segments=DECLARED_SEGMENTS, source='s1')}),
w2 AS ({wide_select(source='s2')})
SELECT * FROM w1 UNION ALL BY NAME SELECT * FROM w2"""


ARCHIVE_YEAR = 1996


def q_archive_written() -> str:
    ts = _updated_ts()
    return f"""WITH {derived_cte(dedupe=False)}
SELECT id, evn, CAST(year({ts}) AS INTEGER) AS y, CAST(month({ts}) AS INTEGER) AS m, CAST(day({ts}) AS INTEGER) AS d
FROM env WHERE year({ts}) = {ARCHIVE_YEAR}"""


def q_empty_result() -> str:
    return (f"WITH {derived_cte(dedupe=False)}\nSELECT count(*) AS messages, CAST(0 AS BIGINT) AS tables_written, "
            "false AS folder_written FROM env")


def q_feed_tables() -> str:
    states = ", ".join(f"'{s}'" for s in layout.STATES)
    names = ", ".join(f"('{v}')" for v in ("v4_acme", "v4_road_runner"))
    return (f"WITH {derived_cte()},\n{split_cte()},\nwide AS ({wide_select()}),\ntables(table_name) AS (VALUES {names})\n"
            f"SELECT wide.*, table_name FROM wide, tables WHERE pt_address_state_prov IN ({states})")


def q_catchup_segments() -> str:
    """Blob segments in message order: the earlier DG1 and OBX come first."""
    unions = []
    for s in SEGMENTS:
        earlier = ""
        if s in ("dg1", "obx"):
            sid = s.upper()
            unions.append(f"SELECT patientid, id, '{s}' AS seg, 1 AS occurrence, string_split('{sid}|0|EARLIER|E' || id || "
                          f"'^FIRST~SECOND', '|') AS fields FROM env WHERE {s} IS NOT NULL")
            earlier = "2"
        unions.append(f"SELECT patientid, id, '{s}' AS seg, {earlier or 1} AS occurrence, {_fields(s)} AS fields FROM env")
    body = "\n  UNION ALL ".join(unions)
    return f"""WITH {derived_cte()},
segs AS ({body}),
fld AS (SELECT patientid, id, seg, occurrence, fields, unnest(generate_series(2, len(fields))) AS fi
        FROM segs WHERE fields IS NOT NULL),
rp AS (SELECT patientid, id, seg, occurrence, fi - 1 AS field, string_split(fields[fi], '~') AS reps FROM fld),
rp2 AS (SELECT *, unnest(generate_series(1, len(reps))) AS rep FROM rp),
cp AS (SELECT patientid, id, seg, occurrence, field, rep, string_split(reps[rep], '^') AS comps FROM rp2),
cp2 AS (SELECT *, unnest(generate_series(1, len(comps))) AS comp FROM cp)
SELECT patientid, id, seg, CAST(occurrence AS INTEGER) AS occurrence, CAST(field AS INTEGER) AS field,
       CAST(rep AS INTEGER) AS rep, CAST(comp AS INTEGER) AS comp, comps[comp] AS value
FROM cp2 WHERE trim(comps[comp]) <> ''"""


def q_archive() -> str:
    ts = _updated_ts()
    return f"""WITH {derived_cte(dedupe=False)}
SELECT id, CAST(year({ts}) AS INTEGER) AS y, CAST(month({ts}) AS INTEGER) AS m,
       CAST(day({ts}) AS INTEGER) AS d, strftime({ts}, '%Y/%-m/%-d') AS prefix
FROM env"""


INFERRED_COLUMNS = tuple(c.lower() for c in ENV_COLS)


def q_declared_schema() -> str:
    """Dedupe happens on the 11 declared columns only (the reader drops the rest)."""
    states = ", ".join(f"'{s}'" for s in layout.STATES)
    cols = "patientid, tenantid, dob, id, updatedat, createdat, visitnumber, msh, evn, pid, pv1"
    return (f"WITH {derived_cte(dedupe=False)},\nenv11 AS (SELECT DISTINCT {cols} FROM env),\n"
            f"{split_cte(source='env11', present=DECLARED_SEGMENTS)},\nwide AS ({wide_select()})\n"
            f"SELECT * FROM wide WHERE pt_address_state_prov IN ({states})")


def q_inferred() -> str:
    return f"WITH {derived_cte()}\nSELECT DISTINCT {', '.join(INFERRED_COLUMNS)} FROM env"


def queries() -> dict[str, str]:
    return {
        "adt_flatten": q_flatten(),
        "adt_state_filter": q_state_filter(),
        "adt_envelope_dedupe": q_dedupe(),
        "adt_digest_dedupe": q_dedupe(),
        "adt_segment_long": q_long(),
        "adt_ignore_lists": q_ignore_lists(),
        "adt_last_repetition": q_last_repetition(),
        "adt_numbered_repetitions": q_numbered(),
        "adt_full_messages": q_full_messages(),
        "adt_numbered_extras": q_numbered_extras(),
        "adt_extras": q_extras(),
        "adt_extras_map": q_extras(),
        "adt_observed_wide": q_observed_wide(),
        "adt_truncate_names": q_truncate_names(),
        "adt_document_scan": q_document_scan(),
        "adt_document_store": q_document_scan(),
        "adt_json_variant": q_inferred(),
        "adt_observed_append": q_observed_wide(),
        "adt_dead_letter": q_dead_letter(),
        "adt_dead_letter_good": q_dead_letter_good(),
        "adt_dead_letter_replay": q_dead_letter_replay(),
        "adt_stream_dead_letter": q_stream_dead_letter(),
        "adt_latest_patient": q_latest_patient(),
        "adt_latest_stream_dead_letter": q_latest_stream_dead_letter(),
        "adt_patient_merge": q_latest_patient(),
        "adt_append_once": q_append_once(),
        "adt_new_referrals": q_new_referrals(),
        "adt_known_patients": q_known_patients(),
        "adt_feed_count": q_feed_count_full(),
        "adt_schema_evolution": q_schema_evolution(),
        "adt_stream_flatten": q_state_filter(),
        "adt_stream_latest": q_latest_patient(),
        "adt_json_scan": q_dedupe(),
        "adt_json_inferred": q_inferred(),
        "adt_json_documents": q_dedupe(),
        "adt_catchup_segments": q_catchup_segments(),
        "adt_catchup_ranges": q_dedupe(),
        "adt_catchup_range_segments": q_catchup_segments(),
        "adt_feed_tables": q_feed_tables(),
        "adt_evolving_append": q_schema_evolution(),
        "adt_archive_written": q_archive_written(),
        "adt_archive_compacted": q_archive_written(),
        "adt_empty_result": q_empty_result(),
        "adt_declared_schema": q_declared_schema(),
        "adt_message_table": q_dedupe(),
        "adt_catchup_blob": q_dedupe(),
        "adt_archive_prefix": q_archive(),
        "adt_state_filter_sql": q_state_filter(),
    }
