"""Golden rows: two hand-made envelopes read from JSON files (one object per
file), flattened with the default layout."""

import json
import os

from segflow import layout
from segflow.operators import extract
from segflow.plans import etl
from segflow.sources.envelope import read_json_envelopes

HARBOR = {
    "patientId": "700100", "tenantId": "harbor", "dob": "1971-12-24", "id": 4401,
    "updatedAt": "2019-03-04 07:08:09", "createdAt": "2019-03-04 07:08:00", "visitNumber": 9917,
    "MSH": "MSH|^~&|HARBOR|HB^HBWEST|||20190304070809||ADT^A08|m-1|P|2.3",
    "EVN": "EVN|A08|20190304070809||MOVED|Q17^TIDE^MARLOW^^^^^^HB^^^^^HBW||HBWEST^5550001^NPI",
    "PID": "PID|1||88^^^^A~99^^^^B||TIDE^CORAL||19711224|F|||7 PIER LN^^SANDPORT^OR^97001^USA^H^^LAGOON",
    "PV1": "PV1|||DOCK^^^HBWEST^^^HBW^^LOWER DOCK||||||||||||||||9917"}

RIDGE = {
    "patientId": "700200", "tenantId": "ridge", "dob": "2002-02-02", "id": 4402,
    "updatedAt": "2020-10-11 12:13", "createdAt": "2020-10-11 12:13", "visitNumber": "15",
    "EVN": "EVN|A08|202010111213||ADMIT|R9^STONE^FLINT^^^^^^RG^^^^^RGN||RGNORTH^777^TAX",
    "PID": "PID|1||1^^^^A||STONE^AGATE||20020202|M|||1 CLIFF RD~22 CLIFF RD^^HIGHTON^ID^83201^USA^C^^CRAG",
    "PV1": "PV1|||PEAK^R5^B2^RGNORTH^^^RGN^^SUMMIT||||||||||||||||15"}

# Values by position; the names come from the layout.
EXPECTED = {
    "4401": {"evn-2.1": "20190304070809", "evn-4.1": "MOVED", "evn-5.1": "Q17", "evn-5.2": "TIDE", "evn-5.3": "MARLOW",
             "evn-5.9": "HB", "evn-5.14": "HBW", "evn-7.1": "HBWEST", "evn-7.2": "5550001", "evn-7.3": "NPI",
             "pid-5.1": "TIDE", "pid-5.2": "CORAL", "pid-7.1": "19711224", "pid-8.1": "F", "pid-11.1": "7 PIER LN",
             "pid-11.3": "SANDPORT", "pid-11.4": "OR", "pid-11.5": "97001", "pid-11.6": "USA", "pid-11.7": "H",
             "pid-11.9": "LAGOON", "pv1-3.1": "DOCK", "pv1-3.4": "HBWEST", "pv1-3.9": "LOWER DOCK", "pv1-19.1": "9917"},
    "4402": {"evn-2.1": "202010111213", "evn-4.1": "ADMIT", "evn-5.1": "R9", "evn-5.2": "STONE", "evn-5.3": "FLINT",
             "evn-5.9": "RG", "evn-5.14": "RGN", "evn-7.1": "RGNORTH", "evn-7.2": "777", "evn-7.3": "TAX",
             "pid-5.1": "STONE", "pid-5.2": "AGATE", "pid-7.1": "20020202", "pid-8.1": "M", "pid-11.1": "22 CLIFF RD",
             "pid-11.3": "HIGHTON", "pid-11.4": "ID", "pid-11.5": "83201", "pid-11.6": "USA", "pid-11.7": "C",
             "pid-11.9": "CRAG", "pv1-3.1": "PEAK", "pv1-3.2": "R5", "pv1-3.3": "B2", "pv1-3.4": "RGNORTH",
             "pv1-3.9": "SUMMIT", "pv1-19.1": "15"},
}


def _named(values):
    by_place = {f"{c.pos.segment}-{c.pos.field}.{c.pos.component}": c.name for c in layout.wide_columns()}
    return {by_place[k]: v for k, v in values.items()}


def _write(tmp_dir, msgs):
    for i, m in enumerate(msgs):
        with open(os.path.join(tmp_dir, f"pid_{i}.json"), "w") as fh:
            json.dump(m, fh, indent=2)  # one pretty-printed object per file
    return tmp_dir + "/*.json"


def test_golden_rows(spark, tmp_dir):
    env = read_json_envelopes(spark, _write(tmp_dir, [HARBOR, RIDGE]))
    wide = extract.flatten_wide(etl.prepared(env, dedupe=False), extras=True, keep=("patientid", "dob", "id"))
    rows = {r["id"]: r.asDict() for r in wide.collect()}
    for msg in (HARBOR, RIDGE):
        row = rows[str(msg["id"])]
        got = {k: v for k, v in row.items() if v is not None and k not in ("extras", "id", "patientid", "dob")}
        assert got == _named(EXPECTED[row["id"]])
        assert (row["patientid"], row["dob"], row["extras"]) == (msg["patientId"], msg["dob"], {})


def test_all_mapped_columns_are_there(spark, tmp_dir):
    wide = extract.flatten_wide(etl.prepared(read_json_envelopes(spark, _write(tmp_dir, [RIDGE]))))
    assert wide.columns == ["patientid", "dob", *[c.name for c in layout.wide_columns()]]


def test_dedupe_and_state_filter(spark, tmp_dir):
    away = RIDGE | {"id": 4403, "PID": RIDGE["PID"].replace("^ID^", "^NV^")}
    env = read_json_envelopes(spark, _write(tmp_dir, [HARBOR, HARBOR, RIDGE, away]))
    assert env.count() == 3
    assert etl.patient_rows(env).count() == 2


def test_inferred_types_are_text(spark, tmp_dir):
    env = read_json_envelopes(spark, _write(tmp_dir, [HARBOR, RIDGE]), schema=None)
    assert {t for _, t in env.dtypes} == {"string"}
    assert sorted(r.id for r in env.collect()) == ["4401", "4402"]
