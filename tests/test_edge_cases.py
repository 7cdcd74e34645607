"""Inline edge cases for the extraction expressions (FIXTURES §4)."""

from pyspark.sql import Row

from segflow.functions import hl7
from segflow.operators import extract, filters, shape
from segflow.sources.envelope import ENVELOPE


def _env(spark, **segs):
    base = {f.name.lower(): None for f in ENVELOPE.fields}
    base.update({"patientid": "p1", "dob": "2000-01-01", "id": "1"})
    base.update({k.lower(): v for k, v in segs.items()})
    cols = list(base)
    return spark.createDataFrame([tuple(base[c] for c in cols)], ", ".join(f"{c} string" for c in cols))


def _one(spark, **segs):
    return extract.flatten_wide(_env(spark, **segs), extras=True).collect()[0]


def test_repeated_location_last_nonblank(spark):
    fields = [""] * 45
    fields[2], fields[3], fields[17], fields[19], fields[44] = "E", "W1 ~W2~~  ~W4^^^", " ", "31007", "201901020304"
    r = _one(spark, PV1="PV1|" + "|".join(fields[1:]))
    assert r.pt_loc_poc_1 == "W4"
    assert r.pt_class == "E"
    assert r.pt_admitting_doc_id_num is None       # PV1-17 is a single space
    assert r.pt_admit_date_1 == "201901020304"
    assert r.pt_visit_number == "31007"


def test_insurance_address_positional(spark):
    r = _one(spark, IN1="IN1|1|GOLD||SEASIDE MUTUAL|BOX 5^FLOOR 2^SANDPORT^OR^97001|||G-7")
    assert r.pt_insurance_company_add_street == "BOX 5"
    assert r.pt_insurance_company_add_city == "SANDPORT"
    assert r.pt_insurance_company_add_state_prov == "OR"
    assert r.extras["in1_5_2"] == "FLOOR 2"         # XAD .2 is not mapped: kept as extra
    assert r.pt_insurance_plan_id == "GOLD"


def test_null_empty_and_id_only_segments(spark):
    for pid in (None, "", "PID"):
        r = _one(spark, PID=pid)
        assert r.pt_last_name is None and r.patientid == "p1"


def test_foreign_segment_text_contributes_nothing(spark):
    r = _one(spark, PID="PV1|||X^Y")
    assert r.pt_id_4 is None and r.pt_last_name is None


def test_blank_last_repetition_keeps_earlier(spark):
    r = _one(spark, PID="PID|1||||A^B||||||1 RD^^C^NV^1~2 RD^^D^^2")
    assert r.pt_address_state_prov == "NV"
    assert r.pt_address_st_1 == "2 RD"


def test_seg_field_ignore_is_exact(spark):
    # PID-1 ignored, PID-10 kept; PID-12 ignored whole (even unmapped).
    r = _one(spark, PID="PID|1||||||||||||||||||||||||||||")
    assert r.extras == {}
    r = _one(spark, PID="PID|1|||||||||R1^RACE|||XX")
    assert r.pt_race_identifier == "R1" and r.pt_race_text == "RACE"
    assert "pid_12_1" not in r.extras and "pid_1_1" not in r.extras


def test_component_ignores(spark):
    # CX_4 / CX_5 on PID-3 and XTN_2/XTN_3 on PID-13 are dropped, PID-3.1 by name.
    r = _one(spark, PID="PID|1||A^B^C^D^E||||||||||555^PRN^PH^a@b.c")
    assert r.extras == {"pid_3_2": "B", "pid_3_3": "C"}
    assert r.pt_contact_phone_number_1 == "555" and r.pt_email == "a@b.c"


def test_unknown_segment_fields_go_to_extras(spark):
    r = _one(spark, NK1="NK1|1|KIN^ANN~KIN2^BOB|SPO")
    assert r.extras == {"nk1_1_1": "1", "nk1_2_1": "KIN2", "nk1_2_2": "BOB", "nk1_3_1": "SPO"}


def test_state_filter_is_exact(spark):
    rows = []
    for st in ("CA", "ca", "CA ", "NY", None):
        pid = None if st is None else f"PID|1||||||||||1 RD^^C^{st}^1"
        rows.append(_env(spark, PID=pid))
    df = rows[0]
    for r in rows[1:]:
        df = df.unionByName(r)
    kept = filters.keep_states(extract.flatten_wide(df)).collect()
    assert [r.pt_address_state_prov for r in kept] == ["CA"]


def test_regex_matches_hof_definition(spark):
    vals = ["168 ~219~C~PMA^^^^^^^^^", "a^b~c^  ~ ", " ", "", "x", "^y", "a~~", "  ~b^c",
            "a^b^c~d^^f", None, "e^ ~ f^g", "~~^z~"]
    df = spark.createDataFrame([Row(f=v) for v in vals], "f string")
    exprs = []
    for c in (1, 2, 3):
        exprs += [hl7.last_component("f", c).alias(f"r{c}"), hl7.last_component_hof("f", c).alias(f"h{c}")]
    for r in df.select(*exprs).collect():
        assert (r.r1, r.r2, r.r3) == (r.h1, r.h2, r.h3)


def test_truncate_names_cut_and_collision(spark):
    import pytest

    df = spark.createDataFrame([("x", "y")], f"{'a' * 64} string, b string")
    assert shape.truncate_names(df).columns == ["a" * 62, "b"]
    clash = spark.createDataFrame([("x", "y")], f"{'a' * 64} string, {'a' * 65} string")
    with pytest.raises(ValueError):
        shape.truncate_names(clash)


def test_rename_absent_is_noop(spark):
    df = spark.createDataFrame([("x",)], "pid_8_administrative_sex_is_none string")
    out = shape.rename_columns(df)
    assert out.columns == ["pt_gender"]
    assert shape.rename_columns(out).columns == ["pt_gender"]


def test_lower_case_names(spark):
    df = spark.createDataFrame([("x", "y")], "patientId string, PID string")
    assert shape.lower_case_names(df).columns == ["patientid", "pid"]
