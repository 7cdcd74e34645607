"""Table-driven checks of the positional layout (no Spark)."""

from segflow import layout as L


def test_field_map_parses_every_name():
    cols = L.columns()
    assert len(cols) == 182
    assert len({c.name for c in cols}) == 182
    assert len({(c.pos.segment, c.pos.field) for c in cols}) == 107


def test_numbered_names():
    numbered = [c for c in L.columns() if c.pos.rep is not None]
    assert len(numbered) == 12
    dg1 = [c for c in numbered if c.pos.segment == "dg1"][0]
    assert (dg1.pos.field, dg1.pos.component, dg1.pos.rep) == (3, 3, 1)


def test_wide_columns_default_and_numbered():
    assert len(L.wide_columns()) == 170
    # pt_account_number_2 is ignored by name in numbered mode
    names = [c.name for c in L.wide_columns(numbered=True)]
    assert len(names) == 181 and "pt_account_number_2" not in names


def test_parse_raw_name_cases():
    p = L.parse_raw_name("pid_2_patient_id_cx_1_id_number")
    assert (p.segment, p.field, p.datatype, p.component, p.rep) == ("pid", 2, "cx", 1, None)
    p = L.parse_raw_name("pd1_4_patient_primary_care_provider_name_id_no_xcn_13_identifier_type_code")
    assert (p.datatype, p.component) == ("xcn", 13)
    p = L.parse_raw_name("al1_5_allergy_reaction_code_st_none_2")
    assert (p.datatype, p.component, p.rep) == ("st", 1, 2)
    p = L.parse_raw_name("in1_25_report_of_eligibility_flag_id_none")
    assert (p.datatype, p.component, p.rep) == ("id", 1, None)
    assert L.parse_raw_name("none_none_varies_1_none_1") is None


def test_ignore_rules():
    r = L.ignore_rules()
    assert r.drops("pid", 1, 1)                 # PID_1
    assert not r.drops("pid", 10, 1)            # PID_1 does not drop PID_10
    assert r.drops("pid", 3, 5)                 # CX_5 on a CX field
    assert r.drops("pid", 13, 2)                # XTN_2
    assert r.drops("pid", 3, 1)                 # full name, unnumbered
    assert r.drops("pv1", 3, 7)                 # full name, unnumbered
    assert not r.drops("pid", 3, 1, rep=2)      # numbered PID-3.1 #2 is kept
    assert r.drops("pid", 18, 1, rep=2)         # numbered name in the list
    assert r.drops("pid", 6, 3)                 # XPN_3 on PID-6 (type from the extra table)
    assert not r.drops("nk1", 2, 3)             # NK1 types unknown: cannot apply


def test_load_full_ignore_file_equivalent(tmp_path):
    # A full list in the one-name-per-line format gives the same wide layout.
    p = tmp_path / "names.txt"
    p.write_text("\n".join(L.DEFAULT_IGNORE_NAMES + ("gt1_10_guarantor_type_is_none_1",)) + "\n")
    r = L.ignore_rules(ignore_names=L.load_name_list(str(p)))
    assert [c.name for c in L.wide_columns(rules=r)] == [c.name for c in L.wide_columns()]


def test_truncated_name_and_table_name():
    assert L.truncated_name("a" * 63) == "a" * 63
    assert L.truncated_name("a" * 64) == "a" * 62
    # bytes decide whether to cut, characters how much to keep
    assert L.truncated_name("é" * 40) == "é" * 40
    assert L.truncated_name("é" + "a" * 70) == "é" + "a" * 61
    assert L.table_name("road-runner") == "v4_road_runner"
    assert L.table_name("acme", "v5") == "v5_acme"


def test_cluster_settings_scale():
    from segflow.session import cluster_settings, shuffle_blocks

    small = cluster_settings(10 << 20)
    big = cluster_settings(100 << 40)                   # 100 TB
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(big["spark.sql.shuffle.partitions"]) == 20_000
    # One bit a block of map status must fit a driver.
    assert shuffle_blocks(100 << 40, big) / 8 < 300 << 20


def test_no_private_folder_on_a_cluster():
    import pytest

    from segflow.session import require_local

    require_local("local[8]")
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            require_local(master)
