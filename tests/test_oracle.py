"""Spark vs DuckDB on the driver tables (sf0.001), and a parse-free oracle
that computes expected values straight from `orders`/`customer`."""

import hashlib
import json

import duckdb
import pytest

import __spark_entry__ as E
from segflow.operators import extract
from tests.conftest import SF001

TABLES = ("orders", "customer")
FAST = ["adt_flatten", "adt_state_filter", "adt_envelope_dedupe", "adt_segment_long",
        "adt_ignore_lists", "adt_numbered_repetitions", "adt_extras", "adt_latest_patient",
        "adt_new_referrals", "adt_dead_letter", "adt_catchup_blob", "adt_document_scan",
        "adt_full_messages", "adt_numbered_extras", "adt_dead_letter_good", "adt_stream_dead_letter",
        "adt_catchup_segments", "adt_json_documents", "adt_feed_tables", "adt_evolving_append",
        "adt_archive_written", "adt_empty_result", "adt_observed_wide", "adt_extras_map",
        "adt_patient_merge", "adt_append_once", "adt_latest_stream_dead_letter", "adt_dead_letter_replay",
        "adt_digest_dedupe", "adt_catchup_ranges", "adt_catchup_range_segments"]


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    hs = sorted(hashlib.sha1(json.dumps([None if r[i] is None else str(r[i]) for i in order])
                             .encode()).hexdigest() for r in rows)
    return hashlib.sha1("".join(hs).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    from segflow.plans.queries import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)


def test_parse_free_oracle(spark):
    """Expected values from the order/customer columns, no splitting at all (full
    messages have their own oracle, for every column)."""
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    expect = orders.join(cust, orders.o_custkey == cust.c_custkey).where("o_orderkey % 10 <> 4").selectExpr(
        "CAST(o_orderkey AS STRING) AS id",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS visit",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS poc",
        "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE c_name END AS last",
        "CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex",
        "CASE WHEN o_orderkey % 97 = 0 THEN NULL "
        "     ELSE coalesce(CASE c_nationkey % 6 WHEN 0 THEN 'CA' WHEN 1 THEN 'OR' WHEN 2 THEN 'WA' "
        "          WHEN 3 THEN 'NY' WHEN 4 THEN 'UT' END, "
        "          CASE WHEN o_orderkey % 11 = 0 THEN 'NV' END) END AS state")
    plain = E.queries()["adt_envelope_dedupe"](spark, SF001).where("CAST(id AS BIGINT) % 10 <> 4")
    got = extract.flatten_wide(plain, keep=("id",)).selectExpr(
        "id", "pt_visit_number AS visit", "pt_loc_poc_1 AS poc", "pt_last_name AS last",
        "pt_gender AS sex", "pt_address_state_prov AS state")
    assert got.count() == expect.count()
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0


def test_every_mapped_column_holds_a_value(spark):
    from pyspark.sql import functions as F

    from segflow import layout

    wide = E.queries()["adt_flatten"](spark, SF001)
    names = [c.name for c in layout.wide_columns()]
    seen = wide.agg(*[F.count(F.col(n)).alias(n) for n in names]).first()
    assert len(names) == 170 and [n for n in names if not seen[n]] == []


def test_layout_equals_the_oracles_places():
    from segflow import layout
    from segflow.plans.places import IGNORED_FIELDS, IGNORED_PLACES, PLACES

    rules = layout.ignore_rules()
    assert {c.name: f"{c.pos.segment}-{c.pos.field}.{c.pos.component}" for c in layout.wide_columns()} == PLACES
    assert {f"{s}_{f}" for s, f in rules.seg_fields} == set(IGNORED_FIELDS)
    assert all(rules.drops(*[int(x) if x.isdigit() else x for x in k.split("_")]) for k in IGNORED_PLACES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "pt_address_state_prov" in df.columns
