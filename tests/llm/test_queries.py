"""Registered queries on the smallest tables: oracles, contracts, held-out accuracy."""

import os
import sys

import duckdb
import pytest

from segflow.llm import oracle, queries

from . import brute

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_oracle(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    want = duck.sql(oracle.ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = sorted(map(str, (tuple(r) for r in got.select(*want.columns).collect())))
    assert rows == sorted(map(str, want.fetchall()))


def test_whole_tables(spark, duck):
    docs = duck.sql("select doc_id, text from documents").fetchall()
    assert {r.doc_id: r.component_id for r in queries.op6_minhash_near_dedup(spark, SF).collect()} == brute.near(docs, 85)
    assert sorted(tuple(r) for r in queries.op3_substring_dedup(spark, SF).collect()) == sorted(brute.strip_repeats(docs))
    scan = {r.doc_id: r.base_sha256 for r in queries.op1_secret_scans(spark, SF).collect()}
    assert scan == {i: brute.sha(",".join(brute.base_spans(t))) for i, t in docs}
    items = duck.sql("select item_id, text from benchmark").fetchall()
    found = {r.doc_id: set(map(int, r["items"].split(","))) for r in queries.op7_benchmark_decontamination(spark, SF).collect()}
    assert found == brute.contaminated(docs, items)


@pytest.mark.parametrize("name, column, least", [("op4_quality_classifier", "quality", 0.9), ("op8_toxicity", "toxic", 0.85)])
def test_held_out(spark, name, column, least):
    """Accuracy on the fold that was left out, on tables with enough labels."""
    sf = "/root/testdata/sf0.01"
    truth = dict(duckdb.sql(f"select doc_id, {column} from '{sf}/labels.parquet'").fetchall())
    rows = queries.QUERIES[name](spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert held and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) >= least
