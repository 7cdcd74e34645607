"""The pipeline against its stages applied one by one in plain Python."""

import duckdb

import corpus_pipeline
from segflow.llm.bpe_automaton import word_bpe
from segflow.llm.common import table
from segflow.llm.queries import WORD_MODEL, tokenizer_path, training_labels
from segflow.llm.toxicity import fit_toxicity

from . import brute
from .data import EDGES, frame

SF = "/root/testdata/sf0.001"


def test_run_equals_plain_stages(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model = fit_toxicity(docs, training_labels(spark, SF, "toxic", 3, 1))
    scores = model.scores(model.lexicon(), [t or "" for _, t in rows])
    rows = [r for r, s in zip(rows, scores) if s < 0.7]
    rows = [r for r, d in zip(rows, brute.exact(rows, "min")) if d[3]]
    group = brute.near(rows, 80)
    rows = [(i, t) for i, t in rows if group[i] == i]
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    leaked = brute.contaminated(rows, items)
    rows = [(i, t) for i, t in rows if i not in leaked]
    bpe = word_bpe(tokenizer_path(WORD_MODEL))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == {i for i, _ in rows}
    assert all(got[i]["ids"] == bpe.encode(t) for i, t in rows)


def test_stages_take_edge_cases(spark):
    for make in (EDGES, []):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = frame(spark, make)
            out = stage(spark, docs, SF)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns, name
            assert out.count() <= docs.count()


def test_five_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "bpe"]
