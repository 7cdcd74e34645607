"""Exact, near and substring dedup against plain versions."""

import random

import pytest

from segflow.llm import near_dedup as near_module
from segflow.llm.components import components
from segflow.llm.exact_dedup import exact_dedup
from segflow.llm.near_dedup import near_dedup
from segflow.llm.substring_dedup import substring_dedup

from . import brute
from .data import EDGES, corpus, frame


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_edges(spark, keep):
    rows = EDGES + [(20, "tie"), (21, "tie"), (19, "tie"), (22, "Tie")]
    got = exact_dedup(frame(spark, rows), keep=keep).collect()
    want = brute.exact(rows, keep)
    assert sorted(map(key, (tuple(r) for r in got))) == sorted(map(key, want))


def test_exact_one_group_and_none(spark):
    got = exact_dedup(frame(spark, [(i, "hot") for i in range(50)]), keep="max").collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(49, 50)} and sum(r.kept for r in got) == 1
    assert exact_dedup(frame(spark, [])).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_near_equals_all_pairs(spark, percent):
    rows = corpus(seed=percent)
    ids = dict(rows)
    rows = list(ids.items())
    want = brute.near(rows, percent)
    got = {r.doc_id: r for r in near_dedup(frame(spark, rows), percent, bands=30, rows=4).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(got[i].n_shingles == len(brute.shingles(t)) for i, t in rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_edges(spark):
    got = near_dedup(frame(spark, EDGES), 85).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(EDGES)
    assert [by_id[i].n_shingles for i in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 1]
    assert by_id[8].component_id == by_id[7].component_id == 6 and not by_id[7].kept
    assert by_id[1].component_id == 1 and by_id[2].component_id == 2 and by_id[1].kept
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert near_dedup(frame(spark, []), 85).count() == 0


def test_near_chain_behind_the_pivot(spark):
    """Members linked to each other but to no pivot are still joined."""
    base = [f"w{i}" for i in range(200)]

    def edited(*at):
        w = list(base)
        for k in at:
            w[k] = f"e{k}"
        return " ".join(w)

    far = list(range(3, 120, 12))
    rows = [(1, edited()), (2, edited(100)), (3, edited(50)), (10, edited(*far)), (11, edited(*far, 199)), (12, edited(*far, 0))]
    want = brute.near(rows, 85)
    got = {r.doc_id: r.component_id for r in near_dedup(frame(spark, rows), 85).collect()}
    assert got == want and want[11] == want[12] == 10


def test_superminhash_estimates_jaccard():
    import numpy as np

    rnd = np.random.default_rng(0)
    both = rnd.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(both[:2000]), np.unique(both[500:2500])
    sig = near_module.super_minhash([a, b, a[:7], np.zeros(0, np.uint64)], 120)
    assert abs((sig[0] == sig[1]).mean() - 1500 / 2500) < 0.15
    assert (sig[3] == 0xFFFFFFFF).all() and (sig[2] != 0xFFFFFFFF).all()
    again = near_module.super_minhash([a], 120)
    assert (again[0] == sig[0]).all()


def test_components_path_and_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (5, 4)]
    got = {r.id: r.label for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(60))


@pytest.mark.parametrize("rows", [EDGES, corpus(seed=3, n=120), []], ids=["edges", "corpus", "empty"])
def test_substring(spark, rows):
    got = substring_dedup(frame(spark, rows)).collect()
    want = brute.strip_repeats(rows)
    assert sorted(map(key, (tuple(r) for r in got))) == sorted(map(key, want))


def test_substring_every_shift(spark):
    """A passage of exactly 13 words is found at all offsets modulo the period."""
    shared = [f"s{i}" for i in range(13)]
    rows = [(1, " ".join(shared))]
    for a in range(8):
        rows.append((10 + a, " ".join([f"x{a}_{i}" for i in range(a)] + shared + [f"z{a}"])))
    got = {r.doc_id: r.n_removed for r in substring_dedup(frame(spark, rows)).collect()}
    assert got[1] == 0 and all(got[10 + a] == 13 for a in range(8))


def test_substring_repeats_inside_one_document(spark):
    rows = [(5, "a b " * 60), (3, "a b " * 9), (9, "x " + "a b " * 40 + "y"), (1, "c " * 20), (2, "c " * 13)]
    got = substring_dedup(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute.strip_repeats(rows))


def test_substring_text(spark):
    rows = [(1, "a b c d e f g h i j k l m"), (2, "pre a b c d e f g h i j k l m post")]
    got = {r.doc_id: r.kept_text for r in substring_dedup(frame(spark, rows), with_text=True).collect()}
    assert got[2] == "pre post"


def test_substring_of_one_id_on_two_texts(spark):
    shared = [f"s{k}" for k in range(30)]
    lone, short = [f"l{k}" for k in range(60)], [f"t{k}" for k in range(15)]
    rows = [(1, " ".join(shared)), (2, " ".join(lone[:25] + shared + lone[25:])), (2, " ".join(short)),
            (2, " ".join(lone)), (2, " ".join(short + shared[:14])), (2, " ".join(shared)), (2, " ".join(shared)),
            (3, " ".join(short + short)), (3, " ".join(lone[:13]) + " x " + " ".join(lone[:13]))]
    got = substring_dedup(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.strip_repeats(rows))


def family(n, seed=1, words=200, changes=2):
    """Texts of one template with a few words changed: near the threshold, linked by chains."""
    rnd = random.Random(seed)
    template = [f"w{k}" for k in range(words)]
    rows = []
    for i in range(n):
        w = list(template)
        for k in rnd.sample(range(words), changes):
            w[k] = f"x{rnd.randrange(10 ** 9)}"
        rows.append((i, " ".join(w)))
    return rows


def test_pairs_of_a_template_family_grow_linearly(spark, monkeypatch):
    from segflow.llm import near_dedup as module

    tried, plain = [], module._verified

    def counting(pairs, sets, percent):
        tried.append(pairs.count())
        return plain(pairs, sets, percent)

    monkeypatch.setattr(module, "_verified", counting)
    sums = {}
    for n in (100, 400):
        tried.clear()
        rows = family(n)
        got = {r.doc_id: r.component_id for r in module.near_dedup(frame(spark, rows), percent=85).collect()}
        assert got == brute.near(rows, 85)
        sums[n] = sum(tried)
    # All pairs would be 16 times as many; buckets fill up as the family grows, so
    # small ones have fewer pairs a text (386 and 2,539 measured).
    assert sums[400] < 8 * sums[100] and sums[400] < 10 * 400, sums


def test_open_pairs_in_blocks(spark, monkeypatch):
    """The exact search alone, its frequent shingles in blocks of a few rows."""
    from segflow.llm import near_dedup as module

    monkeypatch.setattr(module, "BLOCK", 3)
    monkeypatch.setattr(module, "STALLED", 0)           # no round at all
    rows = family(40, seed=5, changes=3) + [(100 + i, t.replace("w1", "y1")) for i, t in family(25, seed=6)]
    got = {r.doc_id: r.component_id for r in module.near_dedup(frame(spark, rows), percent=85).collect()}
    assert got == brute.near(rows, 85)
