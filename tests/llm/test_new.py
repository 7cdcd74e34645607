"""Fill-in-middle, line dedup and lexical search against plain versions."""

import ast
import hashlib
import math
import os
import random
import tempfile
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from segflow.llm import fill_middle, lexical_search, line_dedup
from segflow.llm.queries import op11_fill_in_middle, op12_line_dedup, op13_lexical_search

from . import brute, data

SF = "/root/testdata/sf0.001"
SENTINELS = [(20, "has <P> inside"), (21, "<S>"), (22, "tail <M>"), (23, "<P<S<M"), (24, "é"), (25, "\U0001f642"),
             (26, "ab<"), (27, ">P<" * 9), (28, "日本語" * 3001), (29, "a")]


def fim(i, text):
    t = text or ""
    d = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(d[8 * k: 8 * k + 8], 16) for k in range(4)]
    n = len(t)
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, n, "plain", None, None, t
    a, z = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    form = "spm" if h[3] % 100 < 20 else "psm"
    p, m, s = t[:a], t[a:z], t[z:]
    return i, n, form, a, z - a, f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


def fim_rows(df):
    return sorted(map(str, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in df.collect())))


def test_fill_in_middle(spark):
    rows = data.EDGES + SENTINELS + data.corpus(n=80)
    made = fill_middle.fill_in_middle(data.frame(spark, rows))
    assert fim_rows(made) == sorted(str(fim(i, t)) for i, t in rows)
    back = made.select(fill_middle.restore(F.col("output"), F.col("form")).alias("t")).collect()
    assert sorted(r.t for r in back) == sorted(t or "" for _, t in rows)
    assert {"psm", "spm", "plain"} == {r.form for r in made.collect()}
    assert fill_middle.fill_in_middle(data.frame(spark, [])).count() == 0
    kept = fill_middle.fill_in_middle(data.frame(spark, rows), plain_percent=100)
    assert {r.form for r in kept.collect()} == {"plain"}


def test_units_rank_and_select():
    rnd = random.Random(3)
    for size in (0, 1, 2, 7, 8, 9, 500):
        text = "".join(rnd.choice("aé日\U0001f642\x00 ") for _ in range(size))
        raw = np.frombuffer(text.encode(), np.uint8)
        units = fill_middle.Units(raw)
        ends = np.cumsum([0] + [len(c.encode()) for c in text])
        assert units.select(np.arange(size + 1)).tolist() == ends.tolist()
        assert units.rank(ends).tolist() == list(range(size + 1))


def lines(rows, least):
    seen = defaultdict(int)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(brute.LOWER)
    for _, t in rows:
        for k in {key(x) for x in (t or "").split("\n")} - {""}:
            seen[k] += 1
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        keep = [x for x in own if seen[key(x)] < least]
        out.append((i, len(own), len(own) - len(keep), "\n".join(keep)))
    return sorted(map(str, out))


def line_rows(seed, n=60, first_id=0):
    rnd = random.Random(seed)
    common = ["Shared line", "  shared LINE\t", "MIT License", "é É", "", " ", "x" * 3000]
    return [(first_id + i, "\n".join(rnd.choice(common) if rnd.random() < 0.3 else f"own {rnd.randrange(200)}"
                                     for _ in range(rnd.randint(1, 12)))) for i in range(n)]


def got_lines(df):
    return sorted(map(str, ((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect())))


@pytest.mark.parametrize("filter_bytes", [line_dedup.FILTER_BYTES, 0])
def test_line_dedup(spark, filter_bytes):
    rows = line_rows(1) + data.EDGES + [(7000 + i, "\n".join(["one"] * 400)) for i in range(12)]
    df = data.frame(spark, rows)
    for least in (1, 3, 10):
        assert got_lines(line_dedup.line_dedup(df, least, filter_bytes=filter_bytes)) == lines(rows, least)
    assert line_dedup.line_dedup(data.frame(spark, []), filter_bytes=filter_bytes).count() == 0


def state_rows(state):
    return (sorted(map(tuple, state.counts.collect())),
            {r.shard: Counter(np.frombuffer(bytes(r.slots), np.uint32).tolist()) for r in state.filters.collect()
             if any(bytes(r.slots))})


def test_line_store_is_reversible(spark):
    first, more = line_rows(2, 40), line_rows(3, 40, first_id=100)
    a, b = data.frame(spark, first), data.frame(spark, more)
    store = line_dedup.LineStore(spark, os.path.join(tempfile.mkdtemp(prefix="segflow-lines-"), "s"), min_docs=5)
    assert got_lines(store.strip(a)) == lines(first, 10 ** 6)          # an empty store drops nothing
    assert store.insert("a", a) and not store.insert("a", a)            # a batch counts once
    before = state_rows(store.state())
    assert got_lines(store.strip(a)) == lines(first, 5)
    assert store.insert("b", b)
    want = [r for r in lines(first + more, 5) if r in set(got_lines(store.strip(b)))]
    assert len(want) == len(more) and state_rows(store.state()) != before
    assert got_lines(store.strip(b, filter_bytes=0)) == got_lines(store.strip(b))
    assert store.delete("b", b) and not store.delete("b", b)
    assert state_rows(store.state()) == before and got_lines(store.strip(a)) == lines(first, 5)
    with pytest.raises(Exception, match="never added"):
        store.delete("c", b)
    assert state_rows(store.state()) == before                          # a failed update leaves no trace
    assert store.delete("a", a) and store.state().counts.count() == 0


def test_cuckoo_filter():
    rnd = np.random.default_rng(0)
    keys = rnd.integers(0, 1 << 63, (5000, 2), dtype=np.uint64)
    made = line_dedup.Cuckoo.of(keys)
    assert made.contains(keys).all()
    others = rnd.integers(0, 1 << 63, (20_000, 2), dtype=np.uint64)
    assert made.contains(others).sum() <= 2
    for place in made.each(keys[:2500]):
        assert made.delete(*place)
    assert made.contains(keys[2500:]).all() and made.contains(keys[:2500]).sum() <= 2
    for place in made.each(keys[2500:]):
        assert made.delete(*place)
    assert not made.slots.any() and not made.delete(0, 7)


def test_filter_mistakes_are_exceptions(spark):
    """Keys that differ only where the filter does not look are told apart."""
    low = [(5 << 40, (9 << 32) + i, 1 if i else 20) for i in range(4)]
    keys = spark.createDataFrame(low, "h1 long, h2 long, n long").withColumn("was", F.lit(0).cast("long"))
    rows = line_dedup._refresh(None, keys, 8, 10).collect()
    assert sum(len(r.exceptions) for r in rows) == 16 * 3
    found = line_dedup.Repeated(rows, 8)([np.array([a, b], np.int64).tobytes() for a, b, _ in low])
    assert found.tolist() == [True, False, False, False]


TERM = brute.re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def search(rows, items, top):
    docs = [(i, TERM.findall((t or "").translate(brute.LOWER))) for i, t in rows]
    n_docs, n_terms = sum(bool(w) for _, w in docs), sum(len(w) for _, w in docs)
    df = Counter(t for _, w in docs for t in set(w))
    out = []
    for item, text in sorted(set((i, t or "") for i, t in items)):
        asked = set(TERM.findall(text.translate(brute.LOWER)))
        ranked = []
        for i, w in docs:
            tf = Counter(x for x in w if x in asked)
            m = 50 + (50 * len(w) * n_docs) // n_terms if n_terms else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c) // (1000 * c + 20 * m))
                        for t, c in tf.items())
            if score > 0 and i is not None:
                ranked.append((-score, i))
        out += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def item_frame(spark, items):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, rank string, salt string")


@pytest.mark.parametrize("options", [{}, {"tree_postings": 60}, {"block_items": 2}])
def test_lexical_search(spark, options):
    rows = data.EDGES + data.corpus(n=150)
    rnd = random.Random(9)
    vocabulary = sorted({w for _, t in rows for w in (t or "").split()[:40]})
    items = [(k, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 30)))) for k in range(8)]
    items += [(90, None), (91, ""), (92, "nowhereatall"), (93, "a a a B"), (93, "c"), (93, "c"), (94, "é 你好 ü1")]
    want = search(rows, items, 7)
    got = lexical_search.lexical_search(data.frame(spark, rows).repartition(3), item_frame(spark, items), top=7, **options)
    assert sorted(map(tuple, got.collect())) == want


def test_lexical_search_empty(spark):
    docs, items = data.frame(spark, data.EDGES), item_frame(spark, [(1, "one two")])
    assert lexical_search.lexical_search(data.frame(spark, []), items).count() == 0
    assert lexical_search.lexical_search(docs, item_frame(spark, [])).count() == 0
    assert lexical_search.lexical_search(data.frame(spark, [(1, None), (2, "-- ..")]), items).count() == 0


def test_bounds_leave_documents_out():
    """Equal scores rank by id, copies share one path, and a search scores few documents."""
    rnd = random.Random(1)
    n, ranks = 3000, 400
    vectors = [sorted({min(ranks - 1, int(rnd.expovariate(1 / 60))) for _ in range(rnd.randint(1, 25))}) for _ in range(n - 500)]
    vectors += [vectors[0]] * 500
    sizes = np.array([len(v) for v in vectors])
    flat = np.array([x for v in vectors for x in v], np.int32)
    tf = np.array([1 + x % 3 for x in range(len(flat) - 500 * len(vectors[0]))] + [1 + x % 3 for x in range(len(vectors[0]))] * 500)
    m = np.array([rnd.randint(50, 300) for _ in range(n - 500)] + [77] * 500)
    tree = lexical_search.Tree(np.arange(n)[::-1].copy(), m, sizes, flat, tf, ranks)
    assert len(tree.node_tf) < len(flat) - 499 * len(vectors[0])
    scored = []
    plain = tree.scores
    tree.scores = lambda docs, weight: scored.append(len(docs)) or plain(docs, weight)
    for asked in (np.array([3, 40, 90, 200]), np.array([0]), np.array(vectors[0])):
        weights = 9000 - 20 * asked.astype(np.int64)
        weight = np.zeros(ranks, np.int64)
        weight[asked] = weights
        best = lexical_search.Best(10)
        scored.clear()
        tree.search(asked, weights, weight, best)
        every = plain(np.arange(n), weight)
        order = np.lexsort((tree.doc_id, -every))[:10]
        order = order[every[order] > 0]
        assert best.doc_id.tolist() == tree.doc_id[order].tolist() and best.score.tolist() == every[order].tolist()
        assert sum(scored) < n


def test_queries_read_whole_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(tuple(r) for r in op11_fill_in_middle(spark, SF).collect()) == sorted(
        (*fim(i, t)[:5], sha(fim(i, t)[5]), sha(t or "")) for i, t in docs)
    assert sorted(r.kept_sha256 for r in op12_line_dedup(spark, SF).collect()) == sorted(
        sha(ast.literal_eval(r)[3]) for r in lines(docs, 10))
    assert sorted(map(tuple, op13_lexical_search(spark, SF).collect())) == search(docs, items, 50)
