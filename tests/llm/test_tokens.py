"""Token counts and BPE against the libraries of the files."""

import hashlib
import random

import numpy as np
import pytest

from segflow.llm import token_counts as counts
from segflow.llm.bpe_automaton import TokenizationAutomaton, encode_decode, word_bpe
from segflow.llm.queries import PIECE_MODEL, WORD_MODEL, tokenizer_path
from segflow.llm.token_counts import token_counts

from .data import EDGES, corpus, frame, long_text

TEXTS = [t or "" for _, t in EDGES]


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_MODEL))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(WORD_MODEL))


def test_counts(spark, pieces):
    rows = EDGES + corpus(n=30)
    got = token_counts(frame(spark, rows), tokenizer_path(PIECE_MODEL), limit=50).collect()
    want = sorted((len((t or "").encode()), len(pieces.encode(t or ""))) for _, t in rows)
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 50) for r in got)
    assert token_counts(frame(spark, []), tokenizer_path(PIECE_MODEL)).count() == 0


def test_pieces_join_to_the_text_and_the_count(pieces):
    rnd = random.Random(2)
    for _ in range(200):
        text = "".join(rnd.choice("abc  é▁\n.1") for _ in range(rnd.randint(0, 300)))
        cut = counts.safe_pieces(text, 20)
        assert " ".join(cut) == text
        assert sum(len(x) for x in pieces.encode(cut)) == len(pieces.encode(text))


def test_automaton_small_merges():
    """Every string over a small alphabet, against merging by rank."""
    base = ["a", "b", "a</w>", "b</w>"]
    merges = [("a", "a"), ("a", "b"), ("aa", "b</w>"), ("ab", "ab"), ("b", "a</w>"), ("aa", "aa"), ("a", "ab")]
    vocab = {s: i for i, s in enumerate(dict.fromkeys(base + [x + y for x, y in merges]))}
    rank = {m: i for i, m in enumerate(merges)}
    auto = TokenizationAutomaton(vocab, merges)
    for n in range(1, 11):
        for bits in range(2**n):
            s = "".join("ab"[bits >> k & 1] for k in range(n))
            w = [*s[:-1], s[-1] + "</w>"]
            while True:
                best = min((rank.get(p, 99), k) for k, p in enumerate(zip(w, w[1:]))) if len(w) > 1 else (99, 0)
                if best[0] == 99:
                    break
                k = best[1]
                w[k:k + 2] = [w[k] + w[k + 1]]
            assert [auto.label[i] for i in auto.encode_word(s)] == w


def test_bpe_equals_library(library):
    bpe = word_bpe(tokenizer_path(WORD_MODEL))
    rnd = random.Random(4)
    alphabet = "aabeehinorstt  S'’.,!?-019ÉéßΣςİ\t\n\x0b\x1c\x85\xa0 ​你🙂́Ᲊ՘_<|>"
    texts = TEXTS + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    texts += ["don't we'll I'VE <|endoftext|>x<|startoftext|>", "aaaaaaaaaaa oooooooooo", long_text(500)]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert bpe.encode(t) == ids
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_rows(spark, library):
    got = encode_decode(frame(spark, EDGES), tokenizer_path(WORD_MODEL), with_ids=True, with_text=True).collect()
    assert len(got) == len(EDGES)
    want = sorted(hashlib.sha256(np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()
                  for t in TEXTS)
    assert sorted(r.ids_sha256 for r in got) == want
    for r in got:
        assert r.n_tokens == len(r.ids) and r.decoded == library.decode(r.ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert encode_decode(frame(spark, []), tokenizer_path(WORD_MODEL)).count() == 0


def explicit_arcs(vocab, merges):
    """The automaton built state by state: each state's set of arcs, by label."""
    base = [s for s in vocab if len(s.removesuffix("</w>")) == 1]
    arcs = {s: set(base) for s in base if not s.endswith("</w>")} | {"": set(base)}
    for u, v in merges:
        if u not in arcs or v not in arcs[u]:
            continue
        w = u + v
        if not w.endswith("</w>"):
            arcs[w] = set(arcs[v])          # leads where v-arcs led, before the cut below
        arcs[u] = arcs[u] - {v}             # the copy that u alone leads to loses its v-arc
        for state in arcs:
            if u in arcs[state]:
                arcs[state].add(w)
    return arcs


def test_arcs_equal_an_explicit_automaton():
    """States and arcs of random merge lists, not only the encodings."""
    rnd = random.Random(6)
    for _ in range(60):
        inner = ["a", "b", "c"][: rnd.randint(1, 3)]
        known, merges = [*inner, *[x + "</w>" for x in inner]], []
        for _ in range(rnd.randint(1, 14)):
            u, v = rnd.choice([x for x in known if not x.endswith("</w>")]), rnd.choice(known)
            if u + v not in known and len(u + v) < 30:
                merges.append((u, v))
                known.append(u + v)
        vocab = {s: i for i, s in enumerate(known)}
        auto, arcs = TokenizationAutomaton(vocab, merges), explicit_arcs(vocab, merges)
        live = {*auto.inner, *(f"{x}</w>" for x in auto.final)}
        assert live == {x for state in arcs.values() for x in state} | (set(arcs) - {""})
        for t in auto.inner:
            assert {x for x in live if auto.step(vocab[t], vocab[x])} == arcs[t], (merges, t)


def test_groups_are_balanced_by_bytes(monkeypatch):
    seen = []

    class Fake:
        def encode(self, group, num_threads):
            seen.append([len(x.encode()) for x in group])
            return [x.split() for x in group]

    monkeypatch.setattr(counts, "_model", lambda path: (Fake(), True))
    values = ["\u65e5" * 30_000, "a" * 30_000, "b c"] * 12
    got = counts.count_tokens(values, [len(v.encode()) for v in values], "x")
    assert got == [len(v.split()) for v in values]
    assert all(counts.GROUP_BYTES <= sum(x) < counts.GROUP_BYTES + 90_001 for x in seen[:-1]) and len(seen) > 2
