"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context.

1. The lexicon is mined from a bounded sample of labelled training rows: words,
   and stems (word beginnings), that stand in toxic documents and hardly in
   others.  Support is counted in distinct neighbourhoods (word before and
   after), so copies of one document do not vouch for its words.
   Support and clean counts are joined in Spark; every term that is precise enough
   is kept, of whatever length, so the labelled sample alone bounds the lexicon.
2. The lexicon is a trie.  Its product with the Levenshtein automaton of k edits
   (a letter more, less or other, or two neighbours swapped) is determinised while
   words are read: a state is the set of (trie node, edits so far), a transition is
   computed once and kept.  Each distinct word takes one walk and yields its term and
   distance.  Terms whose near misses also stand in clean training documents are
   matched exactly only; that alone decides for short terms too.
3. A term's evidence is its log-odds of standing in a toxic text.  Hits are told
   apart by a window of words around each: quotation marks and reporting verbs
   speak for quotation, other hits and second-person words for abuse.  A ridge
   logistic regression over the evidence by kind of hit, fitted on the same
   sample, gives the score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.llm.common import arrow_map, bounded_sample, cut, ship, texts

SAMPLE_ROWS = 20_000        # labelled training rows used at most
MIN_SUPPORT = 5             # distinct neighbourhoods of a term in toxic documents
MIN_PRECISION = 0.9
STEM_LENGTHS = (4, 5, 6, 7)
STEM_WORDS = 4              # distinct words under a stem
FUZZY_PRECISION = 0.8
FUZZY_SHARE = 0.8           # evidence of a near miss, as a share of the term's
WINDOW = 10                 # words on either side of a hit
KNOWN_WORDS = 150_000       # word results kept per Python worker
KNOWN_ARCS = 200_000        # determinised transitions kept per Python worker

# Cue words of the context window.
REPORTING = {"said", "says", "called", "calls", "quote", "quoted", "wrote", "word", "term", "slur", "insult",
             "sagte", "nannte", "dit", "appelle", "dijo", "llama"}
SECOND_PERSON = {"you", "your", "youre", "u", "du", "dich", "dein", "ihr", "tu", "toi", "vous", "te", "usted", "ti"}
OPENING, CLOSING = "“«„‘", "”»“’"

_WORD = re.compile(r"\w+")


class Lexicon:
    """Trie of terms; a term ending in * is a stem and accepts any ending."""

    def __init__(self, terms: list[str], exact_only: set[str] = frozenset(), edits: int = 1):
        self.edits = edits
        self.children: list[dict[str, int]] = [{}]
        self.end: list[str | None] = [None]         # term that ends at a node
        self.stem: list[bool] = [False]
        self.exact_only = exact_only
        for t in terms:
            node = 0
            for c in t.rstrip("*"):
                nxt = self.children[node].get(c)
                if nxt is None:
                    nxt = self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.end.append(None)
                    self.stem.append(False)
                node = nxt
            if self.end[node] is None or t.endswith("*"):
                self.end[node], self.stem[node] = t, t.endswith("*")
        self._fresh()

    def _fresh(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.arcs: dict[tuple[int, str], int] = {}
        self.known: dict[str, tuple[str, int] | None] = {}
        self.start = self._state({0: 0})

    def _state(self, at: dict) -> int:
        """State of a set of places with their edits, closed under letters left out.
        A place is a node, or (node, letter): that letter must come next, as the second
        of two swapped ones."""
        todo = [n for n in at if isinstance(n, int)]
        while todo:
            node = todo.pop()
            e = at[node]
            if e < self.edits and not self.stem[node]:
                for child in self.children[node].values():
                    if at.get(child, self.edits + 1) > e + 1:
                        at[child] = e + 1
                        todo.append(child)
        key = frozenset(at.items())
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(at)
        return self.ids[key]

    def _arc(self, state: int, c: str) -> int:
        """-1: no term can come of it."""
        known = self.arcs.get((state, c))
        if known is not None:
            return known
        to: dict = {}

        def go(place, cost: int) -> None:
            if cost <= self.edits and to.get(place, self.edits + 1) > cost:
                to[place] = cost

        for place, e in self.sets[state].items():
            if isinstance(place, tuple):             # inside a swap
                if place[1] == c:
                    go(place[0], e)
                continue
            if self.stem[place]:
                go(place, e)                         # anything may follow a stem
                continue
            child = self.children[place].get(c)
            if child is not None:
                go(child, e)
            if e < self.edits:
                go(place, e + 1)                     # a letter too many
                for letter, other in self.children[place].items():
                    go(other, e + 1)                 # another letter
                    swapped = self.children[other].get(c)
                    if swapped is not None and letter != c:
                        go((swapped, letter), e + 1)
        result = self.arcs[state, c] = self._state(to) if to else -1
        return result

    def near(self, word: str) -> dict[str, int]:
        """All terms within the allowed edits, with their distance."""
        if len(self.arcs) >= KNOWN_ARCS:
            self._fresh()
        state = self.start
        for c in word:
            state = self._arc(state, c)
            if state < 0:
                return {}
        return {self.end[n]: e for n, e in self.sets[state].items() if isinstance(n, int) and self.end[n] is not None}

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the nearest term, or None."""
        if word in self.known:
            return self.known[word]
        if len(self.known) >= KNOWN_WORDS:
            self._fresh()
        found = [(e, t) for t, e in self.near(word).items() if not (e and t in self.exact_only)]
        best = min(found, default=None)
        self.known[word] = best and (best[1], best[0])
        return self.known[word]


N_FEATURES = 5


def _features(lexicon: Lexicon, evidence: dict[str, float], text: str) -> list[float]:
    """Evidence of the strongest hit, plain and quoted; most hits in one window;
    second-person words near hits; share of hits.

    A near miss counts as FUZZY_SHARE of its term: labels seldom hold enough of
    them to learn more than whether clean texts hold them too (exact_only)."""
    low = text.lower()
    words = _WORD.findall(low)
    hits = {w: m for w in set(words) if (m := lexicon.match(w)) is not None}
    if not hits:
        return [0.0] * N_FEATURES
    best = [0.0, 0.0]
    places, you = [], 0
    spans = list(_WORD.finditer(low))
    for i, m in enumerate(spans):
        hit = hits.get(m.group())
        if hit is None:
            continue
        places.append(i)
        near = words[max(0, i - WINDOW): i + WINDOW + 1]
        a = spans[max(0, i - WINDOW)].start()
        z = spans[min(len(spans) - 1, i + WINDOW)].end()
        before, after = low[a: m.start()], low[m.end(): z]
        quoted = ((before.count('"') % 2 == 1 and '"' in after)
                  or (max(before.rfind(c) for c in OPENING) > max(before.rfind(c) for c in CLOSING)
                      and any(c in after for c in CLOSING))
                  or not REPORTING.isdisjoint(words[max(0, i - 3): i]))
        weight = evidence[hit[0]] * (FUZZY_SHARE if hit[1] else 1.0)
        best[quoted] = max(best[quoted], weight)
        you += not SECOND_PERSON.isdisjoint(near)
    together = max(sum(1 for q in places[k: k + 2 * WINDOW + 1] if q - p <= 2 * WINDOW) for k, p in enumerate(places))
    return [*best, math.log1p(together), math.log1p(you), len(places) / len(words)]


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 60) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        size = np.abs(step).max()
        w -= step * min(1.0, 4.0 / max(size, 1e-9))
        if size < 1e-6:
            break
    return w


class Toxicity:
    """Lexicon and weights; plain data, sent to the tasks with the function."""

    def __init__(self, evidence: dict[str, float], exact_only: set[str], weights: np.ndarray):
        self.evidence, self.exact_only, self.weights = evidence, set(exact_only), np.asarray(weights)

    def lexicon(self) -> Lexicon:
        return Lexicon(list(self.evidence), self.exact_only)

    def scores(self, lexicon: Lexicon, values: list[str]) -> np.ndarray:
        x = np.array([_features(lexicon, self.evidence, t) for t in values]).reshape(-1, N_FEATURES)
        z = x @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _terms_of(text: str) -> Iterator[tuple[str, str, int]]:
    """(term, word, neighbourhood) of each term's first place in a text."""
    words = _WORD.findall(text.lower())
    seen = set()
    for i, w in enumerate(words):
        if w in seen:
            continue
        around = zlib.crc32(" ".join(words[max(0, i - 1): i] + ["_"] + words[i + 1: i + 2]).encode())
        for t in (w, *(w[:k] + "*" for k in STEM_LENGTHS if len(w) > k)):
            if t not in seen:
                seen.add(t)
                yield t, w, around


def _mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = {(t, w, c) for text in b.column("text").to_pylist() for t, w, c in _terms_of(text)}
        if rows:
            t, w, c = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(w), pa.array(c, pa.int64())],
                                             names=["term", "word", "around"])


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
                 text_col: str = "text") -> Toxicity:
    """Mine the lexicon and fit the weights on at most `sample_rows` rows.

    labels: (doc_id, label) rows that may be learned from, label 0 or 1.  Without
    any toxic row the lexicon is empty and every text gets a low score.
    """
    chosen = bounded_sample(labels, sample_rows)        # bounded, so it may be broadcast
    sample = cut(texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
                 .select("text", F.col("label").cast("int").alias("label")))
    mined = (arrow_map(sample.where("label = 1").select("text"), "toxicity", _mine, "term string, word string, around long")
             .groupBy("term").agg(F.countDistinct("around").alias("p"), F.countDistinct("word").alias("words"))
             .where((F.col("p") >= MIN_SUPPORT) & (~F.col("term").endswith("*") | (F.col("words") >= STEM_WORDS))))

    def count_clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n: Counter[str] = Counter()
            for text in b.column("text").to_pylist():
                words = set(_WORD.findall(text.lower()))
                n.update(words)
                n.update({w[:k] + "*" for w in words for k in STEM_LENGTHS if len(w) > k})
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(list(n)), pa.array(list(n.values()), pa.int64())],
                                                 names=["term", "n"])

    clean = (arrow_map(sample.where("label = 0").select("text"), "toxicity", count_clean, "term string, n long")
             .groupBy("term").agg(F.sum("n").alias("n")))
    # Precise terms only reach the driver; their number is bounded by the sample.
    precise = (mined.join(clean, "term", "left").select("term", "p", F.coalesce("n", F.lit(0)).alias("n"))
               .where(F.col("p") >= MIN_PRECISION * (F.col("p") + F.col("n"))).collect())
    counts = {r.term: (r.p, r.n) for r in precise}
    good = sorted(counts, key=lambda t: (not t.endswith("*"), len(t), t))
    terms: list[str] = []
    held: set[str] = set()
    for t in good:                                       # shortest stems first; no term under a stem
        body = t.rstrip("*")
        if not any(body[:k] + "*" in held for k in range(1, len(body) + 1)):
            terms.append(t)
            held.add(t)
    terms.sort(key=lambda t: (-counts[t][0], t))
    by_label = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = math.log((by_label.get(1, 0) + 0.5) / (by_label.get(0, 0) + 0.5))
    evidence = {t: max(0.0, math.log((counts[t][0] + 0.5) / (counts[t][1] + 0.5)) - prior) for t in terms}

    # Near misses that stand in clean documents too: those terms match exactly only.
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)
        known: dict[str, list[str]] = {}

        def misses(word: str) -> list[str]:
            if word not in known:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                places = lexicon.near(word)
                known[word] = [] if 0 in places.values() else list(places)      # a term itself is no miss
            return known[word]

        for b in batches:
            n: Counter[tuple[str, int]] = Counter()
            for text, y in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                found = {t for w in set(_WORD.findall(text.lower())) for t in misses(w)}
                n.update((t, y) for t in found)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in n]), pa.array([y for _, y in n], pa.int32()),
                     pa.array(list(n.values()), pa.int64())], names=["term", "label", "n"])

    seen: dict[str, list[int]] = {}
    for r in (arrow_map(sample, "toxicity", near, "term string, label int, n long")
              .groupBy("term", "label").agg(F.sum("n").alias("n")).collect()):
        seen.setdefault(r.term, [0, 0])[r.label] += r.n
    exact_only = {t for t, (clean_n, toxic_n) in seen.items()
                  if clean_n and toxic_n / (clean_n + toxic_n) < FUZZY_PRECISION}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms, exact_only)
        for b in batches:
            rows = [_features(lexicon, evidence, t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), b.column("label")],
                                             names=["x", "label"])

    # One row for each different feature vector, with its count.
    table = (arrow_map(sample, "toxicity", features, "x array<double>, label int")
             .groupBy("x", "label").agg(F.count(F.lit(1)).alias("n")).collect())
    if not any(r.label == 1 for r in table):
        return Toxicity({}, set(), np.array([0.0] * N_FEATURES + [-4.0]))
    x = np.array([r.x for r in table])
    y = np.array([float(r.label) for r in table])
    n = np.array([r.n for r in table])
    return Toxicity(evidence, exact_only, _fit(np.repeat(x, n, 0), np.repeat(y, n)))


def score_toxicity(docs: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score (0 to 1, higher: toxic likelier).

    Defined cases: null and empty texts have no hit and get the base score;
    repeated rows are scored each; a null id is passed on; whole texts are read;
    an empty table gives no rows; extra columns are not read.  No shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = model.lexicon()
        for b in batches:
            s = model.scores(lexicon, b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())],
                                             names=["doc_id", "score"])

    return arrow_map(texts(docs, id_col, text_col), "toxicity", run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: Toxicity, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, whose text scores below `threshold`.

    Same cases as score_toxicity; null and empty texts stay unless the base
    score reaches the threshold.  No shuffle: rows are judged where they are read.
    """
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = model.lexicon()
        for b in batches:
            values = [t or "" for t in b.column(place).to_pylist()]
            yield b.filter(pa.array(model.scores(lexicon, values) < threshold))

    ship(docs.sparkSession)
    return arrow_map(docs, "toxicity", run, docs.schema)
