"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text falls into one of at most BINS bins; the model is a table
of additions for each feature, and a small two-way table for a few pairs.  The
tables are learned by cyclic boosting: round after round, each feature in turn
(later each pair) gets a shallow tree fitted to what is left of the log-odds, and
the tree is added to its table at a small rate.  Scoring looks up bins and adds.

Features are computed in Spark; only those of a bounded labelled sample reach the
driver, where the tables are learned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.llm.common import arrow_map, bounded_sample, texts

SAMPLE_ROWS = 20_000        # labelled training rows used at most
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 8
RATE, LEAST_ROWS, SMOOTH = 0.1, 10, 1.0

FEATURES = ("log_bytes", "log_words", "upper_share", "digit_share", "symbol_share", "pipe_share", "stop_share",
            "mark_share", "mean_word", "short_words", "distinct_words", "distinct_pairs", "distinct_lines",
            "words_per_line", "sentence_lines", "top_word", "wide_share", "letters_per_word")

_KIND = np.full(256, 7)                               # other punctuation and controls
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[65:91] = 1
_KIND[97:123] = 2
_KIND[48:58] = 3
_KIND[[ord(c) for c in "#$%&*@^~=+<>{}[]\\/_"]] = 4
_KIND[ord("|")] = 5
_KIND[[ord(c) for c in ".,;:"]] = 6
_KIND[[ord(c) for c in "!?"]] = 8
_KIND[128:] = 9


def features(text: str) -> list[float]:
    """Numbers that describe a whole text; the empty text has zeros."""
    raw = text.encode("utf-8")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kind = np.bincount(_KIND, weights=by_byte, minlength=10)
    n, inked = len(words), max(1.0, len(raw) - kind[0])
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    often = Counter(words)
    pairs = len(set(zip(words, words[1:]))) / max(1, n - 1) if n > 1 else 1.0
    ended = sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines)
    return [np.log1p(len(raw)), np.log1p(n), kind[1] / max(1.0, kind[1] + kind[2]), kind[3] / inked, kind[4] / inked,
            kind[5] / inked, kind[6] / inked, kind[8] / inked, lengths.mean(), (lengths <= 3).mean(),
            len(often) / n, pairs, len(set(lines)) / len(lines), n / len(lines), ended / len(lines), max(often.values()) / n,
            kind[9] / inked, (kind[1] + kind[2] + kind[9]) / n]


def _split(g: np.ndarray, h: np.ndarray, c: np.ndarray, lo: int, hi: int) -> tuple[float, int]:
    """Best cut of bins lo..hi into two: (gain, first bin on the right)."""
    if hi - lo < 2:
        return 0.0, 0
    gl, hl, cl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1], np.cumsum(c[lo:hi])[:-1]
    gt, ht, ct = g[lo:hi].sum(), h[lo:hi].sum(), c[lo:hi].sum()
    gain = gl**2 / (hl + SMOOTH) + (gt - gl)**2 / (ht - hl + SMOOTH) - gt**2 / (ht + SMOOTH)
    gain[(cl < LEAST_ROWS) | (ct - cl < LEAST_ROWS)] = 0
    k = int(np.argmax(gain))
    return float(gain[k]), lo + k + 1


def _tree(g: np.ndarray, h: np.ndarray, c: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Shallow tree over ordered bins: the value it adds in each bin."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = max(((*_split(g, h, c, lo, hi), lo, hi) for lo, hi in parts), key=lambda x: x[0])
        if best[0] <= 1e-9:
            break
        _, at, lo, hi = best
        parts.remove((lo, hi))
        parts += [(lo, at), (at, hi)]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = -g[lo:hi].sum() / (h[lo:hi].sum() + SMOOTH)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, float]:
    """One cut of the first feature, one cut of the second in each half."""
    best, table = -1.0, np.zeros(g.shape)
    for flip in (False, True):
        a, b, n = (g.T, h.T, c.T) if flip else (g, h, c)
        for at in range(1, a.shape[0]):
            gain, out = 0.0, np.zeros(a.shape)
            for rows in (slice(0, at), slice(at, None)):
                ga, ha, ca = a[rows].sum(0), b[rows].sum(0), n[rows].sum(0)
                part = _tree(ga, ha, ca, leaves=2)
                out[rows] = part
                gain += -(ga * part).sum() - 0.5 * (ha * part**2).sum()
            if gain > best:
                best, table = gain, out.T.copy() if flip else out
    return table, best


class QualityModel:
    """Bin edges, a table a feature, and a table a pair; plain arrays."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        if not len(x):
            x = np.zeros((1, len(FEATURES)))
        self.edges = [np.unique(np.quantile(v, np.linspace(0, 1, BINS + 1)[1:-1])) for v in x.T]
        self.coarse = [np.unique(np.quantile(v, np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) for v in x.T]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        share = (y.sum() + 0.5) / (len(y) + 1)
        self.base = float(np.log(share / (1 - share)))
        if 0 < y.sum() < len(y):
            self._learn(x, y)

    def _learn(self, x: np.ndarray, y: np.ndarray) -> None:
        bins = [np.searchsorted(e, v, "right") for e, v in zip(self.edges, x.T)]
        wide = [np.searchsorted(e, v, "right") for e, v in zip(self.coarse, x.T)]
        z = np.full(len(y), self.base)
        ones = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, self.tables)]

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-z))
            return p - y, p * (1 - p)

        for _ in range(ROUNDS):
            for j, b in enumerate(bins):
                g, h = slopes()
                size = len(self.tables[j])
                step = RATE * _tree(np.bincount(b, g, size), np.bincount(b, h, size), ones[j])
                self.tables[j] += step
                z += step[b]

        def grid(i: int, j: int, v: np.ndarray | None) -> np.ndarray:
            shape = (len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)
            return np.bincount(wide[i] * shape[1] + wide[j], v, shape[0] * shape[1]).reshape(shape)

        g, h = slopes()
        gains = sorted(((_pair_tree(grid(i, j, g), grid(i, j, h), grid(i, j, None))[1], i, j)
                        for i in range(x.shape[1]) for j in range(i)), reverse=True)[:PAIRS]
        self.pairs = [(i, j, np.zeros((len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)))
                      for gain, i, j in gains if gain > 0]
        for _ in range(PAIR_ROUNDS):
            for i, j, table in self.pairs:
                g, h = slopes()
                step = RATE * _pair_tree(grid(i, j, g), grid(i, j, h), grid(i, j, None))[0]
                table += step
                z += step[wide[i], wide[j]]

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for e, t, v in zip(self.edges, self.tables, x.T):
            z += t[np.searchsorted(e, v, "right")]
        for i, j, t in self.pairs:
            z += t[np.searchsorted(self.coarse[i], x[:, i], "right"), np.searchsorted(self.coarse[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([features(t) for t in column.to_pylist()], float).reshape(-1, len(FEATURES))


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
                text_col: str = "text") -> QualityModel:
    """Learn the tables from at most `sample_rows` labelled rows (doc_id, label).

    Without rows, or with one label only, every text gets the base share."""
    chosen = bounded_sample(labels, sample_rows)        # bounded, so it may be broadcast
    sample = texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(b.column("label").cast(pa.float64())),
                 pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    rows = sorted(arrow_map(sample, "quality", run, "doc_id long, y double, x array<double>").collect())
    return QualityModel(np.array([r.x for r in rows]).reshape(-1, len(FEATURES)), np.array([r.y for r in rows]))


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score (0 to 1, higher: label 1 likelier).

    Defined cases: null and empty texts get the score of all-zero features;
    repeated rows are scored each; a null id is passed on; whole texts are read;
    an empty table gives no rows; extra columns are not read.  No shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.scores(_matrix(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())],
                                             names=["doc_id", "score"])

    return arrow_map(texts(docs, id_col, text_col), "quality", run, "doc_id long, score double")
