"""Ranked lexical search: document FP-trees and branch-and-bound per item.

Documents are cut to the terms that some item asks for.  Each task lays the vectors of
its documents, terms in order of frequency from the rarest on, into a trie: documents
that begin alike share a path (copies share all of it).  Nodes stand in preorder, and
each knows the documents below it, the largest tf of its own term, the largest tf of
any term from it down, and the least m.

An item is searched depth first, its rarest term first.  A branch holds the subtrees in
which that term is the item's first one, so all rarer ones are known to be missing
there.  With the node's maxima and least m no document below can score above
    w * part(own tf) + sum over commoner item terms of w * part(least of subtree tf, list tf).
Subtrees whose bound is under the item's k-th score so far are left out, the documents
of the others are scored exactly, and when the bound of all later branches falls under
the k-th score the item is done.  Scores and bounds are 64-bit integers as the contract
defines them, so a bound is never rounded below a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segflow.llm.common import arrow_map, cut, texts
from segflow.llm.textops import chunks

TOP = 50
BLOCK_ITEMS = 2_000         # items searched in one pass over the vectors
TREE_POSTINGS = 2_000_000   # (document, term) pairs of one trie
MERGE_SALTS = 64            # first merge of an item's lists: this many parts
U = np.uint64

# Bytes outside terms: ASCII but for digits and letters.
_BREAKS = np.ones(256, bool)
_BREAKS[128:] = False
for _a, _z in (("0", "9"), ("A", "Z"), ("a", "z")):
    _BREAKS[ord(_a): ord(_z) + 1] = False


def _expand(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [lo, hi), one range after the other."""
    sizes = hi - lo
    if not len(sizes):
        return np.zeros(0, np.int64)
    before = np.cumsum(sizes) - sizes
    return np.repeat(lo - before, sizes) + np.arange(sizes.sum())


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Saturated share of a term, in billionths."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Tree:
    """FP-tree of documents given as postings sorted by (document, rank); at least one
    posting a document.  rank: place of the term, 0 is the rarest."""

    def __init__(self, doc_id: np.ndarray, m: np.ndarray, sizes: np.ndarray, rank: np.ndarray, tf: np.ndarray, ranks: int):
        # Documents in the order of their paths.
        raw, ends = rank.astype(">u4").tobytes(), np.cumsum(sizes) * 4
        paths = [raw[z - 4 * n: z] for z, n in zip(ends.tolist(), sizes.tolist())]
        order = np.array(sorted(range(len(paths)), key=paths.__getitem__), np.int64)
        del paths
        at = _expand((np.cumsum(sizes) - sizes)[order], np.cumsum(sizes)[order])
        self.rank, self.tf = rank[at], tf[at].astype(np.int64)
        self.doc_id, self.m, sizes = doc_id[order], m[order], sizes[order]
        self.off = np.concatenate([[0], np.cumsum(sizes)])
        n_docs, first = len(sizes), self.off[:-1]
        doc = np.repeat(np.arange(n_docs), sizes)
        depth = np.arange(len(doc)) - first[doc]
        # Length of the path shared with the document before.
        prior = np.maximum(doc - 1, 0)
        same = (doc > 0) & (depth < sizes[prior])
        same &= self.rank[np.where(same, first[prior] + depth, 0)] == self.rank
        shared = np.minimum.reduceat(np.where(same, len(doc), depth), first)
        new = depth >= shared[doc]
        # The node of each posting: its own if new, else the last new one at its depth.
        by_depth = np.lexsort((doc, depth))
        here = np.where(new[by_depth], np.arange(len(doc)), 0)
        node_no = np.cumsum(new) - 1
        node = np.empty(len(doc), np.int64)
        node[by_depth] = node_no[by_depth[np.maximum.accumulate(here)]]
        # Largest tf of a document from each posting on.
        back = (n_docs - 1 - doc[::-1]).astype(np.int64) << 32
        onward = (np.maximum.accumulate(self.tf[::-1] + back) - back)[::-1]
        by_node = np.argsort(node, kind="stable")
        begin = np.searchsorted(node[by_node], np.arange(new.sum()))
        self.node_tf = np.maximum.reduceat(self.tf[by_node], begin)
        self.node_onward = np.maximum.reduceat(onward[by_node], begin)
        self.node_m = np.minimum.reduceat(self.m[doc[by_node]], begin)
        self.lo = np.minimum.reduceat(doc[by_node], begin)
        self.hi = np.maximum.reduceat(doc[by_node], begin) + 1
        # Header lists: nodes of each term, in preorder.
        term = self.rank[new]
        self.nodes = np.argsort(term, kind="stable")
        self.heads = np.searchsorted(term[self.nodes], np.arange(ranks + 1))
        self.list_tf = np.zeros(ranks, np.int64)
        np.maximum.at(self.list_tf, term, self.node_tf)
        self.least_m = self.m.min() if n_docs else 0

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        lo, hi = self.off[docs], self.off[docs + 1]
        at = _expand(lo, hi)
        w = weight[self.rank[at]]
        of = np.repeat(np.arange(len(docs)), hi - lo)[w > 0]
        at, w = at[w > 0], w[w > 0]
        out = np.zeros(len(docs), np.int64)
        np.add.at(out, of, w * part(self.tf[at], self.m[docs][of]))
        return out

    def search(self, ranks: np.ndarray, weights: np.ndarray, weight: np.ndarray, best: Best) -> None:
        """ranks, weights: an item's terms, rarest first; weight: the same by rank."""
        most = weights * part(self.list_tf[ranks], self.least_m)
        rest = np.concatenate([np.cumsum(most[::-1])[::-1], [0]])
        handled = np.zeros(len(self.m), bool)
        for j, r in enumerate(ranks):
            if rest[j] < best.least:
                break
            nodes = self.nodes[self.heads[r]: self.heads[r + 1]]
            nodes = nodes[~handled[self.lo[nodes]]]
            handled[_expand(self.lo[nodes], self.hi[nodes])] = True
            m = self.node_m[nodes]
            bound = weights[j] * part(self.node_tf[nodes], m)
            open_ = bound + rest[j + 1] >= best.least
            nodes, m, bound = nodes[open_], m[open_], bound[open_]
            if best.least > 1 and len(nodes):
                onward = self.node_onward[nodes]
                for q, w in zip(ranks[j + 1:], weights[j + 1:]):
                    bound += w * part(np.minimum(onward, self.list_tf[q]), m)
                nodes = nodes[bound >= best.least]
            if len(nodes):
                docs = _expand(self.lo[nodes], self.hi[nodes])
                best.add(self.scores(docs, weight), self.doc_id[docs])


class Best:
    """The k best (score, doc_id) so far; `least` is the score that the next must reach."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.score, self.doc_id = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, doc_id: np.ndarray) -> None:
        good = score >= self.least
        score, doc_id = np.concatenate([self.score, score[good]]), np.concatenate([self.doc_id, doc_id[good]])
        order = np.lexsort((doc_id, -score))[: self.k]
        self.score, self.doc_id = score[order], doc_id[order]
        if len(order) == self.k:
            self.least = max(1, int(self.score[-1]))


@dataclass
class Items:
    """One block of items over a common vocabulary (sorted 64-bit term hashes)."""

    ids: list
    terms: list[np.ndarray]         # of each item: places in the vocabulary, once each
    vocabulary: np.ndarray


def read_items(rows) -> Items:
    """rows: (item_id, text); the same tokeniser as for documents."""
    ids, column = [r[0] for r in rows], pa.array([r[1] for r in rows], pa.large_string())
    hashes = [h for w in chunks(column, lower=True, breaks=_BREAKS) for h in np.split(w.hash, w.first[1:-1])]
    vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, U)
    return Items(ids, [np.searchsorted(vocabulary, np.unique(h)) for h in hashes], vocabulary)


def term_vectors(docs: DataFrame, vocabulary: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, tfs): number of terms of each document, with repeats, and its
    counts of the vocabulary's terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(len(vocabulary), 1)
        for b in batches:
            for w in chunks(b.column("text"), lower=True, breaks=_BREAKS):
                at = np.searchsorted(vocabulary, w.hash)
                hit = at < len(vocabulary)
                hit[hit] = vocabulary[at[hit]] == w.hash[hit]
                pairs, tf = np.unique(w.doc_of_word()[hit] * size + at[hit], return_counts=True)
                offsets = pa.array(np.searchsorted(pairs // size, np.arange(w.n_docs + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(w.lo, w.n_docs), pa.array(w.counts().astype(np.int64)),
                     pa.ListArray.from_arrays(offsets, pa.array((pairs % size).astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32)))],
                    names=["doc_id", "n", "terms", "tfs"])

    return arrow_map(texts(docs, id_col, text_col), "lexical_search", run,
                     "doc_id long, n long, terms array<int>, tfs array<int>")


def _block(vectors: DataFrame, items: Items, n_docs: int, n_terms: int, top: int, tree_postings: int) -> DataFrame:
    """(item, item_id, doc_id, score): the best `top` of each task for each item."""
    size = len(items.vocabulary)
    df = np.zeros(size, np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():   # one row a term at most
        df[r[0]] = r[1]
    w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    by_rank = np.lexsort((np.arange(size), df))                # rarest first
    rank_of = np.empty(size, np.int32)
    rank_of[by_rank] = np.arange(size)
    asked = []
    for terms in items.terms:
        ranks = np.sort(rank_of[terms])
        ranks = ranks[(w[by_rank[ranks]] > 0) & (df[by_rank[ranks]] > 0)]
        asked.append((ranks, w[by_rank[ranks]]))
    ids = items.ids

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[Tree]:
        held, postings = [], 0

        def build() -> Tree:
            t = pa.Table.from_batches(held).combine_chunks()
            sizes = np.diff(t.column("terms").chunk(0).offsets.to_numpy())
            rank = rank_of[t.column("terms").chunk(0).flatten().to_numpy()]
            tf = t.column("tfs").chunk(0).flatten().to_numpy()
            order = np.lexsort((rank, np.repeat(np.arange(len(sizes)), sizes)))
            m = 50 + (50 * t.column("n").to_numpy() * n_docs) // n_terms
            return Tree(t.column("doc_id").to_numpy(), m, sizes.astype(np.int64), rank[order], tf[order], size)

        for b in batches:
            if b.num_rows:
                held.append(b)
                postings += len(b.column("terms").flatten())
            if postings >= tree_postings:
                yield build()
                held, postings = [], 0
        if held:
            yield build()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in ids]
        weight = np.zeros(size, np.int64)
        for tree in trees(batches):
            for (ranks, weights), b in zip(asked, best):
                weight[ranks] = weights
                tree.search(ranks, weights, weight, b)
                weight[ranks] = 0
        for i, b in enumerate(best):
            if len(b.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b.score), i, np.int32)), pa.array([ids[i]] * len(b.score), pa.int64()),
                     pa.array(b.doc_id), pa.array(b.score)], names=["item", "item_id", "doc_id", "score"])

    useful = vectors.where("doc_id IS NOT NULL AND size(terms) > 0")
    return arrow_map(useful, "lexical_search", search, "item int, item_id long, doc_id long, score long")


def lexical_search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", block_items: int = BLOCK_ITEMS,
                   tree_postings: int = TREE_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's `top` best documents of all, exactly.

    Items are searched in blocks of about `block_items` (a stated query set; each block
    takes one pass over the documents), so what reaches the driver and the tasks is one
    block's items and the document counts of their terms.  Equal scores rank by
    ascending doc_id.  Defined cases: null and empty texts have no term; a document
    without an id counts in the statistics but is not ranked; rows that repeat an id
    are ranked each; equal rows of `items` count once, different texts under one
    item_id are ranked apart; items without a known term, an empty benchmark or empty
    documents give no rows; texts are read whole; extra columns are not read.  Terms are
    told apart by 64-bit hash.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).cast("long").alias("item_id"),
                         F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text")).distinct()
    blocks = max(1, -(-asked.count() // block_items))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found, totals = None, None
    for block in range(blocks):
        read = read_items(asked.where(place == block).orderBy("item_id", "text").collect())
        vectors = cut(term_vectors(docs, read.vocabulary, id_col, text_col))
        if totals is None:
            totals = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not totals[1] or not len(read.vocabulary):
            continue
        lists = _block(vectors, read, *totals, top, tree_postings)
        # Two merges, so that no task gets an item's lists of all tasks at once.
        lists = lists.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(MERGE_SALTS)))
        for keys in (["item", "salt"], ["item"]):
            order = Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")
            lists = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        lists = lists.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        found = lists if found is None else found.unionByName(lists)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found
