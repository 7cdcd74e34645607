"""Substring dedup with difference-cover anchors.

A window of 13 words repeated in two documents, at any two offsets, has a shift
d < 7 for which both offsets plus d fall on the cover {0, 1, 3} modulo 7 (every
difference modulo 7 is a difference of two cover elements).  So hashing 7-word
pieces at cover positions only (3 of 7 positions) still gives both documents one
common anchor inside the window.

1. Anchors: 7-word hashes at cover positions; those that a second document has
   are shared.
2. Extension: in documents with shared anchors, every 13-word window around one
   gets a 96-bit hash of its words.  A window goes if the least document that
   has it is another, smaller one.
3. Words covered by windows that go are removed.  Where an id stands on
   different texts, starts of windows carry a row key (a hash of the text)
   beside it; elsewhere the key is 0 and takes no room in the shuffle.

Before rows are shuffled, every task folds the repeats it sees itself: for an
anchor or window that several documents of a batch share, the answer for all but
the least one is known at once, so a passage in a third of all documents sends
one row a batch and not one a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segflow.llm.common import arrow_map, cut, release, texts
from segflow.llm.textops import U, chunks, mix

WINDOW = 13
PERIOD, COVER = 7, (0, 1, 3)        # a difference cover modulo 7
ANCHOR = WINDOW - PERIOD + 1        # words of an anchor: fits at every shift


def _anchors(words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document of the chunk, word position in it, hash) of the cover anchors."""
    at, h = words.windows(ANCHOR)
    doc = words.doc_of_word()[at]
    pos = at - words.first[doc]
    on = np.isin(pos % PERIOD, COVER)
    return doc[on], pos[on], h[on]


def _lists(n: int, owner: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Values by owner (sorted) as a list column of n rows."""
    offs = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values, kind))


def _send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, doc_id, known): an anchor of a document to be looked up, or (known
    not null) the anchors of a document that the batch itself shows to be shared."""
    for b in batches:
        ids = b.column("doc_id").to_numpy(zero_copy_only=False)
        parts = [((d + w.lo).astype(np.int32), h) for w in chunks(b.column("text")) for d, _, h in [_anchors(w)]]
        if not parts:
            continue
        key, h = ids[np.concatenate([p[0] for p in parts])], np.concatenate([p[1] for p in parts])
        del parts
        order = np.lexsort((key, h))
        h, key = h[order], key[order]
        del order
        fresh = np.ones(len(h), bool)                       # one row an anchor and document
        fresh[1:] = (h[1:] != h[:-1]) | (key[1:] != key[:-1])
        h, key = h[fresh], key[fresh]
        head = np.ones(len(h), bool)
        head[1:] = h[1:] != h[:-1]
        group = np.cumsum(head) - 1
        many = np.bincount(group, minlength=1)[group] > 1
        # The least document speaks for its batch; rows go out by document, so
        # that the ids of neighbouring rows compress away.
        look = np.flatnonzero(head)
        look = look[np.argsort(key[look], kind="stable")]
        own = np.flatnonzero(many)
        own = own[np.argsort(key[own], kind="stable")]
        docs, n_each = np.unique(key[own], return_counts=True)
        known = _lists(len(docs), np.repeat(np.arange(len(docs)), n_each), h[own].view(np.int64), pa.int64())
        n = len(look)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[look].view(np.int64)), pa.array(key[look], pa.int64()), pa.nulls(n, pa.list_(pa.int64()))],
            names=["h", "doc_id", "known"])
        if len(docs):
            yield pa.RecordBatch.from_arrays(
                [pa.array(mix(docs.astype(np.int64).view(U), 77).view(np.int64)), pa.array(docs, pa.int64()), known],
                names=["h", "doc_id", "known"])


def _send_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (w1, w2, doc_id, row, at, starts): a window to be looked up and where it
    starts (starts, if the document has it more than once); or (w2 null) starts
    of windows that a smaller document of the batch has."""
    for b in batches:
        b = b.filter(pa.compute.is_valid(b.column("shared")))
        if not b.num_rows:
            continue
        ids = b.column("doc_id").to_numpy(zero_copy_only=False)
        rows = np.where(b.column("many").to_numpy(zero_copy_only=False), b.column("row").to_numpy(zero_copy_only=False), 0)
        shared = b.column("shared")
        flat, offs = shared.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pa.compute.list_value_length(shared).to_numpy())])
        parts = []
        for w in chunks(b.column("text")):
            doc, pos, h = _anchors(w)
            a, z = offs[w.lo], offs[w.lo + w.n_docs]
            wanted_doc = np.repeat(np.arange(w.n_docs), np.diff(offs[w.lo: w.lo + w.n_docs + 1]))
            # Anchor and document together name a shared anchor.
            hit = np.isin(mix(h ^ mix(doc.astype(U))), mix(flat[a:z].view(U) ^ mix(wanted_doc.astype(U))))
            first = w.first[doc[hit]] + pos[hit]
            at, w1 = w.windows(WINDOW)
            _, w2 = w.windows(WINDOW, salt=0x5851F42D4C957F2D)
            w2 = (w2 >> U(32)).astype(np.uint32)
            # Windows that hold a shared anchor start at most PERIOD - 1 before it.
            near = np.zeros(len(w.hash) + 1, np.int32)
            np.add.at(near, np.maximum(first - PERIOD + 1, 0), 1)
            np.add.at(near, first + 1, -1)
            use = np.cumsum(near)[at] > 0
            at, w1, w2 = at[use], w1[use], w2[use]
            own = w.doc_of_word()[at]
            parts.append((w1, w2, ids[own + w.lo], rows[own + w.lo], (at - w.first[own]).astype(np.int32)))
        w1, w2, key, row, at = (np.concatenate([p[i] for p in parts]) for i in range(5))
        del parts
        order = np.lexsort((at, row, key, w2, w1))
        w1, w2, key, row, at = w1[order], w2[order], key[order], row[order], at[order]
        del order
        head = np.ones(len(w1), bool)
        head[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
        least = key[np.flatnonzero(head)][np.cumsum(head) - 1] if len(key) else key
        mine = np.flatnonzero(key == least)
        # One row a window and text, also where the texts share their id.
        turn = np.ones(len(w1), bool)
        turn[1:] = head[1:] | (key[1:] != key[:-1]) | (row[1:] != row[:-1])
        group = np.cumsum(turn) - 1
        often = np.bincount(group[mine], minlength=1)[group[mine]] > 1
        again, mine = mine[often], mine[~often]
        mine = mine[np.lexsort((at[mine], row[mine], key[mine]))]      # by document, as above
        gone = np.flatnonzero(key != least)
        gone = gone[np.lexsort((at[gone], row[gone], key[gone]))]
        new = np.ones(len(gone), bool)
        new[1:] = (key[gone[1:]] != key[gone[:-1]]) | (row[gone[1:]] != row[gone[:-1]])
        place = np.flatnonzero(new)
        docs, doc_rows, n_each = key[gone[place]], row[gone[place]], np.diff(np.append(place, len(gone)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(w1[mine].view(np.int64)), pa.array(w2[mine].view(np.int32)), pa.array(key[mine], pa.int64()),
             pa.array(row[mine], pa.int64()), pa.array(at[mine], pa.int32()), pa.nulls(len(mine), pa.list_(pa.int32()))],
            names=["w1", "w2", "doc_id", "row", "at", "starts"])
        if len(again):
            groups, place, each = np.unique(group[again], return_index=True, return_counts=True)
            one = again[place]
            yield pa.RecordBatch.from_arrays(
                [pa.array(w1[one].view(np.int64)), pa.array(w2[one].view(np.int32)), pa.array(key[one], pa.int64()),
                 pa.array(row[one], pa.int64()), pa.nulls(len(one), pa.int32()),
                 _lists(len(one), np.repeat(np.arange(len(one)), each), at[again], pa.int32())],
                names=["w1", "w2", "doc_id", "row", "at", "starts"])
        if len(docs):
            yield pa.RecordBatch.from_arrays(
                [pa.array(mix(docs.astype(np.int64).view(U), 78).view(np.int64)), pa.nulls(len(docs), pa.int32()),
                 pa.array(docs, pa.int64()), pa.array(doc_rows, pa.int64()), pa.nulls(len(docs), pa.int32()),
                 _lists(len(docs), np.repeat(np.arange(len(docs)), n_each), at[gone], pa.int32())],
                names=["w1", "w2", "doc_id", "row", "at", "starts"])


def _strip(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n_words, n_removed, sha, kept_text = [], [], [], []
        for text, row, gone, by_row in zip(*(b.column(c) for c in ("text", "row", "gone", "by_row"))):
            words = text.as_py().encode("utf-8").split()
            kept = words
            if gone.is_valid:
                cover = np.zeros(len(words) + 1, np.int32)
                starts = gone.values.to_numpy()
                if len(by_row.values):                      # the id stands on other texts too
                    keys, lists = by_row.values.flatten()
                    starts = lists.filter(pa.compute.equal(keys, row)).flatten().to_numpy()
                np.add.at(cover, starts, 1)
                np.add.at(cover, starts + WINDOW, -1)
                stay = np.cumsum(cover)[:-1] == 0
                kept = [words[i] for i in np.flatnonzero(stay)]
            joined = b" ".join(kept)
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            sha.append(hashlib.sha256(joined).hexdigest())
            if with_text:
                kept_text.append(joined.decode("utf-8"))
        cols = [b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(sha, pa.string())]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            cols, names = [*cols, pa.array(kept_text, pa.string())], [*names, "kept_text"]
        yield pa.RecordBatch.from_arrays(cols, names=names)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (and kept_text).

    Words are [^\\x20\\x09-\\x0D]+, unchanged.  A word goes if a window of 13
    words covers it that also starts in a document with a smaller doc_id; windows
    are judged on the input.  Defined cases: null text has no words; documents
    of fewer than 13 words lose nothing; a null id neither loses words nor counts
    as a source; rows that share an id are no sources for each other, and each
    loses what a smaller id has of its own text; an empty table gives no rows; extra columns are not read.

    Between its two halves the call collects the driver's garbage (`common.release`,
    about 1.5 s): Spark then drops the shuffle files of the anchors, and the bound on
    disk depends on that.
    """
    src = texts(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    sent = arrow_map(src.where("doc_id IS NOT NULL"), "substring", _send_anchors, "h long, doc_id long, known array<long>")
    by_anchor = Window.partitionBy("h")
    # Ids that stand on different texts, with no anchors of their own.
    many = (src.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("row").alias("lo"), F.max("row").alias("hi"))
            .where("lo < hi").select("doc_id", F.expr("CAST(array() AS array<bigint>)").alias("hs"), F.lit(True).alias("many")))
    shared = cut(sent.withColumn("lo", F.min("doc_id").over(by_anchor)).withColumn("hi", F.max("doc_id").over(by_anchor))
                 .where("known IS NOT NULL OR lo < hi")
                 .select("doc_id", F.coalesce("known", F.array("h")).alias("hs"), F.lit(False).alias("many")).union(many)
                 .groupBy("doc_id").agg(F.flatten(F.collect_list("hs")).alias("shared"), F.max("many").alias("many")))
    del sent
    release(docs.sparkSession)
    # Both joins below shuffle texts by doc_id in one and the same way, so the
    # exchange is made once and used twice; rows of one id pick theirs by row key.
    marked = src.join(shared, "doc_id", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    windows = arrow_map(marked, "substring", _send_windows, "w1 long, w2 int, doc_id long, row long, at int, starts array<int>")
    by_window = Window.partitionBy("w1", "w2")
    gone = (windows.withColumn("lo", F.min("doc_id").over(by_window))
            .where("w2 IS NULL OR lo < doc_id")
            .select("doc_id", "row", F.coalesce("starts", F.array("at")).alias("at"))
            .groupBy("doc_id").agg(F.flatten(F.collect_list(F.expr("IF(row = 0, at, NULL)"))).alias("gone"),
                                   F.collect_list(F.expr("IF(row = 0, NULL, struct(row, at))")).alias("by_row")))
    return arrow_map(
        src.join(gone, "doc_id", "left"), "substring", lambda batches: _strip(batches, with_text),
        "doc_id long, n_words long, n_removed long, kept_sha256 string"
        + (", kept_text string" if with_text else ""))
