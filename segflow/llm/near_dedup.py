"""MinHash near-dedup: SuperMinHash signatures, banding, verification, union-find.

1. Each text becomes its set of 5-word shingles (64-bit hashes).  Documents with
   one and the same set form a class; only class representatives go on.
2. SuperMinHash: every shingle draws, level by level, one slot of a random
   permutation and a rank r + level; a slot keeps its least rank.  Ranks of one
   shingle are thus spread evenly over the slots (lower variance than independent
   MinHash), and a set is finished once all slots hold a rank below the next level.
3. Banding: representatives that agree on all slots of a band meet in a bucket.
4. Verification on full sets.  In each bucket every member is compared with the
   bucket's pivot, the member that meets most others in all its buckets (in a
   group of edited copies, the text nearest to all).  Where members are left in
   different components, further rounds compare them with other pivots, one a bucket
   and round, as long as components go on merging: a family of texts that hang
   together by chains is joined with a number of pairs that is linear in its size.
   Pairs that this leaves open (neither a pivot, different components) are searched
   exactly by prefix filtering: if two sets overlap enough, their rarest shingles
   meet.  Only rows outside a shingle's largest component look for partners there,
   and a frequent shingle's partners are dealt over blocks.
5. Union-find grouping over verified links by star contraction.

No bucket is capped and no group is expanded into all pairs; copies in excess of
a representative never enter step 2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segflow.llm.common import arrow_map, cut, scratch, texts
from segflow.llm.components import components
from segflow.llm.textops import U, Words, chunks, mix

SHINGLE = 5
BANDS, ROWS = 24, 5         # misses a pair at 0.85 with probability 8e-7
STALLED = 20                # the last round finds less than one link for so many open groups
BLOCK = 512                 # partners at a shingle that stand in one block
ELEMENTS = 1 << 13          # shingles whose permutations stand in memory at once
FRACTION = 25               # bits of a rank below its level, so at most 128 slots


def shingle_sets(words: Words, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a chunk.

    Fewer words than a shingle: the whole sequence as one; no words: none.
    """
    at, h = words.windows(size)
    counts = words.counts()
    cuts = np.searchsorted(at, words.first)
    out = []
    for d in range(words.n_docs):
        if counts[d] >= size:
            out.append(np.unique(h[cuts[d]: cuts[d + 1]]))
        else:
            out.append(words.whole(d) if counts[d] else np.zeros(0, U))
    return out


def super_minhash(sets: list[np.ndarray], slots: int = BANDS * ROWS, block: int = ELEMENTS) -> np.ndarray:
    """SuperMinHash signatures (one row a set); empty sets keep the top value.

    Each open element holds a permutation of `slots` bytes, so sets are taken in
    blocks of about `block` elements; a set is never divided.
    """
    sizes = np.cumsum([len(s) for s in sets])
    out, lo = [np.zeros((0, slots), np.uint32)], 0
    while lo < len(sets):
        hi = int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + block, "right"))
        hi = max(lo + 1, hi)
        out.append(_super_minhash(sets[lo:hi], slots))
        lo = hi
    return np.concatenate(out)


def _super_minhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    sig = np.full((len(sets), slots), 0xFFFFFFFF, np.uint32)
    flat = sig.reshape(-1)
    sizes = np.array([len(s) for s in sets])
    element = np.concatenate(sets) if len(sets) else np.zeros(0, U)
    owner = np.repeat(np.arange(len(sets)), sizes)
    perm = first = None
    for level in range(slots):
        if not len(element):
            break
        draw = mix(element, 0xA0761D6478BD642F + level * 0x9E3779B97F4A7C15)
        rank = (U(level) << U(FRACTION)) | (draw >> U(64 - FRACTION))
        k = (level + (((draw & U(0xFFFFFFFF)) * U(slots - level)) >> U(32)).astype(np.int64))
        if level == 0:
            slot = first = k
        else:
            if perm is None:        # most sets are finished by now
                perm = np.tile(np.arange(slots, dtype=np.uint8), (len(element), 1))
                rows = np.arange(len(element))
                perm[rows, first] = 0
                perm[:, 0] = first
            rows = np.arange(len(element))
            slot = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[:, level]
        np.minimum.at(flat, owner * slots + slot, rank.astype(np.uint32))
        open_sets = sig.max(axis=1) >= np.uint32((level + 1) << FRACTION)
        left = open_sets[owner]
        if not left.all():
            element, owner = element[left], owner[left]
            if perm is None:
                first = first[left]
            else:
                perm = perm[left]
    return sig


def band_hashes(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band, different between bands."""
    part = sig.astype(U).reshape(len(sig), bands, rows)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=U), part.shape[:2]).copy()
    for r in range(rows):
        h = mix(h * U(0x9FB21C651E98DF25) + part[:, :, r])
    return h


def _lists(rows: np.ndarray) -> pa.ListArray:
    n, k = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k),
                                    pa.array(rows.reshape(-1).view(np.int64)))


def _signatures(batches: Iterator[pa.RecordBatch], bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("doc_id")
        for w in chunks(b.column("text"), lower=True):
            sets = shingle_sets(w)
            sums = np.array([[mix(s, 11).sum(dtype=U), mix(s, 29).sum(dtype=U)] for s in sets], U).reshape(-1, 2)
            keys = band_hashes(super_minhash(sets, bands * rows), bands, rows)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(w.lo, w.n_docs), pa.array(np.array([len(s) for s in sets], np.int64)),
                 pa.array(sums[:, 0].copy().view(np.int64)), pa.array(sums[:, 1].copy().view(np.int64)), _lists(keys)],
                names=["doc_id", "n_shingles", "d1", "d2", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("doc_id")
        for w in chunks(b.column("text"), lower=True):
            sets = shingle_sets(w)
            offs = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(w.lo, w.n_docs), pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))],
                names=["id", "els"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs whose full sets overlap enough."""
    left = sets.select(F.col("id").alias("a"), F.col("els").alias("els_a"))
    right = sets.select(F.col("id").alias("b"), F.col("els").alias("els_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    both = both.withColumn("n", F.size(F.array_intersect("els_a", "els_b")))
    return both.where(F.expr(f"100 * n >= {percent} * (size(els_a) + size(els_b) - n)")).select("a", "b")


def _fits(percent: int) -> str:
    """Sizes alone allow the similarity."""
    return f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"


def near_dedup(docs: DataFrame, percent: int = 85, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * |intersection| >= percent * |union| of their
    shingle sets; a component's id is the least doc_id in it and only that
    document is kept.  A pair of similarity s is missed by the banding with
    probability (1 - s**rows)**bands: 8e-7 at 0.85 with 24 x 5, 1e-7 at 0.8 with
    30 x 4.  Defined cases: null, empty or blank texts have an empty
    set and no link; a null id is its own component with a null id and is kept;
    rows repeated with one id share one decision (the least of their
    components, all rows alike); an empty table gives no rows; extra columns are
    not read; texts are used whole.
    """
    if bands * rows > 128:
        raise ValueError("at most 128 slots")
    src = texts(docs, id_col, text_col)
    sig = cut(arrow_map(src, "near", lambda batches: _signatures(batches, bands, rows),
                        "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"))
    of_class = ["n_shingles", "d1", "d2"]
    full = sig.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = cut(full.groupBy(*of_class).agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")))

    # Buckets of two or more representatives, and their pivots.
    keys = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("k"))
    shared = keys.groupBy("k").agg(F.count(F.lit(1)).alias("c")).where("c > 1").repartition("c", "k")
    met = cut(keys.join(shared, "k"))
    score = met.groupBy("rep").agg(F.sum("c").alias("score"))
    met = met.join(score, "rep").select("k", "rep", "n", "c", "score")
    pivots = met.groupBy("k").agg(F.max(F.struct("score", (-F.col("rep")).alias("minus"), "n")).alias("p"))
    pivots = pivots.select("k", (-F.col("p.minus")).alias("pivot"), F.col("p.n").alias("n_b")).repartition("pivot", "k")
    met = cut(met.join(pivots, "k").select("k", "rep", "n", "c", "pivot", "n_b"))
    pairs = (met.where("rep <> pivot").withColumnRenamed("n", "n_a").where(_fits(percent))
             .select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct())
    pairs = cut(pairs)

    # Full sets of the documents that met another one.
    wanted = met.select(F.col("rep").alias("doc_id")).distinct()
    found = src.join(wanted, "doc_id", "left_semi")
    sets = cut(arrow_map(found, "near", _sets, "id long, els array<long>"))
    links = cut(_verified(pairs, sets, percent))
    labels = components(links, "a", "b")

    # Pairs that the pivots leave open: members of one bucket, neither its pivot,
    # in different components.
    members = met.where("c > 2 AND rep <> pivot").select("k", F.col("rep").alias("id"), "n")
    with scratch(src.sparkSession, "near") as keep:
        named = keep(_open(members, labels))
        groups = found = named.select("k", "label").distinct().count()
        while groups and found * STALLED >= groups:
            # Any member will do as a pivot; the hash takes another one in each bucket.
            chosen = named.groupBy("k").agg(F.min(F.struct(F.xxhash64("k", "id").alias("h"), "id", "n", "label")).alias("p"))
            chosen = chosen.select("k", F.col("p.id").alias("pivot"), F.col("p.n").alias("n_b"), F.col("p.label").alias("label_b"))
            named = keep(named.join(chosen.repartition("pivot", "k"), "k").where("id <> pivot"))
            tried = keep(named.where("label <> label_b").withColumnRenamed("n", "n_a").where(_fits(percent))
                         .select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct())
            more = keep(_verified(tried, sets, percent))
            found = more.count()
            labels = keep(_relabelled(labels, more)) if found else labels
            named = keep(_open(named.select("k", "id", "n"), labels))
            groups = named.select("k", "label").distinct().count()
        rest = keep(named.select("id", "label").distinct())
        more = keep(_verified(_prefix_pairs(rest, sets, percent), sets, percent))
        final = cut(_relabelled(labels, more))

    ids = (classes.select(*of_class, "rep").join(final.withColumnRenamed("id", "rep"), "rep", "left")
           .select(*of_class, F.coalesce("label", "rep").alias("component_id")).repartition("component_id"))
    out = (sig.select("doc_id", *of_class).join(ids, of_class, "left")
           .select("doc_id", "n_shingles",
                   F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
                   .otherwise(F.col("doc_id")).alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _label(rows: DataFrame, labels: DataFrame, column: str, out: str) -> DataFrame:
    """`rows` with the component of `column` as `out`; without a link it is the id itself."""
    known = labels.select(F.col("id").alias(column), F.col("label").alias("_known"))
    return rows.join(known, column, "left").withColumn(out, F.coalesce("_known", column)).drop("_known")


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(k, id, n, label) of the buckets whose members stand in several components."""
    named = _label(members, labels, "id", "label")
    unsettled = (named.groupBy("k").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                 .where("lo < hi").select("k", "lo").repartition("lo", "k").select("k"))
    return named.join(unsettled, "k").select("k", "id", "n", "label")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links: only components that the links join change."""
    ends = _label(_label(links, labels, "a", "u"), labels, "b", "v").select("u", "v")
    joined = components(ends, "u", "v").select(F.col("id").alias("label"), F.col("label").alias("least"))
    known = labels.unionByName(joined.select(F.col("label").alias("id"), "label")).distinct()
    return known.join(joined, "label", "left").select("id", F.coalesce("least", "label").alias("label"))


def _prefix_pairs(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All (a, b) of different labels that prefix filtering cannot rule out.

    Shingles are ordered by how many of these sets hold them, rarest first.  Sets
    that overlap by `percent` share a shingle within their first
    n - ceil(percent * n / 100) + 1.
    """
    tokens = (rest.join(sets, "id").select("id", "label", F.size("els").alias("n"), F.explode("els").alias("t")))
    often = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("f")).where("f > 1").repartition("f", "t")
    # Shingles of one set only come first in the order but can meet nothing:
    # they just use up places of the prefix.
    common = tokens.join(often, "t")
    order = Window.partitionBy("id").orderBy("f", "t")
    kept = common.withColumn("r", F.row_number().over(order)).withColumn("m", F.count("t").over(Window.partitionBy("id")))
    kept = kept.withColumn("p", F.expr("r + n - m"))            # place among all shingles of the set
    kept = kept.withColumn("blocks", F.expr(f"ceil(f / {BLOCK})"))
    prefix = kept.where(F.expr(f"p <= n - ceil({percent} * n / 100) + 1")).select("t", "id", "label", "n", "p", "blocks")
    prefix = cut(prefix)
    per = prefix.groupBy("t", "label").agg(F.count(F.lit(1)).alias("c"))
    main = (per.groupBy("t").agg(F.max(F.struct("c", "label")).alias("x"), F.count(F.lit(1)).alias("labels"))
            .where("labels > 1").select("t", F.col("x.label").alias("main")).repartition("main", "t"))
    mixed = cut(prefix.join(main, "t"))
    a = mixed.where("label <> main").select("t", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"),
                                          F.col("id").alias("x"), F.col("label").alias("label_x"),
                                          F.col("n").alias("n_a"), F.col("p").alias("p_a"))
    b = mixed.select("t", F.expr("pmod(xxhash64(id), blocks)").alias("block"), F.col("id").alias("y"),
                     F.col("label").alias("label_y"), F.col("n").alias("n_b"), F.col("p").alias("p_b"))
    # At the first shingle that both hold, enough places must be left in each.
    need = f"ceil({percent} * (n_a + n_b) / {100 + percent})"
    found = (a.join(b, ["t", "block"]).where("label_x <> label_y").where(_fits(percent))
             .where(F.expr(f"n_a - p_a + 1 >= {need} AND n_b - p_b + 1 >= {need}")))
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
