"""Benchmark decontamination with spaced seeds, in DataFrame and SQL functions only.

A seed is a fixed mask over at most SPAN consecutive words; only the masked
positions are hashed, so a substituted word elsewhere in the span does not hide
the hit.  The three masks together hit every pattern of substitutions that SHARE
allows in a window of REACH words or in a whole item of SPAN to REACH words, but
for one pattern at ten words (tests/llm enumerates them).  Items that the masks
do not settle get contiguous pieces: one more than the substitutions allowed, so
one is always intact.  Items of fewer than SPAN words are one piece, the whole
item, and match verbatim only.  The seeds of all benchmark items (a small table)
are joined with the seeds of every position of every document.  A hit names a document, an item and a diagonal (how
far the item's words are shifted); the item is then laid over the document's
words on that diagonal and its best window of REACH words (or the whole item, if
shorter) must agree in at least SHARE of its positions.

Documents are read twice and only narrow rows are joined in between: the first
pass turns words into hashes inside whole-stage code, the second takes the words
under each diagonal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 9
MASKS = ((0, 1, 3, 5, 8), (0, 2, 3, 6, 8), (0, 1, 3, 4, 5))
REACH = 20
SHARE = 0.8
UNSETTLED = (10,)               # item lengths from SPAN to REACH where the masks miss a pattern
BROADCAST_ROWS = 2_000_000      # seeds of a benchmark that may be sent to every task (about 64 MB)


def _words(text: Column) -> Column:
    """Lower-cased runs of letters and digits (an empty string may stand at either end)."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1)


def _pieces(n: int, share: float, reach: int) -> list[tuple[int, int]]:
    """(start, length) of the contiguous pieces of an item of n words; none if the masks settle it."""
    if n < SPAN:
        return [(0, n)]
    default = share >= SHARE and reach >= REACH
    if n not in UNSETTLED if default else n > reach:
        return []
    size = min(n, reach)
    spare = max(s for s in range(size + 1) if s == 0 or (size - s) / size >= share)
    ends = [n * k // (spare + 1) for k in range(spare + 2)]
    return [(a, z - a) for a, z in zip(ends, ends[1:]) if z > a]


def _seeds(df: DataFrame, keep: list[str], lengths: list[int]) -> DataFrame:
    """One row for each position and mask or piece length that fits: kept columns, pos, kind, h.

    kind is the piece length, or 0 for a mask."""
    shapes = [(0, m) for m in MASKS] + [(n, tuple(range(n))) for n in lengths]
    offsets = sorted({o for _, m in shapes for o in m})
    shifted = [F.slice("w", o + 1, F.greatest(F.size("w"), F.lit(0))) for o in offsets]
    spots = df.select(*keep, F.posexplode(F.arrays_zip(*shifted)).alias("pos", "x"))
    word = {o: F.col("x").getField(str(i)) for i, o in enumerate(offsets)}
    hashes = [F.when(word[m[-1]].isNotNull(), F.struct(F.lit(n).alias("kind"), F.xxhash64(F.lit(i), *[word[o] for o in m]).alias("h")))
              for i, (n, m) in enumerate(shapes)]
    return spots.select(*keep, "pos", F.explode(F.array(*hashes)).alias("x")).where("x IS NOT NULL").select(*keep, "pos", "x.kind", "x.h")


def find_contaminated(docs: DataFrame, items: DataFrame, share: float = SHARE, reach: int = REACH,
                      id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                      item_text: str = "text") -> DataFrame:
    """One row per contaminated document: doc_id, n_items, items, overlap.

    items lists the item ids found, ascending and comma-joined; overlap is the
    best agreement of a window.  Defined cases: null and empty texts hold
    nothing; items of fewer than SPAN words match verbatim (all words in a row);
    items without words match nothing; a document with a null id is never reported; rows repeated
    with one id give one row; repeated items are found together; empty tables
    give no rows; extra columns are not read; texts are used whole.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    src = src.where("doc_id IS NOT NULL AND text IS NOT NULL")
    bench = (items.where(F.col(item_text).isNotNull() & F.col(item_col).isNotNull())
             .select(F.col(item_col).alias("item_id"), F.filter(_words(F.col(item_text)), lambda x: x != "").alias("w"))
             .where(F.size("w") > 0).withColumn("n", F.size("w")))
    # Piece lengths follow from item lengths, of which only those up to REACH have pieces.
    sizes = [r.n for r in bench.where(F.col("n") <= max(int(reach), SPAN, *UNSETTLED)).select("n").distinct().collect()]
    cuts = {n: p for n in sorted(sizes) if (p := _pieces(n, share, int(reach)))}
    lengths = sorted({length for p in cuts.values() for _, length in p})
    wanted = F.col("kind") == 0
    for n, p in cuts.items():
        for at, length in p:
            wanted = wanted | ((F.col("n") == n) & (F.col("pos") == at) & (F.col("kind") == length))
    seeds = (_seeds(bench, ["item_id", "n"], lengths).where(wanted & ((F.col("n") >= SPAN) | (F.col("kind") > 0)))
             .select("h", "item_id", "n", F.col("pos").alias("item_pos")).distinct())
    if seeds.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:      # a proven bound
        seeds = F.broadcast(seeds)
    spots = _seeds(src.select("doc_id", _words(F.col("text")).alias("w")), ["doc_id"], lengths).drop("kind")
    hits = (spots.join(seeds, "h")
            .select("doc_id", "item_id", "n", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct())
    per_doc = hits.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "n", "shift")).alias("hits"))

    # Words of the document under each item: small rows, so the text goes no further.
    laid = (src.join(per_doc, "doc_id").withColumn("w", _words(F.col("text")))
            .select("doc_id", F.explode(F.expr(
                "transform(hits, h -> named_struct('item_id', h.item_id, 'off', greatest(-h.shift, 0), "
                "'part', slice(w, greatest(h.shift, 0) + 1, h.n)))")).alias("x"))
            .select("doc_id", "x.*"))
    window = f"least({int(reach)}, n)"
    agree = F.expr("transform(sequence(0, n - 1), i -> IF(i >= off AND get(part, i - off) = get(w, i), 1, 0))")
    best = F.expr(f"array_max(transform(sequence(1, n - {window} + 1), "
                  f"s -> aggregate(slice(agree, s, {window}), 0, (a, x) -> a + coalesce(x, 0))))")
    judged = (laid.join(bench, "item_id").withColumn("agree", agree)
              .withColumn("overlap", best / F.expr(window)))
    return (judged.where(F.col("overlap") >= share)
            .groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("found"), F.max("overlap").alias("overlap"))
            .select("doc_id", F.size("found").cast("long").alias("n_items"),
                    F.array_join(F.transform("found", lambda i: i.cast("string")), ",").alias("items"), "overlap"))
