"""S4 without shuffling whole envelopes.

Most envelopes are unique, so only few rows need to meet.  Rows are named by 128-bit
digests; these alone are counted (16 bytes a row cross the network, copies fold in
every map task).  Digests that occur more than once go into a Bloom filter of bounded
size.  Rows that the filter does not know are unique and pass through where they are
read; the others are suspects, and only they are deduplicated as whole rows.  A digest
collision or a false positive of the filter makes a unique row a suspect, which costs
its shuffle and changes nothing, so the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.session import checkpoint_dir, tasks_for, work_path

BITS_PER_KEY = 12
HASHES = 4
FEW_ROWS = 200_000          # up to here whole rows are shuffled: the digests' jobs cost more than they save
SALTS, FREQUENT = 8, 10_000
MIN_BITS, MAX_BITS = 1 << 12, 1 << 26       # the filter takes 8 MB at most


def digest(columns) -> list[Column]:
    """Two 64-bit hashes of a row.  Hash functions pass over NULLs, so which columns
    are NULL is hashed too."""
    values = [F.col(f"`{c}`") for c in columns]
    nulls = [v.isNull() for v in values]
    return [F.xxhash64(*values, *nulls).alias("_d1"), F.xxhash64(F.lit(71), *nulls, *values).alias("_d2")]


def _short(rows: DataFrame) -> DataFrame:
    """The digests in 31 bits each: sums of their multiples cannot overflow."""
    return rows.withColumns({c: F.pmod(c, F.lit(1 << 31)) for c in ("_d1", "_d2")})


def _places(bits: int) -> list[Column]:
    return [F.pmod(F.col("_d1") + F.col("_d2") * F.lit(i), F.lit(bits).cast("long")) for i in range(HASHES)]


def bloom_words(digests: DataFrame, bits: int) -> DataFrame:
    """One row: the filter's bits as an array of 64-bit words."""
    places = digests.select(F.explode(F.array(*_places(bits))).alias("p"))
    words = places.groupBy(F.expr("p div 64").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.expr("CAST(p % 64 AS INT)"))).alias("b"))
    every = digests.sparkSession.range(bits // 64).withColumnRenamed("id", "w")
    full = every.join(words, "w", "left").select("w", F.coalesce("b", F.lit(0).cast("long")).alias("b"))
    return full.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda s: s["b"]).alias("words"))


def dedupe_by_digest(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct rows; the same as `dropDuplicates()` on all columns.

    `rows` is read three times (digests, unique rows, suspects): give it a stored
    table, not a frame that is costly to compute.  Columns of map type cannot be
    hashed.  The number of repeated digests sets the filter's size, up to `max_bits`;
    with more of them the share of suspects grows and the result stays the same.
    """
    names = rows.columns
    return _dedupe_named(rows.select("*", *digest(names)), names, max_bits)


def _dedupe_named(named: DataFrame, names: list[str], max_bits: int) -> DataFrame:
    """The same on rows that carry their digests."""
    spark = named.sparkSession
    checkpoint_dir(spark)
    counted = named.groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("n"))
    repeated = _short(counted.where("n > 1")).checkpoint(eager=True)
    bits = MIN_BITS
    count, copies, most = repeated.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    while bits < min(max_bits, BITS_PER_KEY * count):
        bits *= 2
    filter_ = bloom_words(repeated, bits).checkpoint(eager=True).scalar()
    held = F.lit(True)
    for p in _places(bits):
        held = held & (F.bit_get(F.get(filter_, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1)
    # Behind a one-row generator the test is a column, and is not run once for each filter above it.
    tagged = _short(named).select(*names, F.inline(F.array(F.struct(held.alias("_suspect")))))
    unique = tagged.where("NOT _suspect").select(*names)
    # A compressed split holds millions of rows, too many to be aggregated whole in one
    # task: suspects are dealt to tasks of a bounded number of rows first.  Where a row
    # is frequent, a salt spreads its copies and each task folds its share of them.
    suspects = tagged.where("_suspect").select(*names, F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt"))
    by = [F.col(f"`{c}`") for c in names] + (["_salt"] if most > FREQUENT else [])
    tasks = tasks_for(spark, copies)
    dealt = suspects.repartition(tasks, *by) if tasks > 1 else suspects     # few are folded where they are read
    return unique.unionByName(dealt.select(*names).dropDuplicates())


def distinct_stored(rows: DataFrame, few: int = FEW_ROWS) -> DataFrame:
    """Distinct rows of a stored table; the same as `dropDuplicates()` on all columns.
    Of more than `few` rows only digests and suspects are shuffled."""
    return rows.dropDuplicates() if rows.count() <= few else dedupe_by_digest(rows)


def distinct_rows(rows: DataFrame, few: int = FEW_ROWS) -> DataFrame:
    """Distinct rows of any frame; the same as `dropDuplicates()` on all columns.

    `rows` is computed once, into a table of the shared folder that the result reads.
    A whole-row aggregate would hold as many rows as a map task makes, spill them and
    shuffle all of them; from the table only digests and suspects are shuffled.
    """
    spark = rows.sparkSession
    path = work_path(spark, "rows")
    named = rows.select("*", *digest(rows.columns))         # counting reads the stored digests alone
    named.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(named.schema).parquet(path)
    if stored.count() <= few:
        return stored.select(*[F.col(f"`{c}`") for c in rows.columns]).dropDuplicates()
    return _dedupe_named(stored, rows.columns, MAX_BITS)
