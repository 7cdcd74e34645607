"""K7: an index of known patients, so that a batch reads few of them.

Ids are kept in key-hash buckets, each with a blocked Bloom filter: an id falls into one
block of 1,024 bits and sets a few of them.  A batch meets the blocks of its own ids; an
id whose bits are not all set is new, without a look at any list.  For the others only
the buckets that hold such an id are read and compared exactly.  Adding a batch
rewrites the buckets of its new ids (copy-on-write) and commits a manifest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.session import checkpoint_dir, written
from segflow.sinks.commitlog import CommitLog

BUCKETS = 64
WORDS = 16                  # 64-bit words of a block
KEYS_A_BLOCK = 80           # about 13 bits an id, 1 % false positives
HASHES = 5


class KnownPatients:
    """`buckets` is fixed when the index is made.  One writer at a time."""

    MANIFEST = "bucket int, version long, blocks int"

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, key: str = "patientid"):
        self.spark, self.path, self.buckets, self.key = spark, path.rstrip("/"), buckets, key
        self.log = CommitLog(spark, self.path)
        checkpoint_dir(spark)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def manifest(self) -> dict[int, tuple[int, int]]:
        """bucket -> (version that holds it, blocks of its filter)."""
        head = self.log.head()
        if head is None:
            return {}
        rows = self.spark.read.schema(self.MANIFEST).parquet(f"{self.path}/{head.folder}").collect()    # one row a bucket
        return {r.bucket: (r.version, r.blocks) for r in rows}

    def _read(self, table: str, schema: str, places: dict[int, tuple[int, int]], buckets) -> DataFrame:
        folders = [f"{self.path}/{table}/version={places[b][0]}/bucket={b}" for b in sorted(buckets) if b in places]
        if not folders:
            return self.spark.createDataFrame([], f"{schema}, bucket int")
        rows = self.spark.read.schema(f"{schema}, bucket int, version long").option("basePath", f"{self.path}/{table}")
        return rows.parquet(*folders).drop("version")

    def ids(self, buckets=None) -> DataFrame:
        places = self.manifest()
        return self._read("ids", f"{self.key} string", places, places if buckets is None else buckets).select(self.key)

    @staticmethod
    def _bits() -> list[Column]:
        """Places inside a block that an id sets, ten bits of a second hash each."""
        return [F.pmod(F.shiftright("g", 10 * i), F.lit(64 * WORDS)).cast("int") for i in range(HASHES)]

    def _placed(self, ids: DataFrame, blocks: DataFrame) -> DataFrame:
        """ids with bucket, block and hash bits; blocks: (bucket, blocks), one row a bucket."""
        rows = ids.withColumn("bucket", self._bucket()).join(F.broadcast(blocks), "bucket")
        return rows.withColumn("block", F.pmod(F.xxhash64(F.lit(3), self.key), F.col("blocks")).cast("int")) \
            .withColumn("g", F.xxhash64(F.lit(5), self.key))

    def new_patients(self, batch: DataFrame) -> DataFrame:
        """Patients of `batch` that are not in the index, with their message count: the
        rows of `patients.new_patients` against all known ones.  Messages without a
        patient are left out."""
        per_patient = batch.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.count(F.lit(1)).alias("n_messages"))
        places = self.manifest()
        if not places:
            return per_patient
        size = self.spark.createDataFrame([(b, n) for b, (_, n) in places.items()], "bucket int, blocks int")
        filters = self._read("filters", "block int, words array<bigint>", places, places)
        held = F.lit(True)
        for at in self._bits():
            held = held & F.coalesce(F.bit_get(F.get("words", F.floor(at / 64).cast("int")), at % 64) == 1, F.lit(False))
        placed = self._placed(per_patient, size).join(filters, ["bucket", "block"], "left")
        suspects = placed.where(held).select(self.key, "bucket").checkpoint(eager=True)
        touched = [r[0] for r in suspects.select("bucket").distinct().collect()]            # at most `buckets`
        known = suspects.join(self.ids(touched), self.key, "left_semi")
        return per_patient.join(known.select(self.key), self.key, "left_anti")

    def add(self, batch: DataFrame, run: str) -> bool:
        """Put the batch's patients into the index; False if that run's are in."""
        if self.log.find(run):
            return False
        head = self.log.head()
        version = head.version + 1 if head else 1
        places = self.manifest()
        fresh = self.new_patients(batch).select(self.key).withColumn("bucket", self._bucket())
        with written(fresh, "fresh") as new:
            counts = {r.bucket: r["count"] for r in new.groupBy("bucket").count().collect()}
            old = self._read("ids", f"{self.key} string", places, counts)
            rows = old.select(self.key, "bucket").unionByName(new.select(self.key, "bucket"))
            with written(rows, "bucket-ids") as whole:
                sizes = {r.bucket: max(1, -(-r["count"] // KEYS_A_BLOCK)) for r in whole.groupBy("bucket").count().collect()}
                if sizes:
                    (whole.repartition(len(sizes), "bucket").write.mode("overwrite").partitionBy("bucket")
                     .parquet(f"{self.path}/ids/version={version}"))
                    size = self.spark.createDataFrame(list(sizes.items()), "bucket int, blocks int")
                    spots = self._placed(whole.select(self.key), size).select("bucket", "block", F.explode(F.array(*self._bits())).alias("at"))
                    words = spots.groupBy("bucket", "block", F.floor(F.col("at") / 64).cast("int").alias("w")).agg(
                        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at") % 64)).alias("b"))
                    blocks = words.groupBy("bucket", "block").agg(F.map_from_entries(F.collect_list(F.struct("w", "b"))).alias("m"))
                    full = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.coalesce(F.try_element_at("m", w), F.lit(0).cast("long")))
                    (blocks.select("bucket", "block", full.alias("words")).repartition(len(sizes), "bucket")
                     .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/filters/version={version}"))
        now = {**places, **{b: (version, n) for b, n in sizes.items()}}
        folder = f"manifest/version={version}"
        rows = [(b, v, n) for b, (v, n) in sorted(now.items())]
        self.spark.createDataFrame(rows, self.MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{folder}")
        self.log.commit(run, folder, sum(counts.values()))
        return True
