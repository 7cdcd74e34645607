"""K7: the index of known patients against the full anti join."""

import os

from pyspark.sql import functions as F

from segflow.operators import patients
from segflow.operators.known_patients import KnownPatients


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def messages(spark, lo, hi, step=1):
    return spark.range(lo, hi, step).select(F.concat(F.lit("p"), F.col("id")).alias("patientid"), F.lit("m").alias("id"))


def test_three_batches_equal_the_anti_join(spark, tmp_dir):
    index = KnownPatients(spark, os.path.join(tmp_dir, "k"), buckets=4)
    nobody = spark.createDataFrame([(None, "m"), ("p7", "again")], "patientid string, id string")
    batches = [messages(spark, 0, 3000, 2).unionByName(nobody), messages(spark, 0, 1000), messages(spark, 2500, 4000).unionByName(nobody)]
    known = batches[0].where("false")
    for k, batch in enumerate(batches):
        assert rows_of(index.new_patients(batch)) == rows_of(patients.new_patients(batch, known))
        assert index.add(batch, f"b{k}") and not index.add(batch, f"b{k}")
        known = known.unionByName(batch)
    assert index.new_patients(batches[1]).count() == 0
    assert rows_of(index.ids()) == rows_of(known.select("patientid").where("patientid IS NOT NULL").distinct())


def test_a_batch_reads_matching_buckets_only(spark, tmp_dir, monkeypatch):
    index = KnownPatients(spark, os.path.join(tmp_dir, "k"), buckets=32)
    index.add(messages(spark, 0, 5000), "a")
    read, plain = [], KnownPatients._read

    def logged(self, table, schema, places, buckets):
        if table == "ids":
            read.append(len(list(buckets)))
        return plain(self, table, schema, places, buckets)

    monkeypatch.setattr(KnownPatients, "_read", logged)
    assert index.new_patients(messages(spark, 10, 11)).count() == 0 and read == [1]       # one known patient
    read.clear()
    fresh = messages(spark, 100_000, 100_300)
    assert index.new_patients(fresh).count() == 300 and read[0] <= 16                    # false positives of the filter only
    before = index.manifest()
    index.add(messages(spark, 200_000, 200_001), "b")
    assert len({b for b, v in index.manifest().items() if before[b] != v}) == 1
    index.add(messages(spark, 0, 0), "empty")
    assert index.ids().count() == 5001
