"""K5: dead letters are kept, replayed, and parked after a number of attempts.

A store holds the letters that wait.  A replay parses them again, after a repair if
one is given: those that are good now leave the store as envelopes, the others wait
for the next replay until they have had `max_attempts`, then they are parked.  Each
change is one commit, so a letter is always in exactly one of the three places: good +
waiting + parked = letters added.  A run that is repeated changes nothing.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.operators.deadletter import tag_documents
from segflow.session import written
from segflow.sinks.commitlog import CommitLog
from segflow.sources.envelope import CORRUPT, ENVELOPE

MAX_ATTEMPTS = 3
LETTER = "body string, reason string, attempts int, added string"


def letters_of(dead: DataFrame) -> DataFrame:
    """(body, reason) of dead rows: the text itself where it is at hand (a document's
    `json`, text that did not parse), else the envelope's columns as JSON."""
    names = [c for c in dead.columns if c not in (CORRUPT, "reason", "key", "json", "batch_id")]
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])) if names else F.lit(None).cast("string")
    texts = [F.col(c) for c in ("json", CORRUPT) if c in dead.columns]
    return dead.select(F.coalesce(*texts, body).alias("body"), "reason")


class DeadLetterStore:
    def __init__(self, spark: SparkSession, path: str, max_attempts: int = MAX_ATTEMPTS):
        self.spark, self.path, self.max_attempts = spark, path.rstrip("/"), max_attempts
        self.log = CommitLog(spark, self.path)

    def _folders(self, table: str) -> list[str]:
        """Committed folders that hold `table`.  A replay rewrites what waits, so only
        the last replay's folder and letters added after it count there."""
        entries = self.log.entries()
        replays = [e for e in entries if e.folder.startswith("replay/")]
        if table == "waiting":
            since = replays[-1].version if replays else 0
            found = [e.folder for e in entries if e.version > since] + [f"{e.folder}/waiting" for e in replays[-1:]]
        else:
            found = [f"{e.folder}/{table}" for e in replays]
        return [f"{self.path}/{f}" for f in found]

    def _read(self, table: str, schema: str) -> DataFrame:
        folders = self._folders(table)
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def waiting(self) -> DataFrame:
        return self._read("waiting", LETTER)

    def parked(self) -> DataFrame:
        return self._read("parked", LETTER)

    def good(self) -> DataFrame:
        """Envelopes that a replay made of letters, with the attempts they took."""
        columns = ", ".join(f"`{f.name}` string" for f in ENVELOPE.fields)
        return self._read("good", f"{columns}, attempts int, added string")

    def add(self, dead: DataFrame, run: str) -> bool:
        """Keep a run's dead rows; False if that run's are here already."""
        if self.log.find(f"add-{run}"):
            return False
        folder = f"added/{run}"
        rows = letters_of(dead).select("body", "reason", F.lit(0).alias("attempts"), F.lit(run).alias("added"))
        rows.write.mode("overwrite").parquet(f"{self.path}/{folder}")
        self.log.commit(f"add-{run}", folder)
        return True

    def replay(self, run: str, repair: Callable[[DataFrame], DataFrame] | None = None) -> bool:
        """Parse all that waits again; False if that replay is done already.

        `repair` gets the letters and may change `body`; a letter that stays dead keeps
        its own text and gets the new reason.  Text is parsed once.
        """
        if self.log.find(f"replay-{run}"):
            return False
        letters = self.waiting().withColumnRenamed("reason", "last").withColumn("kept", F.col("body"))
        folder = f"replay/{run}"
        base = f"{self.path}/{folder}"
        tagged = tag_documents(repair(letters) if repair else letters, "body")
        tagged = tagged.withColumn("attempts", F.col("attempts") + 1)
        with written(tagged, "replay") as copy:
            good = copy.where("reason IS NULL").select(
                *[F.col(f"_e.`{f.name}`").alias(f.name) for f in ENVELOPE.fields], "attempts", "added")
            good.write.mode("overwrite").parquet(f"{base}/good")
            still = copy.where("reason IS NOT NULL").select(F.col("kept").alias("body"), "reason", "attempts", "added")
            spent = F.col("attempts") >= self.max_attempts
            still.where(spent).write.mode("overwrite").parquet(f"{base}/parked")
            still.where(~spent).write.mode("overwrite").parquet(f"{base}/waiting")
        self.log.commit(f"replay-{run}", folder)
        return True
