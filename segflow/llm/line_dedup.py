"""Line dedup: sharded cuckoo filters backed by exact reference-count tables.

A line's key is the line without white space at its ends and with A-Z lower-cased,
named by a 128-bit hash.  The reference-count table holds, for each key, the number
of documents with it.  Keys are dealt into shards by their hash; a shard's cuckoo
filter holds a 32-bit fingerprint of each key that stands in `min_docs` documents or
more.  Adding documents adds to the counts and inserts the keys that reach the
threshold; removing documents subtracts and deletes the keys that fall below it, which
a cuckoo filter allows and a Bloom filter does not.  Adding and then removing documents
gives back the state before.

A filter may take a key for another.  The counts hold every key there is, so each shard
probes its own filter with its rare keys and keeps those that it wrongly accepts as
exceptions: filter and exceptions together answer exactly.

Documents are stripped where they are read while all filters together stay under a
checked size; beyond it the lines meet the counts in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.llm.common import arrow_map, cut, texts

MIN_DOCS = 10
SHARD_KEYS = 1 << 16            # keys of a shard, about
MIN_BITS = 8                    # 256 shards at least
FILTER_BYTES = 32 << 20         # filters that are sent to every task, at most
SLOTS, LOAD, KICKS = 4, 0.85, 500
FLUSH_KEYS = 200_000            # keys that a task counts before it hands them on
U = np.uint64


def key_of(line: bytes) -> bytes:
    """bytes.strip and bytes.lower know ASCII only: 0x20, 0x09-0x0D and A-Z."""
    return line.strip().lower()


def _digests(lines: list[bytes]) -> list[bytes]:
    """128-bit name of each line's key; empty for an empty key."""
    return [xxhash.xxh3_128_digest(k) if k else b"" for k in map(key_of, lines)]


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), U).reshape(-1, 2)


_FACTOR, _ALL = 0xFF51AFD7ED558CCD, (1 << 64) - 1


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(33))) * U(_FACTOR)
    return h ^ (h >> U(33))


def _mix_one(h: int) -> int:
    h = ((h ^ (h >> 33)) * _FACTOR) & _ALL
    return h ^ (h >> 33)


class Cuckoo:
    """Cuckoo filter: two buckets of four slots a key, 32-bit fingerprints, 0 for a free slot."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots
        self.mask = len(slots) - 1

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 1
        while buckets * SLOTS * LOAD < keys:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint32))

    @classmethod
    def of(cls, keys: np.ndarray) -> Cuckoo:
        """Filter of (n, 2) keys; doubled until all find a place."""
        size = len(keys)
        while True:
            made = cls.sized(size)
            if all(made.insert(*place) for place in made.each(keys)):
                return made
            size = 2 * max(size, 1)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first bucket, fingerprint) of each key."""
        print_ = (keys[:, 1] >> U(32)).astype(np.uint32)
        return (keys[:, 0] & U(self.mask)).astype(np.int64), np.where(print_ == 0, 1, print_).astype(np.uint32)

    def each(self, keys: np.ndarray) -> Iterator[tuple[int, int]]:
        a, f = self.places(keys)
        return zip(a.tolist(), f.tolist())

    def other(self, bucket: int, fingerprint: int) -> int:
        return bucket ^ (_mix_one(fingerprint) & self.mask)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        a, f = self.places(keys)
        b = a ^ (_mix(f.astype(U)) & U(self.mask)).astype(np.int64)
        return (np.concatenate([self.slots[a], self.slots[b]], axis=1) == f[:, None]).any(axis=1)

    def insert(self, bucket: int, fingerprint: int) -> bool:
        """False if no place is found; the filter must then be built anew."""
        for at in (bucket, self.other(bucket, fingerprint)):
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = fingerprint
                return True
        for kick in range(KICKS):
            seat = (kick + fingerprint) % SLOTS
            fingerprint, self.slots[at, seat] = int(self.slots[at, seat]), fingerprint
            at = self.other(at, fingerprint)
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = fingerprint
                return True
        return False

    def delete(self, bucket: int, fingerprint: int) -> bool:
        for at in (bucket, self.other(bucket, fingerprint)):
            held = np.flatnonzero(self.slots[at] == fingerprint)
            if len(held):
                self.slots[at, held[0]] = 0
                return True
        return False


@dataclass
class LineState:
    """counts: h1, h2, n (documents that hold the key, 1 or more).  filters: shard,
    slots, exceptions (16 bytes a key), one row a shard that holds keys."""

    counts: DataFrame
    filters: DataFrame
    bits: int
    min_docs: int


def key_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(h1, h2, n): documents (rows) that hold each key; folded per task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            h = _halves(list(n)).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(list(n.values()), pa.int64())], names=["h1", "h2", "n"])

        n: Counter[bytes] = Counter()
        for b in batches:
            for text in b.column("text").cast(pa.large_binary()):
                n.update(set(_digests(text.as_py().split(b"\n"))) - {b""})
                if len(n) >= FLUSH_KEYS:
                    yield rows()
                    n.clear()
        if n:
            yield rows()

    return (arrow_map(texts(docs, id_col, text_col).select("text"), "line_dedup", run, "h1 long, h2 long, n long")
            .groupBy("h1", "h2").agg(F.sum("n").alias("n")))


def _shard(bits: int):
    return F.shiftrightunsigned("h1", 64 - bits)


def _bits(keys: int) -> int:
    return max(MIN_BITS, (max(keys, 1) // SHARD_KEYS).bit_length())


def _refresh(old: DataFrame | None, keys: DataFrame, bits: int, min_docs: int) -> DataFrame:
    """Filters after an update; keys: h1, h2, n (now), was (before).

    A shard's keys are bounded (SHARD_KEYS), so one task holds them at a time."""
    def shard_row(shard: int, held: bytes | None, t: pa.Table) -> pa.Table:
        k = np.stack([t.column(c).to_numpy() for c in ("h1", "h2")], axis=1).view(U).reshape(-1, 2)
        hot, was_hot = (t.column(c).to_numpy() >= min_docs for c in ("n", "was"))
        made = None
        if held is not None:
            made = Cuckoo(np.frombuffer(held, np.uint32).reshape(-1, SLOTS).copy())
            for place in made.each(k[was_hot & ~hot]):
                made.delete(*place)
            if not all(made.insert(*place) for place in made.each(k[hot & ~was_hot])):
                made = None                                   # too full
        if made is None:
            made = Cuckoo.of(k[hot])
        rare = k[~hot & (t.column("n").to_numpy() > 0)]
        wrong = rare[made.contains(rare)] if len(rare) else rare
        return pa.table({"shard": pa.array([shard], pa.int64()), "slots": pa.array([made.slots.tobytes()], pa.binary()),
                         "exceptions": pa.array([wrong.tobytes()], pa.binary())})

    schema = "shard long, slots binary, exceptions binary"
    dealt = keys.withColumn("shard", _shard(bits))
    if old is None:
        return dealt.groupBy("shard").applyInArrow(lambda key, t: shard_row(key[0].as_py(), None, t), schema)

    def both(key, f: pa.Table, t: pa.Table) -> pa.Table:
        held = f.column("slots")[0].as_py() if f.num_rows else None
        if not t.num_rows:
            return f.select(["shard", "slots", "exceptions"])
        return shard_row(key[0].as_py(), held, t)

    return old.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInArrow(both, schema)


def empty_state(spark: SparkSession, min_docs: int = MIN_DOCS) -> LineState:
    return LineState(spark.createDataFrame([], "h1 long, h2 long, n long"),
                     spark.createDataFrame([], "shard long, slots binary, exceptions binary"), 0, min_docs)


def change(state: LineState, docs: DataFrame, sign: int = 1, id_col: str = "doc_id", text_col: str = "text",
           keep=cut) -> LineState:
    """The state with the documents added (sign 1) or removed (-1).

    Removing a document that was never added stops with an error.  `keep` writes a
    frame and gives it back (by default a checkpoint)."""
    delta = key_counts(docs, id_col, text_col).withColumn("n", F.col("n") * sign)
    if state.bits == 0:                                        # nothing there yet
        merged = delta.withColumn("was", F.lit(0).cast("long"))
    else:
        merged = (state.counts.withColumn("was", F.col("n"))
                  .unionByName(delta.withColumn("was", F.lit(0).cast("long")))
                  .groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.sum("was").alias("was")))
    wrong = F.raise_error(F.lit("documents are removed that were never added")).cast("long")
    merged = keep(merged.withColumn("n", F.when(F.col("n") >= 0, F.col("n")).otherwise(wrong)))
    bits = _bits(merged.count())
    old = state.filters if bits == state.bits else None
    filters = keep(_refresh(old, merged, bits, state.min_docs))
    return LineState(merged.where("n > 0").select("h1", "h2", "n"), filters, bits, state.min_docs)


class Repeated:
    """All shards' filters and exceptions in flat arrays, for probes of many keys."""

    def __init__(self, rows, bits: int):
        self.bits = bits
        self.base, self.mask = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, U)
        parts, at = [np.zeros((1, SLOTS), np.uint32)], 1       # bucket 0: shards without keys
        for r in rows:
            slots = np.frombuffer(bytes(r.slots), np.uint32).reshape(-1, SLOTS)
            self.base[r.shard], self.mask[r.shard] = at, len(slots) - 1
            parts.append(slots)
            at += len(slots)
        self.slots = np.concatenate(parts)
        self.exceptions = {bytes(r.exceptions)[i: i + 16] for r in rows for i in range(0, len(r.exceptions), 16)}

    def __call__(self, digests: list[bytes]) -> np.ndarray:
        full = [d or bytes(16) for d in digests]
        keys = _halves(full)
        shard = (keys[:, 0] >> U(64 - self.bits)).astype(np.int64)
        mask = self.mask[shard]
        f = (keys[:, 1] >> U(32)).astype(np.uint32)
        f[f == 0] = 1
        a = keys[:, 0] & mask
        b = a ^ (_mix(f.astype(U)) & mask)
        base = self.base[shard]
        hit = ((self.slots[base + a.astype(np.int64)] == f[:, None]).any(axis=1)
               | (self.slots[base + b.astype(np.int64)] == f[:, None]).any(axis=1))
        for i in np.flatnonzero(hit):
            hit[i] = bool(digests[i]) and full[i] not in self.exceptions
        return hit


def _kept(batch_ids, values: list[bytes], gone) -> pa.RecordBatch:
    """gone(digests, owner): which of all lines go; owner is the document of each."""
    lines = [text.split(b"\n") for text in values]
    counts = np.array([len(x) for x in lines], np.int64)
    ends = np.cumsum(counts)
    drop = gone(_digests([x for own in lines for x in own]), np.repeat(np.arange(len(values)), counts))
    dropped = np.zeros(len(values), np.int64)
    np.add.at(dropped, np.searchsorted(ends, np.flatnonzero(drop), "right"), 1)
    out = [text if not d else b"\n".join(x for x, g in zip(own, drop[z - len(own): z]) if not g)
           for text, own, d, z in zip(values, lines, dropped, ends)]
    return pa.RecordBatch.from_arrays(
        [batch_ids, pa.array(counts), pa.array(dropped), pa.array(out, pa.string())],
        names=["doc_id", "n_lines", "n_dropped", "text"])


KEPT = "doc_id long, n_lines long, n_dropped long, text string"


def strip_lines(docs: DataFrame, state: LineState, id_col: str = "doc_id", text_col: str = "text",
                filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per document: doc_id, n_lines (before), n_dropped, text (lines that stay).

    Lines whose key is empty or not in the counts always stay.  Up to `filter_bytes`
    the filters go to every task and no text is shuffled; with more, lines are joined
    with the counts.  The rows are the same either way.
    """
    src = texts(docs, id_col, text_col)
    size = state.filters.agg(F.sum(F.length("slots") + F.length("exceptions"))).first()[0] or 0
    if size <= filter_bytes:
        rows, bits = state.filters.collect(), max(state.bits, 1)
        repeated = Repeated(rows, bits)                        # bounded by the check above

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                values = b.column("text").cast(pa.large_binary()).to_pylist()
                yield _kept(b.column("doc_id"), values, lambda digests, _: repeated(digests))

        return arrow_map(src, "line_dedup", run, KEPT)

    def name(b: pa.RecordBatch, values: list[bytes]) -> list[bytes]:
        return [xxhash.xxh3_128_digest(f"{i}:".encode() + t) for i, t in zip(b.column("doc_id").to_pylist(), values)]

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column("text").cast(pa.large_binary()).to_pylist()
            for row, text in zip(name(b, values), values):
                keys = list(set(_digests(text.split(b"\n"))) - {b""})
                if keys:
                    h = _halves(keys).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * len(keys), pa.binary()), pa.array(h[:, 0]), pa.array(h[:, 1])], names=["row", "h1", "h2"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column("text").cast(pa.large_binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(name(b, values), pa.binary())],
                                             names=["doc_id", "text", "row"])

    hot = state.counts.where(F.col("n") >= state.min_docs).select("h1", "h2")
    # A row that stands twice gives the same lines twice; a set holds them once.
    gone = (arrow_map(src, "line_dedup", lines, "row binary, h1 long, h2 long").join(hot, ["h1", "h2"])
            .groupBy("row").agg(F.collect_set(F.struct("h1", "h2")).alias("gone")))
    joined = (arrow_map(src, "line_dedup", named, "doc_id long, text string, row binary")
              .join(gone, "row", "left").select("doc_id", "text", F.col("gone.h1").alias("h1"), F.col("gone.h2").alias("h2")))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [{np.array([x, y], np.int64).tobytes() for x, y in zip(h1 or (), h2 or ())}
                    for h1, h2 in zip(b.column("h1").to_pylist(), b.column("h2").to_pylist())]
            values = b.column("text").cast(pa.large_binary()).to_pylist()
            yield _kept(b.column("doc_id"), values, lambda digests, owner: np.array([d in keys[i] for d, i in zip(digests, owner)], bool))

    return arrow_map(joined, "line_dedup", strip, KEPT)


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text",
               filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, text without repeated lines.

    Lines whose key stands in `min_docs` documents or more go everywhere.  Defined
    cases: null and empty text are one empty line; empty keys never go; each row
    counts as a document, also with a null or repeated id; a key counts once a
    document however often it stands there; a text whose lines all go is empty; lines
    may have any length; an empty table gives no rows; extra columns are not read.
    Keys are compared by 128-bit hash.
    """
    state = change(empty_state(docs.sparkSession, min_docs), docs, 1, id_col, text_col)
    return strip_lines(docs, state, id_col, text_col, filter_bytes)


class LineStore:
    """A line state kept under a folder, one version an update.

    Tables of a version are written first and its row of the log last, so readers see
    whole versions only; an update that failed halfway is written over by the next.  An
    update is named by its batch: one that the log holds already is not applied again.
    One writer at a time.
    """

    LOG = "version long, batch string, change string, bits int, min_docs int"

    def __init__(self, spark: SparkSession, path: str, min_docs: int = MIN_DOCS):
        self.spark, self.path, self.min_docs = spark, path.rstrip("/"), min_docs

    def log(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.LOG).parquet(f"{self.path}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.LOG)

    def state(self) -> LineState:
        last = self.log().orderBy(F.desc("version")).first()
        if last is None:
            return empty_state(self.spark, self.min_docs)
        if last.min_docs != self.min_docs:
            raise ValueError(f"the store was made with min_docs {last.min_docs}")
        counts, filters = (self.spark.read.parquet(f"{self.path}/{t}/version={last.version}") for t in ("counts", "filters"))
        return LineState(counts.where("n > 0").select("h1", "h2", "n"), filters, last.bits, last.min_docs)

    def _apply(self, batch: str, docs: DataFrame, sign: int, id_col: str, text_col: str) -> bool:
        known = self.log()
        if not known.where((F.col("batch") == batch) & (F.col("change") == str(sign))).isEmpty():
            return False
        version = (known.agg(F.max("version")).first()[0] or 0) + 1
        names = iter(("counts", "filters"))

        def keep(df: DataFrame) -> DataFrame:
            path = f"{self.path}/{next(names)}/version={version}"
            df.write.mode("overwrite").parquet(path)
            return self.spark.read.parquet(path)

        state = change(self.state(), docs, sign, id_col, text_col, keep)
        row = [(version, batch, str(sign), state.bits, state.min_docs)]
        self.spark.createDataFrame(row, self.LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        return True

    def insert(self, batch: str, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> bool:
        """Add a batch of documents; False if that batch was added before."""
        return self._apply(batch, docs, 1, id_col, text_col)

    def delete(self, batch: str, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> bool:
        """Remove documents (the same texts as were added); False if that was done before."""
        return self._apply(batch, docs, -1, id_col, text_col)

    def strip(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              filter_bytes: int = FILTER_BYTES) -> DataFrame:
        return strip_lines(docs, self.state(), id_col, text_col, filter_bytes)
