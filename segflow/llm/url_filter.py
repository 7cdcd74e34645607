"""URL filters: sort-merge range join of page urls with nested host and path rules.

A host is keyed by its labels in reverse order, each followed by a dot, and the path
follows behind a slash ("blog.example.org" with "/es/" -> "org.example.blog.//es/").
A rule covers the interval of all keys that begin with its own, from the key itself to
the key with a byte FF behind it, which no UTF-8 text reaches; intervals are nested or
apart.  Walking the keys in order, a stack of rules is pushed where an interval opens
and popped where it closes.  Only its top matters for a page, the longest rule so far, so
an opening carries its own rule and a closing the rule below it, the longest shorter
rule of the same host that its path begins with.

A rule also holds for subdomains, so a page asks once for each of its host's ancestors
(bounded by the host's labels) that has rules at all; the longest answer wins.

The boundaries are dealt into key ranges of about SEGMENT events.  A range begins with
the top of the stack at its start, so ranges are swept apart; one with many pages is
split into several sweeps, each with the range's few events.  Events copied that way stay
a small share of the pages, however many rules there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segflow.llm.common import cut

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SEGMENT = 2_000             # rule boundaries of one range, about
SWEEP = 250_000             # page keys of one sweep, about
MOST_RANGES = 2_000         # their bounds are literals in the plan

# Rules of the registered query: (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
TOP = "struct<n:int,verdict:string,rule:string>"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first "://" up to / ? # or the end, A-Z
    lower-cased; path from there up to ? # or the end.  Null, or no "://": both
    empty."""
    rest = F.when(url.contains("://"), F.regexp_replace(url, "(?s)^.*?://", ""))
    host = F.regexp_extract(rest, "(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return (F.coalesce(F.translate(host, UPPER, UPPER.lower()), empty), F.coalesce(path, empty))


def host_key(host: Column) -> Column:
    """Reversed-host canonical key; the empty host has the empty key."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, "[.]", -1)), "."), F.lit(".")))


def key(host: Column, path: Column) -> Column:
    """Key of a rule or a page as bytes."""
    return F.encode(F.concat(host_key(host), F.lit("/"), path), "UTF-8")


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """A list of rules as a frame, made of literals."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    none = F.expr("CAST(array() AS array<struct<verdict:string,host:string,path:string>>)")
    return spark.range(1).select(F.inline(F.array(*rows) if rows else none))


def boundary_events(rules: DataFrame) -> DataFrame:
    """(key, top): where an interval opens or closes, and the rule that holds from there
    on.  `top` has null fields where none does.

    The rule below a rule is found by joining its path's beginnings, at the lengths that
    rules of its host have, with the rules on equality."""
    r = rules.select(F.translate("host", UPPER, UPPER.lower()).alias("host"), "path", "verdict").where("host IS NOT NULL AND path IS NOT NULL")
    # Of two verdicts for one place the larger text counts: block before allow.
    r = r.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    r = cut(r.withColumn("top", F.expr("struct(CAST(length(concat(host, path)) AS int) AS n, verdict, concat(host, path) AS rule)")))
    lengths = r.groupBy("host").agg(F.array_sort(F.collect_set(F.length("path"))).alias("lengths"))
    shorter = (r.join(lengths, "host").select("host", "path", F.explode("lengths").alias("l")).where("l < length(path)")
               .select("host", "path", F.expr("substr(path, 1, l)").alias("start")))
    held = r.select("host", F.col("path").alias("start"), F.col("top").alias("outer"))
    below = shorter.join(held, ["host", "start"]).groupBy("host", "path").agg(F.max("outer").alias("below"))
    place = key(F.col("host"), F.col("path"))
    opens = r.select(place.alias("key"), F.col("top").cast(TOP).alias("top"))
    nothing = F.expr(f"CAST(named_struct('n', NULL, 'verdict', NULL, 'rule', NULL) AS {TOP})")
    closes = (r.join(below, ["host", "path"], "left")
              .select(F.concat(place, F.unhex(F.lit("FF"))).alias("key"), F.coalesce(F.col("below").cast(TOP), nothing).alias("top")))
    return opens.unionByName(closes)


def _range_of(place: str, bounds: list[bytes]) -> Column:
    """Number of bounds that are not above a key, by two steps through them."""
    step = max(1, int(len(bounds) ** 0.5))
    rows = [bounds[i: i + step] for i in range(0, len(bounds), step)]

    def listed(values: list[bytes]) -> str:
        return "array(" + ", ".join(f"X'{b.hex()}'" for b in values) + ")"

    if not rows:
        return F.lit(0)
    heads = listed([x[0] for x in rows])
    inner = "array(" + ", ".join(map(listed, rows)) + ")"
    row = f"greatest(size(filter({heads}, b -> b <= {place})) - 1, 0)"
    return F.expr(f"{row} * {step} + size(filter(get({inner}, {row}), b -> b <= {place}))")


def _ranged(events: DataFrame) -> tuple[DataFrame, list[bytes]]:
    """(key, top, part) with the top at each range's start, and the ranges' bounds."""
    events = cut(events)
    ranges = min(MOST_RANGES, max(1, events.count() // SEGMENT))
    if ranges > 1:
        events = cut(events.repartitionByRange(ranges, "key").withColumn("part", F.spark_partition_id()))
    else:
        events = events.withColumn("part", F.lit(0))
    # One row a range: its first key, and the top after its last event.  Openings and
    # closings never share a key, so the order of events is total.
    ends = events.groupBy("part").agg(F.min("key").alias("first"), F.max_by("top", "key").alias("last")).orderBy("part").collect()
    bounds = [bytes(r["first"]) for r in ends[1:]]
    number = {r.part: k for k, r in enumerate(ends)}               # empty ranges have no number
    if len(ends) > 1:
        order = F.array(*[F.lit(number.get(p, 0)) for p in range(max(number) + 1)])
        events = events.withColumn("part", F.get(order, F.col("part")))
    starts = [F.struct(F.unhex(F.lit("")).alias("key"),
                       F.struct(F.lit(r.last.n).cast("int").alias("n"), F.lit(r.last.verdict).cast("string").alias("verdict"),
                                F.lit(r.last.rule).cast("string").alias("rule")).alias("top"), F.lit(k + 1).alias("part"))
              for k, r in enumerate(ends[:-1])]
    if starts:
        first = events.sparkSession.range(1).select(F.inline(F.array(*starts)))
        events = events.select("key", "top", "part").unionByName(first)
    return events.select("key", "top", "part"), bounds


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", sweep: int = SWEEP,
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    Defined cases: null or malformed urls have empty host and path, no rule and
    the default verdict; urls of any length are keyed whole; a null page id is passed on;
    repeated rows are judged each; rules of equal length are told apart by verdict
    (block before allow) and text; rules without a host or path fit nothing; an empty
    rules or pages table works; extra columns are not read.
    """
    host, path = url_parts(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    events, bounds = _ranged(boundary_events(rules))
    # Each different place once; of its host's ancestors those that have rules.
    ruled = rules.select(F.translate("host", UPPER, UPPER.lower()).alias("ancestor")).where("ancestor IS NOT NULL").distinct()
    chain = F.expr("transform(sequence(1, size(split(host, '[.]', -1))), i -> array_join(slice(split(host, '[.]', -1), i, "
                   "size(split(host, '[.]', -1))), '.'))")
    asked = rows.select("host", "path").distinct().withColumn("ancestor", F.explode(chain)).join(ruled, "ancestor", "left_semi")
    asked = asked.withColumn("key", key(F.col("ancestor"), F.col("path"))).withColumn("part", _range_of("key", bounds))
    asked = cut(asked.select("host", "path", "key", "part"))
    sweeps = asked.groupBy("part").agg(F.expr(f"CAST(ceil(count(1) / {sweep}) AS int)").alias("sweeps"))   # one row a range
    places = (asked.join(F.broadcast(sweeps), "part")
              .withColumn("sweep", F.expr("pmod(xxhash64(host, path), sweeps)")).drop("sweeps").withColumn("is_page", F.lit(1)))
    copies = (events.join(F.broadcast(sweeps), "part").withColumn("sweep", F.explode(F.expr("sequence(0L, CAST(sweeps AS bigint) - 1)")))
              .drop("sweeps").withColumn("is_page", F.lit(0)))
    order = Window.partitionBy("part", "sweep").orderBy("key", "is_page").rowsBetween(Window.unboundedPreceding, 0)
    top = (places.unionByName(copies, allowMissingColumns=True)
           .withColumn("top", F.last("top", ignorenulls=True).over(order)).where("is_page = 1 AND top.rule IS NOT NULL"))
    best = top.groupBy("host", "path").agg(F.max("top").alias("best")).repartition("best", "host", "path")
    return (rows.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
