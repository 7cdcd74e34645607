"""End-to-end plans: envelopes -> patient rows -> sinks.

`patient_rows` is the whole nightly job as one lazy plan:
lower-case names -> state filter -> dedupe -> flatten (expressions only).
The dedupe is its only shuffle.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow import layout
from segflow.operators import deadletter, extract, filters, shape
from segflow.operators.dedupe import distinct_rows
from segflow.session import written
from segflow.sinks import tables
from segflow.sinks.commitlog import CommitLog


def prepared(envelopes: DataFrame, dedupe: bool = True) -> DataFrame:
    """S4 + P1: exact duplicates removed (envelopes are computed once), names lower-cased."""
    df = distinct_rows(envelopes) if dedupe else envelopes
    return shape.lower_case_names(df)


def _state_first(envelopes: DataFrame, states: Iterable[str], rules=None) -> DataFrame | None:
    """F1 on envelopes: rows whose state is kept, before anything is shuffled.

    The state is read once, behind a one-row generator, so the filter cannot be
    pushed into the message text as a repeated expression.  None if the layout
    has no state column here.
    """
    found = [c for c in layout.wide_columns(rules=rules) if c.name == filters.STATE_COLUMN]
    if not found or found[0].pos.segment not in envelopes.columns:
        return None
    value = extract.single_value_sql(found[0].pos)
    state = f"inline(array(named_struct('__state', {value})))"
    return envelopes.selectExpr("*", state).where(F.col("__state").isin(list(states))).drop("__state")


def patient_rows(envelopes: DataFrame,
                 segments: Iterable[str] = layout.HL7_SEGMENTS,
                 states: Iterable[str] | None = layout.STATES,
                 dedupe: bool = True, **flatten_opts) -> DataFrame:
    """The reference job's output rows for one run (before the sink).

    The state filter runs on the envelopes, below the dedupe: rejected rows are
    neither shuffled nor flattened.  Equal envelopes have equal states, so the
    order does not matter.
    """
    segments = list(segments)
    df = shape.lower_case_names(envelopes)
    kept = None
    if states is not None and not flatten_opts.get("numbered"):
        states = list(states)
        if "pid" in [x.lower() for x in segments]:
            kept = _state_first(df, states, flatten_opts.get("rules"))
    df = df if kept is None else kept
    df = df.dropDuplicates() if dedupe else df
    wide = extract.flatten_wide(df, segments=segments, **flatten_opts)
    return filters.keep_states(wide, states) if states is not None and kept is None else wide


def run_feeds_jdbc(envelopes: DataFrame, feeds: Iterable[str], url: str, properties: dict,
                   version: str = layout.TABLE_VERSION, evolve_ddl=None,
                   dead_table: str | None = None, **opts) -> dict[str, int]:
    """K1-K3, K5 for a relational sink: flatten once, append to one table per feed.

    The source is read and parsed once: tagged envelopes are written to the shared
    folder, and both the good and the dead ones are taken from there.  Dead envelopes
    go to `dead_table` (by default `<version>_dead_letters`).  The flattened rows are
    written there too, so each feed's write reads them back instead of running the
    dedupe again.  An empty result skips the writes (F2).  Names are truncated for
    the database (P5).
    """
    with written(deadletter.tag_envelopes(envelopes), "tagged") as tagged:
        good, dead = deadletter.tagged_parts(tagged)
        if filters.has_rows(dead):
            tables.append_jdbc(dead, url, dead_table or f"{version}_dead_letters", properties)
        out = {}
        with written(shape.truncate_names(patient_rows(good, **opts)), "rows") as rows:
            if filters.has_rows(rows):
                for feed in feeds:
                    table = layout.table_name(feed, version)
                    if evolve_ddl is not None:
                        out[table] = tables.append_jdbc_evolving(rows, url, table, properties, evolve_ddl)
                    else:
                        out[table] = tables.append_jdbc(rows, url, table, properties)
        return out


def run_feeds_parquet(envelopes: DataFrame, feeds: Iterable[str], base_path: str,
                      version: str = layout.TABLE_VERSION, dead_path: str | None = None,
                      run: str | None = None, **opts) -> dict[str, int]:
    """K1-K3, K5 Parquet twin: a single job writes every feed's table directory.

    The source is read and parsed once (see `run_feeds_jdbc`).  Dead envelopes are
    appended to `dead_path` (by default `<base_path>_dead`).  Neither path is touched
    when there is nothing to write to it (F2).  With `run` both tables have a commit
    log: a run that is repeated, after a success or a failure, leaves one copy, and
    `tables.read_committed` reads them.
    """
    dead_path = dead_path or f"{base_path.rstrip('/')}_dead"
    feeds = list(feeds)
    done = CommitLog(envelopes.sparkSession, base_path).find(run) if run is not None else None
    if done is not None:                    # the feeds are committed last
        return {layout.table_name(f, version): done.rows // len(feeds) for f in feeds}
    with written(deadletter.tag_envelopes(envelopes), "tagged") as tagged:
        good, dead = deadletter.tagged_parts(tagged)
        if run is not None:
            tables.append_once(dead, dead_path, run, skip_empty=True)
        elif filters.has_rows(dead):
            tables.append_parquet(dead, dead_path)
        rows = shape.truncate_names(patient_rows(good, **opts))
        if run is not None:
            return tables.write_feeds_once(rows, base_path, feeds, run, version)
        # Rows are there after the dedupe if some are there before it; that needs no shuffle.
        if not filters.has_rows(patient_rows(good, **{**opts, "dedupe": False})):
            return {}
        return tables.write_feeds_parquet(rows, base_path, feeds, version)
