"""Column-shape operators: names, renames, truncation, observed widening."""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow import layout


def lower_case_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name, by position."""
    return df.toDF(*[c.lower() for c in df.columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str] | Iterable[tuple[str, str]]
                   = layout.FIELD_MAP) -> DataFrame:
    """Raw name -> business name in one projection; absent names are no-ops."""
    pairs = dict(mapping)
    present = {k: v for k, v in pairs.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def truncate_names(df: DataFrame) -> DataFrame:
    """P5: names over 63 bytes cut to their first 62 characters.

    Raises when two columns would end up with the same name (the reference
    did not check; a silent clash would make the append fail later).
    """
    names = [layout.truncated_name(c) for c in df.columns]
    if len(set(names)) != len(names):
        dup = sorted({n for n in names if names.count(n) > 1})
        raise ValueError(f"column names collide after truncation: {dup}")
    return df.toDF(*names) if names != df.columns else df


def observed_columns(df: DataFrame, fixed: Iterable[str], extras_col: str = "extras") -> list[str]:
    """Names of the fixed columns that hold a value somewhere, plus every
    `extras` key seen.

    Two aggregates: one row of flags, and the distinct keys (folded in every map
    task, then shuffled by key).  The keys are the result's column names, so
    they must reach the driver; a table cannot have more of them than the
    driver can plan.
    """
    fixed = list(fixed)
    flags = df.agg(*[F.max(F.col(c).isNotNull().cast("int")).alias(f"_{i}") for i, c in enumerate(fixed)]).first() \
        if fixed else {}
    keys = sorted(r[0] for r in df.select(F.explode(F.map_keys(extras_col)).alias("_k")).distinct().collect())
    names = [c for i, c in enumerate(fixed) if flags[f"_{i}"] == 1]
    return names + [k for k in keys if k not in names]


def observed_wide(df: DataFrame, keep: Iterable[str] = ("patientid", "dob"),
                  extras_col: str = "extras", sort: bool = True,
                  materialize: bool = False) -> DataFrame:
    """Union-of-keys widening.  Columns are what the data contained: the
    mapped columns with at least one value and one column per `extras` key,
    missing values NULL, names sorted.

    Finding the columns needs a pass over the data (like schema inference).
    With `materialize=True` the input is first checkpointed into the shared
    checkpoint folder, so the discovery pass and the final read both scan
    that copy instead of flattening twice.
    """
    keep = list(keep)
    if materialize:
        from segflow.session import checkpoint_dir

        checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    fixed = [c for c in df.columns if c not in keep and c != extras_col]
    names = observed_columns(df, fixed, extras_col)
    if sort:
        names = sorted(names)
    exprs = [F.col(c) if c in fixed else F.col(extras_col).getItem(c).alias(c) for c in names]
    return df.select(*[F.col(c) for c in keep], *exprs)
