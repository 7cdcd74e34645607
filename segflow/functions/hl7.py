"""Expressions over pipe-delimited HL7 v2 segment text.

All of these are built-in Spark SQL expressions (no Python UDF): a segment is
split once on `|` into its fields; a field splits on `~` into repetitions and a
repetition on `^` into components.  Element 0 of the field array is the segment
id, so field n is element n.

Blank means empty after `trim` (spaces only).  The default reading of a
component is the last repetition whose value is not blank; a blank in the
last repetition leaves an earlier value standing.

Each builder returns Spark SQL expression text (`*_sql`), so a projection of
hundreds of columns is handed to the JVM in one `selectExpr` call; the
`Column` forms wrap the same text with `F.expr` for single use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELD_SEP = r"\|"
REP_SEP = "~"
COMP_SEP = r"\^"
PLACE = 1_000_000_000       # a place as one number: field * PLACE + component


def sql_str(value: str) -> str:
    """A Spark SQL string literal for `value`."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def segment_fields_sql(text: str, seg_id: str) -> str:
    """array<string> of the segment's fields, NULL unless it is a `seg_id` segment.

    A NULL, empty or foreign segment therefore contributes nothing, and every
    value read from it is NULL (the row itself survives).
    """
    sid = seg_id.upper()
    return (f"CASE WHEN startswith({text}, {sql_str(sid + '|')}) OR {text} = {sql_str(sid)} "
            f"THEN split({text}, {sql_str(FIELD_SEP)}) END")


def field_sql(fields: str, n: int) -> str:
    """Field n (1-based) of a field array; NULL when absent (no ANSI error)."""
    return f"get({fields}, {n})"


def not_blank_sql(v: str) -> str:
    return f"CASE WHEN trim({v}) <> '' THEN {v} END"


def last_component_pattern(comp: int) -> str:
    """Regex whose group 1 is component `comp` of the last repetition in which
    it holds a non-space character: skip greedily to the latest `~` after
    which that component is not blank."""
    return r"(?s)^(?:.*~)?(?:[^~^]*\^){%d}([^~^]*[^~^ ][^~^]*)(?:[~^].*)?$" % (comp - 1)


def last_component_sql(field_text: str, comp: int) -> str:
    """Component `comp` of the last repetition in which it is not blank.
    One regex, no lambda, so it stays inside generated code."""
    return f"nullif(regexp_extract({field_text}, {sql_str(last_component_pattern(comp))}, 1), '')"


def nth_component_sql(field_text: str, comp: int, rep: int) -> str:
    """Component `comp` of repetition `rep` (both 1-based); blank -> NULL."""
    v = (f"get(split(get(split({field_text}, {sql_str(REP_SEP)}), {rep - 1}), "
         f"{sql_str(COMP_SEP)}), {comp - 1})")
    return not_blank_sql(v)


def last_component_hof_sql(field_text: str, comp: int) -> str:
    """Same result as `last_component_sql`, written with higher-order
    functions; the readable definition the regex is tested against."""
    return (f"try_element_at(filter(transform(split({field_text}, {sql_str(REP_SEP)}), "
            f"r -> get(split(r, {sql_str(COMP_SEP)}), {comp - 1})), v -> trim(v) <> ''), -1)")


def field_entries_sql(seg_id: str, fields: str, excluded_fields: list[int],
                      excluded_keys: list[str]) -> str:
    """array<struct<key,value>> of every non-blank component of a segment.

    Keys are positional (`pid_6_1`); repetitions collapse to the last
    non-blank value.  Fields in `excluded_fields` and keys in `excluded_keys`
    are left out.  Used for the `extras` map of unmapped values.  Each
    field's repetitions are split once and bound to a lambda variable.
    """
    seg = seg_id.lower()
    # Entries carry their place as one number until the filter is through: literal IN
    # lists become hash-set look-ups, and keys are spelt for the entries that stay.
    places = [tuple(map(int, k.split("_")[1:])) for k in excluded_keys]
    plain = sorted({f for f, c in places if c == 1})
    ex_f = f"i IN ({', '.join(str(i) for i in sorted(excluded_fields))})" if excluded_fields else "false"
    # A field whose one value stands at an excluded place gives nothing.
    ex_f += f" OR (i IN ({', '.join(map(str, plain))}) AND NOT contains(f, '^') AND NOT contains(f, '~'))" if plain else ""
    ex_k = f"e.at IN ({', '.join(f'{f * PLACE + c}L' for f, c in sorted(places))})" if places else "false"
    empty = "CAST(array() AS array<struct<at:bigint,value:string>>)"
    per_comp = (f"c -> named_struct('at', i * {PLACE}L + c, 'value', aggregate(reps, CAST(NULL AS STRING), "
                f"(acc, r) -> CASE WHEN trim(get(r, c - 1)) <> '' THEN get(r, c - 1) ELSE acc END))")
    with_reps = (f"reps -> transform(sequence(1, array_max(transform(reps, r -> size(r)))), "
                 f"{per_comp})")
    reps = (f"transform(split(f, {sql_str(REP_SEP)}), r -> split(r, {sql_str(COMP_SEP)}))")
    # Fast path for a field without repetitions: its components in one pass.
    single = (f"transform(split(f, {sql_str(COMP_SEP)}), (v, j) -> named_struct('at', i * {PLACE}L + j + 1, "
              f"'value', CASE WHEN trim(v) <> '' THEN v END))")
    per_field = (f"(f, i) -> CASE WHEN i = 0 OR trim(f) = '' OR {ex_f} "
                 f"THEN {empty} WHEN NOT contains(f, '~') THEN {single} "
                 f"ELSE get(transform(array({reps}), {with_reps}), 0) END")
    key = f"concat({sql_str(seg + '_')}, CAST(e.at div {PLACE}L AS STRING), '_', CAST(e.at % {PLACE}L AS STRING))"
    return (f"transform(filter(flatten(transform({fields}, {per_field})), "
            f"e -> e.value IS NOT NULL AND NOT {ex_k}), e -> named_struct('key', {key}, 'value', e.value))")


# Column forms --------------------------------------------------------------

def segment_fields(text: str, seg_id: str) -> Column:
    return F.expr(segment_fields_sql(ident(text), seg_id))


def last_component(field_text: str, comp: int) -> Column:
    return F.expr(last_component_sql(ident(field_text), comp))


def last_component_hof(field_text: str, comp: int) -> Column:
    return F.expr(last_component_hof_sql(ident(field_text), comp))


def nth_component(field_text: str, comp: int, rep: int) -> Column:
    return F.expr(nth_component_sql(ident(field_text), comp, rep))
