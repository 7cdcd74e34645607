"""HL7 flattening: envelopes -> wide patient rows, long field rows, extras.

Everything is projections (plus generators for the long form) over the
envelope columns: no join, no shuffle, no Python.  The wide path is three
projections: split each used segment once, split each used field once, then
read every mapped value from the split parts.  Catalyst keeps them apart
because each intermediate array is read by several columns (it does not
inline expensive expressions referenced more than once).  Expressions are
built as SQL text and applied with one `selectExpr` per projection.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow import layout
from segflow.functions import hl7
from segflow.functions.hl7 import ident, sql_str

# A place as one number: segment * SEGMENT_PLACE + field * FIELD_PLACE + component.
SEGMENT_PLACE, FIELD_PLACE = 10 ** 16, 10 ** 8
ENTRY_TYPE = "array<struct<key:string,value:string>>"


def _segment_text(df: DataFrame, seg: str) -> str:
    """The envelope column holding segment `seg` (lower-cased names), or NULL."""
    return ident(seg) if seg in df.columns else "CAST(NULL AS STRING)"


def _fields_name(seg: str) -> str:
    return f"__fields_{seg}"


def _text_name(seg: str, field: int) -> str:
    return f"__t_{seg}_{field}"


def _parts_name(seg: str, field: int, rep: int | None) -> str:
    return f"__c_{seg}_{field}" + ("" if rep is None else f"_{rep}")


def _field_parts(cols: list[layout.Column], numbered: bool) -> list[str]:
    """Second projection: each used field's components, split once.  Default mode
    splits the last repetition and keeps the text of a repeated field for values that
    are blank there; numbered mode splits the repetitions it reads."""
    out, seen = [], set()
    for c in cols:
        p = c.pos
        text = hl7.field_sql(ident(_fields_name(p.segment)), p.field)
        if numbered:
            key = (p.segment, p.field, p.rep or 1)
            if key not in seen:
                seen.add(key)
                k = p.rep or 1
                # The first repetition needs no array: the text before any `~`.
                rep = (f"substring_index({text}, '~', 1)" if k == 1
                       else f"get(split({text}, {sql_str(hl7.REP_SEP)}), {k - 1})")
                out.append(f"split({rep}, {sql_str(hl7.COMP_SEP)}) AS "
                           f"{ident(_parts_name(p.segment, p.field, p.rep or 1))}")
            continue
        key = (p.segment, p.field)
        if key not in seen:
            seen.add(key)
            out.append(f"CASE WHEN contains({text}, '~') THEN {text} END AS {ident(_text_name(p.segment, p.field))}")
            out.append(f"split(substring_index({text}, '~', -1), {sql_str(hl7.COMP_SEP)}) AS "
                       f"{ident(_parts_name(p.segment, p.field, None))}")
    return out


def _value(pos: layout.Position, numbered: bool) -> str:
    """Third projection: one mapped value from the pre-split parts."""
    if numbered:
        parts = ident(_parts_name(pos.segment, pos.field, pos.rep or 1))
        return hl7.not_blank_sql(f"get({parts}, {pos.component - 1})")
    parts = ident(_parts_name(pos.segment, pos.field, None))
    text = ident(_text_name(pos.segment, pos.field))
    # Earlier repetitions are searched only for a value that is blank in the last one.
    return f"coalesce({hl7.not_blank_sql(f'get({parts}, {pos.component - 1})')}, {hl7.last_component_sql(text, pos.component)})"


def single_value_sql(pos: layout.Position) -> str:
    """One mapped value straight from its segment column (default reading)."""
    text = hl7.field_sql(f"({hl7.segment_fields_sql(ident(pos.segment), pos.segment)})", pos.field)
    return hl7.last_component_sql(text, pos.component)


def extras_exclusions(seg: str, rules: layout.IgnoreRules, field_map=layout.FIELD_MAP,
                      numbered: bool = False) -> tuple[list[int], list[str]]:
    """Fields and positional keys of `seg` that never go to `extras`:
    whole ignored fields, mapped positions (unnumbered names only, unless in
    numbered mode), component-ignored positions of typed fields, and
    unnumbered ignored names."""
    fields = sorted(f for s, f in rules.seg_fields if s == seg)
    keys = {c.pos.key for c in layout.columns(field_map)
            if c.pos.segment == seg and (numbered or c.pos.rep is None)}
    for (s, f), dt in rules.datatypes.items():
        if s == seg:
            keys.update(f"{s}_{f}_{c}" for d, c in rules.components if d == dt)
    keys.update(f"{s}_{f}_{c}" for s, f, c, r in rules.names if s == seg and r is None)
    return fields, sorted(keys)


def flatten_wide(envelopes: DataFrame,
                 segments: Iterable[str] = layout.HL7_SEGMENTS,
                 keep: Iterable[str] = ("patientid", "dob"),
                 numbered: bool = False,
                 extras: bool = False,
                 rename: bool = True,
                 rules: layout.IgnoreRules | None = None,
                 field_map=layout.FIELD_MAP) -> DataFrame:
    """One wide row per envelope.

    Columns: `keep` (metadata, default patientid and dob), then one string
    column per mapped position of the chosen segments (business names, or
    raw names with `rename=False`), then `extras map<string,string>` of
    unmapped, un-ignored values when `extras=True`.  In numbered mode `extras`
    also holds the repetitions of mapped positions that have no name of their
    own (`pid_11_1_3`), so no repetition is lost.  Expects lower-cased
    envelope names (see `shape.lower_case_names`).
    """
    rules = rules or layout.ignore_rules()
    segs = [s.lower() for s in segments]
    cols = layout.wide_columns(segs, numbered=numbered, rules=rules, field_map=field_map)
    return _read_columns(envelopes, cols, segs, keep, numbered, extras, rename, rules, field_map)


def _read_columns(envelopes: DataFrame, cols: list[layout.Column], segs: list[str], keep: Iterable[str], numbered: bool = False,
                  extras: bool = False, rename: bool = True, rules: layout.IgnoreRules | None = None,
                  field_map=layout.FIELD_MAP) -> DataFrame:
    keep = [ident(k) for k in keep]
    used = [s for s in segs if extras or any(c.pos.segment == s for c in cols)]

    split = envelopes.selectExpr(*keep, *[
        f"{hl7.segment_fields_sql(_segment_text(envelopes, s), s)} AS {ident(_fields_name(s))}"
        for s in used])
    carried = [ident(_fields_name(s)) for s in used] if extras else []
    parts = split.selectExpr(*keep, *carried, *_field_parts(cols, numbered))

    out = list(keep)
    for c in cols:
        out.append(f"{_value(c.pos, numbered)} AS {ident(c.name if rename else c.raw)}")
    if extras:
        entries = []
        for s in used:
            ex_fields, ex_keys = extras_exclusions(s, rules, field_map, numbered)
            e = hl7.field_entries_sql(s, ident(_fields_name(s)), ex_fields, ex_keys)
            entries.append(f"coalesce({e}, CAST(array() AS {ENTRY_TYPE}))")
            more = repetition_entries(s, rules, field_map) if numbered else None
            if more:
                entries.append(more)
        merged = f"concat({', '.join(entries)})" if entries else f"CAST(array() AS {ENTRY_TYPE})"
        out.append(f"map_from_entries({merged}) AS extras")
    return parts.selectExpr(*out)


def observed_places(envelopes: DataFrame, segments: Iterable[str] = layout.HL7_SEGMENTS) -> list[tuple[str, int, int]]:
    """(segment, field, component) of every place that holds a value somewhere.

    Every value of a segment is first written as one `x`, so messages that fill the
    same places look alike: these shapes fold in every map task, and only different
    ones are taken apart.  The places are few (they name columns) and are collected.
    """
    segs = [s.lower() for s in segments]
    value = sql_str("[^|~^]*[^|~^ ][^|~^]*")
    structs = ", ".join(
        f"named_struct('seg', {sql_str(s)}, 'shape', CASE WHEN startswith({t}, {sql_str(s.upper() + '|')}) "
        f"THEN regexp_replace({t}, {value}, 'x') END)" for s in segs for t in [_segment_text(envelopes, s)])
    shapes = envelopes.selectExpr(f"inline(array({structs}))").where("shape IS NOT NULL").distinct()
    split = shapes.selectExpr("seg", f"split(shape, {sql_str(hl7.FIELD_SEP)}) AS fields")
    places = _explode_fields(split, []).select("seg", "field", "comp").distinct()
    return sorted((r.seg, r.field, r.comp) for r in places.collect())


def flatten_observed(envelopes: DataFrame, keep: Iterable[str] = ("patientid", "dob"),
                     segments: Iterable[str] = layout.HL7_SEGMENTS, rules: layout.IgnoreRules | None = None,
                     field_map=layout.FIELD_MAP, places: Iterable[tuple[str, int, int]] | None = None) -> DataFrame:
    """Union-of-keys widening.  Columns are what the data contains, names sorted:
    mapped places under their business names, others that are not ignored under
    positional ones; missing values NULL.

    `places` are found by `observed_places` unless given (from another frame with the
    same places, such as the envelopes before a dedupe, or from a registry).  Values
    are read like those of `flatten_wide`; no map is built.
    """
    rules = rules or layout.ignore_rules()
    segs = [s.lower() for s in segments]
    seen = sorted(observed_places(envelopes, segs) if places is None else places)
    cols = {c.name: c for c in layout.wide_columns(segs, rules=rules, field_map=field_map)
            if (c.pos.segment, c.pos.field, c.pos.component) in set(seen)}
    for s in segs:
        fields, keys = extras_exclusions(s, rules, field_map)
        for seg, f, c in seen:
            key = f"{seg}_{f}_{c}"
            if seg == s and f not in fields and key not in keys and key not in cols:
                cols[key] = layout.Column(key, key, layout.Position(seg, f, "", c, None))
    return _read_columns(envelopes, [cols[n] for n in sorted(cols)], segs, keep)


def segments_long(envelopes: DataFrame,
                  segments: Iterable[str] = layout.HL7_SEGMENTS,
                  keep: Iterable[str] = ("patientid", "id")) -> DataFrame:
    """One row per non-blank component value.

    Columns: `keep`, seg (lower-case id), field, rep, comp (all 1-based),
    value (as written).  Three chained generators over the split arrays; no
    shuffle.
    """
    k = [ident(x) for x in keep]
    segs = [s.lower() for s in segments]
    structs = ", ".join(
        f"named_struct('seg', {sql_str(s)}, 'fields', "
        f"{hl7.segment_fields_sql(_segment_text(envelopes, s), s)})" for s in segs)
    stacked = envelopes.selectExpr(*k, f"inline(array({structs}))")
    return _explode_fields(stacked, k)


def occurrences_long(segments: DataFrame, keep: Iterable[str] = ("patientid", "id")) -> DataFrame:
    """X12 over segment rows (seg, occurrence, text), as `blob_segments` gives
    them: keep, seg, occurrence, field, rep, comp, value.  No shuffle."""
    k = [*[ident(x) for x in keep], "occurrence"]
    split = segments.selectExpr(*k, "seg", f"split(text, {sql_str(hl7.FIELD_SEP)}) AS fields")
    return _explode_fields(split, k)


def _explode_fields(stacked: DataFrame, k: list[str]) -> DataFrame:
    """(k, seg, fields) -> one row per non-blank component value."""
    fields = stacked.selectExpr(*k, "seg", "posexplode(fields) AS (field, _ftext)") \
        .where("field > 0 AND trim(_ftext) <> ''")      # a blank field has blank components only
    return _explode_reps(fields, k)


def _explode_reps(fields: DataFrame, k: list[str]) -> DataFrame:
    """(k, seg, field, _ftext) -> one row per non-blank component value."""
    reps = fields.selectExpr(*k, "seg", "field",
                             f"posexplode(split(_ftext, {sql_str(hl7.REP_SEP)})) AS (_rep0, _rtext)")
    comps = reps.selectExpr(*k, "seg", "field", "_rep0 + 1 AS rep",
                            f"posexplode(split(_rtext, {sql_str(hl7.COMP_SEP)})) AS (_comp0, value)")
    return comps.where("trim(value) <> ''").selectExpr(
        *k, "seg", "field", "rep", "_comp0 + 1 AS comp", "value")


def _in_list(expr: str, keys) -> str:
    keys = sorted(keys)
    if not keys:
        return "false"
    return f"{expr} IN ({', '.join(sql_str(x) for x in keys)})"


def _in_numbers(expr: str, numbers) -> str:
    numbers = sorted(set(numbers))
    return f"({expr}) IN ({', '.join(f'{n}L' for n in numbers)})" if numbers else "false"


def ignore_predicate_sql(rules: layout.IgnoreRules | None = None, seg: str = "seg",
                         field: str = "field", comp: str = "comp", rep: str = "rep",
                         numbered: bool = False) -> str:
    """X6-X8 on long rows: true for rows the ignore lists drop.

    Names that end in a repetition number are names of numbered mode only, so
    they drop nothing unless `numbered`; there they drop that repetition.

    Three hash-set lookups (`IN` over literal keys becomes an InSet), so the
    check stays in the generated code of the scan stage; no join is needed.
    """
    rules = rules or layout.ignore_rules()
    sf = [f"{s}_{f}" for s, f in rules.seg_fields]
    comp_keys = set()
    for (s, f), dt in rules.datatypes.items():
        comp_keys.update(f"{s}_{f}_{c}" for d, c in rules.components if d == dt)
    comp_keys.update(f"{s}_{f}_{c}" for s, f, c, r in rules.names if r is None)
    rep_keys = [f"{s}_{f}_{c}_{r}" for s, f, c, r in rules.names if numbered and r is not None]
    k2 = f"concat_ws('_', {seg}, CAST({field} AS STRING))"
    k3 = f"concat_ws('_', {k2}, CAST({comp} AS STRING))"
    k4 = f"concat_ws('_', {k3}, CAST({rep} AS STRING))"
    return f"({_in_list(k2, sf)} OR {_in_list(k3, comp_keys)} OR {_in_list(k4, rep_keys)})"


def ignore_predicate(rules: layout.IgnoreRules | None = None, numbered: bool = False) -> Column:
    return F.expr(ignore_predicate_sql(rules, numbered=numbered))


def apply_ignore_lists(long_rows: DataFrame, rules: layout.IgnoreRules | None = None,
                       numbered: bool = False) -> DataFrame:
    """Drop ignored positions from long rows."""
    return long_rows.where(f"NOT {ignore_predicate_sql(rules, numbered=numbered)}")


def _unnamed_repetitions(seg: str, rules: layout.IgnoreRules, field_map=layout.FIELD_MAP) -> dict[int, tuple]:
    """Mapped fields of `seg` -> (named, components, taken): repetitions 1 to `named` have
    a name at every mapped component, so a text that holds no more of them has none
    without a name; `taken` lists the (component, repetition) that are named or ignored."""
    listed = {k: v for k, v in layout.listed_repetitions(field_map).items() if k.startswith(seg + "_")}
    taken = {tuple(map(int, k.split("_")[1:])) + (r,) for k, reps in listed.items() for r in reps}
    taken |= {(f, c, r) for s, f, c, r in rules.names if s == seg and r is not None}
    mapped = sorted(tuple(map(int, k.split("_")[1:])) for k in listed)
    mapped = [(f, c) for f, c in mapped if not rules.drops(seg, f, c)]
    out = {}
    for f in sorted({f for f, _ in mapped}):
        comps = [c for g, c in mapped if g == f]
        reps = [listed[f"{seg}_{f}_{c}"] for c in comps]
        named = min(next(r for r in range(len(x) + 1) if r + 1 not in x) for x in reps)
        out[f] = (named, comps, sorted((c, r) for g, c, r in taken if g == f))
    return out


def repetition_entries(seg: str, rules: layout.IgnoreRules, field_map=layout.FIELD_MAP) -> str | None:
    """SQL: entries of the mapped positions of `seg` whose repetition has no
    business name in numbered mode, under `seg_field_comp_rep` keys.

    Places are compared as numbers; keys are spelt for the entries that stay.
    """
    fields = ident(_fields_name(seg))
    parts = []
    for f, (named, comps, spots) in _unnamed_repetitions(seg, rules, field_map).items():
        text = hl7.field_sql(fields, f)
        entries = (f"flatten(transform(split({text}, {sql_str(hl7.REP_SEP)}), (r, i) -> "
                   f"transform(split(r, {sql_str(hl7.COMP_SEP)}), (v, j) -> "
                   f"named_struct('comp', j + 1, 'rep', i + 1, 'value', v))))")
        at = f"e.comp * {hl7.PLACE}L + e.rep"
        kept = (f"filter({entries}, e -> e.comp IN ({', '.join(map(str, comps))}) AND trim(e.value) <> '' AND NOT "
                + (f"{at} IN ({', '.join(f'{c * hl7.PLACE + r}L' for c, r in spots)})" if spots else "false") + ")")
        spelt = (f"transform({kept}, e -> named_struct('key', concat('{seg}_{f}_', CAST(e.comp AS STRING), '_', "
                 f"CAST(e.rep AS STRING)), 'value', e.value))")
        parts.append(f"CASE WHEN substring_index({text}, '~', {named}) <> {text} THEN {spelt} END" if named else spelt)
    if not parts:
        return None
    return "concat(" + ", ".join(f"coalesce({p}, CAST(array() AS {ENTRY_TYPE}))" for p in parts) + ")"


def extras_long(wide: DataFrame, keep: Iterable[str] = ("patientid",)) -> DataFrame:
    """X11 as rows from a wide frame's `extras` map: (keep..., key, value).

    Behind a one-row generator the map is a column: Spark infers a filter on the size of
    what is exploded, which would else be pushed under the projection and build the map
    a second time."""
    k = [ident(x) for x in keep]
    return wide.selectExpr(*k, "inline(array(struct(extras AS extras)))").selectExpr(*k, "explode(extras) AS (key, value)")


def extras_rows(envelopes: DataFrame,
                segments: Iterable[str] = layout.HL7_SEGMENTS,
                keep: Iterable[str] = ("patientid", "id"),
                rules: layout.IgnoreRules | None = None,
                field_map=layout.FIELD_MAP, numbered: bool = False) -> DataFrame:
    """X11 straight from envelopes as rows (keep..., key, value), without
    lambdas: generators explode segments, fields and components.  A field
    without repetitions is split once; of others the candidate component
    numbers (1 + the number of `^` in the field bounds any repetition's
    component count) each read their value by regex, like the wide path.  Same result
    as `extras_long(flatten_wide(..., extras=True))`.  With `numbered` the
    repetitions of mapped places that have no name follow, under
    `seg_field_comp_rep` keys, from chained generators over the fields that can
    hold one.
    """
    rules = rules or layout.ignore_rules()
    k = [ident(x) for x in keep]
    segs = [s.lower() for s in segments]
    number = {s: i for i, s in enumerate(segs)}
    ex_fields, ex_places = [], []
    for s in segs:
        f, keys = extras_exclusions(s, rules, field_map, numbered)
        ex_fields += [(s, i, 0) for i in f]
        ex_places += [(s, *map(int, key.split("_")[1:])) for key in keys]

    def listed(at: str, places) -> str:
        """Whether a place is in a list, by its number; keys are spelt for rows that stay."""
        return _in_numbers(at, [number[s] * SEGMENT_PLACE + f * FIELD_PLACE + c for s, f, c in places])

    structs = ", ".join(
        f"named_struct('seg', {sql_str(s)}, 'at', {number[s] * SEGMENT_PLACE}L, 'fields', "
        f"{hl7.segment_fields_sql(_segment_text(envelopes, s), s)})" for s in segs)
    stacked = envelopes.selectExpr(*k, f"inline(array({structs}))")
    # `at` is the segment's number up to here, the field's from here on.
    every = stacked.selectExpr(*k, "seg", "at", "posexplode(fields) AS (field, ftext)").where("field > 0 AND trim(ftext) <> ''")
    every = every.selectExpr(*k, "seg", f"at + field * {FIELD_PLACE}L AS at", "field", "ftext")
    known = f"field < {FIELD_PLACE}"
    fields = every.where(f"NOT ({known} AND {listed('at', ex_fields)})")
    # A field without repetitions is split once; of one with some, component numbers are candidates.
    cands = fields.selectExpr(
        *k, "seg", "at", "field", "ftext",
        f"posexplode(CASE WHEN NOT contains(ftext, '~') THEN split(ftext, {sql_str(hl7.COMP_SEP)}) ELSE "
        "array_repeat(CAST(NULL AS STRING), 1 + length(ftext) - length(replace(ftext, '^', ''))) END) AS (c0, single)")
    cands = cands.where(f"(single IS NULL OR trim(single) <> '') AND NOT ({known} AND c0 + 1 < {FIELD_PLACE} AND "
                        f"{listed('at + c0 + 1', ex_places)})")
    pattern = (f"concat({sql_str('(?s)^(?:.*~)?(?:[^~^]*' + chr(92) + '^){')}, "
               f"CAST(c0 AS STRING), {sql_str('}([^~^]*[^~^ ][^~^]*)(?:[~^].*)?$')})")
    value = f"CASE WHEN single IS NOT NULL THEN single ELSE nullif(regexp_extract(ftext, {pattern}, 1), '') END"
    # Behind a one-row generator the value is a column: the test below does not read it a second time.
    read = cands.selectExpr(*k, "seg", "field", "c0", f"inline(array(struct({value} AS value)))").where("value IS NOT NULL")
    out = read.selectExpr(*k, "concat_ws('_', seg, CAST(field AS STRING), CAST(c0 + 1 AS STRING)) AS key", "value")
    if not numbered:
        return out
    fields, once, places, taken = [], [], [], []
    for s in segs:
        for f, (named, comps, spots) in _unnamed_repetitions(s, rules, field_map).items():
            fields.append((s, f, 0))
            if named:
                once.append((s, f, 0))
            places += [(s, f, c) for c in comps]
            taken += [f"{s}_{f}_{c}_{r}" for c, r in spots]
    more = every.where(f"{known} AND {listed('at', fields)} AND (contains(ftext, '~') OR NOT {listed('at', once)})")
    rows = _explode_reps(more.withColumnRenamed("ftext", "_ftext"), [*k, "at"])
    rows = rows.where(f"comp < {FIELD_PLACE} AND {listed('at + comp', places)}")
    key = "concat_ws('_', seg, CAST(field AS STRING), CAST(comp AS STRING), CAST(rep AS STRING))"
    rows = rows.selectExpr(*k, f"inline(array(struct({key} AS key)))", "value")
    return out.unionByName(rows.where(f"NOT {_in_list('key', taken)}"))
