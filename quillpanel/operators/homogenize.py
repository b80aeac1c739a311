"""Homogenize: one name and one coding for a variable across waves. One projection for each table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillpanel.operators.clean import coerce_types
from quillpanel.plans.mapping import Issue, MapColumns, MapRow, check_mapping, clean_mapping, merge_codings, parse_coding
from quillpanel.session import qcol

Bundle = dict[str, dict[int, DataFrame | None]]


@dataclass
class Homogenized:
    bundle: Bundle
    mapping: list[MapRow]
    issues: list[Issue] = field(default_factory=list)
    managed: dict[tuple[str, int], list[str]] = field(default_factory=dict)


def recode(c: Column, values: Mapping[str, str]) -> Column:
    """Each value rewritten once, all at the same time (so 1 and 2 can swap); others and NULL stay. Text result."""
    text = F.trim(c.cast("string"))
    whole = F.regexp_replace(text, r"^([+-]?\d+)\.0$", "$1")
    if not values:
        return text
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), whole), text)


def homogenize(
    mapping: Sequence[Mapping[str, object]], bundle: Mapping[str, Mapping[int, DataFrame | None]], *, cols: MapColumns = MapColumns(), waves: Sequence[str] | None = None, infer: bool = True
) -> Homogenized:
    """Every table with its mapped variables renamed to the master's name (in capitals) and recoded to the final
    coding; other columns stay. ``$X`` as a name copies the homogenised column X.

    Problems are issues, never exceptions: rows that fail the mapping check are left out; a column that a table lacks
    is an err, a row without a master name takes its first name with a warn, a coding that cannot be read or merged
    leaves the wave's values as they are. infer: types of recoded columns are inferred again (a profile job)."""
    rows, issues = check_mapping(clean_mapping(mapping, cols, waves), waves)
    out: Bundle = {}
    managed: dict[tuple[str, int], list[str]] = {}
    for group, tables in bundle.items():
        out[group] = {}
        own = [r for r in rows if r.group == group]
        for time, df in tables.items():
            if df is None:
                out[group][time] = None
                continue
            named: dict[str, Column] = {}
            recoded: list[str] = []
            copies: list[tuple[str, str]] = []
            for r in own:
                name = r.names.get(time)
                if not name:
                    continue
                master = r.master
                if not master:
                    master = next(n for n in r.names.values() if n)
                    issues.append(Issue("warn", group, time, name, "no homogenized name: the first name is taken"))
                final = master.upper()
                if name.startswith("$"):
                    copies.append((final, name[1:].upper()))
                    continue
                if name not in df.columns:
                    issues.append(Issue("err", group, time, name, "variable not in table"))
                    continue
                cell: Column = qcol(name)
                code = r.codes.get(time)
                if code and r.final_code:
                    try:
                        values, found = merge_codings(parse_coding(r.final_code), parse_coding(code), group, final, time)
                    except ValueError as x:
                        values, found = {}, [Issue("err", group, time, final, f"coding: {x}")]
                    issues += found
                    if values:
                        cell = recode(cell, values)
                        recoded.append(final)
                named[final] = cell
            for final, source in copies:
                if source in named:
                    named[final] = named[source]
                    recoded += [final] if source in recoded else []
                else:
                    issues.append(Issue("err", group, time, source, "copied variable isn't homogenised"))
            raw = {r.names.get(time) for r in own}
            rest = [c for c in df.columns if c not in raw and c.upper() not in named]
            table = df.select(*(qcol(c) for c in rest), *(v.alias(k) for k, v in named.items()))
            out[group][time] = coerce_types(table, recoded) if infer and recoded else table
            managed[(group, time)] = list(named)
    return Homogenized(out, rows, issues, managed)
