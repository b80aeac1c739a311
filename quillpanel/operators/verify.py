"""Verification: duplicate, malformed and unmatched ids, mismatches between sources."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillpanel.functions.text import name_mismatch
from quillpanel.session import fresh, qcol

FIX_COLUMNS = ("Verifier", "Problem", "WHAT", "change.from", "change.to", "Note")


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], renamed: Mapping[str, str]) -> Column:
    return reduce(lambda a, b: a & b, (left[f"`{k}`"].eqNullSafe(right[f"`{renamed[k]}`"]) for k in keys))


def flag_duplicates(df: DataFrame, keys: Sequence[str], name: str = "duplicated") -> DataFrame:
    """All rows, with ``name``: whether the row's keys occur more than once (NULL equals NULL).

    Keys are counted map-side and joined back, so a key that holds a third of the rows is never one task's group."""
    renamed = {k: fresh(df, f"__k{i}") for i, k in enumerate(keys)}
    repeated = df.groupBy(*(qcol(k).alias(renamed[k]) for k in keys)).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
    marked = repeated.withColumn("__again", F.lit(True))
    joined = df.join(marked, _null_safe(df, marked, keys, renamed), "left")
    return joined.select(*(df[f"`{c}`"] for c in df.columns), F.coalesce(F.col("__again"), F.lit(False)).alias(name))


def only_in(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose keys ``right`` doesn't have; NULL keys match NULL keys."""
    renamed = {k: f"__r{i}" for i, k in enumerate(keys)}
    other = right.select(*(qcol(k).alias(renamed[k]) for k in keys)).distinct()
    return left.join(other, _null_safe(left, other, keys, renamed), "left_anti")


def id_pattern(fixed: str = "", changing: str = "", numbers: int | tuple[int, int] = 0, structure: str = "CXN", anchored: bool = True) -> str:
    """Regular expression of an id: X the fixed text, C one of the changing parts, N so many digits."""
    digits = rf"\d{{{numbers[0]},{numbers[1]}}}" if isinstance(numbers, tuple) else rf"\d{{{numbers}}}"
    parts = {"X": re.escape(fixed), "C": f"(?:{changing})", "N": digits}
    body = "".join(parts[s] for s in structure)
    return f"^{body}$" if anchored else body


def bad_pattern(c: Column, pattern: str) -> Column:
    """Whether an id is missing or doesn't follow the pattern. Never NULL."""
    return ~F.coalesce(c.rlike(pattern), F.lit(False))


def fix_format(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Empty columns for the verifier to fill in, after ``first``; unchanged where a name is taken."""
    taken = {c.lower() for c in df.columns}
    if any(f.lower() in taken for f in FIX_COLUMNS):
        return df
    lead = [c for c in first if c in df.columns]
    return df.select(*map(qcol, lead), *(F.lit(None).cast("string").alias(f) for f in FIX_COLUMNS), *(qcol(c) for c in df.columns if c not in lead))


def single_set_issues(
    df: DataFrame,
    id_col: str,
    *,
    reference: DataFrame | None = None,
    patterns: Mapping[str, str] | None = None,
    checks: Mapping[str, Callable[[DataFrame], Column]] | None = None,
) -> DataFrame:
    """Rows with any issue, and ISSUE: the names of all, comma-joined: duplicated_id, bad_<column>, dataonly, custom.

    NULL custom results count as no issue. NULL ids are duplicates of each other and match a NULL in the reference.
    An empty table gives none."""
    flag = fresh(df, "__dup")
    out = flag_duplicates(df, [id_col], flag)
    issues: list[Column] = [F.when(qcol(flag), F.lit("duplicated_id"))]
    issues += [F.when(bad_pattern(qcol(c), p), F.lit(f"bad_{c}")) for c, p in (patterns or {}).items()]
    lone = fresh(df, "__known")
    if reference is not None:
        known = reference.select(qcol(id_col).alias("__ref")).distinct().withColumn(lone, F.lit(True))
        joined = out.join(known, out[f"`{id_col}`"].eqNullSafe(known["__ref"]), "left").drop("__ref")
        out = joined
        issues.append(F.when(qcol(lone).isNull(), F.lit("dataonly")))
    issues += [F.when(F.coalesce(check(out), F.lit(False)), F.lit(name)) for name, check in (checks or {}).items()]
    said = F.nullif(F.concat_ws(", ", *issues), F.lit(""))
    return out.select(*(qcol(c) for c in df.columns), said.alias("ISSUE")).filter(F.col("ISSUE").isNotNull())


def weird_or_duplicated(df: DataFrame, id_col: str, pattern: str) -> DataFrame:
    """The older report: rows with a repeated id (DUPLICATED ID) and other rows with a malformed one (WEIRD ID)."""
    flag = fresh(df, "__dup")
    out = flag_duplicates(df, [id_col], flag)
    issue = F.when(qcol(flag), F.lit("DUPLICATED ID")).when(bad_pattern(qcol(id_col), pattern), F.lit("WEIRD ID"))
    return out.select(*(qcol(c) for c in df.columns), issue.alias("ISSUE")).filter(F.col("ISSUE").isNotNull())


def merge_sources(sources: Mapping[str, DataFrame], id_col: str, columns: Sequence[str], allow_duplicates: bool = True) -> DataFrame:
    """Full outer join of all sources on the id, columns suffixed ``_<source>``.

    Rows without an id match nothing: they come after the join, one for each row of a source, so they neither
    multiply nor meet in one task.

    Each source adds DUP_<source>: whether the row's id is repeated there. Ids repeated in two sources multiply; a
    ValueError names them if ``allow_duplicates`` is False (one aggregate for each source)."""
    merged: DataFrame | None = None
    repeated: list[str] = []
    nameless: list[DataFrame] = []
    for name, df in sources.items():
        flagged = flag_duplicates(df, [id_col], f"DUP_{name}")
        if not allow_duplicates and flagged.filter(f"`DUP_{name}`").limit(1).count():
            repeated.append(name)
        every = flagged.select(qcol(id_col).alias(f"__id_{name}"), qcol(f"DUP_{name}"), *(qcol(c).alias(f"{c}_{name}") for c in columns if c in df.columns))
        nameless.append(every.filter(F.col(f"__id_{name}").isNull()).withColumnRenamed(f"__id_{name}", id_col))
        one = every.filter(F.col(f"__id_{name}").isNotNull())
        if merged is None:
            merged = one.withColumnRenamed(f"__id_{name}", id_col)
            continue
        both = merged.join(one, merged[f"`{id_col}`"] == one[f"__id_{name}"], "full")
        merged = both.select(F.coalesce(qcol(id_col), qcol(f"__id_{name}")).alias(id_col), *(qcol(c) for c in both.columns if c not in (id_col, f"__id_{name}")))
    if len(repeated) > 1:
        raise ValueError(f"ids repeated in {', '.join(repeated)}: their join would multiply rows")
    assert merged is not None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), nameless, merged)


def duplicate_provenance(names: Sequence[str]) -> Column:
    """'ID DUPLICATED IN A & B', or 'NO'."""
    where = F.concat_ws(" & ", *(F.when(F.coalesce(qcol(f"DUP_{n}"), F.lit(False)), F.lit(n)) for n in names))
    return F.when(where == "", F.lit("NO")).otherwise(F.concat(F.lit("ID DUPLICATED IN "), where))


def value_mismatch(columns: Sequence[Column], upper: float | None = None, lower: float | None = None) -> Column:
    """Whether any value differs from the first known one; with margins, by more than ``upper`` above or ``lower``
    below it. Never NULL; unknown values don't differ."""
    base, values = F.coalesce(*columns), F.array(*columns)
    if upper is None and lower is None:
        return F.coalesce(F.exists(values, lambda x: F.coalesce(x != base, F.lit(False))), F.lit(False))
    out = F.lit(False)
    if upper is not None:
        out = out | F.coalesce(F.exists(values, lambda x: F.coalesce(x > base + upper, F.lit(False))), F.lit(False))
    if lower is not None:
        out = out | F.coalesce(F.exists(values, lambda x: F.coalesce(x < base - lower, F.lit(False))), F.lit(False))
    return out


def resolve_tolerance(tolerance: float | Mapping[str, float], variable: str) -> float:
    if not isinstance(tolerance, Mapping):
        return tolerance
    if variable in tolerance:
        return tolerance[variable]
    if ".others" in tolerance:
        return tolerance[".others"]
    raise KeyError(f"no tolerance for {variable} and no .others")


def names_differ(columns: Sequence[Column], tolerance: float) -> Column:
    """Whether any two of the names mismatch; the predicate is symmetric, so each pair is compared once."""
    bare = [F.regexp_replace(c, r"\p{Punct}++", "") for c in columns]
    pairs = [name_mismatch(a, b, tolerance) for i, a in enumerate(bare) for b in bare[i + 1 :]]
    return reduce(lambda x, y: x | y, pairs) if pairs else F.lit(False)


def cross_source_issues(
    sources: Mapping[str, DataFrame],
    reference: tuple[str, DataFrame] | None,
    id_col: str,
    *,
    names: Sequence[str] = (),
    variables: Sequence[str] = (),
    tolerance: float | Mapping[str, float] = 0.1,
    upper: Mapping[str, float] | None = None,
    lower: Mapping[str, float] | None = None,
    allow_duplicates: bool = True,
) -> DataFrame:
    """Merged sources (the reference first), with <variable>_ISSUE for each checked column, DUPS and N_ISSUES; rows
    with an issue or a repeated id only."""
    every = {reference[0]: reference[1], **sources} if reference else dict(sources)
    merged = merge_sources(every, id_col, [*names, *variables], allow_duplicates)
    flags: dict[str, Column] = {}
    for v in variables:
        present = [qcol(f"{v}_{n}").try_cast("double") for n in every if f"{v}_{n}" in merged.columns]
        if len(present) > 1:
            flags[f"{v}_ISSUE"] = value_mismatch(present, (upper or {}).get(v), (lower or {}).get(v))
    for v in names:
        present = [qcol(f"{v}_{n}") for n in every if f"{v}_{n}" in merged.columns]
        if len(present) > 1:
            flags[f"{v}_ISSUE"] = names_differ(present, resolve_tolerance(tolerance, v))
    flagged = merged.withColumns({**flags, "DUPS": duplicate_provenance(list(every))})
    count = reduce(lambda a, b: a + b, (qcol(f).cast("int") for f in flags), F.lit(0))
    return flagged.withColumn("N_ISSUES", count).filter((F.col("N_ISSUES") > 0) | (F.col("DUPS") != "NO"))


def unique_row_id(id_col: str, uid_col: str) -> Column:
    return F.concat(F.coalesce(qcol(id_col), F.lit("")), F.coalesce(qcol(uid_col), F.lit("")))


def long_set_issues(df: DataFrame, id_col: str, time_col: str, root: str, times: Sequence[int], **how) -> dict[str, DataFrame]:
    """``single_set_issues`` for each time of a long table, named ``<root>_<time>``; each is a filtered view."""
    return {f"{root}_{t}": single_set_issues(df.filter(qcol(time_col) == t), id_col, **how) for t in times}


def content_summary(bundle: Mapping[str, Mapping[int, DataFrame | None]]) -> list[tuple[str, int, str]]:
    """(group, time, variable) of every table that is there; only schemas are read."""
    return [(g, t, c) for g, tables in bundle.items() for t, df in tables.items() if df is not None for c in df.columns]


def column_collisions(bundle: Mapping[str, Mapping[int, DataFrame | None]], keys: Sequence[str]) -> set[str]:
    """Columns that occur in more than one group."""
    owners: dict[str, set[str]] = {}
    for g, _, c in content_summary(bundle):
        owners.setdefault(c, set()).add(g)
    return {c for c, gs in owners.items() if len(gs) > 1 and c not in keys}
