"""Merging groups and waves, and reshaping between long and wide panels."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillpanel.operators.verify import column_collisions
from quillpanel.session import qcol

TIME = ".TIME"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key: the first by ``order``, then by all columns, so the choice never depends on chance.
    Aggregated map-side; NULL keys are one key."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*map(qcol, order), *(qcol(c) for c in rest if c not in order and not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))))
    row = F.struct(*(qcol(c).alias(f"c{i}") for i, c in enumerate(rest)))
    best = df.groupBy(*map(qcol, keys)).agg(F.min_by(row, rank).alias("__r")) if rest else df.select(*map(qcol, keys)).distinct()
    return best.select(*(F.col(f"__r.c{rest.index(c)}").alias(c) if c in rest else qcol(c) for c in df.columns)) if rest else best


def merge_groups(bundle: Mapping[str, Mapping[int, DataFrame | None]], ids: Sequence[str], *, order: Sequence[str] = (), merge_col: str = ".MERGE") -> dict[int, DataFrame]:
    """For each time the groups' tables, full outer joined on the first known of ``ids`` (NULL keys match).

    Columns of several groups get the suffix ``_<group>``; every group must list the same times; a key that repeats
    in a table keeps its first row by ``order``. Adds .TIME."""
    times = {tuple(sorted(t)) for t in bundle.values()}
    if len(times) > 1:
        raise ValueError("all groups must list the same times")
    shared = column_collisions(bundle, [])
    out: dict[int, DataFrame] = {}
    for time in next(iter(times), ()):
        merged: DataFrame | None = None
        for group, tables in bundle.items():
            df = tables[time]
            if df is None:
                continue
            present = [c for c in ids if c in df.columns]
            named = df.select(F.coalesce(*map(qcol, present)).alias(merge_col), *(qcol(c).alias(f"{c}_{group}" if c in shared else c) for c in df.columns))
            one = keep_first(named, [merge_col], [f"{c}_{group}" if c in shared else c for c in order if c in df.columns])
            if merged is None:
                merged = one
                continue
            key = f"__key_{group}"
            right = one.withColumnRenamed(merge_col, key)
            joined = merged.join(right, merged[f"`{merge_col}`"].eqNullSafe(right[key]), "full")
            merged = joined.select(F.coalesce(qcol(merge_col), qcol(key)).alias(merge_col), *(qcol(c) for c in joined.columns if c not in (merge_col, key)))
        if merged is not None:
            out[time] = merged.withColumn(TIME, F.lit(time))
    return out


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    numeric = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]
    if a in numeric and b in numeric:
        return max(a, b, key=numeric.index) if not {type(a), type(b)} == {T.LongType, T.FloatType} else T.DoubleType()
    if isinstance(a, T.NullType):
        return b
    return a if isinstance(b, T.NullType) else T.StringType()


def merge_times(tables: Mapping[int, DataFrame], first: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """All waves below each other by column name, what a wave lacks NULL, types widened (to text where nothing else
    fits). ``first`` columns lead, then ``order`` or the alphabet."""
    kinds: dict[str, T.DataType] = {}
    for df in tables.values():
        for f in df.schema:
            kinds[f.name] = _common_type(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    rest = sorted(c for c in kinds if c not in first)
    if order is not None:
        rest = [c for c in order if c in rest] + [c for c in rest if c not in order]
    names = [*(c for c in first if c in kinds), *rest]
    aligned = [df.select(*((qcol(c).cast(kinds[c]) if c in df.columns else F.lit(None).cast(kinds[c])).alias(c) for c in names)) for df in tables.values()]
    return reduce(DataFrame.unionByName, aligned)


def split_times(df: DataFrame, time: str, times: Sequence[int]) -> dict[int, DataFrame]:
    """A filtered view for each time."""
    return {t: df.filter(qcol(time) == t) for t in times}


def varying_columns(df: DataFrame, ids: Sequence[str], time: str) -> dict[str, bool]:
    """Which columns differ within an id: two aggregates, by id (map-side), then over all."""
    values = [c for c in df.columns if c not in ids and c != time]
    per_id = df.groupBy(*map(qcol, ids)).agg(*(F.min(qcol(c)).alias(f"l{i}") for i, c in enumerate(values)), *(F.max(qcol(c)).alias(f"h{i}") for i, c in enumerate(values)))
    row = per_id.agg(*(F.max((F.col(f"l{i}") != F.col(f"h{i}")).cast("int")).alias(f"v{i}") for i in range(len(values)))).first()
    return {c: bool(row[f"v{i}"]) for i, c in enumerate(values)}


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*map(qcol, keys)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def spread(
    df: DataFrame, ids: Sequence[str], time: str = TIME, *, split: Sequence[str] | None = None, force_unite: Sequence[str] = (), times: Sequence[int] | None = None, drop_empty: bool = True, on_duplicates: str = "error", max_times: int = 10_000
) -> DataFrame:
    """The wide panel: one row for each id, united columns once, split ones as ``<column>_<time>``.

    split: columns to spread; by default those that differ within some id (profiled). force_unite: columns that are
    united by their mode, the smallest of equally frequent values. Unknown values don't count; a united column is
    filled from any time. A repeated (id, time) is an error, or the largest value is taken (``on_duplicates='max'``).
    Rows without an id are one id. Aggregates are partial; the distinct times are read once if not given, and a
    ValueError says so if they are more than ``max_times`` (each is a column)."""
    if on_duplicates == "error" and repeated_keys(df, [*ids, time]).limit(1).count():
        raise ValueError("an id has several rows at one time")
    values = [c for c in df.columns if c not in ids and c != time]
    if split is None:
        varies = varying_columns(df, ids, time)
        split = [c for c in values if varies[c] and c not in force_unite]
    if times is None:
        times = sorted(r[0] for r in df.select(qcol(time)).filter(qcol(time).isNotNull()).distinct().limit(max_times + 1).collect())
        if len(times) > max_times:
            raise ValueError(f"more than {max_times} times")
    times = list(times)
    united = [c for c in values if c not in split]
    plain = [c for c in united if c not in force_unite]
    cells = [F.max(qcol(c)).alias(c) for c in plain]
    cells += [F.max(F.when(qcol(time) == t, qcol(c))).alias(f"{c}_{t}") for c in split for t in times]
    wide = df.groupBy(*map(qcol, ids)).agg(*cells) if cells else df.select(*map(qcol, ids)).distinct()
    for c in (x for x in united if x in force_unite):
        counted = df.filter(qcol(c).isNotNull()).groupBy(*map(qcol, ids), qcol(c)).agg(F.count(F.lit(1)).alias("__n"))
        top = counted.groupBy(*(qcol(i).alias(f"__m{k}") for k, i in enumerate(ids))).agg(F.max("__n").alias("__top"))
        both = counted.join(top, reduce(lambda a, b: a & b, (qcol(i).eqNullSafe(F.col(f"__m{k}")) for k, i in enumerate(ids))))
        mode = both.filter("__n = __top").groupBy(*(F.col(f"__m{k}") for k in range(len(ids)))).agg(F.min(qcol(c)).alias(c))
        wide = wide.join(mode, reduce(lambda a, b: a & b, (qcol(i).eqNullSafe(F.col(f"__m{k}")) for k, i in enumerate(ids))), "left").drop(*(f"__m{k}" for k in range(len(ids))))
    ordered = [*ids, *united, *(f"{c}_{t}" for c in split for t in times)]
    wide = wide.select(*map(qcol, ordered))
    if drop_empty:
        from quillpanel.operators.clean import drop_empty_columns

        wide = drop_empty_columns(wide, keep=list(ids))
    return wide


def time_roots(columns: Sequence[str]) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for c in columns:
        if m := re.fullmatch(r"(.+)_(\d+)", c):
            out.setdefault(m[1], []).append(int(m[2]))
    return out


def gather(df: DataFrame, time: str = TIME, united: Sequence[str] | None = None) -> DataFrame:
    """The long panel of a wide one: columns ``<root>_<digits>`` become ``root`` with a row for each time that any
    root has; a root without that time is NULL there. One pass, no shuffle."""
    roots = time_roots([c for c in df.columns if united is None or c not in united])
    times = sorted({t for ts in roots.values() for t in ts})
    united = [c for c in df.columns if not any(c == f"{r}_{t}" for r, ts in roots.items() for t in ts)]
    if not times:
        return df
    kinds = {r: reduce(_common_type, (df.schema[f"{r}_{t}"].dataType for t in ts)) for r, ts in roots.items()}
    cell = lambda r, t: qcol(f"{r}_{t}").cast(kinds[r]) if t in roots[r] else F.lit(None).cast(kinds[r])
    rows = F.array(*(F.struct(F.lit(t).alias("t"), *(cell(r, t).alias(f"r{i}") for i, r in enumerate(roots))) for t in times))
    long = df.select(*map(qcol, united), F.explode(rows).alias("__row"))
    return long.select(*map(qcol, united), F.col("__row.t").alias(time), *(F.col(f"__row.r{i}").alias(r) for i, r in enumerate(roots)))


def permute_tags(df: DataFrame, groups: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``<x>_<group>_<time>`` to ``<x>_<time>_<group>`` and back."""
    tags = "|".join(map(re.escape, groups))
    renames = {}
    for c in df.columns:
        if m := re.fullmatch(rf"(.+)_({tags})_(\d+)", c):
            renames[c] = (m[1], f"{m[1]}_{m[3]}_{m[2]}")
        elif m := re.fullmatch(rf"(.+)_(\d+)_({tags})", c):
            renames[c] = (m[1], f"{m[1]}_{m[3]}_{m[2]}")
    return df.withColumnsRenamed({c: new for c, (root, new) in renames.items() if columns is None or root in columns})


def coalesce_over_times(df: DataFrame, ids: Sequence[str], time: str, columns: Sequence[str], ranges: Sequence[Sequence[int]], result: str, priority: Sequence[str] | None = None) -> DataFrame:
    """``result``: for each id and range of times, the first known value by column (in ``priority`` or the given
    order), then by time, on every row whose time is in the range; NULL on other rows. Joined back from partial
    aggregates, so an id of any size fits."""
    ordered = [c for c in (priority or []) if c in columns] + [c for c in columns if c not in (priority or [])]
    which: Column = F.lit(None).cast("int")
    for i, r in reversed(list(enumerate(ranges))):
        which = F.when(qcol(time).isin(*r), i).otherwise(which)
    ranged = df.withColumn("__range", which)
    firsts = [F.min_by(qcol(c), F.when(qcol(c).isNotNull(), qcol(time))).alias(f"__f{i}") for i, c in enumerate(ordered)]
    found = ranged.filter("__range IS NOT NULL").groupBy(*(qcol(c).alias(f"__i{k}") for k, c in enumerate(ids)), F.col("__range").alias("__r")).agg(*firsts)
    found = found.select(*(F.col(f"__i{k}") for k in range(len(ids))), "__r", F.coalesce(*(F.col(f"__f{i}") for i in range(len(ordered)))).alias(result))
    on = reduce(lambda a, b: a & b, (qcol(c).eqNullSafe(F.col(f"__i{k}")) for k, c in enumerate(ids)), F.col("__range") == F.col("__r"))
    return ranged.join(found, on, "left").select(*map(qcol, df.columns), qcol(result))
