"""The codebook document: descriptives, histograms, frequencies, value tables, as rows and as Markdown."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillpanel.plans.mapping import parse_coding
from quillpanel.session import qcol

# Kinds of variables that get descriptives, and those that get value tables.
NUMERIC_KINDS = re.compile(r"proportion|continuous|count|^ordered")
CODED_KINDS = ("binary", "ordered-categorical", "unordered-categorical")


def medians(df: DataFrame, columns: Sequence[str], bins: int = 512, few: int = 20_000) -> dict[str, float | None]:
    """The exact median of each column, unknown values left out.

    The two middle ranks are narrowed down by histograms, all columns in one job a round, until the bin that holds a
    rank has few rows or one value; only then its values are counted one by one. What comes to the driver is bounded
    by columns x bins and columns x ``few``; no task sees more than a partial count."""
    value = {c: F.nanvl(qcol(c).cast("double"), F.lit(None)) for c in columns}
    row = df.agg(*(f(value[c]).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max)))).first()
    found: dict[tuple[str, int], float | None] = {}
    # (column, rank) to (least, greatest, rows below the least, rows between)
    search: dict[tuple[str, int], tuple[float, float, int, int]] = {}
    for i, c in enumerate(columns):
        n = row[f"n{i}"]
        for rank in {(n - 1) // 2, n // 2} if n else ():
            search[(c, rank)] = (row[f"lo{i}"], row[f"hi{i}"], 0, n)
    while search:
        for k in [k for k, (low, high, *_) in search.items() if low == high]:
            found[k] = search.pop(k)[0]
        spans = {(c, low, high, below, n) for (c, _), (low, high, below, n) in search.items()}
        if not spans:
            break
        cells = []
        for c, low, high, _, n in spans:
            x, width = value[c], (high - low) / bins
            fine = n <= few or low + width <= low
            place = F.lit(0) if fine else F.least(F.floor((x - low) / width), F.lit(bins - 1)).cast("int")
            cells.append(F.when((x >= low) & (x <= high), F.struct(F.lit(c).alias("c"), F.lit(low).alias("low"), F.lit(high).alias("high"), place.alias("bin"), F.when(F.lit(fine), x).alias("x"), x.alias("v"))))
        counted = df.select(F.explode(F.array_compact(F.array(*cells))).alias("e")).groupBy("e.c", "e.low", "e.high", "e.bin", "e.x").agg(F.count(F.lit(1)).alias("n"), F.min("e.v").alias("least"), F.max("e.v").alias("most"))
        got: dict[tuple[str, float, float], list] = {}
        for r in counted.collect():
            got.setdefault((r["c"], r["low"], r["high"]), []).append(r)
        for (c, rank), (low, high, below, _) in list(search.items()):
            for r in sorted(got[(c, low, high)], key=lambda r: r["least"]):
                if below + r["n"] > rank:
                    search[(c, rank)] = (r["least"], r["most"], below, r["n"])
                    break
                below += r["n"]
    out: dict[str, float | None] = {}
    for i, c in enumerate(columns):
        n = row[f"n{i}"]
        out[c] = (found[(c, (n - 1) // 2)] + found[(c, n // 2)]) / 2 if n else None  # type: ignore[operator]
    return out


def descriptives(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """(variable, n, min, mean, median, sd, max) of numeric columns, unknown values left out; one pass for all columns,
    and those of ``medians``."""
    middle = medians(df, columns)
    measures = []
    for i, c in enumerate(columns):
        x = F.nanvl(qcol(c).cast("double"), F.lit(None))
        measures.append(F.struct(F.lit(c).alias("variable"), F.count(x).alias("n"), F.min(x).alias("min"), F.avg(x).alias("mean"), F.lit(middle[c]).cast("double").alias("median"), F.stddev_samp(x).alias("sd"), F.max(x).alias("max")).alias(f"m{i}"))
    row = df.agg(*measures).select(F.explode(F.array(*(F.col(f"m{i}") for i in range(len(columns))))).alias("m")).select("m.*")
    return row.select("variable", "n", *(F.bround(F.col(c), digits).alias(c) for c in ("min", "mean", "median", "sd", "max")))


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, value, n) with unknown values as NULL; one shuffle for all columns, counted map-side."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("variable"), qcol(c).cast("string").alias("value")) for c in columns)))
    return df.select(cells.alias("c")).groupBy(F.col("c.variable").alias("variable"), F.col("c.value").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """(bin, low, high, n) of equal bins from the least to the greatest value (which falls into the last bin)."""
    x = F.nanvl(qcol(column).cast("double"), F.lit(None))
    known = df.select(x.alias("x")).filter("x IS NOT NULL")
    edge = known.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    low, high = edge["lo"], edge["hi"]
    if low is None:
        return known.select(F.lit(0).alias("bin"), F.col("x").alias("low"), F.col("x").alias("high"), F.lit(0).cast("long").alias("n")).limit(0)
    width = (high - low) / bins or 1.0
    place = F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)).cast("int")
    return known.groupBy((place + 1).alias("bin")).agg(F.count(F.lit(1)).alias("n")).select("bin", (low + (F.col("bin") - 1) * width).alias("low"), (low + F.col("bin") * width).alias("high"), "n")


def codebook_rows(metadata: Sequence[Mapping[str, object]], section: str | None = None, wave: str | None = None) -> list[dict[str, object]]:
    """Rows that appear in the document: with a final name, not dropped, present in the wave, not left out, of the
    section (a regular expression); the first row of each final name."""
    out: dict[str, dict[str, object]] = {}
    for r in metadata:
        name = str(r.get("FINALNAMES") or "").strip()
        if not name or re.match("drop", str(r.get("DROPCASE") or ""), re.IGNORECASE) or r.get("leaveout") in (True, "Y", 1):
            continue
        if wave and r.get("PRESENCE") and wave not in re.split(r"[,\s]+", str(r["PRESENCE"])):
            continue
        if section and not re.search(section, str(r.get("IndexSections") or "")):
            continue
        out.setdefault(name, dict(r))
    return list(out.values())


def resolve_name(name: str, columns: Sequence[str], wave: str | None = None, group: str | None = None) -> str | None:
    """The table's column of a codebook name: itself, with the wave's tag, or with the group's."""
    if name in columns:
        return name
    if wave and f"{name}{wave}" in columns:
        return f"{name}{wave}"
    if wave and f"{name}_{wave}" in columns:
        return f"{name}_{wave}"
    if group:
        return next((c for c in columns if re.fullmatch(re.escape(name) + r"\w*_" + re.escape(group), c)), None)
    return None


def codebook_markdown(df: DataFrame, metadata: Sequence[Mapping[str, object]], *, title: str = "Codebook", section: str | None = None, wave: str | None = None, group: str | None = None, bins: int = 30) -> str:
    """The document: descriptives in one job, a histogram for each numeric variable, a value table for each coded variable (equal codings of a subgroup
    once), a notice for each variable the table lacks. Only summaries come to the driver."""
    rows = codebook_rows(metadata, section, wave)
    named = [(r, resolve_name(str(r["FINALNAMES"]), df.columns, wave, group)) for r in rows]
    numeric = [c for r, c in named if c and NUMERIC_KINDS.search(str(r.get("Type") or "")) and "AGE" != c.upper()]
    stats = {r["variable"]: r for r in descriptives(df, numeric).collect()} if numeric else {}
    out, shown, noted = [f"# {title}", ""], set(), set()
    for r, c in named:
        note = str(r.get("SUB_NOTE") or "")
        if note and r.get("SUBGROUP") not in noted:
            noted.add(r.get("SUBGROUP"))
            out += [note, ""]
        out += [f"## {r['FINALNAMES']}", "", str(r.get("ITEMDES") or ""), ""]
        if c is None:
            out += ["*variable not in database*", ""]
            continue
        if c in stats:
            s = stats[c]
            out += ["| n | min | mean | median | sd | max |", "|-|-|-|-|-|-|", f"| {s['n']} | {s['min']} | {s['mean']} | {s['median']} | {s['sd']} | {s['max']} |", ""]
            bars = histogram(df, c, bins).orderBy("bin").collect()
            most = max((b["n"] for b in bars), default=1)
            out += ["| bin | n | |", "|-|-|-|", *(f"| {b['bin']} | {b['n']} | {'#' * max(1, round(20 * b['n'] / most))} |" for b in bars), ""]
        if r.get("CODING") and str(r.get("Type")) in CODED_KINDS:
            text = str(r["CODING"])
            mark = (r.get("SUBGROUP") or c, hashlib.md5(text.encode()).hexdigest())  # noqa: S324
            if mark not in shown:
                shown.add(mark)
                try:
                    out += ["| value | label |", "|-|-|", *(f"| {v} | {d} |" for v, d in parse_coding(text)), ""]
                except ValueError as x:
                    out += [f"*coding cannot be read: {x}*", ""]
    return "\n".join(out)
