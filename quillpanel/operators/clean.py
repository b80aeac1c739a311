"""Cleaning: artifacts, types, dates, accents, empty rows and columns, non-response dummies.

Decisions that depend on values (which columns are empty, which type fits) are profiled in one aggregate over the
table; everything else is one projection.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillpanel.functions.text import remove_accents as plain_letters
from quillpanel.functions.text import without_blanks
from quillpanel.session import qcol

# Cells that spreadsheets write for "nothing".
ARTIFACT = r"^(?i:N\s?/?A|#N/A|#DIV/0!|#VALUE!)$"
MISSING_CODE = r"^\s*-?99\s*$"
ID_COLUMN = re.compile(r"(?:\w+ID[^A-Za-z]|ID$|ID..)")
INTEGER, NUMBER, LOGICAL = r"^\s*[+-]?\d{1,18}\s*$", r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d{1,3})?\s*$", r"^\s*(?:TRUE|FALSE|T|F|true|false)\s*$"
# Strptime letters and the Java pattern letters that mean the same.
STRPTIME = {"Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm", "S": "ss", "p": "a", "b": "MMM", "B": "MMMM", "j": "DDD", "z": "xx", "%": "%"}
SAS_EPOCH_S = -315_619_200


def java_pattern(fmt: str) -> str:
    """A strptime format as a Java date pattern; a format without % is taken as Java already."""
    if "%" not in fmt:
        return fmt
    out, i = "", 0
    while i < len(fmt):
        if fmt[i] == "%" and i + 1 < len(fmt):
            out += STRPTIME[fmt[i + 1]]
            i += 2
        else:
            out += f"'{fmt[i]}'" if fmt[i].isalpha() else fmt[i]
            i += 1
    return out


def clear_artifacts(c: Column) -> Column:
    """Trimmed; NULL where nothing or only an artifact is left."""
    t = F.trim(c)
    return F.when((t == "") | t.rlike(ARTIFACT), F.lit(None)).otherwise(t)


def strip_missing_code(c: Column) -> Column:
    """Text cells that only say 99 or -99 become NULL."""
    return F.when(c.rlike(MISSING_CODE), F.lit(None)).otherwise(c)


def parse_date(c: Column, fmt: str, numeric: bool = False) -> Column:
    """Timestamp of a text in one format, NULL where it doesn't fit; numbers count seconds from 1960."""
    return F.timestamp_seconds(c.cast("double") + F.lit(SAS_EPOCH_S)) if numeric else F.try_to_timestamp(c, F.lit(java_pattern(fmt)))


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def infer_types(df: DataFrame, columns: Sequence[str] | None = None, logical: bool = False) -> dict[str, str]:
    """Narrowest type of each text column that all its values fit: boolean (if asked), bigint, double or string.

    Whole columns decide, all or nothing; columns without a value stay string. One aggregate over the table."""
    columns = list(columns if columns is not None else _text_columns(df))
    if not columns:
        return {}
    measures = []
    for i, c in enumerate(columns):
        value = qcol(c)
        measures += [F.count(value).alias(f"n{i}"), F.min(value.rlike(INTEGER)).alias(f"i{i}"), F.min(value.rlike(NUMBER)).alias(f"d{i}"), F.min(value.rlike(LOGICAL)).alias(f"b{i}")]
    row = df.agg(*measures).first()
    out = {}
    for i, c in enumerate(columns):
        if not row[f"n{i}"]:
            out[c] = "string"
        elif logical and row[f"b{i}"]:
            out[c] = "boolean"
        else:
            out[c] = "bigint" if row[f"i{i}"] else "double" if row[f"d{i}"] else "string"
    return out


def cast_to(c: Column, kind: str) -> Column:
    return F.trim(c).try_cast(kind) if kind != "string" else c


def coerce_types(df: DataFrame, columns: Sequence[str] | None = None, logical: bool = False) -> DataFrame:
    kinds = infer_types(df, columns, logical)
    return df.select(*(cast_to(qcol(c), kinds[c]).alias(c) if kinds.get(c, "string") != "string" else qcol(c) for c in df.columns))


def _filled(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.when(F.trim(c) != "", c)
    return F.nanvl(c, F.lit(None)) if isinstance(kind, (T.DoubleType, T.FloatType)) else c


def drop_empty_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Without columns that hold only NULL, NaN or blanks. One aggregate. A table without rows keeps all."""
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *(F.count(_filled(qcol(f.name), f.dataType)).alias(f"c{i}") for i, f in enumerate(df.schema))).first()
    if not counts["__rows"]:
        return df
    return df.select(*(qcol(c) for i, c in enumerate(df.columns) if counts[f"c{i}"] or c in keep))


def drop_empty_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Without rows that hold only NULL, NaN or blanks in ``columns`` (all by default)."""
    fields = [f for f in df.schema if columns is None or f.name in columns]
    if not fields:
        return df
    some = F.lit(False)
    for f in fields:
        some = some | _filled(qcol(f.name), f.dataType).isNotNull()
    return df.filter(some)


def id_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if ID_COLUMN.search(c.upper())]


def since(df: DataFrame, column: str, begin: str) -> DataFrame:
    """Rows dated ``begin`` or later; undated rows go."""
    return df.filter(qcol(column) >= F.lit(begin).cast(df.schema[column].dataType))


def clean(
    df: DataFrame,
    *,
    id_cols: Sequence[str] | None = None,
    date_cols: Mapping[str, str] | None = None,
    begin_date: str | None = None,
    begin_col: str | None = None,
    remove_accents: bool = True,
    types: bool = True,
    drop_empty: bool = True,
) -> DataFrame:
    """The basic cleaning of a survey table.

    Text in capitals, artifacts NULL, whole columns coerced, dates parsed, 99 and -99 NULL in what stays text (numbers
    keep them), accents off, blanks out of ids, empty columns and rows dropped. date_cols: column to format.
    begin_date applies to ``begin_col``, or to the only date column. Idempotent; an empty table stays as it is."""
    date_cols = dict(date_cols or {})
    ids = set(id_columns(df) if id_cols is None else id_cols)
    text = [c for c in _text_columns(df) if c not in date_cols]
    first = df.select(*((F.upper(plain_letters(clear_artifacts(qcol(c))) if remove_accents else clear_artifacts(qcol(c))).alias(c) if c in text else qcol(c)) for c in df.columns))
    kinds = infer_types(first, text) if types else {}
    out = []
    for c in df.columns:
        if c in date_cols:
            numeric = isinstance(df.schema[c].dataType, T.NumericType)
            out.append(parse_date(qcol(c), date_cols[c], numeric).alias(c))
        elif c in text and kinds.get(c, "string") != "string":
            out.append(cast_to(qcol(c), kinds[c]).alias(c))
        elif c in text:
            cell = strip_missing_code(qcol(c))
            out.append((without_blanks(cell) if c in ids else cell).alias(c))
        else:
            out.append(qcol(c))
    done = first.select(*out)
    bound = begin_col or (next(iter(date_cols)) if len(date_cols) == 1 else None)
    if begin_date and bound:
        done = since(done, bound, begin_date)
    if drop_empty:
        done = drop_empty_rows(drop_empty_columns(done))
    return done


def legacy_clean(df: DataFrame, *, date_col: str | None = None, date_format: str = "%Y-%m-%d", begin_date: str | None = None) -> DataFrame:
    """The older order of steps: ids first (-99 off, blanks out), artifacts anywhere in a cell blank it, then types
    and capitals, then the date bound."""
    anywhere = r"(?i)\bN/A\b|#N/A|#DIV/0!|#VALUE!"
    ids, text = set(id_columns(df)), set(_text_columns(df))

    def cell(c: str) -> Column:
        if c not in text:
            return qcol(c)
        x = without_blanks(F.when(F.trim(qcol(c)) == "-99", F.lit(None)).otherwise(qcol(c))) if c in ids else F.trim(qcol(c))
        return F.when((x == "") | x.rlike(anywhere), F.lit(None)).otherwise(x)

    first = drop_empty_rows(drop_empty_columns(df.select(*(cell(c).alias(c) for c in df.columns)), keep=[date_col] if date_col else ()))
    typed = coerce_types(first, [c for c in _text_columns(first) if c != date_col])
    upper = typed.select(*((F.upper(qcol(c)) if c in _text_columns(typed) and c != date_col else qcol(c)).alias(c) for c in typed.columns))
    if date_col and date_col in upper.columns:
        upper = upper.withColumn(date_col, parse_date(qcol(date_col), date_format))
        if begin_date:
            upper = since(upper, date_col, begin_date)
    return drop_empty_rows(upper)


def pad_columns(df: DataFrame, other: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both tables with all of ``names``; what one lacks is NULL of the other's type."""

    def padded(x: DataFrame, y: DataFrame) -> DataFrame:
        kinds = dict(y.dtypes)
        missing = {n: F.lit(None).cast(kinds.get(n, "string")) for n in names if n not in x.columns}
        return x.withColumns(missing) if missing else x

    return padded(df, other), padded(other, df)


def move_after(df: DataFrame, column: str, previous: str) -> DataFrame:
    order = [c for c in df.columns if c != column]
    at = order.index(previous) + 1
    return df.select(*map(qcol, [*order[:at], column, *order[at:]]))


def select_prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and the columns whose name starts with ``prefix``, without it."""
    return df.select(*(qcol(c) for c in keep), *(qcol(c).alias(c[len(prefix) :]) for c in df.columns if c.startswith(prefix) and c not in keep))


def add_prefix(df: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in columns})


def order_by_codebook(df: DataFrame, final: Sequence[str], only_final: bool = False) -> DataFrame:
    """Codebook columns in their order, the rest in alphabetical order."""
    listed = [c for c in dict.fromkeys(final) if c in df.columns]
    rest = [] if only_final else sorted(c for c in df.columns if c not in listed)
    return df.select(*map(qcol, [*listed, *rest]))


def drop_variables(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*(qcol(c) for c in df.columns if c not in set(names)))


def truth(c: Column, kind: T.DataType) -> Column:
    """A dummy item as a number: text T/TRUE is 1, F/FALSE 0."""
    if isinstance(kind, T.StringType):
        u = F.upper(F.trim(c))
        return F.when(u.isin("T", "TRUE"), 1.0).when(u.isin("F", "FALSE"), 0.0).otherwise(u.try_cast("double"))
    return c.cast("double")


def nonresponse_roots(columns: Sequence[str]) -> dict[str, list[str]]:
    """Roots R with a dummy R_99 and items R followed by digits."""
    out = {}
    for c in columns:
        if c.endswith("_99"):
            items = [x for x in columns if re.fullmatch(re.escape(c[:-3]) + r"\d+", x)]
            if items:
                out[c[:-3]] = items
    return out


def patch_nonresponse(df: DataFrame, roots: Sequence[str] | None = None) -> DataFrame:
    """Items of a root are NULL where its R_99 dummy is 1 and no item is positive; the dummy goes.

    A NULL dummy means responded. Roots without a dummy or items are left alone."""
    found = {r: items for r, items in nonresponse_roots(df.columns).items() if roots is None or r in roots}
    kinds = {f.name: f.dataType for f in df.schema}
    patch: dict[str, Column] = {}
    for root, items in found.items():
        total = F.lit(0.0)
        for c in items:
            total = total + F.coalesce(truth(qcol(c), kinds[c]), F.lit(0.0))
        silent = F.coalesce((truth(qcol(f"{root}_99"), kinds[f"{root}_99"]) == 1) & (total <= 0), F.lit(False))
        patch |= {c: F.when(~silent, qcol(c)) for c in items}
    dummies = {f"{r}_99" for r in found}
    return df.select(*(patch.get(c, qcol(c)).alias(c) for c in df.columns if c not in dummies))


def or_known(x: Column, y: Column) -> Column:
    """Three-valued OR, but FALSE where exactly one side is unknown and the other isn't TRUE."""
    either = x | y
    return F.when(either.isNull() & (x.isNotNull() | y.isNotNull()), F.lit(False)).otherwise(either)


def yesno_to_boolean(df: DataFrame) -> DataFrame:
    """Text columns whose values are all Y or N become boolean; columns without a value stay. One aggregate."""
    text = _text_columns(df)
    if not text:
        return df
    row = df.agg(*(F.min(F.upper(qcol(c)).isin("Y", "N")).alias(f"y{i}") for i, c in enumerate(text))).first()
    yes = {c for i, c in enumerate(text) if row[f"y{i}"]}
    return df.select(*((F.upper(qcol(c)) == "Y").alias(c) if c in yes else qcol(c) for c in df.columns))
