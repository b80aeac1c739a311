"""Readers and writers: CSV, Parquet, JSON and ORC natively; workbooks, piece by piece, and Stata files, bounded by nature,
through the driver."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence
from itertools import chain
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillpanel.session import qcol, scratch
from quillpanel.sources.office import workbook_rows, write_workbook

log = logging.getLogger(__name__)


def read_csv(spark: SparkSession, path: str, na: Sequence[str] = ("", "NA"), infer: bool = True) -> DataFrame:
    """Header CSV; cells equal to one of ``na`` are NULL. Types are inferred after that, by whole columns."""
    from quillpanel.operators.clean import coerce_types

    raw = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
    df = raw.select(*(F.when(~qcol(c).isin(*na), qcol(c)).alias(c) for c in raw.columns))
    return coerce_types(df) if infer else df


# The letters of a workbook that the driver holds at a time.
_PIECE_LETTERS = 8_000_000


def _pieces(rows: Iterator[list[str | None]]) -> Iterator[list[list[str | None]]]:
    piece: list[list[str | None]] = []
    letters = 0
    for r in rows:
        piece.append(r)
        letters += len(r) + sum(len(c) for c in r if c)
        if letters > _PIECE_LETTERS:
            yield piece
            piece, letters = [], 0
    yield piece


def read_xlsx(spark: SparkSession, path: str, na: Sequence[str] = ("", "NA")) -> DataFrame:
    """A workbook's first sheet, its first row the header, with the sheets that continue it (see ``write_xlsx``); cells
    are text, those equal to one of ``na`` NULL.

    Read on the driver, in pieces: a workbook of several is a table in the shared folder, which ``forget_stored``
    deletes."""
    import pyarrow as pa

    rows = workbook_rows(path)
    header = [c or f"column_{i + 1}" for i, c in enumerate(next(rows, []))]
    width, missing = len(header), set(na)
    pieces = _pieces([None if c in missing else c for c in (r + [None] * width)[:width]] for r in rows)
    first, second = next(pieces), next(pieces, [])
    if not second:
        return spark.createDataFrame(first, ", ".join(f"`{c}` string" for c in header))
    table, places = scratch(spark, "workbook"), [f"c{i}" for i in range(width)]  # a header may name a column twice
    for piece in chain((first, second), pieces):
        columns = [pa.array(c, pa.string()) for c in zip(*piece, strict=True)]
        spark.createDataFrame(pa.Table.from_arrays(columns, places)).write.mode("append").parquet(table)
    return spark.read.schema(", ".join(f"{c} string" for c in places)).parquet(table).toDF(*header)


def write_xlsx(df: DataFrame, path: str, max_rows: int | None = None) -> None:
    """A report as a workbook, through the driver row by row; rows that a sheet of the format can't hold go to further
    sheets. With ``max_rows`` a ValueError beyond them, before any row is fetched."""
    if max_rows is not None:
        _bounded(df, max_rows)
    write_workbook(path, df.columns, ([v if v is None or isinstance(v, (int, float, str)) else str(v) for v in r] for r in df.toLocalIterator()))


def _bounded(df: DataFrame, most: int) -> None:
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows")


def accept(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """A table as it is, or a file by its ending; anything else is a TypeError."""
    if isinstance(source, DataFrame):
        return source
    if not isinstance(source, str):
        raise TypeError("a path or a DataFrame is needed")
    readers = {".csv": read_csv, ".xlsx": read_xlsx, ".parquet": lambda s, p: s.read.parquet(p), ".json": lambda s, p: s.read.json(p), ".orc": lambda s, p: s.read.orc(p)}
    ending = Path(source).suffix.lower()
    if ending not in readers:
        raise TypeError(f"no reader for {ending or source}")
    return readers[ending](spark, source)


def parse_fields(column: str, fields: int | None = None) -> list:
    """Columns of the comma-separated fields of a text cell. Quoted fields may hold commas, ragged rows are filled with
    NULL, empty fields are NULL, fields beyond ``fields`` (8 if not given) are left out."""
    names = [f"{column}_{i + 1}" for i in range(fields or 8)]
    options = {"sep": ",", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE"}
    row = F.from_csv(qcol(column), ", ".join(f"`{n}` string" for n in names), options)
    return [F.nullif(row[n], F.lit("")).alias(n) for n in names]


def write_csv(df: DataFrame, path: str, small: bool = False) -> None:
    """A folder of CSV parts with headers; one part for reports known to be small."""
    (df.coalesce(1) if small else df).write.mode("overwrite").csv(path, header=True, escape='"')


def write_stata(df: DataFrame, path: str, max_rows: int = 1_000_000) -> bool:
    """A .dta file through the driver, for at most ``max_rows`` rows; a failure is logged, not raised."""
    try:
        _bounded(df, max_rows)
        frame = df.toPandas()
        frame.columns = [c.replace(".", "_").lstrip("_") or "v" for c in frame.columns]
        frame.to_stata(path, write_index=False, version=118)
    except Exception as x:  # noqa: BLE001
        log.warning("no Stata file %s: %s", path, x)
        return False
    return True


def export_bundle(bundle: Mapping[str, Mapping[int, DataFrame | None]], folder: str, file_prefix: str = "T_", variable_prefix: str = "") -> list[str]:
    """``folder/GROUP/T_<wave>.csv`` for every table that is there, ``variable_prefix`` off the column names."""
    out = []
    for group, tables in bundle.items():
        for time, df in tables.items():
            if df is not None:
                path = f"{folder}/{group}/{file_prefix}{time}.csv"
                write_csv(df.select(*(qcol(c).alias(c.removeprefix(variable_prefix)) for c in df.columns)), path)
                out.append(path)
    return out
