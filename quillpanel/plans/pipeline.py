"""The whole pipeline: homogenize, patch non-response, apply the codebook, merge groups and waves, spread."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillpanel.operators.clean import patch_nonresponse
from quillpanel.operators.codebook import CodebookColumns, apply_codebook
from quillpanel.operators.homogenize import Bundle, homogenize
from quillpanel.operators.reshape import TIME, merge_groups, merge_times, spread
from quillpanel.plans.mapping import Issue, MapColumns
from quillpanel.session import qcol
from quillpanel.sources.io import export_bundle, write_csv, write_stata


@dataclass
class Cleaned:
    bundle: Bundle
    issues: list[Issue]
    merged: dict[int, DataFrame] = field(default_factory=dict)
    long: DataFrame | None = None
    wide: DataFrame | None = None


def clean_databases(
    mapping: Sequence[Mapping[str, object]],
    data: Mapping[str, Mapping[int, DataFrame | None]],
    *,
    ids: Sequence[str] = ("ST_ID",),
    map_cols: MapColumns = MapColumns(),
    codebook_cols: CodebookColumns = CodebookColumns(),
    waves: Sequence[str] | None = None,
    patch99: bool = True,
    merge: bool = True,
    spread_times: bool = False,
    on_duplicates: str = "error",
    report_directory: str | None = None,
    output_directory: str | None = None,
    stata: bool = False,
) -> Cleaned:
    """One lazy plan for each table; jobs only where a schema depends on values (types of recoded columns, spread).

    Only managed columns (those the mapping names) and the ids go on to the merge. report_directory: the issues are
    written there, as ISSUES.csv. output_directory: every table is written there, as GROUP/T_<wave>.csv, and what was
    merged as ALL_MERGED_LONG.csv and ALL_MERGED_WIDE.csv; with ``stata`` the merged ones also as .dta, where they are
    small enough for that format."""
    done = homogenize(mapping, data, cols=map_cols, waves=waves)
    issues = list(done.issues)
    bundle: Bundle = {}
    for group, tables in done.bundle.items():
        bundle[group] = {}
        for time, df in tables.items():
            if df is None:
                bundle[group][time] = None
                continue
            managed = [c for c in dict.fromkeys([*ids, *done.managed[(group, time)]]) if c in df.columns]
            one = df.select(*map(qcol, managed))
            one = patch_nonresponse(one) if patch99 else one
            applied = apply_codebook(one.withColumn(TIME, F.lit(time)), mapping, ids=[c for c in ids if c in one.columns], cols=codebook_cols, group=group, when=time, key=f"T{time}", waves=waves)
            issues += applied.issues
            bundle[group][time] = applied.df.drop(TIME)
    out = Cleaned(bundle, issues)
    if merge:
        out.merged = merge_groups(bundle, ids)
        out.long = merge_times(out.merged, [".MERGE", TIME])
        if spread_times:
            out.wide = spread(out.long, [".MERGE"], TIME, on_duplicates=on_duplicates)
    session = next((df.sparkSession for tables in bundle.values() for df in tables.values() if df is not None), None)
    if report_directory and session:
        write_csv(issue_rows(session, issues), f"{report_directory.rstrip('/')}/ISSUES.csv", small=True)
    if output_directory:
        folder = output_directory.rstrip("/")
        export_bundle(bundle, folder)
        for name, df in (("ALL_MERGED_LONG", out.long), ("ALL_MERGED_WIDE", out.wide)):
            if df is not None:
                write_csv(df, f"{folder}/{name}.csv")
                if stata:
                    write_stata(df, f"{folder}/{name}.dta")
    return out


def issue_rows(spark, issues: Sequence[Issue]) -> DataFrame:
    return spark.createDataFrame([(i.level, i.group, i.time, i.variable, i.message) for i in issues], "level string, `Group` string, `Wave` int, `Variable` string, `Issue` string")
