"""Corrections: validated, keyed changes of one table, of several tables, and of long tables.

A sheet has one row for each fix: unique id, id, WHAT (a column, 'whole observation' or 'IDENTICAL'), change_from,
change_to and state. Sheets are joined to tables by key; nothing is applied by position.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillpanel.session import fresh, qcol


@dataclass(frozen=True)
class SheetColumns:
    uid: str = "uid"
    id: str = "id"
    what: str = "what"
    before: str = "change_from"
    after: str = "change_to"
    state: str = "state"


FLAGS = ("missing_uid", "incomplete_record", "duplicate_changes", "multiple_conclusions", "what_not_found", "existing_id", "nonexistent_id_removed")
WHOLE, IDENTICAL = r"^WHOLE\s*OBS", r"^IDENTICAL"


def _key(c: Column) -> Column:
    return F.nullif(F.upper(F.trim(c.cast("string"))), F.lit(""))


def normal_sheet(sheet: DataFrame, cols: SheetColumns = SheetColumns()) -> DataFrame:
    """(uid, id, what, change_from, change_to, state): trimmed, keys and WHAT in capitals, blanks NULL, rows without
    anything dropped."""
    text = lambda c: F.nullif(F.trim(qcol(c).cast("string")), F.lit("")) if c in sheet.columns else F.lit(None).cast("string")
    out = sheet.select(
        F.upper(text(cols.uid)).alias("uid"), F.upper(text(cols.id)).alias("id"), F.upper(text(cols.what)).alias("what"), text(cols.before).alias("change_from"), text(cols.after).alias("change_to"), F.lower(text(cols.state)).alias("state")
    )
    return out.filter(F.coalesce("uid", "id", "what", "change_from", "change_to").isNotNull())


def verify_fixes(sheet: DataFrame, df: DataFrame, uid_col: str, id_col: str, cols: SheetColumns = SheetColumns()) -> DataFrame:
    """The normalised sheet with a fixhash, seven flags and any_issue.

    missing_uid: the table has no such row. incomplete_record: no unique id or WHAT, or no new value where one is
    needed. duplicate_changes: the same fix twice. multiple_conclusions: several new values for one cell.
    what_not_found: no such column. existing_id, nonexistent_id_removed: after all id changes and deletions of the
    sheet an id would occur more than once, or less often than never. NULL keys never match. All counts are
    aggregates joined back."""
    fixes = normal_sheet(sheet, cols)
    whole, same = F.col("what").rlike(WHOLE), F.col("what").rlike(IDENTICAL)
    fixhash = F.md5(F.concat_ws("\x01", *(F.coalesce(F.col(c), F.lit("\x02")) for c in ("uid", "id", "what"))))
    fixes = fixes.withColumn("fixhash", fixhash)
    names = [c.upper() for c in df.columns]
    table = df.select(_key(qcol(uid_col)).alias("__u"), _key(qcol(id_col)).alias("__i"))
    there = table.filter("__u IS NOT NULL").groupBy("__u").agg(F.min("__i").alias("__own"))
    per_hash = fixes.groupBy("fixhash").agg(F.count(F.lit(1)).alias("__times"), F.countDistinct(F.upper("change_to")).alias("__ends"))
    wide = fixes.join(there, fixes["uid"] == there["__u"], "left").join(per_hash, "fixhash")
    known = F.coalesce(whole | same | F.col("what").isin(names), F.lit(False))
    changes_id = F.col("what") == id_col.upper()
    wide = wide.withColumns(
        {
            "missing_uid": F.col("__u").isNull(),
            "incomplete_record": F.col("uid").isNull() | F.col("what").isNull() | F.coalesce(~whole & ~same & F.col("change_to").isNull(), F.lit(False)),
            "duplicate_changes": F.col("__times") > 1,
            "multiple_conclusions": F.col("__ends") > 1,
            "what_not_found": ~known,
            "__id_change": F.coalesce(changes_id, F.lit(False)),
            "__deleted": F.coalesce(whole, F.lit(False)),
        }
    )
    # the pool of ids: what the table has, less what fixes take away, and what they bring
    current = F.coalesce(F.col("__own"), F.upper("change_from"), F.col("id"))
    moves = wide.select(
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("__id_change") | F.col("__deleted"), F.struct(current.alias("i"), F.lit(-1).alias("d"))),
                    F.when(F.col("__id_change") & F.col("change_to").isNotNull(), F.struct(F.upper("change_to").alias("i"), F.lit(1).alias("d"))),
                )
            )
        ).alias("m")
    ).select("m.i", "m.d")
    moved = moves.filter("i IS NOT NULL").groupBy("i").agg(F.sum("d").alias("__d"))
    pool = moved.join(table.groupBy(F.col("__i").alias("i")).agg(F.count(F.lit(1)).alias("__n")), "i", "left").select("i", (F.coalesce("__n", F.lit(0)) + F.col("__d")).alias("__left"))
    wide = (
        wide.join(pool.select(F.col("i").alias("__to"), F.col("__left").alias("__to_left")), F.upper("change_to") == F.col("__to"), "left")
        .join(pool.select(F.col("i").alias("__from"), F.col("__left").alias("__from_left")), current == F.col("__from"), "left")
        .withColumns(
            {
                "existing_id": F.col("__id_change") & F.coalesce(F.col("__to_left") > 1, F.lit(False)),
                "nonexistent_id_removed": (F.col("__id_change") | F.col("__deleted")) & F.coalesce(F.col("__from_left") < 0, F.lit(False)),
            }
        )
    )
    any_issue = F.lit(False)
    for f in FLAGS:
        any_issue = any_issue | F.col(f)
    return wide.select("uid", "id", "what", "change_from", "change_to", "state", "fixhash", *FLAGS, any_issue.alias("any_issue"))


@dataclass
class Result:
    df: DataFrame
    err: DataFrame


def apply_fixes(df: DataFrame, sheet: DataFrame, uid_col: str, id_col: str, *, cols: SheetColumns = SheetColumns(), force: bool = False) -> Result:
    """The corrected table, and the fixes that were not applied.

    A fix is accepted if it has no issue, or by ``force``, and its state is not 'rejected'. Several new values for one
    cell contradict each other; none of them is applied, by force neither. Whole observations are
    deleted; of rows that are IDENTICAL for an id one stays (the one whose key comes first by hash); other fixes set
    the cell of their key, cast to its type (a value that doesn't fit is left out and reported). The sheet is
    aggregated to one row for each key before it meets the table; untouched rows pass through."""
    checked = verify_fixes(sheet, df, uid_col, id_col, cols)
    usable = (~F.col("multiple_conclusions") if force else ~F.col("any_issue")) & (F.coalesce(F.col("state"), F.lit("")) != "rejected") & F.col("uid").isNotNull()
    kinds = {c.upper(): (c, k) for c, k in df.dtypes}
    fits = F.lit(True)
    for upper, (_, kind) in kinds.items():
        if kind != "string":
            fits = fits & ~((F.col("what") == upper) & F.col("change_to").isNotNull() & F.col("change_to").try_cast(kind).isNull())
    checked = checked.withColumn("accepted", F.coalesce(usable & fits, F.lit(False)))
    accepted = checked.filter("accepted")
    whole, same = F.col("what").rlike(WHOLE), F.col("what").rlike(IDENTICAL)
    deleted = accepted.filter(whole).select("uid")
    twins = accepted.filter(same & F.col("id").isNotNull()).select("uid", "id").distinct()
    keeper = twins.groupBy("id").agg(F.min_by("uid", F.struct(F.xxhash64("uid"), "uid")).alias("uid"))
    gone = deleted.unionByName(twins.join(keeper, ["id", "uid"], "left_anti").select("uid")).distinct()
    changes = accepted.filter(~whole & ~same)
    wide = changes.groupBy(F.col("uid").alias("__fixed")).agg(*(F.max(F.when(F.col("what") == u, F.struct(F.col("change_to").alias("v")))).alias(f"__f{i}") for i, u in enumerate(kinds)))
    key = fresh(df, "__uid")
    keyed = df.withColumn(key, _key(qcol(uid_col)))
    kept = keyed.join(gone.withColumnRenamed("uid", "__gone"), keyed[key] == F.col("__gone"), "left_anti")
    fixed = kept.join(wide, kept[key] == wide["__fixed"], "left")
    cells = []
    for i, (c, kind) in enumerate(kinds.values()):
        new = F.col(f"__f{i}")
        cells.append(F.when(new.isNotNull(), new["v"].try_cast(kind)).otherwise(qcol(c)).alias(c))
    return Result(fixed.select(*cells), checked.filter("NOT accepted").drop("accepted"))


def explode_multi_fixes(sheet: DataFrame, *, database: str, what: str, after: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row for each fix of a sheet that packs several: databases are |-parallel with WHAT and new values, and
    within a database variables are comma-parallel.

    Columns: ``keep``, database, what, change_to, n_what, n_values (to tell unequal lists), with NULL for a value that
    a list lacks. A sheet row with one database applies it to all parts."""
    parts = lambda c, d: F.transform(F.split(F.coalesce(c, F.lit("")), d, -1), lambda x: F.trim(x))
    bars = F.arrays_zip(parts(qcol(database), r"\|").alias("d"), parts(qcol(what), r"\|").alias("w"), parts(qcol(after), r"\|").alias("v"))
    by_db = sheet.select(*map(qcol, keep), F.explode(bars).alias("__b")).select(*map(qcol, keep), F.nullif(F.upper(F.col("__b.d")), F.lit("")).alias("database"), F.col("__b.w").alias("__w"), F.col("__b.v").alias("__v")).filter("database IS NOT NULL")
    whats, values = parts(F.col("__w"), ","), parts(F.col("__v"), ",")
    sized = by_db.select(*map(qcol, keep), "database", F.size(whats).alias("n_what"), F.size(values).alias("n_values"), F.explode(F.arrays_zip(whats.alias("w"), values.alias("v"))).alias("__f"))
    return sized.select(
        *map(qcol, keep), "database", F.nullif(F.upper(F.col("__f.w")), F.lit("")).alias("what"), F.nullif(F.col("__f.v"), F.lit("")).alias("change_to"), F.col("n_what").cast("long").alias("n_what"), F.col("n_values").cast("long").alias("n_values")
    ).filter("what IS NOT NULL")


def apply_multi_fixes(tables: Mapping[str, DataFrame], sheet: DataFrame, uid_col: str, id_col: str, *, database: str = "database", uids: Mapping[str, str] | None = None, cols: SheetColumns = SheetColumns(), force: bool = True) -> dict[str, Result]:
    """``apply_fixes`` for each table with the sheet's fixes of that database. uids: the sheet's column of unique ids
    for each database, where there are several."""
    out = {}
    for name, df in tables.items():
        uid = (uids or {}).get(name, cols.uid)
        flat = explode_multi_fixes(sheet, database=database, what=cols.what, after=cols.after, keep=[uid, cols.id]).filter(F.col("database") == name.upper())
        own = flat.select(qcol(uid).alias("uid"), qcol(cols.id).alias("id"), "what", "change_to")
        result = apply_fixes(df, own, uid_col, id_col, force=force)
        out[name] = result
    return out


def apply_long_fixes(df: DataFrame, sheet: DataFrame, root: str, id_col: str, time_col: str, uid_col: str, *, database: str = "database", cols: SheetColumns = SheetColumns(), force: bool = True) -> Result:
    """Fixes of a long table whose sheet names ``<root>_<time>`` as the database: the database joins the key, so the
    table isn't split. Rows without a unique id go; the rest is ordered by id and time by whoever writes it."""
    flat = explode_multi_fixes(sheet, database=database, what=cols.what, after=cols.after, keep=[cols.uid, cols.id])
    own = flat.filter(F.col("database").rlike(f"^{root.upper()}_")).select(
        F.concat_ws("@", F.substring("database", F.lit(len(root) + 2), F.length("database")), F.upper(F.trim(qcol(cols.uid)))).alias("uid"), qcol(cols.id).alias("id"), "what", "change_to"
    )
    key = fresh(df, "__row")
    keyed = df.filter(qcol(uid_col).isNotNull()).withColumn(key, F.concat_ws("@", qcol(time_col).cast("string"), F.upper(F.trim(qcol(uid_col).cast("string")))))
    result = apply_fixes(keyed, own, key, id_col, force=force)
    return Result(result.df.drop(key), result.err)


