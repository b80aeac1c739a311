"""Problem 4: schemas that drift between files.

Rescue-column ingestion. Every record's fields are looked up in a mapping sheet; a value that is known and fits
the target type without loss goes to its typed column, everything else (unknown fields, values that don't fit,
second values of a field, payloads that can't be read) is kept as JSON in one rescue column, so nothing is lost. Approved fields can be promoted later and are replayed from the rescue
column. The changes between successive files of one source are read off the same ingested entries.

The sheet is metadata: one map per group, joined by group. Records are worked on row by row; only the catalogue
of files (fields x files) is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillpanel.functions.coding import code_pairs, code_set
from quillpanel.session import fresh, let, qcol, stored

RESCUE = "_rescued"
ORIGIN = "_origin"
UNPARSED = "_unparsed"  # in the rescue column: a payload that can't be read, as text


def field_key(name: Column) -> Column:
    """What of a field's name counts for matching: letters and digits, without case."""
    return F.lower(F.regexp_replace(name, r"[^\p{L}\p{N}]++", ""))


def sheet_names(sheet: DataFrame, group: str, name_columns: Sequence[str], target: str) -> DataFrame:
    """(group, name_key, field): which field each wave's name belongs to. Empty rows and repeats drop out; of two
    fields that claim one name, the first in alphabetical order has it."""
    long = sheet.select(qcol(group).alias("__g"), F.upper(F.trim(qcol(target))).alias("__f"), F.explode(F.array(*map(qcol, name_columns))).alias("__n"))
    keyed = long.select("__g", "__f", field_key(F.col("__n")).alias("__k")).filter(F.col("__g").isNotNull() & (F.col("__f") != "") & (F.col("__k") != ""))
    return keyed.groupBy(F.col("__g").alias(group), F.col("__k").alias("name_key")).agg(F.min("__f").alias("field"))


def sheet_codes(sheet: DataFrame, group: str, code_columns: Mapping[int, str], target: str) -> DataFrame:
    """(group, field, wave, codes): each wave's code list as an order-free text. Repeated rows count once."""
    entries = F.explode(F.array(*(F.struct(F.lit(w).alias("wave"), code_set(qcol(c)).alias("codes")) for w, c in code_columns.items())))
    long = sheet.select(qcol(group).alias("__g"), F.upper(F.trim(qcol(target))).alias("__f"), entries.alias("__e")).filter(F.col("__g").isNotNull() & (F.col("__f") != ""))
    return long.groupBy(F.col("__g").alias(group), F.col("__f").alias("field"), F.col("__e.wave").alias("wave")).agg(F.min("__e.codes").alias("codes")).filter(F.col("codes").isNotNull())


def json_kind(value: Column) -> Column:
    """whole, decimal, text, boolean, other; NULL for a JSON null."""
    shape = F.schema_of_variant(value)
    return (
        F.when(shape.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "whole")
        .when(shape.startswith("DECIMAL") | shape.isin("DOUBLE", "FLOAT"), "decimal")
        .when(shape == "STRING", "text")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape == "VOID", F.lit(None))
        .otherwise(F.when(value.isNotNull(), "other"))
    )


def lossless(value: Column, kind: Column, target: str) -> Column:
    """Whether the value can be had back from what it becomes as ``target`` (bigint, double, boolean or string).

    Numbers must stay equal, so a fraction is no bigint; texts must be the number as it is usually written; truth
    values are no numbers, but 0 and 1, yes and no are truth values."""
    cast, text = F.try_variant_get(value, "$", target), F.try_variant_get(value, "$", "string")
    number = (kind != "boolean") & (kind != "other")
    if target == "bigint":
        fits = F.when(kind == "whole", True).when(number & text.rlike(r"^-?(0|[1-9]\d*)(\.0+)?$"), True).otherwise((kind == "decimal") & text.contains("E") & (cast.cast("double") == F.try_variant_get(value, "$", "double")) & cast.between(-(2**53), 2**53))
    elif target == "double":
        digits = F.length(F.regexp_replace(F.regexp_replace(text, r"[-.]", ""), "^0+", ""))
        same = cast.cast("string").try_cast("decimal(38,18)") == text.try_cast("decimal(38,18)")
        plain = text.rlike(r"^-?(0|[1-9]\d*)(\.\d+)?$")
        fits = F.when(kind == "whole", cast.try_cast("bigint") == F.try_variant_get(value, "$", "bigint")).when((kind == "decimal") & text.contains("E"), True).otherwise(number & plain & ((digits <= 15) | ((digits <= 19) & same)))
    elif target == "boolean":
        fits = (kind == "boolean") | (kind.isin("whole", "text") & text.isin("0", "1", "true", "false", "yes", "no"))
    elif target == "string":
        fits = kind.isNotNull()
    else:
        raise ValueError(f"no rule for values as {target}")
    return F.coalesce(cast.isNotNull() & fits, F.lit(False))


def ingest(records: DataFrame, names: DataFrame, *, group: str, payload: str) -> DataFrame:
    """``records`` with ``__entries``: array<struct<field, raw, kind, value>> of what each record holds.

    field: the sheet's field, or the raw name where the sheet has none. kind: whole, decimal, text, boolean, other,
    or NULL for a JSON null. A NULL, broken or non-object payload gives an empty array; the raw text stays where it
    was, and a payload that can't be read as a whole is in ``__unparsed``. Groups the sheet doesn't know keep their own names."""
    by_group = names.groupBy(qcol(group).alias("__sheet_group")).agg(F.map_from_entries(F.collect_list(F.struct("name_key", "field"))).alias("__sheet"))
    parsed = records.withColumn("__map", F.from_json(qcol(payload), T.MapType(T.StringType(), T.VariantType())))
    joined = parsed.join(by_group, qcol(group) == F.col("__sheet_group"), "left")

    def entry(e: Column) -> Column:
        field = F.coalesce(F.try_element_at(F.col("__sheet"), field_key(e["key"])), e["key"])
        return F.struct(field.alias("field"), e["key"].alias("raw"), json_kind(e["value"]).alias("kind"), e["value"].alias("value"))

    entries = F.transform(F.map_entries(F.col("__map")), entry)
    unread = F.when((F.trim(qcol(payload)) != "") & (F.col("__map").isNull() | F.try_parse_json(qcol(payload)).isNull()), qcol(payload))
    return joined.withColumn("__entries", F.coalesce(entries, F.array().cast("array<struct<field:string,raw:string,kind:string,value:variant>>"))).withColumn("__unparsed", unread).drop("__map", "__sheet", "__sheet_group")


def typed_table(ingested: DataFrame, target: Mapping[str, str], keep: Sequence[str], recode: DataFrame | None = None, *, group: str = "assess_group", wave: str = "wave", origin: bool = False) -> DataFrame:
    """``keep`` columns, one typed column for each field of ``target``, and ``_rescued``: a JSON object (under their
    raw names) of all fields that the target doesn't have, all values that don't fit their type without loss, and all
    but the first fitting value of a field; a payload that can't be read is there as text, as ``_unparsed``.

    origin: adds ``_origin``, array<struct<field, raw, kind>>: under which name and as what kind of JSON value each of the
    record's fields came in, typed or rescued; ``file_changes`` reads it.

    recode: ``recode_map``'s rows, joined by ``group`` and ``wave``. A field with any in its group is coded: its values
    are translated, and one that its wave's code list doesn't translate is rescued, so that codes never mix."""
    if recode is not None:
        one = recode.groupBy(qcol(group).alias("__rg"), F.col("wave").alias("__rw"), F.concat_ws("=", "field", "value").alias("k")).agg(F.min("final_value").alias("v"))
        codes = one.groupBy("__rg", "__rw").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("__codes"))
        coded = recode.groupBy(qcol(group).alias("__cg")).agg(F.collect_set("field").alias("__coded"))
        ingested = ingested.join(coded, qcol(group) == F.col("__cg"), "left").join(codes, (qcol(group) == F.col("__rg")) & (qcol(wave) == F.col("__rw")), "left")

    is_coded = lambda f: F.coalesce(F.array_contains("__coded", f), F.lit(False)) if recode is not None else F.lit(False)
    final = lambda f, v: F.try_element_at(F.col("__codes"), F.concat_ws("=", f, F.try_variant_get(v, "$", "string")))

    def mark(e: Column) -> Column:
        fits = F.lit(False)
        for field, kind in target.items():
            held = lossless(e["value"], e["kind"], kind)
            if recode is not None:
                held = F.when(is_coded(F.lit(field)), final(e["field"], e["value"]).try_cast(kind).isNotNull()).otherwise(held)
            fits = F.when(e["field"] == field, held).otherwise(fits)
        return F.struct(e["field"].alias("field"), e["raw"].alias("raw"), e["kind"].alias("kind"), e["value"].alias("value"), fits.alias("fits"))

    marked = ingested.withColumn("__entries", F.transform("__entries", mark))
    marked = marked.withColumn("__fitting", F.transform("__entries", lambda e: F.when(e["fits"], e["field"])))
    place = lambda f: F.array_position("__fitting", f)  # noqa: E731  of a field's first fitting value, from 1

    def fitting(field: str, kind: str) -> Column:
        value = F.get("__entries", place(F.lit(field)).cast("int") - 1)["value"]
        plain = F.try_variant_get(value, "$", kind)
        return F.when(is_coded(F.lit(field)), final(F.lit(field), value).try_cast(kind)).otherwise(plain) if recode is not None else plain

    def left(e: Column, i: Column) -> Column:
        return e["kind"].isNotNull() & ~F.coalesce(e["fits"] & (place(e["field"]) == i + 1), F.lit(False))

    rest = F.transform(F.filter("__entries", left), lambda e: F.struct(e["raw"].alias("key"), e["value"].alias("value")))
    unread = F.when(F.col("__unparsed").isNotNull(), F.array(F.struct(F.lit(UNPARSED).alias("key"), F.variant_get(F.to_variant_object(F.array("__unparsed")), "$[0]", "variant").alias("value"))))
    whole = F.concat(_once(rest), F.coalesce(unread, F.array().cast("array<struct<key:string,value:variant>>")))
    traced = [F.transform("__entries", lambda e: F.struct(e["field"].alias("field"), e["raw"].alias("raw"), e["kind"].alias("kind"))).alias(ORIGIN)] if origin else []
    return marked.select(*map(qcol, keep), *traced, *(fitting(f, k).alias(f) for f, k in target.items()), let(whole, lambda r: F.when(F.size(r) > 0, F.to_json(F.map_from_entries(r)))).alias(RESCUE))


def _once(entries: Column) -> Column:
    """The first entry of each key; a payload that repeats a key isn't valid and is kept whole besides."""
    return let(entries, lambda r: let(F.transform(r, lambda e: e["key"]), lambda keys: F.filter(r, lambda e, i: F.array_position(keys, e["key"]) == i + 1)))


def promote(table: DataFrame, approved: Mapping[str, str]) -> DataFrame:
    """Replay approved fields out of the rescue column into typed columns; what still doesn't fit stays rescued.

    approved: raw name to type. A column that exists already is filled where it is NULL, elsewhere the value stays
    rescued."""
    as_map = F.from_json(qcol(RESCUE), T.MapType(T.StringType(), T.VariantType()))

    def replay(m: Column) -> Column:
        taken = lambda k, v: F.lit(False)
        for name, kind in approved.items():
            free = qcol(name).isNull() if name in table.columns else F.lit(True)
            taken = (lambda n, t, o, before: lambda k, v: ((k == n) & o & lossless(v, json_kind(v), t)) | before(k, v))(name, kind, free, taken)
        left = F.map_filter(m, lambda k, v: ~taken(k, v))
        value = lambda n, t: let(F.try_element_at(m, F.lit(n)), lambda v: F.when(lossless(v, json_kind(v), t), F.try_variant_get(v, "$", t)))
        values = [value(n, t).alias(f"f{i}") for i, (n, t) in enumerate(approved.items())]
        return F.struct(F.when(F.size(left) > 0, F.to_json(left)).alias("left"), *values)

    slot = fresh(table, "__replayed")
    replayed = table.withColumn(slot, let(as_map, replay))
    filled = {}
    for i, name in enumerate(approved):
        value = qcol(slot)[f"f{i}"]
        filled[name] = F.coalesce(qcol(name), value) if name in table.columns else value
    return replayed.withColumns({**filled, RESCUE: qcol(slot)["left"]}).drop(slot)


def dominant_types(ingested: DataFrame, fields: Sequence[str]) -> dict[str, str]:
    """Target type of each field: the JSON type most of its values have, over all records. One partial aggregate;
    what comes to the driver is fields x five kinds, bounded by the sheet."""
    sql = {"whole": "bigint", "decimal": "double", "text": "string", "boolean": "boolean", "other": "string"}
    counts = (
        ingested.select(F.explode("__entries").alias("e")).filter(F.col("e.field").isin(*fields) & F.col("e.kind").isNotNull()).groupBy(F.col("e.field").alias("field"), F.col("e.kind").alias("kind")).count()
    )
    best = counts.groupBy("field").agg(F.max_by("kind", F.struct("count", "kind")).alias("kind"))
    found = {r["field"]: sql[r["kind"]] for r in best.collect()}
    return {f: found.get(f, "string") for f in fields}


def with_previous(files: DataFrame, source: Sequence[str], file: str, arrived: str, value: str) -> DataFrame:
    """Each file with ``__prev``: a struct of ``value`` of the file of its source received just before it; first files
    have NULL.

    Two levels, so that a source with any number of files fits: files are ordered within a day, and each day's
    first file takes the last file of the source's latest earlier day. A window holds one day of one source, or
    one row for each day of it. Equal times are ordered by ``file``."""
    order, held = F.struct(qcol(arrived), qcol(file)), F.struct(qcol(value).alias("v"))
    dayed = files.withColumn("__day", F.to_date(qcol(arrived)))
    last = dayed.groupBy(*map(qcol, source), "__day").agg(F.max_by(held, order).alias("__last"))
    across = last.withColumn("__before", F.lag("__last").over(Window.partitionBy(*map(qcol, source)).orderBy("__day"))).drop("__last")
    within = F.lag(held).over(Window.partitionBy(*map(qcol, source), "__day").orderBy(qcol(arrived), qcol(file)))
    joined = dayed.withColumn("__within", within).join(across, [*source, "__day"], "left")
    return joined.withColumn("__prev", F.coalesce(F.col("__within"), F.col("__before"))).drop("__day", "__within", "__before")


def file_changes(table: DataFrame, codes: DataFrame, *, source: Sequence[str], group: str, file: str, wave: str, arrived: str) -> DataFrame:
    """(source columns, file, field, change_kind): what changed from the file received just before. ``table`` is a
    ``typed_table`` with its origins.

    added and removed: the field is in one of the two files only. renamed: the sets of raw names differ.
    retyped: the sets of JSON kinds differ, where both files have any non-null value. recoded: both waves have
    code lists and these differ. A source's first file gives none. Records with a NULL file or source take no
    part; a repeated record changes nothing.

    Records are read once and counted map-side; from then on a file is one row, which holds its fields (there are as
    many as its schema has), and is compared with the row before it. The rows of the files are a written table."""
    keys = [*source, file]
    whole = F.lit(True)
    for k in keys:
        whole = whole & qcol(k).isNotNull()
    said = table.filter(whole).select(*map(qcol, keys), qcol(wave).alias("__wave"), qcol(arrived).alias("__at"), F.explode_outer(ORIGIN).alias("e"))
    seen = said.groupBy(*map(qcol, keys), F.col("e.field").alias("__field"), F.col("e.raw").alias("__raw"), F.col("e.kind").alias("__kind")).agg(F.max("__wave").alias("__wave"), F.min("__at").alias("__at"))
    fields = seen.repartition(*map(qcol, keys)).groupBy(*map(qcol, keys), "__field").agg(
        F.array_sort(F.collect_set("__raw")).alias("raws"), F.array_sort(F.collect_set("__kind")).alias("kinds"), F.max("__wave").alias("__wave"), F.min("__at").alias("__at")
    )
    entry = F.struct(F.col("__field").alias("field"), "raws", "kinds", F.col("__wave").alias("wave"))
    files = fields.groupBy(*map(qcol, keys)).agg(F.min("__at").alias("__at"), F.collect_list(F.when(F.col("__field").isNotNull(), entry)).alias("__fields"))
    listed = codes.select(qcol(group).alias("__cg"), F.struct(F.col("field").alias("f"), F.col("wave").cast("long").alias("w")).alias("k"), "codes").groupBy("__cg").agg(F.map_from_entries(F.collect_list(F.struct("k", "codes"))).alias("__codes"))
    coded = files.join(listed, qcol(group) == F.col("__cg"), "left").drop("__cg")
    code = lambda e: F.try_element_at(F.col("__codes"), F.struct(e["field"].alias("f"), e["wave"].cast("long").alias("w")))
    known = F.map_from_entries(F.transform("__fields", lambda e: F.struct(e["field"], F.struct(e["raws"].alias("raws"), e["kinds"].alias("kinds"), code(e).alias("codes")))))
    rows = with_previous(stored(coded.select(*map(qcol, keys), "__at", known.alias("__now"))), source, file, "__at", "__now").filter(F.col("__prev").isNotNull())

    def changes(f: Column) -> Column:
        def compare(now: Column, old: Column) -> Column:
            here, there = now.isNotNull(), old.isNotNull()
            stays = here & there
            kinds = F.array(
                F.when(here & ~there, "added"),
                F.when(~here & there, "removed"),
                F.when(stays & (now["raws"] != old["raws"]), "renamed"),
                F.when(stays & (F.size(now["kinds"]) > 0) & (F.size(old["kinds"]) > 0) & (now["kinds"] != old["kinds"]), "retyped"),
                F.when(stays & (now["codes"] != old["codes"]), "recoded"),
            )
            return F.transform(F.array_compact(kinds), lambda k: F.struct(f.alias("field"), k.alias("change_kind")))

        return let(F.try_element_at(F.col("__now"), f), lambda now: let(F.try_element_at(F.col("__prev.v"), f), lambda old: compare(now, old)))

    every = F.array_union(F.map_keys("__now"), F.map_keys("__prev.v"))
    return rows.select(*map(qcol, keys), F.inline(F.flatten(F.transform(every, changes))))


def recode_map(sheet: DataFrame, group: str, code_columns: Mapping[int, str], final: str, target: str) -> DataFrame:
    """(group, field, wave, value, final_value): each wave's codes translated through their labels to the final coding.
    A final label 'A & B' means either; a label that is there as a whole comes first."""
    wave_pairs = F.explode(F.array(*(F.struct(F.lit(w).alias("wave"), code_pairs(qcol(c)).alias("pairs")) for w, c in code_columns.items())))
    long = sheet.filter(qcol(group).isNotNull()).select(qcol(group).alias("g"), F.upper(F.trim(qcol(target))).alias("field"), code_pairs(qcol(final)).alias("fin"), wave_pairs.alias("w"))
    flat = long.select("g", "field", "fin", F.col("w.wave").alias("wave"), F.explode("w.pairs").alias("p"))
    said = lambda x: F.array_contains(F.transform(F.split(x["label"], "&"), lambda d: F.trim(d)), F.col("p.label"))
    whole = F.filter("fin", lambda x: x["label"] == F.col("p.label"))
    to = F.coalesce(F.get(whole, F.lit(0)), F.get(F.filter("fin", said), F.lit(0)))["value"]
    return flat.select(F.col("g").alias(group), "field", "wave", F.col("p.value").alias("value"), to.alias("final_value")).filter(F.col("final_value").isNotNull()).distinct()
