"""Queries of the survey operators over the driver's tables, each with the SQL that says the same.

The driver's tables hold no NULLs, so queries that show NULL handling induce them by the same rule on both sides.
"""

from __future__ import annotations

import unicodedata
from functools import reduce
from string import ascii_letters

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillpanel.functions import text
from quillpanel.operators import clean, codebook, corrections, homogenize, matching, report, reshape, verify
from quillpanel.plans import dsl, pipeline
from quillpanel.session import read_table

Spark = SparkSession


def _dec(c: Column, scale: int = 2) -> Column:
    """Sums of doubles that don't depend on the order of addition."""
    return F.sum(c.cast(f"decimal(18,{scale})"))


# ---------------------------------------------------------------- verification
def dup_flag_all_members(spark: Spark, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return verify.flag_duplicates(li, ["l_orderkey", "l_linenumber"])


def single_set_issues(spark: Spark, d: str) -> DataFrame:
    orders = read_table(spark, d, "orders").select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("order_id"), "o_orderkey", "o_totalprice")
    li = read_table(spark, d, "lineitem").select(F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("order_id"), "l_linenumber", "l_partkey", "l_quantity")
    reference = orders.filter("o_totalprice < 200000")
    return verify.single_set_issues(
        li, "order_id", reference=reference, patterns={"order_id": verify.id_pattern("O", "", (1, 4), "XN")}, checks={"large_quantity": lambda x: F.col("l_quantity") > 45}
    )


def id_pattern_bad(spark: Spark, d: str) -> DataFrame:
    c = read_table(spark, d, "customer").select("c_custkey", "c_name")
    pattern = verify.id_pattern("#000000", "Customer", 3, "CXN")
    return c.filter(verify.bad_pattern(F.col("c_name"), pattern))


def weird_or_duplicated(spark: Spark, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select(F.concat(F.lit("P"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")).alias("pid"), "l_orderkey", "l_linenumber")
    return verify.weird_or_duplicated(li, "pid", verify.id_pattern("P", "", (1, 5), "XN"))


def only_in_data(spark: Spark, d: str) -> DataFrame:
    orders = read_table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.expr("nullif(o_custkey, 7)").alias("custkey"))
    customers = read_table(spark, d, "customer").select(F.expr("nullif(c_custkey, 11)").alias("custkey"), "c_name")
    return verify.only_in(customers, orders, ["custkey"])


def only_in_reference(spark: Spark, d: str) -> DataFrame:
    orders = read_table(spark, d, "orders").select(F.expr("nullif(o_custkey, 7)").alias("custkey"), "o_orderkey")
    customers = read_table(spark, d, "customer").filter("c_acctbal > 0").select(F.expr("nullif(c_custkey, 11)").alias("custkey"))
    return verify.only_in(orders, customers, ["custkey"])


def _three_sources(spark: Spark, d: str) -> dict[str, DataFrame]:
    orders = read_table(spark, d, "orders").groupBy(F.col("o_orderkey").alias("k")).agg(F.max(F.floor("o_totalprice")).cast("double").alias("V"))
    li = read_table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.floor(_dec(F.col("l_extendedprice"))).cast("double").alias("V"))
    flat = read_table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.floor(F.max("l_extendedprice")).cast("double").alias("V"))
    return {"ORD": orders, "SUM": li, "MAX": flat.filter("k % 3 <> 0")}


def _mismatch(spark: Spark, d: str, upper: float | None, lower: float | None) -> DataFrame:
    merged = verify.merge_sources(_three_sources(spark, d), "k", ["V"])
    values = [F.col("V_ORD"), F.col("V_SUM"), F.col("V_MAX")]
    return merged.select("k", verify.value_mismatch(values, upper, lower).alias("issue"))


def value_mismatch_equal(spark: Spark, d: str) -> DataFrame:
    return _mismatch(spark, d, None, None)


def value_mismatch_upper(spark: Spark, d: str) -> DataFrame:
    return _mismatch(spark, d, 20000, None)


def value_mismatch_lower(spark: Spark, d: str) -> DataFrame:
    return _mismatch(spark, d, None, 20000)


def value_mismatch_both(spark: Spark, d: str) -> DataFrame:
    return _mismatch(spark, d, 20000, 20000)


def merge_sources_full_outer(spark: Spark, d: str) -> DataFrame:
    customers = read_table(spark, d, "customer").select(F.expr("nullif(c_custkey, 3)").alias("custkey"), "c_mktsegment")
    spent = read_table(spark, d, "orders").groupBy(F.expr("nullif(o_custkey, 5)").alias("custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    return verify.merge_sources({"CUST": customers, "ORD": spent}, "custkey", ["c_mktsegment", "n_orders"])


def dup_provenance(spark: Spark, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), "l_quantity")
    orders = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    merged = verify.merge_sources({"LINE": li, "ORD": orders}, "k", ["l_quantity", "o_orderstatus"])
    return merged.select("k", F.col("l_quantity_LINE").alias("qty"), verify.duplicate_provenance(["LINE", "ORD"]).alias("dups"))


def n_issues_rollup(spark: Spark, d: str) -> DataFrame:
    s = _three_sources(spark, d)
    both = {n: df.withColumn("W", F.floor(F.col("V") / 100000).cast("double")) for n, df in s.items()}
    out = verify.cross_source_issues({"SUM": both["SUM"], "MAX": both["MAX"]}, ("ORD", both["ORD"]), "k", variables=["V", "W"], upper={"V": 20000})
    return out.select("k", "V_ISSUE", "W_ISSUE", "N_ISSUES")


def name_mismatch_osa(spark: Spark, d: str) -> DataFrame:
    """Two sources' names of one customer: equal, two letters swapped (one edit by alignment), two letters wrong, unknown."""
    c = read_table(spark, d, "customer")
    k = F.pmod("c_custkey", F.lit(4))
    other = F.when(k == 0, F.lower("c_name")).when(k == 1, F.regexp_replace("c_name", "^Cu", "uC")).when(k == 2, F.regexp_replace("c_name", "^Cu", "XY"))
    return c.select("c_custkey", text.name_mismatch(F.col("c_name"), other, 0.1).alias("mismatch"))


def name_similarity_lev(spark: Spark, d: str) -> DataFrame:
    """Each distinct part name with the other names of its brand that are close to it: pairs of representatives, found
    by shared segments and not by comparing all."""
    parts = read_table(spark, d, "part").select(F.col("p_brand").alias("block"), F.col("p_name").alias("n")).distinct()
    pairs = matching.close_pairs(parts.withColumnRenamed("n", "v"), parts, 0.3).filter("v < n")
    return pairs.select(F.col("block").alias("p_brand"), F.col("v").alias("p_name"), F.col("n").alias("other"))


def id_retrieval(spark: Spark, d: str) -> DataFrame:
    supplier = read_table(spark, d, "supplier")
    lower = lambda c: F.substring(F.md5(F.col(c).cast("string")), 1, 14)
    master = supplier.select(
        F.concat(F.lit("ID"), F.col("s_suppkey").cast("string")).alias("sid"), lower("s_suppkey").alias("name"), F.concat(F.lit("place "), F.col("s_nationkey").cast("string"), F.lit(" end")).alias("place"),
        F.concat(F.lit("L"), F.col("s_nationkey").cast("string"), F.lit(";")).alias("place_id"), F.substring(F.md5(F.concat(F.lit("t"), F.col("s_nationkey").cast("string"))), 1, 12).alias("teacher"),
        F.concat(F.lit("T"), F.col("s_nationkey").cast("string")).alias("teacher_id"), F.col("s_nationkey").alias("nk"),
    )
    typed = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.substring(lower("s_suppkey"), 1, 12), F.lit("xx"))).otherwise(F.concat(F.substring(lower("s_suppkey"), 1, 13), F.lit("x")))
    survey = supplier.select(
        F.col("s_suppkey").alias("row"), typed.alias("sname"), F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("L"), F.col("s_nationkey").cast("string"), F.lit(";"))).alias("splace"),
        F.when(F.col("s_suppkey") % 4 != 0, F.substring(F.md5(F.concat(F.lit("t"), F.col("s_nationkey").cast("string"))), 1, 12)).alias("steacher"), F.col("s_nationkey").alias("nk"),
    )
    spec = matching.RetrievalSpec("row", "sname", "splace", "steacher", "sid", "name", "place", "place_id", "teacher", "teacher_id")
    block = F.when(F.col("nk") < 10, F.lit("A")).when(F.col("nk") < 20, F.lit("B")).otherwise(F.lit("S"))
    return matching.retrieve_ids(survey, master, spec, block, block)


# ---------------------------------------------------------------- cleaning
def _dirty(spark: Spark, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    token = F.when(k % 11 == 0, "N/A").when(k % 11 == 1, " #N/A ").when(k % 11 == 2, "#DIV/0!").when(k % 11 == 3, "").when(k % 11 == 4, "  x ").when(k % 11 == 5, "n a").otherwise(F.col("o_orderpriority"))
    return o.select(k, token.alias("cell"), F.when(k % 7 == 0, " -99 ").when(k % 7 == 1, "99").when(k % 7 == 2, "199").otherwise(F.col("o_orderstatus")).alias("code"))


def clear_artifacts(spark: Spark, d: str) -> DataFrame:
    return _dirty(spark, d).select("o_orderkey", clean.clear_artifacts(F.col("cell")).alias("cell"))


def strip_99_codes(spark: Spark, d: str) -> DataFrame:
    return _dirty(spark, d).select("o_orderkey", clean.strip_missing_code(F.col("code")).alias("code"))


def id_whitespace_strip(spark: Spark, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit(" "), F.regexp_replace("s_name", "#", " # "), F.lit("\t")).alias("ST_ID"))
    return clean.clean(s, types=False).select(F.col("s_suppkey"), "ST_ID")


def remove_accents_fr(spark: Spark, d: str) -> DataFrame:
    """All documents, whole texts."""
    return read_table(spark, d, "documents").select("doc_id", text.remove_accents(F.col("text")).alias("plain"))


def date_floor_filter(spark: Spark, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.date_format("o_orderdate", "yyyy/MM/dd")).alias("day"))
    parsed = o.withColumn("day", clean.parse_date(F.col("day"), "%Y/%m/%d"))
    return clean.since(parsed, "day", "1995-06-01").select("o_orderkey", F.date_format("day", "yyyy-MM-dd").alias("day"))


def drop_empty_rows(spark: Spark, d: str) -> DataFrame:
    c = read_table(spark, d, "customer")
    k = F.col("c_custkey")
    rows = c.select(k, F.when(k % 4 != 0, F.col("c_name")).otherwise(F.lit("  ")).alias("a"), F.when(k % 6 != 0, F.col("c_acctbal")).alias("b"), F.lit(None).cast("string").alias("c"))
    return clean.drop_empty_columns(clean.drop_empty_rows(rows, ["a", "b", "c"])).select("c_custkey", "a", "b")


def clean_table(spark: Spark, d: str) -> DataFrame:
    p = read_table(spark, d, "part")
    k = F.col("p_partkey")
    raw = p.select(
        k.cast("string").alias("PART_ID"), F.when(k % 9 == 0, "n/a").otherwise(F.concat(F.lit(" "), F.col("p_name"), F.lit(" "))).alias("NAME"), F.when(k % 10 == 0, "").otherwise(F.col("p_size").cast("string")).alias("SIZE"),
        F.when(k % 8 == 0, "-99").otherwise(F.col("p_brand")).alias("BRAND"), F.lit(" ").alias("NOTE"),
    )
    return clean.clean(raw)


def patch99_nonresponse(spark: Spark, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    dummy = lambda i: (F.col("o_orderpriority").startswith(str(i))).cast("int")
    rows = o.select(k, F.when(k % 3 != 0, dummy(1)).alias("Q11"), dummy(2).alias("Q12"), F.when(k % 2 == 0, 1).when(k % 5 != 0, 0).alias("Q1_99"))
    return clean.patch_nonresponse(rows)


def typecast_text(spark: Spark, d: str) -> DataFrame:
    p = read_table(spark, d, "part").select("p_partkey", F.col("p_size").cast("string").alias("size"), F.col("p_retailprice").cast("string").alias("price"), "p_brand")
    return clean.coerce_types(p)


# ---------------------------------------------------------------- corrections
def _fix_sheet(spark: Spark, d: str) -> DataFrame:
    """A fix of every order; the last digit of its key says of which kind."""
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    uid = lambda c: F.concat(F.lit("u"), c.cast("string"))
    ident = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    kind = F.pmod(k, F.lit(10))
    return o.select(
        F.when(kind == 3, F.concat(uid(k), F.lit("z"))).otherwise(uid(k)).alias("uid"), ident.alias("id"),
        F.when(kind == 0, "status").when(kind == 1, "whole observation").when(kind == 2, "height").when(kind.isin(4, 9), "ident").when(kind == 6, "price").otherwise("Status").alias("what"),
        F.lit("x").alias("change_from"),
        F.explode(F.when(kind == 8, F.array(F.lit("Z"), F.lit("Y"))).otherwise(F.array(F.when(kind == 4, F.lit("c1")).when(kind == 5, F.lit(None)).when(kind == 6, F.lit("12.5")).when(kind == 9, F.concat(F.lit("n"), k.cast("string"))).when(kind != 1, F.lit("Z"))))).alias("change_to"),
        F.when(kind == 7, "rejected").otherwise("accepted").alias("state"),
    )


def _fix_table(spark: Spark, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    return o.select(F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("uid"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("ident"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))


def verify_fixes_flags(spark: Spark, d: str) -> DataFrame:
    out = corrections.verify_fixes(_fix_sheet(spark, d), _fix_table(spark, d), "uid", "ident")
    return out.drop("fixhash", "state")


def apply_corrections(spark: Spark, d: str) -> DataFrame:
    return corrections.apply_fixes(_fix_table(spark, d), _fix_sheet(spark, d), "uid", "ident").df


def explode_multi_fix(spark: Spark, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier")
    k = F.col("s_suppkey").cast("string")
    sheet = s.select(
        "s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, "EGRA|ODK").otherwise("egma").alias("db"), F.when(F.col("s_suppkey") % 2 == 0, "AGE,GRADE|AGE").otherwise("sex, age").alias("wh"),
        F.when(F.col("s_suppkey") % 2 == 0, F.concat(k, F.lit(",3|"), k)).otherwise(F.concat(F.lit("F ,"), k)).alias("ch"),
    )
    return corrections.explode_multi_fixes(sheet, database="db", what="wh", after="ch", keep=["s_suppkey"])


# ---------------------------------------------------------------- recoding, reductions
_PRIORITIES = {"1-URGENT": "1", "2-HIGH": "2", "3-MEDIUM": "3", "4-NOT SPECIFIED": "4", "5-LOW": "5"}


def recode_simultaneous(spark: Spark, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    return o.select("o_orderkey", homogenize.recode(F.col("o_orderstatus"), {"F": "O", "O": "F"}).alias("status"), homogenize.recode(F.col("o_orderpriority"), _PRIORITIES).alias("priority"))


# line numbers 1 to 7 are the waves; the odd ones write the flag as text, the even ones as a number
_LINES = dict(enumerate(("BY1", "MY1", "EY1", "BY2", "MY2", "EY2", "BY3"), 1))
_FLAG_TEXT, _FLAG_NUMBER = 'cbind(c("A","N","R"),c("a","n","r"))', 'cbind(c(1,2,3),c("a","n","r"))'
_WAVE_SHEET = [
    {"Group": "LINE", **{f"Name_{w}": "k" if t % 2 else "key" for t, w in _LINES.items()}, "HomogenizedName": "LINE_KEY", "FinalNameDB3": "LINE_KEY"},
    {"Group": "LINE", **{f"Name_{w}": "flag" if t % 2 else "rflag" for t, w in _LINES.items()}, **{f"Code_{w}": _FLAG_TEXT if t % 2 else _FLAG_NUMBER for t, w in _LINES.items()}, "HomogenizedName": "FLAG", "FinalCode": 'cbind(c(10,20,30),c("a","n","r"))', "FinalNameDB3": "FLAG"},
    {"Group": "LINE", **{f"Name_{w}": "qty" for w in _LINES.values()}, "HomogenizedName": "QTY", "FinalNameDB3": "QTY"},
    {"Group": "SHIP", **{f"Name_{w}": "k" for w in _LINES.values()}, "HomogenizedName": "LINE_KEY", "FinalNameDB3": "LINE_KEY"},
    {"Group": "SHIP", **{f"Name_{w}": "status" for w in _LINES.values()}, "HomogenizedName": "STATE", "FinalNameDB3": "STATE"},
]


def _waves(spark: Spark, d: str, key: Column) -> dict[str, dict[int, DataFrame | None]]:
    out: dict[str, dict[int, DataFrame | None]] = {"LINE": {}, "SHIP": {}}
    for t in _LINES:
        li = read_table(spark, d, "lineitem").filter(F.col("l_linenumber") == t)
        number = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
        out["LINE"][t] = li.select(key.alias("k" if t % 2 else "key"), F.col("l_returnflag").alias("flag") if t % 2 else number.alias("rflag"), F.col("l_quantity").alias("qty"))
        out["SHIP"][t] = li.groupBy(key.alias("k")).agg(F.max("l_linestatus").alias("status"))
    return out


def homogenize_waves(spark: Spark, d: str) -> DataFrame:
    key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int"))
    done = homogenize.homogenize(_WAVE_SHEET, {"LINE": _waves(spark, d, key)["LINE"]})
    tables = {t: df.withColumn("wave", F.lit(t)) for t, df in done.bundle["LINE"].items() if df is not None}
    return reshape.merge_times(tables, ["wave"])


def clean_databases(spark: Spark, d: str) -> DataFrame:
    """The whole pipeline, merge and spread included: seven waves of two groups come out as one row for each order."""
    out = pipeline.clean_databases(_WAVE_SHEET, _waves(spark, d, F.concat(F.lit("K"), F.col("l_orderkey").cast("string"))), ids=["LINE_KEY"], spread_times=True)
    return out.wide.withColumnRenamed(".MERGE", "merge_id")


def _reduced(spark: Spark, d: str, rows: list[dict], keep: list[str]) -> DataFrame:
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    dummies = [(F.col("o_orderpriority").startswith(str(i))).cast("int").alias(f"P{i}") for i in range(1, 6)]
    base = o.select(k.alias("OID"), F.col("o_custkey").alias("ID"), F.when(k % 3 != 0, F.col("o_custkey")).alias("A_X"), F.when(k % 2 != 0, F.col("o_custkey") + 1).alias("A_Y"), F.when(k % 5 != 0, F.lit(7)).alias("A_Z"), *dummies, F.col("o_orderstatus").alias("STATUS"))
    applied = codebook.apply_codebook(base, rows, ids=["OID"], time="ID", origins={"X": ["A_X"], "Y": ["A_Y"], "Z": ["A_Z"]})
    if applied.issues:
        raise ValueError(str(applied.issues))
    return applied.df.select(*keep)


def reduction_rows(spark: Spark, d: str) -> DataFrame:
    rows = [
        {"HomogenizedName": "P1", "SubgroupDB3": "PRI", "ReductionDB3": "SUM(.SUBGROUP)", "FinalNameDB3": "n_hot"},
        {"HomogenizedName": "P2", "SubgroupDB3": "PRI"}, {"HomogenizedName": "P3", "SubgroupDB3": "PRI"}, {"HomogenizedName": "P4", "SubgroupDB3": "PRI"}, {"HomogenizedName": "P5", "SubgroupDB3": "PRI"},
        {"HomogenizedName": "A", "ReductionDB3": "FLATTEN(.DATABASES[Z,Y])", "FinalNameDB3": "flat"},
        {"HomogenizedName": "A", "ReductionDB3": "CONSOLIDATE(.GROUPS[X,Y], consolidation_func = \"max\")", "FinalNameDB3": "cons"},
        {"HomogenizedName": "P1", "ReductionDB3": "DEDUMMIFY(P1, P2, P3, P4, P5, c(10, 20, 30, 40, 50))", "FinalNameDB3": "pri"},
        {"HomogenizedName": "STATUS", "ReductionDB3": '.DUMMIFY(STATUS, "F")', "FinalNameDB3": "is_f"},
        {"HomogenizedName": "A_X", "ReductionDB3": "rowSums(A_X, A_Y, na.rm = TRUE)", "FinalNameDB3": "xy"},
        {"HomogenizedName": "A_X", "ReductionDB3": "rowSums(A_X, A_Y)", "FinalNameDB3": "xy_strict"},
        {"HomogenizedName": "A_X", "ReductionDB3": "ifelse(is.na(A_X), -1, A_X %% 10 + 2^2)", "FinalNameDB3": "cond"},
        {"HomogenizedName": "A_X", "ReductionDB3": "MODE(A_Z, A_X, A_Y, na.rm = TRUE)", "FinalNameDB3": "mode"},
        {"HomogenizedName": "STATUS", "ReductionDB3": "STATUS %in% c(\"F\", \"P\")", "FinalNameDB3": "fp"},
    ]
    return _reduced(spark, d, rows, ["OID", "n_hot", "flat", "cons", "pri", "is_f", "xy", "xy_strict", "cond", "mode", "fp"]).withColumns({"cond": F.col("cond").cast("double"), "fp": F.col("fp").cast("int")})


def _panel(spark: Spark, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("t")).agg(F.max("l_quantity").alias("qty"), F.min("l_partkey").alias("part"), F.max("l_returnflag").alias("flag")).withColumn("qty", F.when(F.col("part") % 7 != 0, F.col("qty")))


def grouped_reduction(spark: Spark, d: str) -> DataFrame:
    rows = [
        {"HomogenizedName": "qty", "ReductionDB3": "$G{ mean(.TIMES[1,2], na.rm = TRUE) }", "FinalNameDB3": "early"},
        {"HomogenizedName": "qty", "ReductionDB3": "$G{ max(qty) }", "FinalNameDB3": "strict_max"},
        {"HomogenizedName": "flag", "ReductionDB3": "$G{ MODE(.THIS, na.rm = TRUE) }", "FinalNameDB3": "usual"},
        {"HomogenizedName": "qty", "ReductionDB3": "$G{ length(qty) }", "FinalNameDB3": "n"},
    ]
    panel = _panel(spark, d)
    out = codebook.apply_codebook(panel, rows, ids=["id"], time="t")
    if out.issues:
        raise ValueError(str(out.issues))
    return out.df.select("id", "t", "early", "strict_max", "usual", F.col("n").cast("long").alias("n"))


def coalesce_long(spark: Spark, d: str) -> DataFrame:
    panel = _panel(spark, d).withColumn("alt", F.when(F.col("part") % 2 == 0, F.col("part").cast("double")))
    return reshape.coalesce_over_times(panel, ["id"], "t", ["qty", "alt"], [[1, 2], [3, 4, 5]], "value", priority=["alt"]).select("id", "t", "value")


def mode_first_tie(spark: Spark, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("user_id", "event_type", "event_id")
    row = {"HomogenizedName": "event_type", "ReductionDB3": "$G{ MODE(.THIS) }", "FinalNameDB3": "mode"}
    return codebook.apply_codebook(ev, [row], ids=["user_id"], time="event_id").df.select("user_id", "mode").distinct()


# ---------------------------------------------------------------- merge, reshape
QUARTERS = (1, 2, 3, 4)


def _quarterly(spark: Spark, d: str, quarter: int) -> tuple[DataFrame, DataFrame]:
    """Orders by the quarter they fall into, so that the four waves hold every row."""
    o = read_table(spark, d, "orders").filter(F.quarter("o_orderdate") == quarter)
    a = o.groupBy(F.col("o_custkey").alias("ID")).agg(F.count(F.lit(1)).alias("N"), F.max("o_totalprice").alias("TOP"))
    b = o.filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("ID")).agg(F.count(F.lit(1)).alias("N"), F.min("o_totalprice").alias("LOW"))
    return a, b


def merge_databases_collision(spark: Spark, d: str) -> DataFrame:
    bundle: dict[str, dict[int, DataFrame | None]] = {"ALL": {}, "FIN": {}}
    for t in QUARTERS:
        bundle["ALL"][t], bundle["FIN"][t] = _quarterly(spark, d, t)
    merged = reshape.merge_groups(bundle, ["ID"])
    long = reshape.merge_times(merged, [".MERGE", ".TIME"])
    return long.select(F.col("`.MERGE`").alias("merge_id"), F.col("`.TIME`").alias("time"), "N_ALL", "N_FIN", "TOP", "LOW")


def merge_times_union(spark: Spark, d: str) -> DataFrame:
    """Waves whose columns differ: the odd ones lack LOW, the even ones TOP."""
    waves = {t: _quarterly(spark, d, t)[(t + 1) % 2].withColumn("t", F.lit(t)) for t in QUARTERS}
    return reshape.merge_times(waves, ["ID", "t"])


def spread_times(spark: Spark, d: str) -> DataFrame:
    p = _panel(spark, d).select("id", "t", F.col("qty").alias("QTY"), F.lit("x").alias("SAME"), "flag")
    return reshape.spread(p, ["id"], "t", split=["QTY", "flag"], times=list(range(1, 8)), drop_empty=False)


def auto_split_vars(spark: Spark, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("user_id", "event_id", "event_type", F.lit("c").alias("fixed"), (F.col("user_id") % 3).alias("third"))
    varies = reshape.varying_columns(ev, ["user_id"], "event_id")
    return spark.createDataFrame(sorted(varies.items()), "variable string, varies boolean")


def gather_times(spark: Spark, d: str) -> DataFrame:
    return reshape.gather(spread_times(spark, d), "t")


# ---------------------------------------------------------------- codebook
def codebook_descriptives(spark: Spark, d: str) -> DataFrame:
    return report.descriptives(read_table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_partkey"])


def codebook_histogram(spark: Spark, d: str) -> DataFrame:
    return report.histogram(read_table(spark, d, "lineitem"), "l_quantity", 30).select("bin", "n")


def codebook_frequencies(spark: Spark, d: str) -> DataFrame:
    return report.frequencies(read_table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


# ---------------------------------------------------------------- more of the same operators
def cross_source_names(spark: Spark, d: str) -> DataFrame:
    """Three sources' names: a swap in one, a longer name in another, two wrong letters in some."""
    c = read_table(spark, d, "customer")
    k = F.pmod("c_custkey", F.lit(5))
    one = c.select(F.col("c_custkey").alias("ID"), F.col("c_name").alias("NAME"))
    two = c.filter(k != 3).select(F.col("c_custkey").alias("ID"), F.when(k == 1, F.regexp_replace("c_name", "^Cu", "uC")).when(k == 2, F.regexp_replace("c_name", "^Cu", "XY")).otherwise(F.col("c_name")).alias("NAME"))
    three = c.select(F.col("c_custkey").alias("ID"), F.when(k == 4, F.concat("c_name", F.lit(" the older"))).alias("NAME"))
    out = verify.cross_source_issues({"B": two, "C": three}, ("A", one), "ID", names=["NAME"], tolerance={".others": 0.1})
    return out.select("ID", "NAME_ISSUE", "N_ISSUES")


def long_set_issues(spark: Spark, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ID"), F.col("l_linenumber").alias("t"), "l_quantity")
    out = verify.long_set_issues(li, "ID", "t", "LINE", range(1, 8), checks={"many": lambda x: F.col("l_quantity") > 48})
    parts = [df.withColumn("set_name", F.lit(n)) for n, df in out.items()]
    return reduce(DataFrame.unionByName, parts)


def apply_multi_fixes(spark: Spark, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier")
    key = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))
    base = s.select(key.alias("uid"), key.alias("id"), F.col("s_nationkey").alias("NATION"), F.col("s_name").alias("TITLE"))
    sheet = s.select(key.alias("uid"), key.alias("id"), F.lit("ONE|two").alias("database"), F.lit("NATION,TITLE|title").alias("what"), F.concat((F.col("s_suppkey") % 4).cast("string"), F.lit(", T"), F.col("s_suppkey").cast("string"), F.lit("|U")).alias("change_to"))
    out = corrections.apply_multi_fixes({"ONE": base, "TWO": base}, sheet, "uid", "id")
    return out["ONE"].df.withColumn("tbl", F.lit("ONE")).unionByName(out["TWO"].df.withColumn("tbl", F.lit("TWO")))


def apply_long_fixes(spark: Spark, d: str) -> DataFrame:
    """Every order has a fix of one of its lines; which one depends on its key."""
    li = read_table(spark, d, "lineitem")
    long = li.groupBy(F.concat(F.lit("K"), F.col("l_orderkey").cast("string")).alias("uid"), F.col("l_linenumber").alias("t")).agg(F.max("l_quantity").alias("qty")).withColumn("id", F.col("uid"))
    line = (F.pmod(F.substring("uid", 2, 20).cast("bigint"), F.lit(7)) + 1).cast("string")
    sheet = long.select("uid").distinct().select("uid", F.col("uid").alias("id"), F.concat(F.lit("LINE_"), line).alias("database"), F.lit("QTY").alias("what"), F.lit("-1.5").alias("change_to"))
    return corrections.apply_long_fixes(long, sheet, "LINE", "id", "t", "uid").df.select("uid", "t", "qty")


def legacy_clean(spark: Spark, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    raw = o.select(
        F.when(k % 10 == 0, "-99").otherwise(F.concat(F.lit(" o "), k.cast("string"))).alias("ORDER_ID"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("DAY"),
        F.when(k % 6 == 0, "see n/a").otherwise(F.lower("o_orderpriority")).alias("PRI"), k.cast("string").alias("NUM"), F.lit("").alias("NOTE"),
    )
    out = clean.legacy_clean(raw, date_col="DAY", begin_date="1996-01-01")
    return out.select("ORDER_ID", F.date_format("DAY", "yyyy-MM-dd").alias("DAY"), "PRI", "NUM")


def permute_tags(spark: Spark, d: str) -> DataFrame:
    wide = read_table(spark, d, "orders").groupBy(F.col("o_custkey").alias("ID")).agg(F.count(F.lit(1)).alias("N_ALL_1"), F.max("o_totalprice").alias("TOP_2_FIN"))
    return reshape.permute_tags(wide, ["ALL", "FIN"])


def spread_force_unite(spark: Spark, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    panel = ev.groupBy(F.col("user_id").alias("id"), F.dayofmonth("ts").alias("t")).agg(F.max("value").alias("V"), F.min("event_type").alias("KIND"))
    return reshape.spread(panel, ["id"], "t", split=["V"], force_unite=["KIND"], times=range(1, 32), drop_empty=False)


def keep_first_of_key(spark: Spark, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return reshape.keep_first(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


def three_valued_or(spark: Spark, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    a, b = F.when(k % 3 != 0, k % 2 == 0), F.when(k % 5 != 0, k % 7 == 0)
    return o.select(k, clean.or_known(a, b).alias("either"))


def yes_no_columns(spark: Spark, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    return clean.yesno_to_boolean(o.select(k, F.when(k % 4 == 0, "Y").when(k % 4 != 1, "n").alias("flag"), F.when(k % 2 == 0, "Y").otherwise("x").alias("kept")))


def mapping_recodes(spark: Spark, d: str) -> DataFrame:
    from quillpanel.operators import drift

    codes = {1: "code_by1", 2: "code_my1", 3: "code_ey1", 4: "code_by2"}
    return drift.recode_map(read_table(spark, d, "mapping_sheet"), "assess_group", codes, "final_coding", "homogenized_name")


def table_contents(spark: Spark, d: str) -> DataFrame:
    bundle = {"SURVEY": {1: read_table(spark, d, "assessments"), 2: None}, "PLACES": {1: read_table(spark, d, "locations")}}
    return spark.createDataFrame(verify.content_summary(bundle), "`grp` string, `wave` int, variable string")


QUERIES = {
    f.__name__: f
    for f in (
        dup_flag_all_members, single_set_issues, id_pattern_bad, weird_or_duplicated, only_in_data, only_in_reference, value_mismatch_equal, value_mismatch_upper, value_mismatch_lower, value_mismatch_both,
        merge_sources_full_outer, dup_provenance, n_issues_rollup, name_mismatch_osa, name_similarity_lev, id_retrieval, clear_artifacts, strip_99_codes, id_whitespace_strip, remove_accents_fr, date_floor_filter,
        drop_empty_rows, clean_table, patch99_nonresponse, typecast_text, verify_fixes_flags, apply_corrections, explode_multi_fix, recode_simultaneous, homogenize_waves, clean_databases, reduction_rows,
        cross_source_names, long_set_issues, apply_multi_fixes, apply_long_fixes, legacy_clean, permute_tags, spread_force_unite, keep_first_of_key, three_valued_or, yes_no_columns, mapping_recodes, table_contents,
        grouped_reduction, coalesce_long, mode_first_tie, merge_databases_collision, merge_times_union, spread_times, auto_split_vars, gather_times, codebook_descriptives, codebook_histogram, codebook_frequencies,
    )
}

_THREE = """
    WITH o AS (SELECT o_orderkey AS k, max(floor(o_totalprice)) AS v FROM orders GROUP BY 1),
    s AS (SELECT l_orderkey AS k, floor(sum(CAST(l_extendedprice AS DECIMAL(18,2)))) AS v, floor(max(l_extendedprice)) AS m FROM lineitem GROUP BY 1),
    j AS (SELECT coalesce(o.k, s.k) AS k, o.v AS a, CAST(s.v AS DOUBLE) AS b, CASE WHEN s.k % 3 <> 0 THEN s.m END AS c FROM o FULL JOIN s ON o.k = s.k),
    e AS (SELECT *, coalesce(a, b, c) AS base FROM j)
"""
_FIXES = """
    WITH o AS (SELECT *, o_orderkey % 10 AS kind, unnest(CASE WHEN o_orderkey % 10 = 8 THEN ['Z', 'Y'] ELSE ['Z'] END) AS z FROM orders),
    t AS (SELECT 'U' || o_orderkey AS u, 'C' || o_custkey AS i, o_orderstatus AS status, o_totalprice AS price, 'u' || o_orderkey AS uid, 'c' || o_custkey AS ident FROM orders),
    sheet AS (
        SELECT 'U' || o_orderkey || CASE WHEN kind = 3 THEN 'Z' ELSE '' END AS uid, 'C' || o_custkey AS id,
               CASE kind WHEN 0 THEN 'STATUS' WHEN 1 THEN 'WHOLE OBSERVATION' WHEN 2 THEN 'HEIGHT' WHEN 4 THEN 'IDENT' WHEN 9 THEN 'IDENT' WHEN 6 THEN 'PRICE' ELSE 'STATUS' END AS what,
               'x' AS change_from, CASE WHEN kind = 4 THEN 'c1' WHEN kind = 5 THEN NULL WHEN kind = 6 THEN '12.5' WHEN kind = 9 THEN 'n' || o_orderkey WHEN kind <> 1 THEN z END AS change_to,
               CASE WHEN kind = 7 THEN 'rejected' ELSE 'accepted' END AS state
        FROM o),
    own AS (SELECT u, min(i) AS own FROM t GROUP BY u),
    h AS (SELECT uid, id, what, count(*) AS times, count(DISTINCT upper(change_to)) AS ends FROM sheet GROUP BY ALL),
    f AS (SELECT s.*, own.own, own.u IS NULL AS missing_uid, (s.what <> 'WHOLE OBSERVATION' AND s.change_to IS NULL) AS incomplete_record, h.times > 1 AS duplicate_changes, h.ends > 1 AS multiple_conclusions,
                 s.what NOT IN ('WHOLE OBSERVATION', 'STATUS', 'PRICE', 'IDENT', 'UID') AS what_not_found, s.what = 'IDENT' AS id_change, s.what = 'WHOLE OBSERVATION' AS gone,
                 coalesce(own.own, upper(s.change_from), s.id) AS cur
          FROM sheet s LEFT JOIN own ON own.u = s.uid JOIN h ON h.uid = s.uid AND h.id = s.id AND h.what = s.what),
    moves AS (SELECT i, sum(d) AS d FROM (SELECT cur AS i, -1 AS d FROM f WHERE id_change OR gone UNION ALL SELECT upper(change_to), 1 FROM f WHERE id_change AND change_to IS NOT NULL) GROUP BY i),
    pool AS (SELECT m.i, m.d + coalesce(n, 0) AS l FROM moves m LEFT JOIN (SELECT i, count(*) AS n FROM t GROUP BY i) c ON c.i = m.i),
    v AS (SELECT f.*, (id_change AND coalesce(p.l > 1, false)) AS existing_id, ((id_change OR gone) AND coalesce(q.l < 0, false)) AS nonexistent_id_removed
          FROM f LEFT JOIN pool p ON p.i = upper(change_to) LEFT JOIN pool q ON q.i = cur),
    w AS (SELECT *, missing_uid OR incomplete_record OR duplicate_changes OR multiple_conclusions OR what_not_found OR existing_id OR nonexistent_id_removed AS any_issue FROM v)
"""
_PANEL = """
    WITH g AS (SELECT l_orderkey AS id, l_linenumber AS t, max(l_quantity) AS q, min(l_partkey) AS part, max(l_returnflag) AS flag FROM lineitem GROUP BY 1, 2),
    p AS (SELECT id, t, CASE WHEN part % 7 <> 0 THEN q END AS qty, part, flag FROM g)
"""
_SPREAD_CELLS = ", ".join(f"max(CASE WHEN t = {t} THEN qty END) AS QTY_{t}, max(CASE WHEN t = {t} THEN flag END) AS flag_{t}" for t in range(1, 8))



def _accented() -> tuple[str, str]:
    """Letters of the Latin blocks that are a plain letter with marks, and that letter."""
    letters = [c for c in map(chr, (*range(0xC0, 0x180), *range(0x218, 0x21C), *range(0x1E00, 0x1F00))) if unicodedata.normalize("NFKD", c)[0] in ascii_letters]
    others = {k: v for k, v in text.LIGATURES.items() if len(v) == 1}
    return "".join([*letters, *others]), "".join([*(unicodedata.normalize("NFKD", c)[0] for c in letters), *others.values()])


def _ligatures() -> str:
    out = "text"
    for letter, plain in text.LIGATURES.items():
        out = f"replace({out}, '{letter}', '{plain}')" if len(plain) > 1 else out
    return out


ORACLE = {
    "cross_source_names": "SELECT c_custkey AS ID, true AS NAME_ISSUE, 1 AS N_ISSUES FROM customer WHERE c_custkey % 5 = 2",
    "long_set_issues": """
        WITH x AS (SELECT l_orderkey AS ID, l_linenumber AS t, l_quantity, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS d FROM lineitem)
        SELECT ID, t, l_quantity, concat_ws(', ', CASE WHEN d THEN 'duplicated_id' END, CASE WHEN l_quantity > 48 THEN 'many' END) AS ISSUE, 'LINE_' || t AS set_name FROM x WHERE d OR l_quantity > 48""",
    "apply_multi_fixes": """
        SELECT 'S' || s_suppkey AS uid, 'S' || s_suppkey AS id, s_suppkey % 4 AS NATION, 'T' || s_suppkey AS TITLE, 'ONE' AS tbl FROM supplier
        UNION ALL SELECT 'S' || s_suppkey, 'S' || s_suppkey, s_nationkey, 'U', 'TWO' FROM supplier""",
    "apply_long_fixes": "SELECT 'K' || l_orderkey AS uid, l_linenumber AS t, CASE WHEN l_linenumber = l_orderkey % 7 + 1 THEN -1.5 ELSE max(l_quantity) END AS qty FROM lineitem GROUP BY l_orderkey, l_linenumber",
    "legacy_clean": "SELECT CASE WHEN o_orderkey % 10 <> 0 THEN 'O' || o_orderkey END AS ORDER_ID, strftime(o_orderdate, '%Y-%m-%d') AS DAY, CASE WHEN o_orderkey % 6 <> 0 THEN upper(o_orderpriority) END AS PRI, o_orderkey AS NUM FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01'",
    "permute_tags": "SELECT o_custkey AS ID, count(*) AS N_1_ALL, max(o_totalprice) AS TOP_FIN_2 FROM orders GROUP BY 1",
    "spread_force_unite": f"""
        WITH p AS (SELECT user_id AS id, day(ts) AS t, max(value) AS v, min(event_type) AS k FROM events GROUP BY 1, 2),
        m AS (SELECT id, k, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, k) AS r FROM p GROUP BY 1, 2)
        SELECT p.id, any_value(m.k) AS KIND, {", ".join(f"max(v) FILTER (t = {t}) AS V_{t}" for t in range(1, 32))} FROM p JOIN m ON m.id = p.id AND r = 1 GROUP BY p.id""",
    "keep_first_of_key": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1",
    "three_valued_or": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 = 0 THEN NULL ELSE coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 2 = 0 END, false) OR coalesce(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 7 = 0 END, false) END AS either FROM orders",
    "yes_no_columns": "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN true WHEN o_orderkey % 4 <> 1 THEN false END AS flag, CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'x' END AS kept FROM orders",
    "mapping_recodes": r"""
        WITH l AS (SELECT assess_group, upper(trim(homogenized_name)) AS field, regexp_extract_all(final_coding, 'c\(([^()]*)\)', 1) AS f, c.w AS wave, regexp_extract_all(c.t, 'c\(([^()]*)\)', 1) AS w
                   FROM (SELECT *, unnest([{'w': 1, 't': code_by1}, {'w': 2, 't': code_my1}, {'w': 3, 't': code_ey1}, {'w': 4, 't': code_by2}]) AS c FROM mapping_sheet) WHERE assess_group IS NOT NULL AND c.t IS NOT NULL AND final_coding IS NOT NULL),
        a AS (SELECT assess_group, field, wave, trim(unnest(string_split(w[1], ','))) AS value, trim(unnest(string_split(w[2], ','))) AS d FROM l),
        b AS (SELECT DISTINCT assess_group, field, trim(unnest(string_split(f[1], ','))) AS final_value, trim(unnest(string_split(f[2], ','))) AS d FROM l)
        SELECT DISTINCT assess_group, field, wave, value, final_value FROM a JOIN b USING (assess_group, field, d)""",
    "table_contents": "SELECT CASE table_name WHEN 'assessments' THEN 'SURVEY' ELSE 'PLACES' END AS grp, 1 AS wave, column_name AS variable FROM information_schema.columns WHERE table_name IN ('assessments', 'locations')",
    "dup_flag_all_members": "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS duplicated FROM lineitem",
    "single_set_issues": """
        WITH x AS (SELECT 'O' || l_orderkey AS order_id, l_linenumber, l_partkey, l_quantity, count(*) OVER (PARTITION BY l_orderkey) > 1 AS dup,
                          NOT regexp_full_match('O' || l_orderkey, 'O[0-9]{1,4}') AS bad,
                          l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice < 200000) AS lone, l_quantity > 45 AS big FROM lineitem),
        y AS (SELECT order_id, l_linenumber, l_partkey, l_quantity, concat_ws(', ', CASE WHEN dup THEN 'duplicated_id' END, CASE WHEN bad THEN 'bad_order_id' END, CASE WHEN lone THEN 'dataonly' END, CASE WHEN big THEN 'large_quantity' END) AS ISSUE FROM x)
        SELECT * FROM y WHERE ISSUE <> ''""",
    "id_pattern_bad": "SELECT c_custkey, c_name FROM customer WHERE NOT regexp_full_match(c_name, 'Customer#000000[0-9]{3}')",
    "weird_or_duplicated": """
        WITH x AS (SELECT 'P' || (l_orderkey * 10 + l_linenumber) AS pid, l_orderkey, l_linenumber FROM lineitem),
        y AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY pid) > 1 THEN 'DUPLICATED ID' WHEN NOT regexp_full_match(pid, 'P[0-9]{1,5}') THEN 'WEIRD ID' END AS ISSUE FROM x)
        SELECT * FROM y WHERE ISSUE IS NOT NULL""",
    "only_in_data": "WITH c AS (SELECT nullif(c_custkey, 11) AS custkey, c_name FROM customer), o AS (SELECT nullif(o_custkey, 7) AS custkey FROM orders WHERE o_orderstatus = 'F') SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.custkey IS NOT DISTINCT FROM c.custkey)",
    "only_in_reference": "WITH c AS (SELECT nullif(c_custkey, 11) AS custkey FROM customer WHERE c_acctbal > 0), o AS (SELECT nullif(o_custkey, 7) AS custkey, o_orderkey FROM orders) SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM c WHERE o.custkey IS NOT DISTINCT FROM c.custkey)",
    "value_mismatch_equal": _THREE + "SELECT k, coalesce(a <> base, false) OR coalesce(b <> base, false) OR coalesce(c <> base, false) AS issue FROM e",
    "value_mismatch_upper": _THREE + "SELECT k, coalesce(b > base + 20000, false) OR coalesce(c > base + 20000, false) AS issue FROM e",
    "value_mismatch_lower": _THREE + "SELECT k, coalesce(b < base - 20000, false) OR coalesce(c < base - 20000, false) AS issue FROM e",
    "value_mismatch_both": _THREE + "SELECT k, coalesce(abs(b - base) > 20000, false) OR coalesce(abs(c - base) > 20000, false) AS issue FROM e",
    "merge_sources_full_outer": """
        WITH c AS (SELECT nullif(c_custkey, 3) AS k, c_mktsegment, count(*) OVER (PARTITION BY nullif(c_custkey, 3)) > 1 AS d FROM customer),
        o AS (SELECT nullif(o_custkey, 5) AS k, count(*) AS n FROM orders GROUP BY 1)
        SELECT coalesce(c.k, o.k) AS custkey, c.d AS DUP_CUST, c_mktsegment AS c_mktsegment_CUST, CASE WHEN o.n IS NOT NULL THEN false END AS DUP_ORD, o.n AS n_orders_ORD FROM c FULL JOIN o ON c.k = o.k""",
    "dup_provenance": """
        WITH l AS (SELECT l_orderkey AS k, l_quantity, count(*) OVER (PARTITION BY l_orderkey) > 1 AS d FROM lineitem),
        o AS (SELECT o_orderkey AS k, count(*) OVER (PARTITION BY o_orderkey) > 1 AS d FROM orders),
        j AS (SELECT coalesce(l.k, o.k) AS k, l_quantity AS qty, coalesce(l.d, false) AS a, coalesce(o.d, false) AS b FROM l FULL JOIN o ON l.k = o.k)
        SELECT k, qty, CASE WHEN a AND b THEN 'ID DUPLICATED IN LINE & ORD' WHEN a THEN 'ID DUPLICATED IN LINE' WHEN b THEN 'ID DUPLICATED IN ORD' ELSE 'NO' END AS dups FROM j""",
    "n_issues_rollup": _THREE + """,
        i AS (SELECT k, coalesce(b > base + 20000, false) OR coalesce(c > base + 20000, false) AS V_ISSUE,
                     coalesce(floor(b / 100000) <> floor(base / 100000), false) OR coalesce(floor(c / 100000) <> floor(base / 100000), false) AS W_ISSUE FROM e)
        SELECT k, V_ISSUE, W_ISSUE, CAST(V_ISSUE AS INT) + CAST(W_ISSUE AS INT) AS N_ISSUES FROM i WHERE V_ISSUE OR W_ISSUE""",
    "name_mismatch_osa": "SELECT c_custkey, c_custkey % 4 = 2 AS mismatch FROM customer",
    "name_similarity_lev": """
        WITH p AS (SELECT DISTINCT p_brand, p_name FROM part)
        SELECT a.p_brand, a.p_name, b.p_name AS other FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_name < b.p_name
        WHERE levenshtein(replace(a.p_name, ' ', ''), replace(b.p_name, ' ', '')) <= ceil(greatest(length(a.p_name), length(b.p_name)) * 0.3)
           OR contains(replace(a.p_name, ' ', ''), replace(b.p_name, ' ', '')) OR contains(replace(b.p_name, ' ', ''), replace(a.p_name, ' ', ''))""",
    "id_retrieval": """
        WITH s AS (SELECT s_suppkey AS k, s_nationkey AS n, substr(md5(CAST(s_suppkey AS VARCHAR)), 1, 14) AS name FROM supplier),
        q AS (SELECT k, n, CASE WHEN k % 3 = 0 THEN substr(name, 1, 12) || 'xx' ELSE substr(name, 1, 13) || 'x' END AS name, CASE WHEN n < 10 THEN 'A' WHEN n < 20 THEN 'B' ELSE 'S' END AS blk FROM s),
        m AS (SELECT k, n, name, CASE WHEN n < 10 THEN 'A' WHEN n < 20 THEN 'B' ELSE 'S' END AS blk FROM s),
        c AS (SELECT q.k, q.n, m.k AS mk, m.n AS mn, levenshtein(q.name, m.name) AS lev FROM q JOIN m USING (blk) WHERE levenshtein(q.name, m.name) <= 3),
        d AS (SELECT *, min(CASE WHEN lev <= 2 THEN 1 ELSE 2 END) OVER (PARTITION BY k) AS pass FROM c),
        e AS (SELECT * FROM d WHERE pass = 2 OR lev <= 2),
        f AS (SELECT *, bool_or(mn = n) OVER (PARTITION BY k) AS fits FROM e),
        g AS (SELECT * FROM f WHERE NOT fits OR mn = n OR (k % 4 = 0 AND k % 5 = 0)),
        y AS (SELECT k, count(*) > 1 AND k % 4 <> 0 AND NOT any_value(fits) AS y2, count(*) > 1 AND k % 5 <> 0 AND NOT any_value(fits) AS y1 FROM f GROUP BY k),
        r AS (SELECT k, string_agg('ID' || mk, '|' ORDER BY 'ID' || mk) AS retrieved, count(*) AS n FROM g GROUP BY k)
        SELECT q.k AS "row", coalesce(y1, false) AS VAR1_FLAG, coalesce(y2, false) AS VAR2_FLAG, retrieved, retrieved IS NULL AS NO_MATCH, coalesce(r.n > 1, false) AS MULTIPLE_MATCH, retrieved IS NOT NULL AND count(*) OVER (PARTITION BY retrieved) > 1 AS DUPLICATE_FLAG FROM q LEFT JOIN r ON r.k = q.k LEFT JOIN y ON y.k = q.k""",
    "clear_artifacts": "SELECT o_orderkey, CASE WHEN o_orderkey % 11 IN (0, 1, 2, 3, 5) THEN NULL WHEN o_orderkey % 11 = 4 THEN 'x' ELSE o_orderpriority END AS cell FROM orders",
    "strip_99_codes": "SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (0, 1) THEN NULL WHEN o_orderkey % 7 = 2 THEN '199' ELSE o_orderstatus END AS code FROM orders",
    "id_whitespace_strip": "SELECT s_suppkey, upper(s_name) AS ST_ID FROM supplier",
    "remove_accents_fr": rf"""
        WITH l AS (SELECT doc_id, text, {_ligatures()} AS t FROM documents)
        SELECT doc_id, regexp_replace(translate(t, '{_accented()[0]}', '{_accented()[1]}'), '\p{{M}}+', '', 'g') AS plain FROM l""",
    "date_floor_filter": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderkey % 5 <> 0 AND CAST(o_orderdate AS DATE) >= DATE '1995-06-01'",
    "drop_empty_rows": "SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_name ELSE '  ' END AS a, CASE WHEN c_custkey % 6 <> 0 THEN c_acctbal END AS b FROM customer WHERE c_custkey % 4 <> 0 OR c_custkey % 6 <> 0",
    "clean_table": "SELECT p_partkey AS PART_ID, CASE WHEN p_partkey % 9 <> 0 THEN upper(trim(p_name)) END AS NAME, CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_size AS BIGINT) END AS SIZE, CASE WHEN p_partkey % 8 <> 0 THEN upper(p_brand) END AS BRAND FROM part",
    "patch99_nonresponse": """
        WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderpriority LIKE '1%' AS INT) END AS a, CAST(o_orderpriority LIKE '2%' AS INT) AS b, CASE WHEN o_orderkey % 2 = 0 THEN 1 WHEN o_orderkey % 5 <> 0 THEN 0 END AS z FROM orders),
        y AS (SELECT *, coalesce(z = 1, false) AND coalesce(a, 0) + b <= 0 AS silent FROM x)
        SELECT o_orderkey, CASE WHEN NOT silent THEN a END AS Q11, CASE WHEN NOT silent THEN b END AS Q12 FROM y""",
    "typecast_text": "SELECT p_partkey, CAST(p_size AS BIGINT) AS size, p_retailprice AS price, p_brand FROM part",
    "verify_fixes_flags": _FIXES + "SELECT uid, id, what, change_from, change_to, missing_uid, incomplete_record, duplicate_changes, multiple_conclusions, what_not_found, existing_id, nonexistent_id_removed, any_issue FROM w",
    "apply_corrections": _FIXES + """,
        a AS (SELECT * FROM w WHERE NOT any_issue AND state <> 'rejected')
        SELECT t.uid, coalesce(max(CASE WHEN what = 'IDENT' THEN change_to END), any_value(t.ident)) AS ident, coalesce(max(CASE WHEN what = 'STATUS' THEN change_to END), any_value(status)) AS status,
               coalesce(max(CASE WHEN what = 'PRICE' THEN CAST(change_to AS DOUBLE) END), any_value(price)) AS price
        FROM t LEFT JOIN a ON a.uid = t.u GROUP BY t.uid HAVING NOT coalesce(bool_or(gone), false)""",
    "explode_multi_fix": """
        WITH e AS (SELECT s_suppkey, unnest([{'d': 'EGRA', 'w': 'AGE', 'v': CAST(s_suppkey AS VARCHAR), 'n': 2}, {'d': 'EGRA', 'w': 'GRADE', 'v': '3', 'n': 2}, {'d': 'ODK', 'w': 'AGE', 'v': CAST(s_suppkey AS VARCHAR), 'n': 1}]) AS f FROM supplier WHERE s_suppkey % 2 = 0
                   UNION ALL SELECT s_suppkey, unnest([{'d': 'EGMA', 'w': 'SEX', 'v': 'F', 'n': 2}, {'d': 'EGMA', 'w': 'AGE', 'v': CAST(s_suppkey AS VARCHAR), 'n': 2}]) FROM supplier WHERE s_suppkey % 2 <> 0)
        SELECT s_suppkey, f.d AS database, f.w AS what, f.v AS change_to, CAST(f.n AS BIGINT) AS n_what, CAST(f.n AS BIGINT) AS n_values FROM e""",
    "recode_simultaneous": "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'O' WHEN 'O' THEN 'F' ELSE o_orderstatus END AS status, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW') THEN left(o_orderpriority, 1) ELSE o_orderpriority END AS priority FROM orders",
    "homogenize_waves": """
        SELECT l_linenumber AS wave, CAST(CASE l_returnflag WHEN 'A' THEN 10 WHEN 'N' THEN 20 ELSE 30 END AS BIGINT) AS FLAG, concat_ws('-', l_orderkey, l_partkey, l_suppkey, CAST(l_quantity AS INT)) AS LINE_KEY, l_quantity AS QTY FROM lineitem""",
    "clean_databases": f"""
        WITH x AS (SELECT 'K' || l_orderkey AS k, l_linenumber AS t, CAST(CASE l_returnflag WHEN 'A' THEN 10 WHEN 'N' THEN 20 ELSE 30 END AS BIGINT) AS f, l_quantity AS q, max(l_linestatus) OVER (PARTITION BY l_orderkey, l_linenumber) AS s,
                          row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CASE l_returnflag WHEN 'A' THEN 10 WHEN 'N' THEN 20 ELSE 30 END, l_quantity) AS r FROM lineitem)
        SELECT k AS merge_id, k AS LINE_KEY_LINE, k AS LINE_KEY_SHIP, {", ".join(f"max(f) FILTER (t = {t}) AS FLAG_{t}, max(q) FILTER (t = {t}) AS QTY_{t}, max(s) FILTER (t = {t}) AS STATE_{t}" for t in range(1, 8))}
        FROM x WHERE r = 1 GROUP BY k""",
    "reduction_rows": """
        WITH x AS (SELECT o_orderkey AS OID, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS x, CASE WHEN o_orderkey % 2 <> 0 THEN o_custkey + 1 END AS y, CASE WHEN o_orderkey % 5 <> 0 THEN 7 END AS z, CAST(left(o_orderpriority, 1) AS INT) AS p, o_orderstatus AS s FROM orders)
        SELECT OID, 1 AS n_hot, coalesce(z, y) AS flat, greatest(x, y) AS cons, p * 10 AS pri, CAST(s = 'F' AS INT) AS is_f, coalesce(x, 0) + coalesce(y, 0) AS xy, x + y AS xy_strict, CAST(CASE WHEN x IS NULL THEN -1 ELSE x % 10 + 4 END AS DOUBLE) AS cond,
               CASE WHEN z IS NOT NULL THEN z ELSE coalesce(x, y) END AS mode, CAST(s IN ('F', 'P') AS INT) AS fp FROM x""",
    "grouped_reduction": _PANEL + """,
        f AS (SELECT id, flag, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, min(t)) AS r FROM p GROUP BY id, flag),
        a AS (SELECT id, avg(qty) FILTER (t IN (1, 2)) AS early, CASE WHEN count(*) = count(qty) THEN max(qty) END AS strict_max, count(*) AS n FROM p GROUP BY id)
        SELECT p.id, p.t, early, strict_max, f.flag AS usual, n FROM p JOIN a ON a.id = p.id JOIN f ON f.id = p.id AND f.r = 1""",
    "coalesce_long": _PANEL + """,
        q AS (SELECT *, CASE WHEN part % 2 = 0 THEN CAST(part AS DOUBLE) END AS alt, CASE WHEN t IN (1, 2) THEN 0 WHEN t IN (3, 4, 5) THEN 1 END AS r FROM p),
        b AS (SELECT id, r, coalesce(arg_min(alt, t) FILTER (alt IS NOT NULL), arg_min(qty, t) FILTER (qty IS NOT NULL)) AS value FROM q WHERE r IS NOT NULL GROUP BY id, r)
        SELECT q.id, q.t, b.value FROM q LEFT JOIN b ON b.id = q.id AND b.r = q.r""",
    "mode_first_tie": "WITH c AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, min(event_id)) AS r FROM events GROUP BY 1, 2) SELECT user_id, event_type AS mode FROM c WHERE r = 1",
    "merge_databases_collision": """
        WITH o AS (SELECT *, quarter(o_orderdate) AS t FROM orders),
        a AS (SELECT t, o_custkey AS id, count(*) AS n, max(o_totalprice) AS top FROM o GROUP BY 1, 2), f AS (SELECT t, o_custkey AS id, count(*) AS n, min(o_totalprice) AS low FROM o WHERE o_orderstatus = 'F' GROUP BY 1, 2)
        SELECT coalesce(a.id, f.id) AS merge_id, CAST(coalesce(a.t, f.t) AS INT) AS time, a.n AS N_ALL, f.n AS N_FIN, top AS TOP, low AS LOW FROM a FULL JOIN f ON a.id = f.id AND a.t = f.t""",
    "merge_times_union": """
        SELECT o_custkey AS ID, CAST(quarter(o_orderdate) AS INT) AS t, NULL AS LOW, count(*) AS N, max(o_totalprice) AS TOP FROM orders WHERE quarter(o_orderdate) IN (1, 3) GROUP BY 1, 2
        UNION ALL SELECT o_custkey, CAST(quarter(o_orderdate) AS INT), min(o_totalprice), count(*), NULL FROM orders WHERE quarter(o_orderdate) IN (2, 4) AND o_orderstatus = 'F' GROUP BY 1, 2""",
    "spread_times": _PANEL + f"SELECT id, 'x' AS SAME, {_SPREAD_CELLS} FROM p GROUP BY id",
    "auto_split_vars": "SELECT 'event_type' AS variable, max(n) > 1 AS varies FROM (SELECT count(DISTINCT event_type) AS n FROM events GROUP BY user_id) UNION ALL SELECT 'fixed', false UNION ALL SELECT 'third', false",
    "gather_times": _PANEL + ", ids AS (SELECT DISTINCT id FROM p), ts AS (SELECT unnest(range(1, 8)) AS t) SELECT ids.id, 'x' AS SAME, CAST(ts.t AS INT) AS t, p.qty AS QTY, p.flag AS flag FROM ids CROSS JOIN ts LEFT JOIN p ON p.id = ids.id AND p.t = ts.t",
    "codebook_descriptives": " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count({c}) AS n, CAST(min({c}) AS DOUBLE) AS min, round(avg({c}), 2) AS mean, round(CAST(median({c}) AS DOUBLE), 2) AS median, round(stddev_samp({c}), 2) AS sd, CAST(max({c}) AS DOUBLE) AS max FROM lineitem" for c in ("l_quantity", "l_discount", "l_partkey")
    ),
    "codebook_histogram": "WITH e AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem) SELECT CAST(least(floor((l_quantity - lo) / ((hi - lo) / 30)), 29) AS INT) + 1 AS bin, count(*) AS n FROM lineitem, e GROUP BY 1",
    "codebook_frequencies": "SELECT 'o_orderstatus' AS variable, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 1, 2 UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 1, 2",
}


def dsl_check(cell: str) -> str:
    """The mode of a reduction cell, or the parse error: for sheets that are checked before they run."""
    try:
        return dsl.parse_cell(cell).mode
    except dsl.DslError as x:
        return str(x)
