"""Queries of readers and writers, mapping sheets, macros, helpers and the codebook document, with their SQL."""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillpanel.functions import text
from quillpanel.operators import clean, codebook, corrections, homogenize, matching, report, reshape, verify
from quillpanel.plans import mapping, pipeline
from quillpanel.session import durable, read_table, scratch, stored
from quillpanel.sources import io, office

Spark = SparkSession
WAVES = {"by1": 1, "my1": 2, "ey1": 3, "by2": 4}


def _local(path: str) -> str:
    return path.removeprefix("file://")


# ---------------------------------------------------------------- readers and writers
def _parts(spark: Spark, d: str) -> DataFrame:
    p = read_table(spark, d, "part")
    k = F.col("p_partkey")
    return p.select(k, F.when(k % 4 == 0, "NA").when(k % 4 == 1, F.concat(F.lit('say "'), "p_name", F.lit('", twice'))).otherwise(F.col("p_name")).alias("p_name"), "p_size")


def csv_round_trip(spark: Spark, d: str) -> DataFrame:
    """Written and read again: quotes and commas inside cells stay, NA and empty cells are NULL, types are inferred."""
    path = scratch(spark, "csv")
    io.write_csv(_parts(spark, d), path)
    return io.read_csv(spark, path)


def xlsx_round_trip(spark: Spark, d: str) -> DataFrame:
    path = scratch(spark, "sheet.xlsx")
    Path(_local(path)).parent.mkdir(parents=True, exist_ok=True)
    io.write_xlsx(_parts(spark, d), _local(path))
    return clean.coerce_types(io.read_xlsx(spark, _local(path)))


def stata_round_trip(spark: Spark, d: str) -> DataFrame:
    import pandas as pd

    path = _local(scratch(spark, "nation.dta"))
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    if not io.write_stata(read_table(spark, d, "nation").select("n_nationkey", "n_name"), path):
        raise RuntimeError("no Stata file was written")
    return spark.createDataFrame(pd.read_stata(path)).select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name")


def accept_sources(spark: Spark, d: str) -> DataFrame:
    """A path and a table are both taken."""
    both = io.accept(spark, f"{d}/part.parquet").unionByName(io.accept(spark, read_table(spark, d, "part")))
    return both.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


def parse_text_fields(spark: Spark, d: str) -> DataFrame:
    p = read_table(spark, d, "part")
    cell = F.concat(F.col("p_partkey").cast("string"), F.lit(', "'), "p_name", F.lit(', x" ,, '), "p_brand")
    return p.select("p_partkey", cell.alias("cell")).select("p_partkey", *io.parse_fields("cell", 5))


def export_bundle(spark: Spark, d: str) -> DataFrame:
    """A bundle written as GROUP/T_<wave>.csv without its variables' prefix, and read again."""
    s = read_table(spark, d, "supplier")
    bundle = {"SUP": {1: s.filter("s_nationkey < 10"), 2: s.filter("s_nationkey >= 10"), 3: None}}
    paths = io.export_bundle(bundle, scratch(spark, "bundle"), variable_prefix="s_")
    return reduce(DataFrame.unionByName, (io.read_csv(spark, p).withColumn("wave", F.lit(i)) for i, p in enumerate(paths, 1)))


def stored_tables(spark: Spark, d: str) -> DataFrame:
    """What is stored and checkpointed is read again as it was."""
    return durable(stored(read_table(spark, d, "orders"), "o_orderstatus")).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))


# ---------------------------------------------------------------- mapping sheets
_COLS = mapping.MapColumns(group="assess_group", master="homogenized_name", coding=("final_coding",))


def _sheet(spark: Spark, d: str, most: int = 100_000) -> list[dict[str, object]]:
    rows = read_table(spark, d, "mapping_sheet").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a mapping sheet of more than {most} rows")
    return [r.asDict() for r in rows]


def mapping_cells(spark: Spark, d: str) -> DataFrame:
    """The cleaned mapping sheet, one row for each wave's name."""
    rows = mapping.clean_mapping(_sheet(spark, d), _COLS)
    cells = [(r.group, r.master, t, n, r.codes.get(t)) for r in rows for t, n in r.names.items() if n]
    return spark.createDataFrame(cells, "`group` string, master string, wave int, name string, code string")


def mapping_issues(spark: Spark, d: str) -> DataFrame:
    return pipeline.issue_rows(spark, mapping.check_mapping(mapping.clean_mapping(_sheet(spark, d), _COLS))[1])


def mapping_classes(spark: Spark, d: str) -> DataFrame:
    """What each row of the sheet does."""
    rows = mapping.clean_mapping(_sheet(spark, d), _COLS)
    said = [(r.group, r.master, mapping.classify_row(r.master, r.extra["final_name_db3"], r.extra["reduction_db3"])) for r in rows]
    return spark.createDataFrame(said, "`group` string, master string, class string")


def wave_columns(spark: Spark, d: str) -> DataFrame:
    """Which wave each column of the sheet belongs to."""
    found = [(c, m[0], m[1], mapping.wave_encode(m[1])) for c in read_table(spark, d, "mapping_sheet").columns if (m := mapping.mapping_column(c))]
    return spark.createDataFrame(found, "`column` string, kind string, wave int, code string")


def recode_linked(spark: Spark, d: str) -> DataFrame:
    """'F & P' in the final coding means either."""
    sheet = [{"Group": "ORD", "Name_BY1": "k", "HomogenizedName": "K"}, {"Group": "ORD", "Name_BY1": "st", "Code_BY1": 'cbind(c("F","O","P"),c("f","o","p"))', "FinalCode": 'cbind(c(1,2),c("f & p","o"))', "HomogenizedName": "STATE"}]
    orders = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("st"))
    return homogenize.homogenize(sheet, {"ORD": {1: orders}}).bundle["ORD"][1].select("K", "STATE")


def homogenize_copies(spark: Spark, d: str) -> DataFrame:
    """A name beginning with $ copies another homogenised variable, its recoding included."""
    sheet = [
        {"Group": "ORD", "Name_BY1": "k", "HomogenizedName": "K"},
        {"Group": "ORD", "Name_BY1": "st", "Code_BY1": 'cbind(c("F","O","P"),c("f","o","p"))', "FinalCode": 'cbind(c(1,2,3),c("f","o","p"))', "HomogenizedName": "STATE"},
        {"Group": "ORD", "Name_BY1": "$STATE", "HomogenizedName": "STATE_AGAIN"},
    ]
    orders = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("st"))
    return homogenize.homogenize(sheet, {"ORD": {1: orders}}).bundle["ORD"][1].select("K", "STATE", "STATE_AGAIN")


def pipeline_issues(spark: Spark, d: str) -> DataFrame:
    """The report of a sheet with mistakes, of both stages of the pipeline."""
    sheet = [
        {"Group": "REG", "Name_BY1": "k", "HomogenizedName": "K", "FinalNameDB3": "K"},
        {"Group": "REG", "Name_BY1": "absent", "HomogenizedName": "GONE"},
        {"Group": "REG", "Name_BY1": "name", "Code_BY1": "cbind(c(1,2),c('a'))", "FinalCode": "cbind(c(1),c('a'))", "HomogenizedName": "NAME", "FinalNameDB3": "NAME"},
        {"Group": "REG", "HomogenizedName": "K", "ReductionDB3": "nosuch(K)", "FinalNameDB3": "BROKEN"},
        {"Name_BY1": "lost", "HomogenizedName": "LOST"},
    ]
    region = read_table(spark, d, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"))
    out = pipeline.clean_databases(sheet, {"REG": {1: region}}, ids=["K"], merge=False)
    return pipeline.issue_rows(spark, out.issues).select("level", "Group", "Wave", "Variable")


def present_in_wave(spark: Spark, d: str) -> DataFrame:
    """A codebook applies to a wave the rows that name a variable in it, name none in any, or are marked as generated."""
    sheet = [
        {"Name_BY1": "q", "Name_MY1": "q", "HomogenizedName": "Q", "FinalNameDB3": "Q"},
        {"Name_BY1": "q", "HomogenizedName": "Q", "ReductionDB3": "Q * 2", "FinalNameDB3": "ONLY_FIRST"},
        {"HomogenizedName": "Q", "ReductionDB3": "Q * 3", "FinalNameDB3": "NAMELESS"},
        {"Name_BY1": "q", "GeneratedDB3": "Y", "HomogenizedName": "Q", "ReductionDB3": "Q * 4", "FinalNameDB3": "MARKED"},
    ]
    panel = read_table(spark, d, "part").select(F.col("p_partkey").alias("K"), F.col("p_size").alias("Q"))
    waves = {t: codebook.apply_codebook(panel, sheet, ids=["K"], when=t).df.withColumn("wave", F.lit(t)) for t in (1, 2)}
    return reshape.merge_times(waves, ["K", "wave"])


# ---------------------------------------------------------------- macros
def reduction_macros(spark: Spark, d: str) -> DataFrame:
    snippet = Path(_local(scratch(spark, "snippet.txt")))
    snippet.parent.mkdir(parents=True, exist_ok=True)
    snippet.write_text("ifelse(A > 500, A, B)")
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    base = o.select(k.alias("OID"), F.col("o_custkey").alias("A"), F.when(k % 3 != 0, k).alias("B"), (k % 2).cast("int").alias("P"), F.col("o_orderpriority").alias("PRI"), F.col("o_orderstatus").alias("STATUS"))
    rows = [
        {"HomogenizedName": "A", "SubgroupDB3": "G1"},
        {"HomogenizedName": "B", "SubgroupDB3": "G1"},
        {"HomogenizedName": "A", "ReductionDB3": 'ifelse(.THISNAME == "A", A, 0)', "FinalNameDB3": "named"},
        {"HomogenizedName": "A", "SubgroupDB3": "G1", "ReductionDB3": 'ifelse("B" %in% .SGVARNAMES, SUM(.SUBGROUP), -1)', "FinalNameDB3": "listed"},
        {"HomogenizedName": "A", "ReductionDB3": ".KEY", "FinalNameDB3": "table_key"},
        {"HomogenizedName": "A", "ReductionDB3": "$R{ A + B }", "FinalNameDB3": "both"},
        {"HomogenizedName": "B", "ReductionDB3": "coalesce(B, 0)", "FinalNameDB3": "known"},
        {"HomogenizedName": "PRI", "ReductionDB3": "substr(PRI, 3, 6)", "FinalNameDB3": "part_of"},
        {"HomogenizedName": "A", "ReductionDB3": f'.LOAD("{snippet}")', "FinalNameDB3": "loaded"},
        {"HomogenizedName": "P", "ReductionDB3": "99DUMMY", "FinalNameDB3": "p99"},
        {"HomogenizedName": "STATUS", "ReductionDB3": "DROP"},
    ]
    out = codebook.apply_codebook(base, rows, ids=["OID"], key="T1")
    if out.issues:
        raise ValueError(str(out.issues))
    return out.df


# ---------------------------------------------------------------- helpers
def column_helpers(spark: Spark, d: str) -> DataFrame:
    """Padding, moving, prefixes and dropping of columns."""
    n, r = read_table(spark, d, "nation"), read_table(spark, d, "region")
    padded, _ = clean.pad_columns(n.select("n_nationkey", "n_name", "n_regionkey"), r.select("r_regionkey", "r_name"), ["n_name", "r_name"])
    moved = clean.move_after(padded, "r_name", "n_nationkey")
    bare = clean.select_prefixed(moved, "n_", keep=["r_name"])
    return clean.drop_variables(clean.add_prefix(bare, "x_", ["name"]), ["regionkey"])


def fix_format(spark: Spark, d: str) -> DataFrame:
    """A verifier's form: a row's own id in front, the columns to fill in, then the rest."""
    n = read_table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.when(F.col("n_regionkey") > 0, F.col("n_name")).alias("uid"), "n_regionkey")
    return verify.fix_format(n.withColumn("row_id", verify.unique_row_id("id", "uid")), ["row_id"])


def split_times(spark: Spark, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    parts = [df.agg(F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("top")).withColumn("t", F.lit(t)) for t, df in reshape.split_times(li, "l_linenumber", range(1, 8)).items()]
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- corrections
def apply_identical_fixes(spark: Spark, d: str) -> DataFrame:
    """Of the orders of one customer that are marked IDENTICAL one stays."""
    o = read_table(spark, d, "orders")
    table = o.select(F.concat(F.lit("U"), F.col("o_orderkey").cast("string")).alias("uid"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ident"), F.col("o_orderstatus").alias("status"))
    sheet = table.filter("status = 'F'").select("uid", F.col("ident").alias("id"), F.lit("identical").alias("what"), F.lit("accepted").alias("state"))
    return corrections.apply_fixes(table, sheet, "uid", "ident").df.groupBy("ident", "status").agg(F.count(F.lit(1)).alias("n"))


def apply_forced_fixes(spark: Spark, d: str) -> DataFrame:
    """By force a fix is applied in spite of issues (here: it is there twice), but never several new values for one cell."""
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    table = o.select(F.concat(F.lit("U"), k.cast("string")).alias("uid"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ident"), F.col("o_orderstatus").alias("status"))
    again = F.when(k % 3 == 0, F.array(F.lit("Z"))).when(k % 3 == 1, F.array(F.lit("Z"), F.lit("Z "))).otherwise(F.array(F.lit("Z"), F.lit("Y")))
    sheet = o.select(F.concat(F.lit("u"), k.cast("string")).alias("uid"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("id"), F.lit("STATUS").alias("what"), F.explode(again).alias("change_to"))
    out = corrections.apply_fixes(table, sheet, "uid", "ident", force=True)
    return out.df.groupBy("status").agg(F.count(F.lit(1)).alias("n")).unionByName(out.err.groupBy(F.lit("refused").alias("status")).agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- id retrieval
def _typed_name(c: str) -> Column:
    """Capitals without accents; any other sign beyond ASCII is one question mark."""
    return F.regexp_replace(text.remove_accents(F.upper(c)), r"[^\x00-\x7f]", "?")


def id_retrieval_intake(spark: Spark, d: str) -> DataFrame:
    """The children of ``intake`` looked up in ``masterlist`` by name, place and teacher, within their region."""
    m = read_table(spark, d, "masterlist")
    master = m.select("student_id", _typed_name("student_name").alias("name"), _typed_name("location_name").alias("place"), "location_id", _typed_name("teacher_name").alias("teacher"), "teacher_id")
    survey = read_table(spark, d, "intake").select("intake_id", "region", _typed_name("student_name").alias("sname"), _typed_name("location_name").alias("splace"), _typed_name("teacher_name").alias("steacher"))
    spec = matching.RetrievalSpec("intake_id", "sname", "splace", "steacher", "student_id", "name", "place", "location_id", "teacher", "teacher_id")
    block = F.coalesce(matching.region_block("Lebanon", F.col("region")), matching.region_block("Niger", F.col("region")))
    return matching.retrieve_ids(survey, master, spec, block, F.substring("student_id", 1, 1))


# ---------------------------------------------------------------- the codebook document
_DOCUMENT = [
    {"FINALNAMES": "l_quantity", "Type": "continuous", "ITEMDES": "Pieces", "IndexSections": "A1", "PRESENCE": "W1, W2", "SUBGROUP": "N", "SUB_NOTE": "Numbers"},
    {"FINALNAMES": "flag", "Type": "unordered-categorical", "CODING": 'cbind(c("A","R"),c("open","shut"))', "ITEMDES": "Flag", "IndexSections": "A2", "SUBGROUP": "C", "SUB_NOTE": "Codes"},
    {"FINALNAMES": "mark", "Type": "binary", "CODING": 'cbind(c("A","R"),c("open","shut"))', "ITEMDES": "The same coding once", "IndexSections": "A2", "SUBGROUP": "C", "SUB_NOTE": "Codes"},
    {"FINALNAMES": "nowhere", "Type": "binary", "ITEMDES": "Not in the table", "IndexSections": "A3"},
    {"FINALNAMES": "gone", "DROPCASE": "drop", "IndexSections": "A1"},
    {"FINALNAMES": "hidden", "leaveout": "Y", "IndexSections": "A1"},
    {"FINALNAMES": "later", "PRESENCE": "W3", "IndexSections": "A1"},
    {"FINALNAMES": "elsewhere", "IndexSections": "B1"},
    {"FINALNAMES": "l_quantity", "ITEMDES": "second row of a name", "IndexSections": "A1"},
]


def codebook_document(spark: Spark, d: str) -> DataFrame:
    """The document's lines; it is written as .docx as well."""
    li = read_table(spark, d, "lineitem").select("l_quantity", F.col("l_returnflag").alias("flag_W1"), F.col("l_linestatus").alias("mark_x_EGRA"))
    lines = report.codebook_markdown(li, _DOCUMENT, section="^A", wave="W1", group="EGRA", bins=7)
    path = Path(_local(scratch(spark, "codebook.docx")))
    path.parent.mkdir(parents=True, exist_ok=True)
    office.write_document(str(path), lines)
    return spark.createDataFrame(list(enumerate(lines.split("\n"), 1)), "line int, words string")


QUERIES = {
    f.__name__: f
    for f in (
        csv_round_trip, xlsx_round_trip, stata_round_trip, accept_sources, parse_text_fields, export_bundle, stored_tables, mapping_cells, mapping_issues, mapping_classes, wave_columns, recode_linked, homogenize_copies,
        pipeline_issues, present_in_wave, reduction_macros, column_helpers, fix_format, split_times, apply_identical_fixes, apply_forced_fixes, id_retrieval_intake, codebook_document,
    )
}

_PARTS = """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'say "' || p_name || '", twice' ELSE p_name END AS p_name, p_size FROM part"""
_CELLS = f"""
    WITH s AS (SELECT *, unnest([{", ".join(f"{{'w': {t}, 'n': nullif(trim(name_{w}), ''), 'c': nullif(trim(code_{w}), '')}}" for w, t in WAVES.items())}]) AS x FROM mapping_sheet),
    c AS (SELECT split_part(assess_group, '-', 1) AS "group", trim(homogenized_name) AS master, x.w AS wave, x.n AS name, x.c AS code FROM s WHERE x.n IS NOT NULL)
"""
_PLAIN = "regexp_replace(strip_accents(upper({})), '[^\\x00-\\x7f]', '?', 'g')"


def _plain(column: str) -> str:
    return _PLAIN.format(column)


def _holds(a: str, b: str) -> str:
    return f"(contains(lower({a}), lower({b})) OR contains(lower({b}), lower({a})))"


ORACLE = {
    "csv_round_trip": _PARTS,
    "xlsx_round_trip": _PARTS,
    "stata_round_trip": "SELECT n_nationkey, n_name FROM nation",
    "accept_sources": "SELECT p_brand, 2 * count(*) AS n FROM part GROUP BY 1",
    "parse_text_fields": "SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS cell_1, p_name || ', x' AS cell_2, NULL AS cell_3, p_brand AS cell_4, NULL AS cell_5 FROM part",
    "export_bundle": "SELECT s_suppkey AS suppkey, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal, CASE WHEN s_nationkey < 10 THEN 1 ELSE 2 END AS wave FROM supplier",
    "stored_tables": "SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1",
    "mapping_cells": _CELLS + 'SELECT "group", master, wave, name, code FROM c',
    "mapping_issues": _CELLS + """SELECT 'err' AS level, "group" AS "Group", wave AS "Wave", name AS "Variable", 'DUPLICATE_' || ['BY1', 'MY1', 'EY1', 'BY2'][wave] AS "Issue" FROM c QUALIFY count(*) OVER (PARTITION BY "group", wave, upper(name)) > 1""",
    "mapping_classes": """
        SELECT assess_group AS "group", trim(homogenized_name) AS master,
               CASE WHEN upper(trim(reduction_db3)) IN ('DROP', 'NULL') THEN 'drop'
                    WHEN upper(trim(reduction_db3)) <> '99DUMMY' THEN CASE WHEN final_name_db3 IS NULL THEN 'issue: no final name' ELSE 'reduction' END
                    WHEN final_name_db3 IS NULL THEN 'issue: no final name' WHEN homogenized_name IS NULL THEN 'issue: no initial name' ELSE 'rename' END AS class
        FROM mapping_sheet WHERE coalesce(assess_group, homogenized_name, final_name_db3, name_by1) IS NOT NULL""",
    "wave_columns": " UNION ALL ".join(f"SELECT '{k.lower()}_{w}' AS \"column\", '{k}' AS kind, {t} AS wave, '{w.upper()}' AS code" for w, t in WAVES.items() for k in ("Name", "Code")),
    "recode_linked": "SELECT o_orderkey AS K, CASE WHEN o_orderstatus IN ('F', 'P') THEN 1 ELSE 2 END AS STATE FROM orders",
    "homogenize_copies": "SELECT o_orderkey AS K, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS STATE, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS STATE_AGAIN FROM orders",
    "pipeline_issues": """SELECT * FROM (VALUES ('err', NULL, NULL, 'LOST'), ('err', 'REG', 1, 'absent'), ('err', 'REG', 1, 'NAME'), ('err', 'REG', 1, 'BROKEN')) AS v(level, "Group", "Wave", "Variable")""",
    "present_in_wave": """
        SELECT p_partkey AS K, 1 AS wave, p_size AS Q, p_size * 2 AS ONLY_FIRST, p_size * 3 AS NAMELESS, p_size * 4 AS MARKED FROM part
        UNION ALL SELECT p_partkey, 2, p_size, NULL, p_size * 3, p_size * 4 FROM part""",
    "reduction_macros": """
        SELECT o_orderkey AS OID, o_custkey AS A, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS B, o_orderpriority AS PRI, o_custkey AS named, o_custkey + CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey ELSE 0 END AS listed, 'T1' AS table_key,
               o_custkey + CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS "both", CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey ELSE 0 END AS known, substr(o_orderpriority, 3, 4) AS part_of,
               CASE WHEN o_custkey > 500 THEN o_custkey WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS loaded, o_orderkey % 2 AS p99 FROM orders""",
    "column_helpers": "SELECT NULL AS r_name, n_nationkey AS nationkey, n_name AS x_name FROM nation",
    "fix_format": """
        SELECT n_nationkey || CASE WHEN n_regionkey > 0 THEN n_name ELSE '' END AS row_id, NULL AS "Verifier", NULL AS "Problem", NULL AS "WHAT", NULL AS "change.from", NULL AS "change.to", NULL AS "Note",
               CAST(n_nationkey AS VARCHAR) AS id, CASE WHEN n_regionkey > 0 THEN n_name END AS uid, n_regionkey FROM nation""",
    "split_times": "SELECT count(*) AS n, max(l_quantity) AS top, l_linenumber AS t FROM lineitem GROUP BY l_linenumber",
    "apply_identical_fixes": "SELECT 'C' || o_custkey AS ident, o_orderstatus AS status, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE count(*) END AS n FROM orders GROUP BY o_custkey, o_orderstatus",
    "apply_forced_fixes": "SELECT CASE WHEN o_orderkey % 3 = 2 THEN o_orderstatus ELSE 'Z' END AS status, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT 'refused', 2 * count(*) FROM orders WHERE o_orderkey % 3 = 2",
    "id_retrieval_intake": f"""
        WITH q0 AS (SELECT intake_id AS k, CASE region WHEN 'A' THEN 'A' WHEN '1' THEN 'A' WHEN 'B' THEN 'B' WHEN '2' THEN 'B' ELSE 'S' END AS blk, {_plain("student_name")} AS v, {_plain("location_name")} AS v1, {_plain("teacher_name")} AS v2 FROM intake),
        q AS (SELECT *, regexp_replace(v, '\\s', '', 'g') AS x, regexp_replace(v1, '\\s', '', 'g') AS x1, regexp_replace(v2, '\\s', '', 'g') AS x2 FROM q0),
        m0 AS (SELECT student_id AS id, substr(student_id, 1, 1) AS blk, {_plain("student_name")} AS n, {_plain("location_name")} AS n1, location_id AS i1, {_plain("teacher_name")} AS n2, teacher_id AS i2 FROM masterlist),
        m AS (SELECT *, regexp_replace(n, '\\s', '', 'g') AS y, regexp_replace(n1, '\\s', '', 'g') AS y1, regexp_replace(n2, '\\s', '', 'g') AS y2 FROM m0),
        p AS (SELECT q.k, q.blk, m.id, m.i1, m.i2, q.v1, q.v2, levenshtein(x, y) AS lev, ceil(greatest(length(v), length(n)) * CAST(0.1 AS DOUBLE)) AS near, ceil(greatest(length(v), length(n)) * CAST(0.2 AS DOUBLE)) AS far, x <> '' AND y <> '' AND {_holds("x", "y")} AS held
              FROM q JOIN m ON q.blk = m.blk WHERE m.id IS NOT NULL AND trim(v) <> '' AND trim(n) <> ''),
        c AS (SELECT *, lev <= near OR held AS first FROM p WHERE lev <= far OR held),
        d AS (SELECT * FROM c QUALIFY first OR NOT bool_or(first) OVER (PARTITION BY k)),
        w1 AS (SELECT DISTINCT blk, v1, x1 FROM q WHERE trim(v1) <> ''), t1 AS (SELECT DISTINCT blk, n1, y1, i1 FROM m WHERE i1 IS NOT NULL),
        f1 AS (SELECT DISTINCT w1.blk, v1, i1 FROM w1 JOIN t1 USING (blk) WHERE (trim(n1) <> '' AND {_holds("x1", "y1")} AND {_holds("v1", "n1")}) OR ({_holds("x1", "i1")} AND {_holds("v1", "i1")})),
        w2 AS (SELECT DISTINCT blk, v2, x2 FROM q WHERE trim(v2) <> ''), t2 AS (SELECT DISTINCT blk, n2, y2, i2 FROM m WHERE i2 IS NOT NULL AND trim(n2) <> ''),
        f2 AS (SELECT DISTINCT w2.blk, v2, i2 FROM w2 JOIN t2 USING (blk) WHERE levenshtein(x2, y2) <= ceil(greatest(length(v2), length(n2)) * CAST(0.1 AS DOUBLE)) OR {_holds("x2", "y2")}),
        e AS (SELECT DISTINCT d.k, d.id, d.i1, d.i2, EXISTS (SELECT 1 FROM f1 WHERE f1.blk = d.blk AND f1.v1 = d.v1 AND f1.i1 = d.i1) AS h1, EXISTS (SELECT 1 FROM f1 WHERE f1.blk = d.blk AND f1.v1 = d.v1) AS a1,
                     EXISTS (SELECT 1 FROM f2 WHERE f2.blk = d.blk AND f2.v2 = d.v2 AND f2.i2 = d.i2) AS h2, EXISTS (SELECT 1 FROM f2 WHERE f2.blk = d.blk AND f2.v2 = d.v2) AS a2 FROM d),
        g AS (SELECT *, (SELECT count(DISTINCT id) FROM e z WHERE z.k = e.k) > 1 AND a2 AS on2, bool_or(h2) OVER (PARTITION BY k) AS any2 FROM e),
        h AS (SELECT * FROM g WHERE NOT on2 OR NOT any2 OR h2),
        i AS (SELECT *, (SELECT count(DISTINCT id) FROM h z WHERE z.k = h.k) > 1 AND a1 AS on1, bool_or(h1) OVER (PARTITION BY k) AS any1 FROM h),
        r AS (SELECT k, bool_or(on2 AND NOT any2) AS y2, bool_or(on1 AND NOT any1) AS y1, string_agg(DISTINCT id, '|' ORDER BY id) FILTER (NOT on1 OR NOT any1 OR h1) AS retrieved, count(DISTINCT id) FILTER (NOT on1 OR NOT any1 OR h1) AS n FROM i GROUP BY k)
        SELECT q.k AS intake_id, retrieved, coalesce(y1, false) AS VAR1_FLAG, coalesce(y2, false) AS VAR2_FLAG, retrieved IS NULL AS NO_MATCH, coalesce(r.n > 1, false) AS MULTIPLE_MATCH,
               retrieved IS NOT NULL AND count(*) OVER (PARTITION BY retrieved) > 1 AS DUPLICATE_FLAG FROM q LEFT JOIN r ON r.k = q.k""",
    "codebook_document": """
        WITH s AS (SELECT count(*) AS n, min(l_quantity) AS lo, max(l_quantity) AS hi, round(avg(l_quantity), 2) AS mean, median(l_quantity) AS mid, round(stddev_samp(l_quantity), 2) AS sd FROM lineitem),
        b AS (SELECT CAST(least(floor((l_quantity - lo) / ((hi - lo) / 7)), 6) AS INT) + 1 AS bin, count(*) AS n FROM lineitem, s GROUP BY 1),
        h AS (SELECT list('| ' || bin || ' | ' || n || ' | ' || repeat('#', greatest(1, CAST(round_even(20.0 * n / (SELECT max(n) FROM b), 0) AS INT))) || ' |' ORDER BY bin) AS bars FROM b),
        l AS (SELECT list_concat(['# Codebook', '', 'Numbers', '', '## l_quantity', '', 'Pieces', '', '| n | min | mean | median | sd | max |', '|-|-|-|-|-|-|', '| ' || n || ' | ' || lo || ' | ' || mean || ' | ' || mid || ' | ' || sd || ' | ' || hi || ' |', '', '| bin | n | |', '|-|-|-|'],
              bars, ['', 'Codes', '', '## flag', '', 'Flag', '', '| value | label |', '|-|-|', '| A | OPEN |', '| R | SHUT |', '', '## mark', '', 'The same coding once', '', '## nowhere', '', 'Not in the table', '', '*variable not in database*', '']) AS ls FROM s, h)
        SELECT CAST(unnest(range(1, len(ls) + 1)) AS INT) AS line, unnest(ls) AS words FROM l""",
}
