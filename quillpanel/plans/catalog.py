"""The query catalogue: every query of the core with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillpanel.operators import drift, packed, timestamps
from quillpanel.plans import more_queries, survey_queries, time_sql
from quillpanel.session import read_table

Query = Callable[[SparkSession, str], DataFrame]
WAVES = {1: "by1", 2: "my1", 3: "ey1", 4: "by2"}


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return packed.unpack_values(read_table(spark, d, "corrections"), "fix_id", packed.CORRECTION_FIELDS)


def _ingested(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sheet = read_table(spark, d, "mapping_sheet")
    names = drift.sheet_names(sheet, "assess_group", [f"name_{w}" for w in WAVES.values()], "homogenized_name")
    return drift.ingest(read_table(spark, d, "wave_records"), names, group="assess_group", payload="payload"), names


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The changes of each file, read off the consistent table."""
    codes = drift.sheet_codes(read_table(spark, d, "mapping_sheet"), "assess_group", {k: f"code_{w}" for k, w in WAVES.items()}, "homogenized_name")
    return drift.file_changes(_typed(spark, d, ["received_at"], origin=True), codes, source=["site_no", "assess_group"], group="assess_group", file="file_no", wave="wave", arrived="received_at")


# Target types of the sheet's fields.
TARGET = {
    "ST_ID": "string", "SEX": "bigint", "AGE": "bigint", "GRADE": "bigint", "READ_WPM": "double", "HOME_LANG": "bigint", "ABSENT_DAYS": "bigint",
    "HAS_BOOK": "boolean", "PACKET": "string", "SHIFT": "bigint", "LETTER_SCORE": "double", "CONSENT": "boolean", "WALK_MIN": "double", "SCREENER": "bigint",
}


def _typed(spark: SparkSession, d: str, also: Sequence[str] = (), origin: bool = False) -> DataFrame:
    """origin: for the report of changes, which needs no translated codes."""
    records, _ = _ingested(spark, d)
    codes = None if origin else drift.recode_map(read_table(spark, d, "mapping_sheet"), "assess_group", {k: f"code_{w}" for k, w in WAVES.items()}, "final_coding", "homogenized_name")
    return drift.typed_table(records, TARGET, ["rec_id", "site_no", "assess_group", "wave", "file_no", *also], codes, origin=origin)


PROMOTED = {"audit_flag": "boolean", "form_build": "string"}


def p4_table(spark: SparkSession, d: str) -> DataFrame:
    return drift.promote(_typed(spark, d), PROMOTED)


def p4_values(spark: SparkSession, d: str) -> DataFrame:
    """Where each value of ``wave_records`` is in the consistent table: in a typed column or in the rescue column."""
    table = p4_table(spark, d)
    typed = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"), F.lit(False).alias("rescued")) for f in (*TARGET, *PROMOTED)))
    rescue = F.map_entries(F.from_json(drift.RESCUE, "map<string,variant>"))
    rescued = F.transform(rescue, lambda e: F.struct(e["key"].alias("field"), F.try_variant_get(e["value"], "$", "string").alias("value"), F.lit(True).alias("rescued")))
    cells = table.select("rec_id", F.explode(F.concat(F.filter(typed, lambda c: c["value"].isNotNull()), F.coalesce(rescued, F.array().cast("array<struct<field:string,value:string,rescued:boolean>>")))).alias("c"))
    number = F.col("c.value").try_cast("double")
    return cells.select("rec_id", "c.field", "c.rescued", number.alias("number"), F.when(number.isNull(), F.col("c.value")).alias("words"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    block = F.nullif(F.regexp_extract(F.upper(F.col("st_id")), "([ABS])[^A-Z]*R[^A-Z]*E[^A-Z]*M", 1), F.lit(""))
    return timestamps.normalize_times(
        read_table(spark, d, "assessments"),
        "row_id",
        ["start_time", "submission_time"],
        ["entry_date"],
        places=read_table(spark, d, "locations"),
        place="location_id",
        zone="zone_name",
        sequence=block,
        ingested="received_at",
        anchor="submission_time",
        month_first=F.coalesce(F.col("form_lang") == "en", F.lit(False)),
        years=(2016, 2020),
    )


QUERIES: dict[str, Query] = {**survey_queries.QUERIES, **more_queries.QUERIES, "p1_found": p1_found, "p4_found": p4_found, "p4_table": p4_table, "p4_values": p4_values, "p6_found": p6_found}

_QUOTED = r"""(?:"(?:[^"]|"")*"|“[^”]*”|«[^»]*»|'[^']*')"""
_SIGNS = r",;|\t\n\r，；｜、،؛"
# N/A and dates keep their slashes: a sign that no cell holds stands for them meanwhile
_WHOLE_SQL = r"""regexp_replace(regexp_replace({}, '\b(n)/(a)\b', '\1' || chr(31) || '\2', 'gi'), '\b(\d{{1,4}})/(\d{{1,2}})/(\d{{1,4}})\b', '\1' || chr(31) || '\2' || chr(31) || '\3', 'g')"""
_P1_SQL = rf"""
    WITH c AS (
        SELECT fix_id, 'what' AS field, regexp_replace(regexp_replace({_WHOLE_SQL.format("trim(what)")}, '\s+(et|and|-)\s+', ',', 'gi'), '[/&+]', ',', 'g') AS t FROM corrections
        UNION ALL SELECT fix_id, 'fix_database', regexp_replace(regexp_replace(regexp_replace({_WHOLE_SQL.format("trim(fix_database)")}, '\s+(et|and|-)\s+', ',', 'gi'), ' *[/&+{_SIGNS}] *', ',', 'g'), ' +', ',', 'g') FROM corrections
        UNION ALL SELECT fix_id, 'change_to', trim(change_to, ' ') FROM corrections),
    s AS (SELECT fix_id, field, regexp_extract_all(t || ',', '((?:{_QUOTED.replace("'", "''")}|[^{_SIGNS}])*)[{_SIGNS}]', 1) AS l FROM c WHERE t IS NOT NULL),
    u AS (SELECT fix_id, field, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS pos FROM s),
    v AS (SELECT fix_id, field, pos, trim(x, ' ' || chr(9) || chr(10) || chr(13)) AS x FROM u),
    w AS (SELECT fix_id, field, pos, CASE WHEN x LIKE '"%"' AND len(x) > 1 THEN replace(x[2:-2], '""', '"') WHEN len(x) > 1 AND (x LIKE '“%”' OR x LIKE '«%»' OR x LIKE '''%''') THEN x[2:-2] ELSE x END AS y FROM v),
    z AS (SELECT fix_id, field, pos, replace(y, chr(31), '/') AS item FROM w)
    SELECT fix_id, field, pos, trim(item) AS item FROM z WHERE trim(item) <> '' QUALIFY count(*) OVER (PARTITION BY fix_id, field) >= 2"""
_P4_SQL = r"""
    WITH names AS (
        SELECT assess_group AS g, lower(regexp_replace(n, '[^\p{L}\p{N}]', '', 'g')) AS k, min(upper(trim(homogenized_name))) AS field
        FROM (SELECT assess_group, homogenized_name, unnest([name_by1, name_my1, name_ey1, name_by2]) AS n FROM mapping_sheet)
        WHERE assess_group IS NOT NULL AND trim(homogenized_name) <> '' AND n IS NOT NULL GROUP BY 1, 2),
    lists AS (
        SELECT assess_group AS g, upper(trim(homogenized_name)) AS field, c.w AS wave, regexp_extract_all(c.t, 'c\(([^()]*)\)', 1) AS l
        FROM (SELECT *, unnest([{'w': 1, 't': code_by1}, {'w': 2, 't': code_my1}, {'w': 3, 't': code_ey1}, {'w': 4, 't': code_by2}]) AS c FROM mapping_sheet)
        WHERE assess_group IS NOT NULL AND c.t IS NOT NULL),
    pairs AS (
        SELECT DISTINCT g, field, wave, trim(u.v) || '=' || upper(trim(replace(u.d, '"', ''))) AS p
        FROM (SELECT g, field, wave, unnest(list_transform(range(1, len(string_split(l[1], ',')) + 1), lambda i: {'v': string_split(l[1], ',')[i], 'd': string_split(l[2], ',')[i]})) AS u FROM lists)),
    codes AS (SELECT g, field, wave, string_agg(p, ';' ORDER BY p) AS codes FROM pairs GROUP BY ALL),
    long AS (SELECT site_no, assess_group, file_no, wave, payload, unnest(json_keys(payload)) AS raw FROM wave_records),
    typed AS (
        SELECT long.*, coalesce(n.field, raw) AS field,
               CASE json_type(payload, '$."' || raw || '"') WHEN 'UBIGINT' THEN 'whole' WHEN 'BIGINT' THEN 'whole' WHEN 'DOUBLE' THEN 'decimal' WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean' END AS kind
        FROM long LEFT JOIN names n ON n.g = assess_group AND n.k = lower(regexp_replace(raw, '[^\p{L}\p{N}]', '', 'g'))),
    cat AS (
        SELECT t.site_no, t.assess_group, t.file_no, t.field, string_agg(DISTINCT raw, chr(1) ORDER BY raw) AS raws, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds, min(c.codes) AS codes
        FROM typed t LEFT JOIN codes c ON c.g = t.assess_group AND c.field = t.field AND c.wave = t.wave GROUP BY ALL),
    files AS (SELECT site_no, assess_group, file_no, lag(file_no) OVER (PARTITION BY site_no, assess_group ORDER BY min(received_at), file_no) AS prev FROM wave_records GROUP BY 1, 2, 3),
    cur AS (SELECT c.*, f.prev FROM cat c JOIN files f USING (site_no, assess_group, file_no) WHERE prev IS NOT NULL),
    old AS (SELECT f.site_no, f.assess_group, f.file_no, c.field, c.raws, c.kinds, c.codes FROM files f JOIN cat c ON c.site_no = f.site_no AND c.assess_group = f.assess_group AND c.file_no = f.prev),
    j AS (SELECT site_no, assess_group, file_no, field, a.raws AS r1, b.raws AS r0, a.kinds AS k1, b.kinds AS k0, a.codes AS c1, b.codes AS c0 FROM cur a FULL JOIN old b USING (site_no, assess_group, file_no, field)),
    x AS (SELECT site_no, assess_group, file_no, field, unnest([CASE WHEN r0 IS NULL THEN 'added' END, CASE WHEN r1 IS NULL THEN 'removed' END, CASE WHEN r1 <> r0 THEN 'renamed' END, CASE WHEN k1 <> k0 THEN 'retyped' END, CASE WHEN r1 IS NOT NULL AND r0 IS NOT NULL AND c1 <> c0 THEN 'recoded' END]) AS change_kind FROM j)
    SELECT * FROM x WHERE change_kind IS NOT NULL"""

_KIND_SQL = "CASE k WHEN 'UBIGINT' THEN 'whole' WHEN 'BIGINT' THEN 'whole' WHEN 'DOUBLE' THEN 'decimal' WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'truth' END"
_P4_VALUES_SQL = rf"""
    WITH names AS (
        SELECT assess_group AS g, lower(regexp_replace(n, '[^\p{{L}}\p{{N}}]', '', 'g')) AS k, min(upper(trim(homogenized_name))) AS field
        FROM (SELECT assess_group, homogenized_name, unnest([name_by1, name_my1, name_ey1, name_by2]) AS n FROM mapping_sheet)
        WHERE assess_group IS NOT NULL AND trim(homogenized_name) <> '' AND n IS NOT NULL GROUP BY 1, 2),
    codes AS ({survey_queries.ORACLE["mapping_recodes"]}),
    coded AS (SELECT DISTINCT assess_group AS g, field FROM codes),
    kinds AS (SELECT * FROM (VALUES {", ".join(f"('{f}', '{k}')" for f, k in TARGET.items())}) AS t(field, target)),
    long AS (SELECT rec_id, assess_group AS g, wave, payload, unnest(json_keys(payload)) AS raw, unnest(range(1, len(json_keys(payload)) + 1)) AS pos FROM wave_records WHERE json_valid(payload)),
    said AS (SELECT rec_id, l.g, wave, raw, pos, coalesce(n.field, raw) AS field, json_type(payload, '$."' || raw || '"') AS k, json_extract_string(payload, '$."' || raw || '"') AS v
             FROM long l LEFT JOIN names n ON n.g = l.g AND n.k = lower(regexp_replace(raw, '[^\p{{L}}\p{{N}}]', '', 'g'))),
    kinded AS (SELECT s.*, {_KIND_SQL} AS kind, target, c.field IS NOT NULL AS is_coded, f.final_value FROM said s LEFT JOIN kinds USING (field) LEFT JOIN coded c ON c.g = s.g AND c.field = s.field
               LEFT JOIN codes f ON f.assess_group = s.g AND f.field = s.field AND f.wave = s.wave AND f.value = s.v),
    judged AS (SELECT *, CASE WHEN target IS NULL THEN false WHEN is_coded THEN final_value IS NOT NULL WHEN target = 'string' THEN true
                   WHEN target = 'bigint' THEN kind IN ('whole', 'decimal', 'text') AND regexp_full_match(v, '-?(0|[1-9][0-9]*)([.]0+)?')
                   WHEN target = 'double' THEN kind IN ('whole', 'decimal', 'text') AND regexp_full_match(v, '-?(0|[1-9][0-9]*)([.][0-9]+)?')
                   ELSE kind = 'truth' OR (kind IN ('whole', 'text') AND v IN ('0', '1', 'true', 'false', 'yes', 'no')) END AS fits FROM kinded WHERE k <> 'NULL'),
    placed AS (SELECT *, fits AND row_number() OVER (PARTITION BY rec_id, field, fits ORDER BY pos) = 1 AS typed,
                   (raw = 'audit_flag' AND (kind = 'truth' OR (kind IN ('whole', 'text') AND v IN ('0', '1', 'true', 'false', 'yes', 'no')))) OR raw = 'form_build' AS promoted FROM judged),
    told AS (SELECT rec_id, CASE WHEN typed THEN field ELSE raw END AS field, NOT typed AND NOT promoted AS rescued,
                    CASE WHEN typed AND is_coded THEN final_value WHEN (typed AND target = 'boolean') OR (promoted AND raw = 'audit_flag') THEN CASE WHEN v IN ('1', 'true', 'yes') THEN 'true' ELSE 'false' END ELSE v END AS value FROM placed)
    SELECT rec_id, field, rescued, TRY_CAST(value AS DOUBLE) AS number, CASE WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN value END AS words FROM told"""

ORACLE: dict[str, str] = {**survey_queries.ORACLE, **more_queries.ORACLE, "p1_found": _P1_SQL, "p4_found": _P4_SQL, "p4_values": _P4_VALUES_SQL, "p6_found": time_sql.SQL}
