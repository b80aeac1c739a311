"""Queries of the operators in this package, and the SQL that checks them where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillpanel.llm import contamination, fingerprint, linkage, mixing, mojibake, names, resolution, skeleton
from quillpanel.session import read_table

NAME_TABLES = {"assessments": "row_id", "masterlist": "master_row", "rosters": "roster_id", "intake": "intake_id"}


def _names(spark: SparkSession, d: str):
    return {t: (read_table(spark, d, t), k, "student_name") for t, k in NAME_TABLES.items()}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return skeleton.differing_names(_names(spark, d))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return skeleton.skeleton_groups(_names(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    entries = read_table(spark, d, "assessments")
    copies = fingerprint.collapse_copies(entries, "row_id", fingerprint.assessment_record(entries), ["st_id", "uniqueid"])
    return copies.filter(F.col("n_copies") >= 2).select(F.col("first").alias("first_row_id"), "n_copies")


def _nicknames(spark: SparkSession, d: str) -> dict[str, str]:
    return names.nickname_table(read_table(spark, d, "nicknames"), "nickname", "given_name")


def _persons(spark: SparkSession, d: str) -> DataFrame:
    tables = {
        "masterlist": (read_table(spark, d, "masterlist"), "master_row", "student_name", "father_name", "location_id"),
        "rosters": (read_table(spark, d, "rosters"), "roster_id", "student_name", "father_name", "location_id"),
    }
    return resolution.resolve_people(tables, _nicknames(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return resolution.person_pairs(_persons(spark, d))


def p5_persons(spark: SparkSession, d: str) -> DataFrame:
    """One row for each roster and master row: the person it describes and how many rows that person has."""
    persons = _persons(spark, d)
    sizes = persons.groupBy("entity").agg(F.count("*").alias("n_rows"))
    return persons.join(sizes, "entity").select("tbl", F.col("row").alias("row_id"), F.md5("entity").alias("person"), "n_rows")


def p7_matches(spark: SparkSession, d: str) -> DataFrame:
    return linkage.link_without_keys(read_table(spark, d, "intake"), read_table(spark, d, "masterlist"), read_table(spark, d, "locations"), _nicknames(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_matches(spark, d).select("intake_id", "student_id")


def _leaks(spark: SparkSession, d: str, **how) -> DataFrame:
    return contamination.find_leaks(read_table(spark, d, "documents"), "doc_id", "text", read_table(spark, d, "exam_items"), "item_id", "item_text", **how)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def p8_near(spark: SparkSession, d: str) -> DataFrame:
    """Passages of 25 words that are nearly an item's: weighted shingle similarity of 0.8 or more."""
    near = _leaks(spark, d, window=25, min_similarity=0.8)
    return near.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "n_windows", F.round("similarity", 6).alias("similarity"))


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix_sources(read_table(spark, d, "documents"), "doc_id", "source", "text", read_table(spark, d, "mix_targets"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[1]


def p9_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the mixture, for each source: its tokens are within a document of its share, no document is
    there more often than the cap or twice in one pass, whole passes are whole, and places in shards are 1, 2, 3 ..."""
    mixture, targets = p9_mixture(spark, d), read_table(spark, d, "mix_targets")
    docs = read_table(spark, d, "documents").filter("text IS NOT NULL AND text <> ''").groupBy("source").agg(F.count("*").alias("n_docs"))
    uses = mixture.groupBy("source", "doc_id").agg(F.count("*").alias("n"), F.countDistinct("copy").alias("passes"), F.max("copy").alias("last"), F.max("n_tokens").alias("size"))
    per = uses.groupBy("source").agg(F.max("n").alias("most"), F.bool_and(F.col("n") == F.col("passes")).alias("once"), F.max("size").alias("largest"), F.max("last").alias("last"), F.sum(F.col("size") * F.col("n")).alias("tokens"), F.count("*").alias("used"))
    shards = mixture.groupBy("shard").agg(F.count("*").alias("n"), F.min("place").alias("first"), F.max("place").alias("end"), F.countDistinct("place").alias("places"))
    placed = shards.agg(F.bool_and((F.col("first") == 1) & (F.col("end") == F.col("n")) & (F.col("places") == F.col("n"))).alias("placed")).withColumn("one", F.lit(1))
    total = per.agg(F.sum("tokens").alias("all_tokens")).withColumn("one", F.lit(1))
    wide = targets.withColumn("one", F.lit(1)).join(per, "source").join(docs, "source").join(total, "one").join(placed, "one")
    share = F.col("target_share") * F.col("all_tokens")
    return wide.select(
        "source",
        (F.abs(F.col("tokens") - share) <= 2 * F.col("largest")).alias("share_met"),
        (F.col("most") <= F.col("max_repeats")).alias("within_cap"),
        "once",
        ((F.col("last") == 0) | (F.col("used") == F.col("n_docs"))).alias("passes_whole"),
        "placed",
    )


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    restored = mojibake.restored_texts(read_table(spark, d, "documents"), "doc_id", "text")
    digest = F.when(F.col("lost"), F.lit(str(mojibake.LOST))).otherwise(F.md5("restored"))
    return restored.select("doc_id", digest.alias("restored_md5"))


QUERIES = {"p2_found": p2_found, "p2_groups": p2_groups, "p3_found": p3_found, "p5_found": p5_found, "p5_persons": p5_persons, "p7_found": p7_found, "p7_matches": p7_matches, "p8_found": p8_found, "p8_near": p8_near, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p9_checks": p9_checks, "p10_found": p10_found}

def _p2_sql() -> str:
    """The consistent form by whole words: signs translated by class, then each word told by the scripts of its letters.
    Only the pairs of look-alikes are the operator's, as they are public data."""
    to_latin, from_latin = skeleton._alphabets()
    likes, plain = "".join(to_latin), "".join(to_latin.values())
    wide = "".join(c for c in map(chr, range(0xFF01, 0xFF5F)) if c != "＇")
    narrow = "".join(chr(ord(c) - 0xFEE0) for c in wide)
    blanks = "".join(map(chr, (0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 9, 10, 11, 12, 13, 0x85)))
    hidden = r"[\x{ad}\x{34f}\x{61c}\x{115f}\x{1160}\x{17b4}\x{17b5}\x{180b}-\x{180e}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{206f}\x{3164}\x{fe00}-\x{fe0f}\x{feff}\x{ffa0}]"

    def in_script(alphabet: str, script: str) -> str:
        latin, own = "".join(from_latin[alphabet]), "".join(from_latin[alphabet].values())
        rest = rf"length(regexp_replace(translate(translate(z[1], '{likes}', '{plain}'), '{latin}', '{own}'), '[\p{{{script}}}\P{{L}}]', '', 'g')) = 0"
        return rf"WHEN z[2] = 'other' AND {rest} AND regexp_matches(z[1], '\p{{{script}}}') THEN translate(z[1], '{latin}', '{own}')"

    names = " UNION ALL ".join(f"SELECT '{t}' AS tbl, {k} AS row_id, student_name AS text FROM {t}" for t, k in NAME_TABLES.items())
    return rf"""
    WITH n AS ({names}),
    v AS (SELECT tbl, row_id, text, translate(translate(translate(regexp_replace(text, '{hidden}', '', 'g'), '{wide}', '{narrow}'), '{blanks}', repeat(' ', {len(blanks)})), '{skeleton.HYPHENS}', repeat('-', {len(skeleton.HYPHENS)})) AS v
          FROM n WHERE text IS NOT NULL AND NOT regexp_full_match(text, '[A-Za-z ]*')),
    w AS (SELECT *, regexp_extract_all(v, '[^ -]+|[ -]') AS ws FROM v),
    l AS (SELECT *, list_transform(ws, lambda w: CASE WHEN NOT regexp_matches(w, '\p{{L}}') THEN '' WHEN length(regexp_replace(translate(w, '{likes}', '{plain}'), '[\p{{Latin}}\P{{L}}]', '', 'g')) > 0 THEN 'other'
              WHEN regexp_matches(w, '\p{{Latin}}') OR (regexp_matches(w, '\p{{Cyrillic}}') AND regexp_matches(w, '\p{{Greek}}')) THEN 'latin' ELSE 'open' END) AS ks FROM w),
    c AS (SELECT tbl, row_id, text, nfc_normalize(array_to_string(list_transform(list_zip(ws, ks), lambda z: CASE WHEN z[2] = 'latin' OR (z[2] = 'open' AND list_contains(ks, 'latin')) THEN translate(z[1], '{likes}', '{plain}')
              {in_script("CYRILLIC", "Cyrillic")} {in_script("GREEK", "Greek")} ELSE z[1] END), '')) AS clean_name FROM l)
    SELECT tbl, row_id, clean_name FROM c WHERE clean_name <> text"""


ORACLE = {
    "p2_found": _p2_sql(),
    "p3_found": """
        WITH n AS (
            SELECT row_id, assess_group, wave, age, grade, q11, q12, q1_99, score,
                   upper(regexp_replace(st_id, '[^\\p{L}\\p{N}]', '', 'g')) AS s,
                   upper(regexp_replace(uniqueid, '[^\\p{L}\\p{N}]', '', 'g')) AS u
            FROM assessments WHERE st_id IS NOT NULL AND uniqueid IS NOT NULL),
        t AS (SELECT *, CASE WHEN regexp_matches(u, 'T[0-9]{11}') THEN regexp_extract(u, '(T[0-9]{2})[0-9]{9}', 1)
                             ELSE regexp_extract(u, '(T[0-9]{2})([^0-9]|$)', 1) END AS tablet FROM n),
        p AS (SELECT *, replace(u, tablet, '-') AS r FROM t)
        SELECT min(row_id) AS first_row_id, count(*) AS n_copies FROM p
        GROUP BY s, tablet, regexp_extract(r, '[0-9]+'), regexp_extract(r, '[A-Z]+'), assess_group, wave, age, grade, q11, q12, q1_99, score
        HAVING count(*) >= 2""",
    # all pairs of windows that share a shingle, compared
    "p8_near": r"""
    WITH d AS (SELECT doc_id AS id, regexp_extract_all(lower(strip_accents(text)), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
    i AS (SELECT item_id AS id, regexp_extract_all(lower(strip_accents(item_text)), '[\p{L}\p{N}]+') AS w FROM exam_items WHERE item_text IS NOT NULL),
    si AS (SELECT id, p, array_to_string(w[p:p + 4], ' ') AS s FROM (SELECT id, w, unnest(range(1, len(w) - 3)) AS p FROM i WHERE len(w) >= 25)),
    weight AS (SELECT s, ln(1 + (SELECT count(*) FROM exam_items WHERE item_text IS NOT NULL) / count(DISTINCT id)) AS x FROM si GROUP BY s),
    wi AS (SELECT DISTINCT id, q, s FROM (SELECT id, s, p, unnest(range(greatest(1, p - 20), p + 1)) AS q FROM si) JOIN (SELECT id, len(w) AS n FROM i) USING (id) WHERE q <= n - 24),
    ti AS (SELECT id, q, sum(x) AS t FROM wi JOIN weight USING (s) GROUP BY id, q),
    sd AS (SELECT id, p, array_to_string(w[p:p + 4], ' ') AS s, len(w) AS n FROM (SELECT id, w, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) >= 25)),
    near AS (SELECT DISTINCT id FROM sd SEMI JOIN weight USING (s)),
    wd AS (SELECT DISTINCT id, q, s FROM (SELECT id, s, p, n, unnest(range(greatest(1, p - 20), p + 1)) AS q FROM sd SEMI JOIN near USING (id)) WHERE q <= n - 24),
    td AS (SELECT id, q, sum(coalesce(x, ln(2))) AS t FROM wd LEFT JOIN weight USING (s) GROUP BY id, q),
    shared AS (SELECT wd.id AS doc, wd.q AS dq, wi.id AS item, wi.q AS iq, sum(x) AS b FROM wd JOIN wi USING (s) JOIN weight USING (s) GROUP BY ALL),
    score AS (SELECT doc, item, b / (td.t + ti.t - b) AS x FROM shared JOIN td ON td.id = doc AND td.q = dq JOIN ti ON ti.id = item AND ti.q = iq)
    SELECT doc AS doc_id, item AS item_id, count(*) AS n_windows, round(least(max(x), 1), 6) AS similarity FROM score WHERE x >= 0.8 - 1e-9 GROUP BY doc, item""",
    "p9_checks": "SELECT source, true AS share_met, true AS within_cap, true AS once, true AS passes_whole, true AS placed FROM mix_targets",
    "p8_found": r"""
    WITH w AS (
        SELECT 'd' AS src, doc_id AS id, regexp_extract_all(lower(strip_accents(text)), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL
        UNION ALL SELECT 'i', item_id, regexp_extract_all(lower(strip_accents(item_text)), '[\p{L}\p{N}]+') FROM exam_items),
    g AS (SELECT src, id, w, unnest(range(1, len(w) - 10)) AS p FROM w WHERE len(w) >= 12),
    s AS (SELECT DISTINCT src, id, array_to_string(w[p:p + 11], ' ') AS s FROM g)
    SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM s d JOIN s i ON d.src = 'd' AND i.src = 'i' AND d.s = i.s""",
}
