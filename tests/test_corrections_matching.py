import pytest
from pyspark.sql import functions as F

from quillpanel.operators import corrections as x
from quillpanel.operators import matching

SHEET = "uid string, id string, what string, change_from string, change_to string, state string"


@pytest.fixture
def table(spark):
    return spark.createDataFrame([("U1", "A1", 9), ("U2", "A2", 8), ("U3", "A2", 8), ("U4", "A4", 7)], "UID string, ID string, AGE int")


def sheet(spark, *rows):
    return spark.createDataFrame([(*r, None)[:6] if len(r) == 5 else r for r in rows], SHEET)


@pytest.mark.parametrize(
    ("fix", "flags"),
    [
        (("u1", "A1", "AGE", "9", "10"), set()),
        (("U4", "A4", "whole observation", "", None), set()),
        (("U9", "A9", "AGE", "1", "2"), {"missing_uid"}),
        (("U2", "A2", "AGE", "8", None), {"incomplete_record"}),
        (("U2", "A2", "HEIGHT", "1", "2"), {"what_not_found"}),
        (("U1", "A1", "ID", "A1", "A2"), {"existing_id"}),
    ],
)
def test_flags(spark, table, fix, flags):
    row = x.verify_fixes(sheet(spark, fix), table, "UID", "ID").first()
    assert {f for f in x.FLAGS if row[f]} == flags and row.any_issue == bool(flags)


def test_contradicting_fixes(spark, table):
    out = x.verify_fixes(sheet(spark, ("U1", "A1", "AGE", "9", "10"), ("U1", "A1", "AGE", "9", "11")), table, "UID", "ID").collect()
    assert all(r.duplicate_changes and r.multiple_conclusions for r in out)


def test_force_applies_no_contradictions(spark, table):
    fixes = sheet(spark, ("U1", "A1", "AGE", "9", "10"), ("U1", "A1", "AGE", "9", "11"), ("U2", "A2", "AGE", "8", "5"), ("U2", "A2", "AGE", "8", "5"))
    out = x.apply_fixes(table, fixes, "UID", "ID", force=True)
    assert {r.UID: r.AGE for r in out.df.collect()} == {"U1": 9, "U2": 5, "U3": 8, "U4": 7} and out.err.count() == 2


def test_apply(spark, table):
    fixes = sheet(
        spark, ("u1", "A1", "age", "9", "10"), ("U4", "A4", "Whole obs", None, None), ("U2", "A2", "IDENTICAL", None, None), ("U3", "A2", "IDENTICAL", None, None), ("U9", "A9", "AGE", "1", "2"), ("U1", "A1", "ID", "A1", "A7", "rejected"),
    )
    out = x.apply_fixes(table, fixes, "UID", "ID")
    got = sorted(map(tuple, out.df.collect()))
    assert len(got) == 2 and got[0] == ("U1", "A1", 10) and got[1][1:] == ("A2", 8)
    assert sorted((r.uid, r.what) for r in out.err.collect()) == [("U1", "ID"), ("U9", "AGE")]
    bad = x.apply_fixes(table, sheet(spark, ("U1", "A1", "AGE", "9", "ten")), "UID", "ID")
    assert bad.err.count() == 1 and bad.df.filter("UID = 'U1'").first().AGE == 9
    assert x.apply_fixes(table, sheet(spark, ("U1", "A1", "AGE", "1", "2")).limit(0), "UID", "ID").df.count() == 4


def test_packed_sheet_over_tables(spark, table):
    packed = spark.createDataFrame([("U1", "A1", "EGRA|ODK", "AGE,ID|AGE", "3,A9|4"), ("U2", "A2", "odk", "AGE,ID", "5")], "uid string, id string, database string, what string, change_to string")
    flat = x.explode_multi_fixes(packed, database="database", what="what", after="change_to", keep=["uid"])
    assert sorted(tuple(r) for r in flat.select("uid", "database", "what", "change_to").collect() if r.change_to) == [("U1", "EGRA", "AGE", "3"), ("U1", "EGRA", "ID", "A9"), ("U1", "ODK", "AGE", "4"), ("U2", "ODK", "AGE", "5")]
    assert [(r.n_what, r.n_values) for r in flat.filter("uid = 'U2'").collect()] == [(2, 1), (2, 1)]
    out = x.apply_multi_fixes({"EGRA": table, "ODK": table}, packed, "UID", "ID")
    assert out["EGRA"].df.filter("UID = 'U1'").first()[1:] == ("A9", 3) and out["ODK"].df.filter("UID = 'U1'").first()[1:] == ("A1", 4)


def test_long_fixes(spark):
    df = spark.createDataFrame([("U1", "A", 1, 5), ("U1", "A", 2, 6), (None, "B", 1, 7)], "UID string, ID string, t int, AGE int")
    fixes = spark.createDataFrame([("U1", "A", "EGRA_2", "AGE", "60")], "uid string, id string, database string, what string, change_to string")
    out = x.apply_long_fixes(df, fixes, "EGRA", "ID", "t", "UID")
    assert sorted((r.UID, r.t, r.AGE) for r in out.df.collect()) == [("U1", 1, 5), ("U1", 2, 60)]


def test_retrieval(spark):
    master = spark.createDataFrame(
        [("A1", "MOHAMED ALI", "NORTH SCHOOL", "L1", "T1", "RANA"), ("A2", "MOHAMED ALI", "SOUTH SCHOOL", "L2", "T2", "HUDA"), ("A3", "SARA KHALIL", "NORTH SCHOOL", "L1", "T1", "RANA"), ("B9", "MOHAMED ALI", "EAST SCHOOL", "L9", "T9", "MAYA")],
        "sid string, name string, loc string, loc_id string, t_id string, t string",
    )
    survey = spark.createDataFrame(
        [("s1", "MOHAMMED ALI", "L1", "RANA", "A"), ("s2", "SARA", None, None, "A"), ("s3", "ZZZZ QQQQ", "L1", None, "A"), ("s4", "MOHAMED ALI", None, None, "A"), ("s5", None, None, None, "A"), ("s6", "MOHAMED ALI", None, None, None)],
        "row string, name string, loc string, t string, region string",
    )
    spec = matching.RetrievalSpec("row", "name", "loc", "t", "sid", "name", "loc", "loc_id", "t", "t_id")
    out = matching.retrieve_ids(survey, master, spec, matching.region_block("LEBANON", F.col("region")), F.substring("sid", 1, 1))
    got = {r.row: (r.retrieved, r.NO_MATCH, r.MULTIPLE_MATCH) for r in out.collect()}
    assert got == {"s1": ("A1", False, False), "s2": ("A3", False, False), "s3": (None, True, False), "s4": ("A1|A2", False, True), "s5": (None, True, False), "s6": (None, True, False)}
    assert matching.retrieve_ids(survey.limit(0), master, spec, matching.region_block("x", F.col("region")), F.lit("S")).count() == 0


def test_close_pairs_against_all_pairs(spark):
    import random

    from quillpanel.functions.text import close_names

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 14)))
    left = [("x", word()) for _ in range(80)] + [(None, "a"), ("x", None), ("y", "abcabc")]
    right = [("x", word()) for _ in range(60)]
    for _, v in left[:40]:
        if v:
            letters = list(v)
            for _ in range(rng.randrange(4)):
                letters.insert(rng.randrange(len(letters) + 1), rng.choice("abcd "))
            right.append(("x", "".join(letters)))
    lo, ro = spark.createDataFrame(left, "block string, v string"), spark.createDataFrame(right, "block string, n string")
    for tolerance in (0.0, 0.2, 0.45):
        every = lo.distinct().join(ro.distinct(), "block").filter("trim(v) <> '' AND trim(n) <> ''").filter(close_names(F.col("v"), F.col("n"), tolerance))
        assert {(r.v, r.n) for r in matching.close_pairs(lo, ro, tolerance).collect()} == {(r.v, r.n) for r in every.collect()}
    assert matching.close_pairs(lo.limit(0), ro, 0.2).count() == 0


def test_near_pairs_against_all_pairs(spark):
    import random

    from quillpanel.functions import text

    rng = random.Random(4)
    word = lambda letters, most: "".join(rng.choice(letters) for _ in range(rng.randrange(1, most)))
    for letters, most in (("abc ", 14), ("AbÉéĀā\t-", 9), ("ab", 90)):
        left = [("x", word(letters, most)) for _ in range(40)] + [(None, "a"), ("x", None), ("y", "abcabc"), ("x", "\t"), ("x", "SARA"), ("x", "zz" * 300)]
        right = [("x", (v or "")[:9] + word(letters, most)) for _, v in left] + left[:9] + [("x", "x sara Y"), ("x", "zz" * 302), ("z", "a")]
        lo, ro = spark.createDataFrame(left, "block string, v string"), spark.createDataFrame(right, "block string, n string")
        for tolerance in (0.0, 0.2):
            every = lo.distinct().join(ro.distinct(), "block").filter((text.without_blanks(F.col("v")) != "") & (text.without_blanks(F.col("n")) != "")).filter(text.close_names(F.col("v"), F.col("n"), tolerance))
            got = [tuple(r) for r in matching.near_pairs(lo, ro, tolerance).collect()]
            assert len(got) == len(set(got)) and set(got) == {(r.block, r.v, r.n) for r in every.select("block", "v", "n").collect()}
    assert matching.near_pairs(lo.limit(0), ro, 0.2).count() == 0


def test_retrieval_moves_no_more_than_its_rows(spark):
    """Names within several edits share so short segments that keys for them were thousands a name."""
    import random

    rng = random.Random(5)
    name = lambda: " ".join("".join(rng.choice("bdgklmnrst") + rng.choice("aeiou") for _ in range(4)) for _ in range(3)).upper()
    masters = [(f"A{i}", name(), f"PLACE {i % 7}", f"L{i % 7}", f"T{i % 9}", f"TEACHER {i % 9}") for i in range(200)]
    rows = [(f"s{i}", m[1][:3] + "X" + m[1][3:], m[3], m[5]) for i, m in enumerate(masters[:60])]
    master = spark.createDataFrame(masters, "sid string, name string, loc string, loc_id string, t_id string, t string")
    survey = spark.createDataFrame(rows, "row string, name string, loc string, t string")
    spec = matching.RetrievalSpec("row", "name", "loc", "t", "sid", "name", "loc", "loc_id", "t", "t_id")
    sc = spark.sparkContext
    written = lambda: sum(s.shuffleWriteRecords() for s in sc._jvm.scala.jdk.javaapi.CollectionConverters.asJava(sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)))
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = written()
        got = {r.row: r.retrieved for r in matching.retrieve_ids(survey, master, spec, F.lit("A"), F.lit("A")).collect()}
        assert got == {f"s{i}": f"A{i}" for i in range(60)}
        assert 0 < written() - before < 20_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
