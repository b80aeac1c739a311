import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillpanel.functions import text
from quillpanel.operators import clean, verify


def pair(spark, a, b, f):
    return spark.createDataFrame([(a, b)], "a string, b string").select(f(F.col("a"), F.col("b")).alias("x")).first().x


def brute_osa(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@pytest.mark.parametrize(("a", "b", "d"), [("CA", "AC", 1), ("CA", "ABC", 3), ("kitten", "sitting", 3), ("MOHAMED", "MOHAMMED", 1), ("", "abc", 3), ("", "", 0), (None, "a", None)])
def test_osa_goldens(spark, a, b, d):
    assert pair(spark, a, b, text.osa_distance) == d


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text("abc", max_size=7), st.text("abc", max_size=7)), min_size=20, max_size=20))
def test_osa_against_brute_force(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", text.osa_distance(F.col("a"), F.col("b")).alias("d"), text.osa_distance(F.col("b"), F.col("a")).alias("e"), F.levenshtein("a", "b").alias("l"), text.within_osa(F.col("a"), F.col("b"), F.lit(2)).alias("w")).collect()
    for r in got:
        assert r.d == r.e == brute_osa(r.a, r.b) <= r.l and r.w == (r.d <= 2)


@pytest.mark.parametrize(("a", "b", "x"), [("SARA", "SARA KHALIL", False), ("MOHAMED", "MOHAMMED", True), ("MOHAMEDALIHASSAN", "MOHAMMEDALIHASSAN", False), (None, "SARA", False), ("NA", "SARA", False), ("A(B", "xa(bx", False)])
def test_name_mismatch(spark, a, b, x):
    assert pair(spark, a, b, lambda p, q: text.name_mismatch(p, q, 0.1)) is x


def test_accents(spark):
    df = spark.createDataFrame([("Éçôlé ñ Œuvre ß Ş",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(text.remove_accents(F.col("t"))).collect()] == ["Ecole n OEuvre ss S", None, ""]


def test_clean_golden(spark):
    df = spark.createDataFrame([(" arem 1734", " josé ", "9", "N/A"), ("AREM1735", "-99", "10", ""), ("", "", "", "")], "ST_ID string, NAME string, AGE string, NOTE string")
    once = clean.clean(df)
    assert sorted(map(tuple, once.collect())) == [("AREM1734", "JOSE", 9), ("AREM1735", None, 10)]
    assert sorted(map(tuple, clean.clean(once).collect())) == sorted(map(tuple, once.collect()))
    numeric = spark.createDataFrame([("99",), ("-99",)], "AGE string")
    assert sorted(r[0] for r in clean.clean(numeric).collect()) == [-99, 99]
    assert clean.infer_types(spark.createDataFrame([("1.5", None, "x"), ("2", None, "1")], "a string, b string, c string")) == {"a": "double", "b": "string", "c": "string"}
    assert clean.clean(spark.createDataFrame([], df.schema)).columns == df.columns


def test_legacy_clean_and_dates(spark):
    df = spark.createDataFrame([("a 1", "2017-01-05", "see #N/A", "1"), ("-99", "2015-01-05", "ok", "2"), ("b2", None, "ok", "3")], "X_ID string, D string, T string, N string")
    got = clean.legacy_clean(df, date_col="D", begin_date="2016-01-01").collect()
    assert [(r.X_ID, r.T if "T" in r else None, r.N) for r in got] == [("A1", None, 1)]
    when = spark.createDataFrame([(0.0,)], "s double").select(clean.parse_date(F.col("s"), "", numeric=True).alias("d"))
    assert str(when.first().d) == "1960-01-01 00:00:00"
    assert clean.java_pattern("%d/%m/%Y %H:%M") == "dd/MM/yyyy HH:mm"


def test_patch_nonresponse(spark):
    df = spark.createDataFrame([(1, 0, 0, "a"), (1, 1, None, "b"), (0, 0, 0, "c"), (None, 0, 0, "d"), (1, None, None, "e")], "Q1_99 int, Q11 int, Q12 int, Q1x string")
    got = {r.Q1x: (r.Q11, r.Q12) for r in clean.patch_nonresponse(df).collect()}
    assert got == {"a": (None, None), "b": (1, None), "c": (0, 0), "d": (0, 0), "e": (None, None)}
    other = spark.createDataFrame([(1, 5)], "Q1_99 int, Q10_x int")
    assert clean.patch_nonresponse(other).columns == ["Q1_99", "Q10_x"]


def test_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("t",)], "y string")
    p, q = clean.pad_columns(a, b, ["x", "y"])
    assert p.columns == ["x", "y"] and q.columns == ["y", "x"] and dict(p.dtypes)["y"] == "string"
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert clean.move_after(df, "a", "b").columns == ["b", "a", "c"]
    assert clean.select_prefixed(clean.add_prefix(df, "P_", ["b"]), "P_", ["a"]).columns == ["a", "b"]
    assert clean.order_by_codebook(df, ["c", "zz"]).columns == ["c", "a", "b"]
    t = df.select(clean.or_known(F.lit(False), F.lit(None).cast("boolean")).alias("x"), clean.or_known(F.lit(None).cast("boolean"), F.lit(None).cast("boolean")).alias("y")).first()
    assert (t.x, t.y) == (False, None)
    yn = clean.yesno_to_boolean(spark.createDataFrame([("Y", "N", "x"), ("n", None, "Y")], "a string, b string, c string"))
    assert [k for _, k in yn.dtypes] == ["boolean", "boolean", "string"]


def test_duplicates_with_null_keys_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "id int, __k0 string")
    got = {r["__k0"]: r.duplicated for r in verify.flag_duplicates(df, ["id"]).collect()}
    assert got == {"a": True, "b": True, "c": False, "d": True, "e": True}
    assert verify.flag_duplicates(df.limit(0), ["id"]).count() == 0


def test_only_in_matches_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r.k for r in verify.only_in(left, right, ["k"]).collect()] == [2]
    assert verify.only_in(left, right.limit(0), ["k"]).count() == 3


@pytest.mark.parametrize(
    ("spec", "good", "bad"),
    [(("REM", "A|B", 4, "CXN"), ["AREM1734", "BREM5643"], ["CREM1734", "AREM173", "AREM17345"]), (("ST", "", (3, 5), "XN"), ["ST134", "ST67895"], ["ST12", "XST134"]), (("", "A|B", 3, "CN"), ["A134", "B678"], ["C134"])],
)
def test_id_patterns(spark, spec, good, bad):
    df = spark.createDataFrame([(x,) for x in [*good, *bad, None]], "x string")
    flagged = {r.x for r in df.filter(verify.bad_pattern(F.col("x"), verify.id_pattern(*spec))).collect()}
    assert flagged == {*bad, None}


def test_single_set_issues(spark):
    df = spark.createDataFrame([("A1", 5), ("A1", 6), ("ZZ", 7), ("A3", 99)], "id string, v int")
    reference = spark.createDataFrame([("A1",), ("A3",)], "id string")
    got = verify.single_set_issues(df, "id", reference=reference, patterns={"id": "^A[0-9]$"}, checks={"big": lambda x: F.col("v") > 50}).collect()
    assert sorted((r.id, r.v, r.ISSUE) for r in got) == [("A1", 5, "duplicated_id"), ("A1", 6, "duplicated_id"), ("A3", 99, "big"), ("ZZ", 7, "bad_id, dataonly")]
    fixed = verify.fix_format(df, ["id"])
    assert fixed.columns == ["id", "Verifier", "Problem", "WHAT", "change.from", "change.to", "Note", "v"]
    assert verify.fix_format(fixed, ["id"]).columns == fixed.columns


@pytest.mark.parametrize(
    ("ages", "expected"),
    [((9, 9, None), (False,) * 4), ((9, 10, 11), (True, True, False, True)), ((9, 8, 7), (True, False, True, True)), ((None, 9, 10), (True, False, False, False)), ((None, None, None), (False,) * 4)],
)
def test_margins(spark, ages, expected):
    df = spark.createDataFrame([ages], "a int, b int, c int")
    cols = [F.col(c) for c in "abc"]
    assert tuple(df.select(*(verify.value_mismatch(cols, u, lo).alias(f"x{i}") for i, (u, lo) in enumerate([(None, None), (1, None), (None, 1), (1, 1)]))).first()) == expected


def test_cross_source(spark):
    ref = spark.createDataFrame([("1", "SARA", 9), ("2", "ALI", 8), (None, "X", 1)], "ID string, NAME string, AGE int")
    a = spark.createDataFrame([("1", "SARA KHALIL", 9), ("1", "SARA", 9), ("3", "OMAR", 7)], "ID string, NAME string, AGE int")
    b = spark.createDataFrame([("2", "HUDA", 10), (None, "X", 1)], "ID string, NAME string, AGE int")
    got = {(r.ID, r.NAME_A): (r.NAME_ISSUE, r.AGE_ISSUE, r.DUPS, r.N_ISSUES) for r in verify.cross_source_issues({"A": a, "B": b}, ("REF", ref), "ID", names=["NAME"], variables=["AGE"], upper={"AGE": 1}).collect()}
    assert got == {("1", "SARA KHALIL"): (False, False, "ID DUPLICATED IN A", 0), ("1", "SARA"): (False, False, "ID DUPLICATED IN A", 0), ("2", None): (True, True, "NO", 2)}
    with pytest.raises(ValueError):
        verify.merge_sources({"A": a, "B": a}, "ID", ["AGE"], allow_duplicates=False)
    assert verify.resolve_tolerance({".others": 0.2, "N": 0.1}, "N") == 0.1 and verify.resolve_tolerance({".others": 0.2}, "Z") == 0.2
    with pytest.raises(KeyError):
        verify.resolve_tolerance({"N": 0.1}, "Z")


def test_rows_without_an_id_match_nothing(spark):
    from quillpanel.operators.verify import merge_sources

    one = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "id string, v int")
    two = spark.createDataFrame([("a", 4), (None, 5), (None, 6), ("b", 7)], "id string, v int")
    got = sorted(((r.id, r.v_A, r.v_B) for r in merge_sources({"A": one, "B": two}, "id", ["v"]).collect()), key=str)
    assert got == sorted([("a", 1, 4), ("b", None, 7), (None, 2, None), (None, 3, None), (None, None, 5), (None, None, 6)], key=str)
    assert merge_sources({"A": one.limit(0), "B": two.limit(0)}, "id", ["v"]).count() == 0


def test_long_sets_and_collisions(spark):
    df = spark.createDataFrame([("1", 1), ("1", 1), ("1", 2)], "ID string, t int")
    out = verify.long_set_issues(df, "ID", "t", "EGRA", [1, 2])
    assert {k: v.count() for k, v in out.items()} == {"EGRA_1": 2, "EGRA_2": 0}
    assert verify.column_collisions({"A": {1: df}, "B": {1: df.withColumn("q", F.lit(1)), 2: None}}, ["ID"]) == {"t"}
