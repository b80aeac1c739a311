import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillpanel.operators import codebook, homogenize, report, reshape
from quillpanel.plans import dsl, mapping, pipeline


# ---------------------------------------------------------------- reshape
def test_spread_and_gather(spark, rows):
    df = spark.createDataFrame([("A", 1, "F", 1.0), ("A", 2, None, 2.0), ("B", 1, "M", 3.0)], "id string, `.TIME` int, SEX string, SCORE double")
    wide = reshape.spread(df, ["id"])
    assert wide.columns == ["id", "SEX", "SCORE_1", "SCORE_2"]
    assert rows(wide) == [("A", "F", 1.0, 2.0), ("B", "M", 3.0, None)]
    assert rows(reshape.gather(wide)) == [("A", "F", 1, 1.0), ("A", "F", 2, 2.0), ("B", "M", 1, 3.0), ("B", "M", 2, None)]
    with pytest.raises(ValueError):
        reshape.spread(df.union(df), ["id"])
    forced = spark.createDataFrame([("A", 1, "x"), ("A", 2, "y"), ("A", 3, "y"), (None, 1, "q")], "id string, `.TIME` int, V string")
    assert rows(reshape.spread(forced, ["id"], force_unite=["V"])) == [(None, "q"), ("A", "y")]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=5))
def test_gather_undoes_spread_on_complete_panels(spark, values):
    panel = [(i, t, x) for i, v in enumerate(values) for t, x in zip((1, 2, 12), v, strict=True)]
    df = spark.createDataFrame(panel, "id int, t int, V int")
    back = reshape.gather(reshape.spread(df, ["id"], "t", split=["V"]), "t")
    assert sorted(map(tuple, back.select("id", "t", "V").collect())) == sorted(panel)


def test_merges(spark, rows):
    a = spark.createDataFrame([("1", 5), ("1", 4), (None, 7)], "ID string, N int")
    b = spark.createDataFrame([("1", 6), ("2", 8), (None, 9)], "ID string, N int")
    merged = reshape.merge_groups({"A": {1: a, 2: None}, "B": {1: b, 2: b}}, ["ID"])
    assert rows(merged[1], "`.MERGE`", "N_A", "N_B") == [(None, 7, 9), ("1", 4, 6), ("2", None, 8)]
    long = reshape.merge_times({1: a, 2: b.select("ID", F.col("N").cast("string"), F.lit(1.5).alias("Z"))}, ["ID"])
    assert long.columns == ["ID", "N", "Z"] and dict(long.dtypes)["N"] == "string" and long.count() == 6
    with pytest.raises(ValueError):
        reshape.merge_groups({"A": {1: a}, "B": {1: b, 2: b}}, ["ID"])
    assert reshape.permute_tags(spark.createDataFrame([(1, 2)], "x_A_1 int, x_2_A int"), ["A"]).columns == ["x_1_A", "x_A_2"]


def test_coalesce_over_times(spark, rows):
    df = spark.createDataFrame([("A", 1, None, 5), ("A", 2, 7, None), ("A", 3, 9, 9), (None, 1, 1, None)], "id string, t int, a int, b int")
    out = reshape.coalesce_over_times(df, ["id"], "t", ["a", "b"], [[1, 2]], "v", priority=["b"])
    assert rows(out, "id", "t", "v") == [(None, 1, 1), ("A", 1, 5), ("A", 2, 5), ("A", 3, None)]


# ---------------------------------------------------------------- mapping, homogenize
def test_wave_codes():
    assert [mapping.wave_decode(w) for w in ("BY1", "MY1", "ey1", "BY2", "MY3")] == [1, 2, 3, 4, 8]
    assert [mapping.wave_encode(i) for i in (1, 2, 3, 4, 8)] == ["BY1", "MY1", "EY1", "BY2", "MY3"]
    assert mapping.wave_decode("two", ["One", "Two"]) == 2


def test_mapping_checks():
    rows = mapping.clean_mapping([{"Group": "EGRA-x", "Name_BY1": "sex", "Name_EY1": "gender", "HomogenizedName": "SEX", "Keep": "Y"}, {"Group": "EGRA", "Name_BY1": " sex ", "HomogenizedName": "n/a"}, {"Group": None, "Name_BY1": "q"}, {"Group": " "}])
    assert [(r.group, r.names, r.master) for r in rows] == [("EGRA", {1: "sex", 2: None, 3: "gender"}, "SEX"), ("EGRA", {1: "sex", 2: None, 3: None}, None), (None, {1: "q", 2: None, 3: None}, None)]
    good, issues = mapping.check_mapping(rows)
    assert good == [] and sorted(i.message for i in issues) == ["DUPLICATE_BY1", "DUPLICATE_BY1", "NA_GROUP"]


def test_codings():
    assert mapping.parse_coding('cbind( c(1, 2), c("m","F, g") )') == [("1", "M"), ("2", "F, G")]
    for bad in ("c(1)", "cbind(c(1,2),c('a'))", "system('x')"):
        with pytest.raises(ValueError):
            mapping.parse_coding(bad)
    assert mapping.merge_codings([("0", "A & B"), ("1", "C")], [("5", "A"), ("6|7", "B"), ("8", "C")], "g", "v", 1) == ({"5": "0", "6": "0", "7": "0", "8": "1"}, [])
    values, issues = mapping.merge_codings([("0", "A")], [("1", "Z")], "g", "v", 1)
    assert values == {} and issues[0].level == "err"
    assert mapping.merge_codings([("0", "A"), ("1", "B")], [("1", "A")], "g", "v", 1)[1][0].level == "warn"


def test_homogenize(spark, rows):
    sheet = [{"Group": "EGRA", "Name_BY1": "sex", "Code_BY1": 'cbind(c(1,2),c("M","F"))', "Name_EY1": "gender", "Code_EY1": 'cbind(c(2,1),c("M","F"))', "HomogenizedName": "sex", "FinalCode": 'cbind(c(0,1),c("M","F"))'}, {"Group": "EGRA", "Name_BY1": "$SEX", "HomogenizedName": "copy"}, {"Group": "EGRA", "Name_BY1": "lost", "HomogenizedName": "L"}]
    one = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "sex int, other string")
    three = spark.createDataFrame([(1,), (2,)], "gender int")
    out = homogenize.homogenize(sheet, {"EGRA": {1: one, 2: None, 3: three}})
    assert rows(out.bundle["EGRA"][1], "other", "SEX", "COPY") == [("a", 0, 0), ("b", 1, 1), ("c", None, None)]
    assert rows(out.bundle["EGRA"][3], "SEX") == [(0,), (1,)] and out.bundle["EGRA"][2] is None
    assert [(i.level, i.variable) for i in out.issues] == [("err", "lost")]
    swap = spark.createDataFrame([("1",), ("2",), ("3.0",), (None,)], "v string").select(homogenize.recode(F.col("v"), {"1": "2", "2": "1", "3": "9"}).alias("v"))
    assert [r.v for r in swap.collect()] == ["2", "1", "9", None]


# ---------------------------------------------------------------- the reduction language
PANEL = [("A", 1, 1, None, 2, "b"), ("A", 2, 0, 9, None, "a"), ("A", 3, None, 1, 1, "a"), ("A", 4, 1, 1, 1, None)]
SCHEMA = "id string, `.TIME` int, SEX int, Q_EGRA int, Q_ODK int, NAME string"


def reduce_one(spark, text, initial="SEX", **extra):
    df = spark.createDataFrame(PANEL, SCHEMA)
    rows = [{"HomogenizedName": initial, "ReductionDB3": text, "FinalNameDB3": "OUT", **extra}]
    out = codebook.apply_codebook(df, rows, ids=["id"], origins={"EGRA": ["Q_EGRA"], "ODK": ["Q_ODK"]})
    if "OUT" not in out.df.columns:
        return [i.message for i in out.issues]
    return [r.OUT for r in out.df.orderBy("`.TIME`").collect()]


@pytest.mark.parametrize(
    ("text", "initial", "expected"),
    [
        ("99DUMMY", "SEX", [1, 0, None, 1]),
        ("FLATTEN(.DATABASES[EGRA,ODK])", "Q", [2, 9, 1, 1]),
        ("FLATTEN(.DATABASES(Q)[ODK])", "SEX", [2, None, 1, 1]),
        ("SUM(.GROUPS[EGRA,ODK])", "SEX", [2, 9, 2, 2]),
        (".DUMMIFY(SEX, 1)", "SEX", [1, 0, None, 1]),
        (".DUMMIFY(SEX, 1, na.rm=TRUE)", "SEX", [1, 0, 0, 1]),
        ("$G{ MODE(.THIS, na.rm=TRUE) }", "NAME", ["a"] * 4),
        ("$G{ mean(.TIMES[1,2], na.rm=TRUE) }", "SEX", [0.5] * 4),
        ("$G{ max(SEX) }", "SEX", [None] * 4),
        ("$G{ sum(SEX, na.rm = TRUE) }", "SEX", [2] * 4),
        ("$G{ length(.TIMES(NAME)[1,2,3]) }", "SEX", [3] * 4),
        ("$G{ first(NAME) }", "SEX", ["b"] * 4),
        ("$G{ any(SEX == 1) }", "SEX", [True] * 4),
        ("$R{ ifelse(is.na(Q_ODK), -1, Q_ODK + 2 * 3) }", "SEX", [8, -1, 7, 7]),
        ("SEX %in% c(1, NA)", "SEX", [True, False, True, True]),
        ("SEX %not_in% c(1)", "SEX", [False, True, True, False]),
        ("(SEX == 1) %|% (Q_ODK == 5)", "SEX", [True, False, False, True]),
        ("-2^2", "SEX", [-4.0] * 4),
        ("7 %% 4 * 2", "SEX", [6] * 4),
        ("CONSOLIDATE(Q_EGRA, Q_ODK)", "SEX", [2, 9, 1, 1]),
        ("case_when(SEX == 1, \"x\", SEX == 0, 'y', 'z')", "SEX", ["x", "y", "z", "x"]),
        ("toupper(substr(paste0(NAME, .KEY), 1, 2))", "SEX", ["BM", "AM", "AM", "NA"]),
        ("DEDUMMIFY(SEX, c(5))", "SEX", [5, None, None, 5]),
        ("gsub(\"a\", \"q\", NAME)", "SEX", ["b", "q", "q", None]),
        ("pmax(SEX, Q_ODK)", "SEX", [2, None, None, 1]),
        ("rowMeans(SEX, Q_ODK, na.rm = TRUE)", "SEX", [1.5, 0.0, 1.0, 1.0]),
        ("c(4, 5, 6)[2] + 0", "SEX", [5] * 4),
    ],
)
def test_reductions(spark, text, initial, expected):
    assert reduce_one(spark, text, initial) == expected


@pytest.mark.parametrize("text", ["SUM(", "NOPE(SEX)", "MISSING + 1", ".NOPE", ".TIMES[1]", "SUM(.SUBGROUP)", ".GROUPS", "1 $ 2", "DEDUMMIFY(SEX, c(1, 2))", "c(1)[9]"])
def test_what_a_cell_cannot_mean_is_an_issue(spark, text):
    got = reduce_one(spark, text)
    if text == ".GROUPS":
        assert got
    else:
        assert len(got) == 1 and isinstance(got[0], str)


def test_subgroups_drops_levels_and_load(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, None, 2)], "id int, A int, B int, C int")
    path = tmp_path / "x.txt"
    path.write_text("SUM(A, B)")
    book = [
        {"HomogenizedName": "A", "SubgroupDB3": "S,T", "ReductionDB3": "SUM(.SUBGROUP[S])", "FinalNameDB3": "total"},
        {"HomogenizedName": "B", "SubgroupDB3": "S", "ReductionDB3": "SUM(.SUBGROUP)", "FinalNameDB3": "total"},
        {"HomogenizedName": "C", "ReductionDB3": "total * 2 + C", "FinalNameDB3": "twice"},
        {"HomogenizedName": "C", "ReductionDB3": f'.LOAD("{path}")', "FinalNameDB3": "loaded"},
        {"HomogenizedName": "C", "ReductionDB3": "DROP"},
        {"HomogenizedName": "A", "FinalNameDB3": "a"},
        {"HomogenizedName": "Z", "ReductionDB3": "DROP"},
    ]
    out = codebook.apply_codebook(df, book, ids=["id"])
    assert out.df.columns == ["id", "total", "twice", "loaded", "a", "B"] and tuple(out.df.first()) == (1, 1, 4, 1, 1, None)
    assert [(i.variable, i.message) for i in out.issues] == [("Z", "variable to drop not in table")]


def test_two_dummies_are_an_error(spark):
    df = spark.createDataFrame([(1, 1, 1)], "id int, A int, B int")
    out = codebook.apply_codebook(df, [{"HomogenizedName": "A", "ReductionDB3": "DEDUMMIFY(A, B, c(1, 2))", "FinalNameDB3": "x"}], ids=["id"])
    with pytest.raises(Exception, match="several dummies"):
        out.df.collect()


def test_parser_shapes():
    assert dsl.parse_cell("drop").mode == "drop" and dsl.parse_cell("$G{x}").mode == "group"
    assert json.dumps(dsl.parse("`odd name` + 1").args[0][1].head) == '"odd name"'
    with pytest.raises(dsl.DslError):
        dsl.parse("1 +")


# ---------------------------------------------------------------- pipeline and report
def test_pipeline(spark):
    sheet = [{"Group": "EGRA", "Name_BY1": "id", "Name_MY1": "id", "HomogenizedName": "ST_ID", "FinalNameDB3": "ST_ID"}, {"Group": "EGRA", "Name_BY1": "s", "Name_MY1": "score", "HomogenizedName": "SCORE", "FinalNameDB3": "score"}]
    one, two = spark.createDataFrame([("a", 1), ("b", 2)], "id string, s int"), spark.createDataFrame([("a", 3)], "id string, score int")
    out = pipeline.clean_databases(sheet, {"EGRA": {1: one, 2: two}}, spread_times=True)
    assert out.issues == []
    wide = {r[".MERGE"]: (r.score_1, r.score_2) for r in out.wide.collect()}
    assert wide == {"a": (1, 3), "b": (2, None)}
    assert pipeline.issue_rows(spark, [mapping.Issue("err", "G", 1, "v", "m")]).first()["Issue"] == "m"


def test_pipeline_outputs(spark, tmp_path):
    sheet = [{"Group": "G", "Name_BY1": "k", "HomogenizedName": "K", "FinalNameDB3": "K"}, {"Group": "G", "Name_BY1": "v", "HomogenizedName": "V", "FinalNameDB3": "V"}, {"Group": "G", "Name_BY1": "none", "HomogenizedName": "N"}]
    table = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    out = pipeline.clean_databases(sheet, {"G": {1: table}}, ids=["K"], spread_times=True, report_directory=str(tmp_path / "r"), output_directory=str(tmp_path / "o"), stata=True)
    assert spark.read.csv(str(tmp_path / "r" / "ISSUES.csv"), header=True).count() == len(out.issues) > 0
    for name in ("G/T_1.csv", "ALL_MERGED_LONG.csv", "ALL_MERGED_WIDE.csv"):
        assert spark.read.csv(str(tmp_path / "o" / name), header=True).count() == 2
    assert (tmp_path / "o" / "ALL_MERGED_WIDE.dta").exists()


def test_report(spark, rows):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (4.0, None), (9.0, "b"), (None, "b")], "v double, s string")
    r = report.descriptives(df, ["v"]).first()
    assert (r.n, r.min, r["mean"], r.median, r.sd, r["max"]) == (4, 1.0, 4.0, 3.0, 3.56, 9.0)
    assert rows(report.frequencies(df, ["s"])) == [("s", None, 1), ("s", "a", 2), ("s", "b", 2)]
    assert rows(report.histogram(df, "v", 4), "bin", "n") == [(1, 2), (2, 1), (4, 1)]
    assert report.histogram(df.limit(0), "v").count() == 0
    meta = [{"FINALNAMES": "v", "Type": "continuous", "ITEMDES": "value"}, {"FINALNAMES": "s", "Type": "binary", "CODING": 'cbind(c("a","b"),c("x","y"))'}, {"FINALNAMES": "gone"}, {"FINALNAMES": "d", "DROPCASE": "Drop it"}]
    text = report.codebook_markdown(df, meta)
    assert "| 4 | 1.0 | 4.0 | 3.0 | 3.56 | 9.0 |" in text and "| a | X |" in text and "not in database" in text and "## d" not in text
    assert report.resolve_name("v", ["v_BY1"], "BY1") == "v_BY1" and report.resolve_name("v", ["v_x_EGRA"], None, "EGRA") == "v_x_EGRA"


def test_medians_are_exact(spark):
    import random
    from statistics import median

    rng = random.Random(1)
    data = [(rng.gauss(0, 1), float(rng.randrange(3)), None if i % 3 else i / 7, 5.0, None) for i in range(997)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double")
    expected = {c: median(v) if (v := [r[i] for r in data if r[i] is not None]) else None for i, c in enumerate("abcde")}
    for few in (1, 50, 10_000):
        assert report.medians(df, list("abcde"), bins=8, few=few) == pytest.approx(expected)
    assert report.medians(df.limit(0), ["a"]) == {"a": None}
