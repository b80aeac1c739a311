from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quillpanel.operators.packed import CORRECTION_FIELDS, PackedField, unpack_values


def unpack(spark, cells, how=PackedField()):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "k long, cell string")
    out = {}
    for r in unpack_values(df, "k", {"cell": how}).orderBy("k", "pos").collect():
        out.setdefault(r.k, []).append((r.pos, r.item))
    return out


def test_delimiters_quotes_and_positions(spark):
    got = unpack(spark, ['"5"" ruler, wooden"، a', "'child said \"later\", then left',SREM 1", "a,,b;", "N/A | 12/05/2017;07:29", "A & B", " x\ty\n", "«1,2»｜3"])
    assert got == {
        0: [(1, '5" ruler, wooden'), (2, "a")],
        1: [(1, 'child said "later", then left'), (2, "SREM 1")],
        2: [(1, "a"), (3, "b")],
        3: [(1, "N/A"), (2, "12/05/2017"), (3, "07:29")],
        5: [(1, "x"), (2, "y")],
        6: [(1, "1,2"), (2, "3")],
    }


def test_single_values_nulls_and_blanks_give_no_row(spark):
    assert unpack(spark, [None, "", "  ", "one", '"a, b"', ",,x,,"]) == {}


def test_codes_with_words_and_blanks(spark):
    how = CORRECTION_FIELDS["fix_database"]
    got = unpack(spark, ["EGRA et ODK", "EGMA EGRA", "A - B", " EGRA | SEL |", "EGRA+ODK&SEL"], how)
    assert [[v for _, v in got[i]] for i in range(5)] == [["EGRA", "ODK"], ["EGMA", "EGRA"], ["A", "B"], ["EGRA", "SEL"], ["EGRA", "ODK", "SEL"]]


def test_not_applicable_dates_and_times_are_one_value(spark):
    cells = ["N/A, AGE", "n/a; EGMA / SEX", "12/05/2017 07:29, AGE", "2017-3-1 & N/A", "N/AGE", "SAN/A, B", '"N/A, x" | 1/2']
    what = unpack(spark, cells, CORRECTION_FIELDS["what"])
    assert [[v for _, v in what[i]] for i in range(7)] == [["N/A", "AGE"], ["n/a", "EGMA", "SEX"], ["12/05/2017 07:29", "AGE"], ["2017-3-1", "N/A"], ["N", "AGE"], ["SAN", "A", "B"], ["N/A, x", "1", "2"]]
    bases = unpack(spark, cells, CORRECTION_FIELDS["fix_database"])
    assert [[v for _, v in bases[i]] for i in range(4)] == [["N/A", "AGE"], ["n/a", "EGMA", "SEX"], ["12/05/2017 07:29", "AGE"], ["2017-3-1", "N/A"]]


def test_long_runs_of_blanks(spark):
    for how in (PackedField(), CORRECTION_FIELDS["what"], CORRECTION_FIELDS["fix_database"]):
        assert unpack(spark, ["a" + " " * 200_000 + "," + "\t" * 100_000 + "b" + " " * 200_000], how)[0][0] == (1, "a")


def test_identifiers_keep_inner_blanks(spark):
    assert unpack(spark, ["whole observation", "AGE and GRADE"], CORRECTION_FIELDS["what"]) == {1: [(1, "AGE"), (2, "GRADE")]}


def test_placeholder_signs_in_the_text_survive(spark):
    assert unpack(spark, ["x0y,\"a,b\""]) == {0: [(1, "x0y"), (2, "a,b")]}


def test_very_long_cell(spark):
    long = "x" * 200_000 + ',"y,' + "z" * 100_000 + '"'
    assert [len(v) for _, v in unpack(spark, [long])[0]] == [200_000, 100_002]


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "fix_id long, cell string, field int, pos int, item int, k string")
    assert unpack_values(df, "fix_id", {"cell": PackedField()}).columns == ["fix_id", "field", "pos", "item"]
    one = spark.createDataFrame([(1, "a,b", 5, 6, 7, "q")], df.schema)
    assert unpack_values(one, "fix_id", {"cell": PackedField()}).count() == 2


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='ab ,;|"x', min_size=1, max_size=8).map(lambda s: s.strip()).filter(bool), min_size=2, max_size=5))
def test_round_trip_of_quoted_values(spark, values):
    cell = ",".join('"' + v.replace('"', '""') + '"' for v in values)
    kept = [(i, v.strip()) for i, v in enumerate(values, 1) if v.strip()]
    assert unpack(spark, [cell]) == {0: kept}
