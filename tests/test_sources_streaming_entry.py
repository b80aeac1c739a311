import pytest
from pyspark.sql import functions as F

from quillpanel.operators.packed import PackedField
from quillpanel.sources import io
from quillpanel.streaming import rows as stream


def test_csv_round_trip_and_accept(spark, tmp_path):
    df = spark.createDataFrame([("1", "NA", "x, y"), ("2", "", None)], "a string, b string, c string")
    io.write_csv(df, str(tmp_path / "t.csv"), small=True)
    back = io.accept(spark, str(tmp_path / "t.csv"))
    assert back.dtypes == [("a", "bigint"), ("b", "string"), ("c", "string")] and sorted(map(tuple, back.collect())) == [(1, None, "x, y"), (2, None, None)]
    assert io.accept(spark, df) is df
    for bad in (5, "x.unknown"):
        with pytest.raises(TypeError):
            io.accept(spark, bad)
    cells = df.select("a", *io.parse_fields("c", 3)).orderBy("a").first()
    assert tuple(cells) == ("1", "x", "y", None)


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "P_x int, P_y string")
    paths = io.export_bundle({"G": {1: df, 2: None}}, str(tmp_path), variable_prefix="P_")
    assert paths == [f"{tmp_path}/G/T_1.csv"] and spark.read.csv(paths[0], header=True).columns == ["x", "y"]
    assert io.write_stata(df, str(tmp_path / "t.dta")) and not io.write_stata(df, str(tmp_path / "none" / "t.dta"))


def test_quotes_survive_in_csv_files_and_cells(spark, tmp_path):
    df = spark.createDataFrame([("1", 'say "x, y", twice'), ("2", "a\nb")], "a string, b string")
    io.write_csv(df, str(tmp_path / "q.csv"))
    assert sorted(map(tuple, io.read_csv(spark, str(tmp_path / "q.csv"), infer=False).collect())) == [("1", 'say "x, y", twice'), ("2", "a\nb")]
    cells = spark.createDataFrame([('1, "x, y" ,, z ,5,6,7,8,9',), (None,), ("",)], "c string")
    rows = [tuple(r) for r in cells.select(*io.parse_fields("c")).collect()]
    assert rows[0] == ("1", "x, y", None, "z", "5", "6", "7", "8") and rows[1] == rows[2] == (None,) * 8


def test_workbooks_and_documents(spark, tmp_path):
    import zipfile
    from xml.etree import ElementTree

    from quillpanel.sources import office

    df = spark.createDataFrame([(1, "a & <b>", None), (2, "NA", 2.5), (3, "é " * 20_000, 0.0)], "k long, t string, x double")
    path = str(tmp_path / "t.xlsx")
    io.write_xlsx(df, path)
    got = [tuple(r) for r in io.accept(spark, path).collect()]
    assert got == [("1", "a & <b>", None), ("2", None, "2.5"), ("3", "é " * 20_000, "0.0")]
    io.write_xlsx(df.limit(0), path)
    assert io.read_xlsx(spark, path).columns == ["k", "t", "x"] and io.read_xlsx(spark, path).count() == 0
    with pytest.raises(ValueError):
        io.write_xlsx(df, path, max_rows=2)
    office.write_document(str(tmp_path / "d.docx"), "# T & t\n\nwords\n\n| a | b |\n|-|-|\n| 1 | 2 |\n")
    with zipfile.ZipFile(tmp_path / "d.docx") as z:
        tree = ElementTree.fromstring(z.read("word/document.xml"))
    assert "".join(tree.itertext()) == "T & twordsab12"


def test_workbooks_beyond_one_sheet(spark, tmp_path, monkeypatch):
    import zipfile

    from quillpanel.sources import office

    path = str(tmp_path / "t.xlsx")
    monkeypatch.setattr(io, "_PIECE_LETTERS", 20)
    table = [(i, f"n{i} & <b>", None if i % 2 else "é") for i in range(7)]
    for most, sheets in ((3, 3), (7, 1)):
        office.write_workbook(path, ["k", "t", "T"], iter(table), most)
        with zipfile.ZipFile(path) as z:
            assert sum("worksheets" in n for n in z.namelist()) == sheets
        assert list(office.workbook_rows(path)) == [["k", "t", "T"], *([str(k), t, x] for k, t, x in table)]
        back = io.read_xlsx(spark, path)
        assert back.columns == ["k", "t", "T"] and sorted(map(tuple, back.collect())) == [(str(k), t, x) for k, t, x in table]
    monkeypatch.setattr(office, "_SHEET_LETTERS", 100)
    office.write_workbook(path, ["k"], ([i] for i in range(50)))
    assert [r[0] for r in office.workbook_rows(path)] == ["k", *map(str, range(50))]
    monkeypatch.undo()
    io.write_xlsx(spark.range(1_048_577).coalesce(1), path)
    with zipfile.ZipFile(path) as z:
        assert z.read("xl/workbook.xml").count(b"<sheet ") == 2 and z.read("xl/worksheets/sheet2.xml").count(b"<row>") == 3


def test_other_sheets_are_not_read(tmp_path):
    """Only a sheet that continues the first by its name and header is read with it."""
    import zipfile

    from quillpanel.sources import office

    office.write_workbook(str(tmp_path / "t.xlsx"), ["k"], [[1], [2]], 1)
    for old, new in ((b"Sheet1 continued 2", b"Sheet1 (2)"), (b">k<", b">other<")):
        with zipfile.ZipFile(tmp_path / "t.xlsx") as z, zipfile.ZipFile(tmp_path / "other.xlsx", "w") as out:
            for n in z.namelist():
                out.writestr(n, z.read(n).replace(old, new) if n in ("xl/workbook.xml", "xl/worksheets/sheet2.xml") else z.read(n))
        assert list(office.workbook_rows(str(tmp_path / "other.xlsx"))) == [["k"], ["1"]]


def test_stored_tables_are_deleted_when_asked_for(spark):
    from pathlib import Path

    from quillpanel import session

    session.forget_stored(spark)
    table = session.stored(spark.createDataFrame([(1,)], "k long"))
    path = Path(table.inputFiles()[0].removeprefix("file://")).parent
    assert path.is_dir() and session.forget_stored(spark) == 1 and not path.exists() and session.forget_stored(spark) == 0


def test_streams(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, " N/A ", "a,b"), (2, "ok", "c")], "k long, t string, cell string").write.parquet(source)
    table = spark.readStream.schema("k long, t string, cell string").parquet(source)
    stream.write_table(stream.unpack_stream(stream.clean_rows(table), "k", {"cell": PackedField()}), sink, str(tmp_path / "check")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(sink).select("k", "pos", "item").collect())) == [(1, 1, "a"), (1, 2, "b")]
    late = stream.late_duplicates(stream.with_arrival(table), ["k"], "arrived", "1 minute")
    assert late.isStreaming and "arrived" in late.columns


def test_entry_has_queries_and_matching_sql(spark):
    import __spark_entry__ as entry

    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert entry.entry(spark).columns == ["site_no", "assess_group", "file_no", "field", "change_kind"]


def test_survey_queries_match_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from pathlib import Path

    from quillpanel.plans.catalog import ORACLE, QUERIES

    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("no test data")
    con = duckdb.connect()
    for p in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    text = lambda v: None if v is None else repr(round(v, 6)) if isinstance(v, float) else str(v)
    for name in ("single_set_issues", "value_mismatch_both", "apply_corrections", "verify_fixes_flags", "grouped_reduction", "coalesce_long", "merge_databases_collision", "id_retrieval", "clean_databases", "id_retrieval_intake", "reduction_macros", "codebook_document", "mapping_issues", "p1_found", "p4_values"):
        df = QUERIES[name](spark, str(folder))
        cols = sorted(df.columns)
        result = con.execute(ORACLE[name])
        names = [c[0] for c in result.description]
        expected = sorted(tuple(text(r[names.index(c)]) or "" for c in cols) for r in result.fetchall())
        assert sorted(tuple(text(r[c]) or "" for c in cols) for r in df.select(*(F.col(c) for c in cols)).collect()) == expected, name
