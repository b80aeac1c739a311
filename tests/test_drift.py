import json
from datetime import datetime

import pytest

from quillpanel.operators import drift

SHEET = [
    ("G", "age ", None, "AGE_YEARS", None, "AGE", None),
    ("G", "sex", 'cbind(c(1,2),c("M","F"))', "sex", 'cbind(c(2,1),c("M","F"))', "sex ", 'cbind(c(0,1),c("M","F"))'),
    (None, None, None, None, None, None, None),
    ("G", "age ", None, "AGE_YEARS", None, "AGE", None),
]


@pytest.fixture
def sheet(spark):
    return spark.createDataFrame(SHEET, "g string, n1 string, c1 string, n2 string, c2 string, h string, fin string")


def records(spark, files):
    rows = [(i, 1, "G", f, w, datetime(2020, 1, d), json.dumps(p) if isinstance(p, dict) else p) for i, (f, w, d, p) in enumerate(files)]
    return spark.createDataFrame(rows, "rec long, site long, g string, f long, w int, at timestamp_ntz, payload string")


def changes(spark, sheet, files):
    names = drift.sheet_names(sheet, "g", ["n1", "n2"], "h")
    codes = drift.sheet_codes(sheet, "g", {1: "c1", 2: "c2"}, "h")
    ingested = drift.ingest(records(spark, files), names, group="g", payload="payload")
    table = drift.typed_table(ingested, {"AGE": "bigint", "SEX": "bigint"}, ["rec", "site", "g", "f", "w", "at"], drift.recode_map(sheet, "g", {1: "c1", 2: "c2"}, "fin", "h"), group="g", wave="w", origin=True)
    out = drift.file_changes(table, codes, source=["site", "g"], group="g", file="f", wave="w", arrived="at")
    return sorted((r.f, r.field, r.change_kind) for r in out.collect())


def test_every_kind_of_change(spark, sheet):
    got = changes(spark, sheet, [
        (1, 1, 1, {"age": 9, "sex": 1, "x": 1}),
        (2, 2, 2, {"Age-Years": 9.5, "sex": 2, "y": True}),
        (3, 2, 3, {"Age-Years": None, "sex": 2, "y": "t"}),
    ])
    assert got == [(2, "AGE", "renamed"), (2, "AGE", "retyped"), (2, "SEX", "recoded"), (2, "x", "removed"), (2, "y", "added"), (3, "y", "retyped")]


def test_files_follow_by_arrival_within_and_across_days(spark, sheet):
    got = changes(spark, sheet, [(5, 1, 1, {"a": 1}), (4, 1, 1, {"b": 1}), (1, 1, 9, {"b": 1})])
    # equal times are ordered by file number: 4, 5, then 1
    assert got == [(1, "a", "removed"), (1, "b", "added"), (5, "a", "added"), (5, "b", "removed")]


def test_broken_payloads_and_empty_tables(spark, sheet):
    assert changes(spark, sheet, [(1, 1, 1, {"a": 1}), (2, 1, 2, "not json"), (3, 1, 3, None)]) == [(2, "a", "removed")]
    assert changes(spark, sheet, [(1, 1, 1, {"a": 1})]) == []


def test_rescue_and_promotion(spark, sheet):
    names = drift.sheet_names(sheet, "g", ["n1", "n2"], "h")
    ingested = drift.ingest(records(spark, [(1, 1, 1, {"age": "12", "sex": "?", "flag": 1, "note": "n"}), (1, 1, 1, {"AGE": 7})]), names, group="g", payload="payload")
    assert drift.dominant_types(ingested, ["AGE", "SEX"]) in ({"AGE": "bigint", "SEX": "string"}, {"AGE": "string", "SEX": "string"})
    table = drift.typed_table(ingested, {"AGE": "bigint", "SEX": "bigint"}, ["rec"])
    first, second = table.orderBy("rec").collect()
    assert (first.AGE, first.SEX, json.loads(first._rescued)) == (12, None, {"sex": "?", "flag": 1, "note": "n"})
    assert (second.AGE, second._rescued) == (7, None)
    promoted = drift.promote(table, {"flag": "boolean", "note": "bigint"}).orderBy("rec").first()
    assert (promoted.flag, promoted.note, json.loads(promoted._rescued)) == (True, None, {"sex": "?", "note": "n"})


def test_values_that_would_change_are_rescued(spark, sheet):
    names = drift.sheet_names(sheet, "g", ["n1", "n2"], "h")
    payloads = [{"age": 8.5}, {"age": "8.7"}, {"age": True}, {"age": 8.0}, {"age": "012"}, {"age": 7, "Age-Years": 9}, '{"age": 1', '[5]', '{"age": 3, "age": 4}', {"age": None}, '{"age": 1e3}', {"age": {"y": 1}}, "", None, {"age": 2**60}]
    ingested = drift.ingest(records(spark, [(1, 1, 1, p) for p in payloads]), names, group="g", payload="payload")
    got = {r.rec: (r.AGE, json.loads(r._rescued) if r._rescued else None) for r in drift.typed_table(ingested, {"AGE": "bigint"}, ["rec"]).collect()}
    assert [got[i] for i in range(6)] == [(None, {"age": 8.5}), (None, {"age": "8.7"}), (None, {"age": True}), (8, None), (None, {"age": "012"}), (7, {"Age-Years": 9})]
    assert [got[i] for i in (6, 7)] == [(None, {"_unparsed": '{"age": 1'}), (None, {"_unparsed": "[5]"})]
    assert got[8][0] in (3, 4) and got[8][1]["_unparsed"] == '{"age": 3, "age": 4}'
    assert [got[i] for i in range(9, 15)] == [(None, None), (1000, None), (None, {"age": {"y": 1}}), (None, None), (None, None), (2**60, None)]
    got = {r.rec: (r.AGE, json.loads(r._rescued) if r._rescued else None) for r in drift.typed_table(ingested, {"AGE": "double"}, ["rec"]).collect()}
    assert [got[i] for i in (0, 1, 2, 3, 14)] == [(8.5, None), (8.7, None), (None, {"age": True}), (8.0, None), (2.0**60, None)]


def test_promotion_keeps_what_it_does_not_take(spark):
    table = spark.createDataFrame([(1, None, '{"a": 8.5, "b": 2, "c": "yes"}'), (2, 5, '{"a": 6}'), (3, None, '{"a": 6}')], "k long, a long, _rescued string")
    got = {r.k: (r.a, r.b, r.c, json.loads(r._rescued) if r._rescued else None) for r in drift.promote(table, {"a": "bigint", "b": "boolean", "c": "boolean"}).collect()}
    assert got == {1: (None, None, True, {"a": 8.5, "b": 2}), 2: (5, None, None, {"a": 6}), 3: (6, None, None, None)}


def test_table_is_in_final_coding(spark, sheet):
    names = drift.sheet_names(sheet, "g", ["n1", "n2"], "h")
    codes = drift.recode_map(sheet, "g", {1: "c1", 2: "c2"}, "fin", "h")
    files = [(1, 1, 1, {"sex": 1, "age": 1}), (1, 1, 1, {"sex": "2"}), (2, 2, 2, {"sex": 1}), (2, 2, 2, {"sex": 2}), (2, 2, 2, {"sex": 7}), (3, 3, 3, {"sex": 1}), (2, 2, 2, {"sex": None})]
    ingested = drift.ingest(records(spark, files), names, group="g", payload="payload")
    got = {r.rec: (r.AGE, r.SEX, r._rescued) for r in drift.typed_table(ingested, {"AGE": "bigint", "SEX": "bigint"}, ["rec"], codes, group="g", wave="w").collect()}
    assert got == {0: (1, 0, None), 1: (None, 1, None), 2: (None, 1, None), 3: (None, 0, None), 4: (None, None, '{"sex":7}'), 5: (None, None, '{"sex":1}'), 6: (None, None, None)}


def test_final_labels_of_several_wave_labels(spark):
    sheet = spark.createDataFrame([("G", 'cbind(c(1,2,3),c("a","b","c & d"))', "X", 'cbind(c(7,8),c("A & B","c & d"))')], "g string, c1 string, h string, fin string")
    got = {r.value: r.final_value for r in drift.recode_map(sheet, "g", {1: "c1"}, "fin", "h").collect()}
    assert got == {"1": "7", "2": "7", "3": "8"}


def test_codes_to_final_coding(spark, sheet):
    got = {(r.wave, r.value): r.final_value for r in drift.recode_map(sheet, "g", {1: "c1", 2: "c2"}, "fin", "h").collect()}
    assert got == {(1, "1"): "0", (1, "2"): "1", (2, "2"): "0", (2, "1"): "1"}
