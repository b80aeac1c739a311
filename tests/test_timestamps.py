from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from quillpanel.operators.timestamps import estimate_zones, normalize_times

UTC = timezone.utc


def us(*args):
    return int(datetime(*args, tzinfo=UTC).timestamp() * 1_000_000)


def run(spark, cells, lang="fr", place="B", seq=None, date=False, received=datetime(2017, 5, 1)):
    df = spark.createDataFrame([(i, c, lang, place, seq, received) for i, c in enumerate(cells)], "k long, t string, lang string, place string, seq string, at timestamp_ntz")
    places = spark.createDataFrame([("B", "Asia/Beirut"), ("N", "Africa/Niamey")], "place string, zone string")
    out = normalize_times(df, "k", [] if date else ["t"], ["t"] if date else [], places=places, place="place", zone="zone", sequence=F.col("seq"), ingested="at", anchor="t", month_first=F.col("lang") == "en", years=(2016, 2020))
    return {r.k: r.utc_us for r in out.collect()}


@pytest.mark.parametrize(
    ("cell", "expected"),
    [
        ("2017-03-01 09:00:05", (2017, 3, 1, 7, 0, 5)),
        ("٢٠١٧-٠٣-٠١ ٠٩:٠٠:٠٥", (2017, 3, 1, 7, 0, 5)),
        ("2017-03-01T09:00:05.250+03:00", (2017, 3, 1, 6, 0, 5, 250_000)),
        ("2017-03-01T09:00:05-0400", (2017, 3, 1, 13, 0, 5)),
        ("2017-03-01T09:00:05+02:00[Asia/Beirut]", (2017, 3, 1, 7, 0, 5)),
        ("2017-03-01 09:00:05 WAT", (2017, 3, 1, 8, 0, 5)),
        ("03/04/17 09:10", (2017, 4, 3, 6, 10)),
        ("03.04.2017 09:10:11", (2017, 4, 3, 6, 10, 11)),
        ("2 déc. 2017 09:50:08", (2017, 12, 2, 7, 50, 8)),
        ("21 avril 2017 à 07h25", (2017, 4, 21, 4, 25)),
        ("Mar 21, 2017 8:05:12 PM", (2017, 3, 21, 18, 5, 12)),
        ("02-Nov-2017 13:57", (2017, 11, 2, 11, 57)),
        ("20170424T095441Z", (2017, 4, 24, 9, 54, 41)),
        ("201704101554", (2017, 4, 10, 12, 54)),
        ("1488323205", (2017, 2, 28, 23, 6, 45)),
        ("1488323205123", (2017, 2, 28, 23, 6, 45, 123_000)),
        ("1803942405.0", (2017, 2, 28, 23, 6, 45)),
        ("  2017-03-01T07:00:05.000000Z ", (2017, 3, 1, 7, 0, 5)),
    ],
)
def test_forms(spark, cell, expected):
    assert run(spark, [cell]) == {0: us(*expected)}


def test_long_cells_are_read_whole(spark):
    blanks = " " * 200_000
    assert run(spark, ["2017-03-01 09:00:05" + blanks, blanks + "2017-03-01" + blanks + "09:00:05", "2017-03-01 09:00" + "\t" * 50_000 + "x!", "1" * 100_000, "2017-03-01" + "-" * 100_000]) == {0: us(2017, 3, 1, 7, 0, 5), 1: us(2017, 3, 1, 7, 0, 5)}


def test_month_first_only_with_slashes_in_english_forms(spark):
    assert run(spark, ["03/04/2017 10:00:00", "03.04.2017 10:00:00", "3/4/17 2:05pm"], lang="en") == {0: us(2017, 3, 4, 8), 1: us(2017, 4, 3, 7), 2: us(2017, 3, 4, 12, 5)}


def test_no_row_for_canonical_missing_and_impossible(spark):
    cells = ["2017-03-01T07:00:05.000000Z", None, "", "N/A", "-99", "99", "pm", "?", "31/02/2017 09:10", "2018-13-05 10:00", "0000-00-00 00:00:00", "2017-03-01 25:00", "x" * 100_000, "2017-03-01 09:00 XYZ"]
    assert run(spark, cells) == {}


def test_daylight_saving(spark):
    # 2017-10-29 00:00 in Beirut went back to 23:00: 23:30 occurs twice, the first is summer time
    assert run(spark, ["2017-10-28 23:30:00", "2017-03-26 00:30:00"]) == {0: us(2017, 10, 28, 20, 30), 1: us(2017, 3, 25, 22, 30)}


def test_dates(spark):
    cells = ["42795", "20879", "17226", "01/03/2017", "1 mars 2017", "Mar 1, 2017", "20170301", "01-Mar-17", "2017-03-01", "29/02/2017", "٢٠١٧-٠٣-٠١"]
    got = run(spark, cells, date=True)
    assert set(got) == {0, 1, 2, 3, 4, 5, 6, 7, 10} and set(got.values()) == {us(2017, 3, 1)}


def test_missing_place_takes_the_zone_that_fits(spark):
    # written 12 minutes before ingestion in Niamey (UTC+1)
    received = datetime(2017, 5, 1, 10, 12)
    assert run(spark, ["2017-05-01 11:00:00"], place=None, received=received) == {0: us(2017, 5, 1, 10)}
    assert run(spark, ["2017-05-01 13:00:00"], place=None, received=received) == {0: us(2017, 5, 1, 10)}


def test_estimate_counts_violations(spark):
    rows = [("s", us(2017, 5, 1, 11), us(2017, 5, 1, 10, 5)), ("s", us(2017, 5, 2, 11), us(2017, 5, 2, 10, 9)), (None, us(2017, 5, 2, 13), us(2017, 5, 2, 10, 9))]
    df = spark.createDataFrame(rows, "g string, l long, i long")
    got = {r.g: r.est_zone for r in estimate_zones(df, "g", "l", "i", ["Asia/Beirut", "Africa/Niamey"]).collect()}
    assert got == {"s": "Africa/Niamey", None: "Asia/Beirut"}


def test_empty_table(spark):
    assert run(spark, []) == {}
