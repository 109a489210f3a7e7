import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationday.functions.text import csv_fields, lenient_double, strict_cast, strip_text
from stationday.functions.time import (
    PARTS,
    floor_hour,
    iso_timestamp,
    snapshot_date,
    snapshot_key,
    today,
    with_observation_time,
)

JAPAN = ZoneInfo("Asia/Tokyo")


def texts(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i int, t string")


def column(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_strip_text_trims_unicode_space_and_empties(spark):
    values = ["　 東京 　", "", "  ", "  x　", "a b", None, "\t-\n"]
    assert column(texts(spark, values), strip_text(F.col("t"))) == ["東京", None, None, "x", "a b", None, "-"]


def test_strict_cast_keeps_null_and_zero(spark):
    df = texts(spark, ["0.0", None, "-1.5e1", "+2", ".5", "3."])
    assert column(df, strict_cast(F.col("t"), T.DoubleType(), F.lit("x"))) == [0.0, None, -15.0, 2.0, 0.5, 3.0]


@pytest.mark.parametrize("text", ["abc", "1.0f", "NaN", "Infinity", "1,5", "１", ""])
def test_strict_cast_rejects_other_text(spark, text):
    with pytest.raises(Exception, match="Invalid double for x: "):
        column(texts(spark, [text]), strict_cast(F.col("t"), T.DoubleType(), F.lit("x")))


@pytest.mark.parametrize("text", ["5.0", "x", "99999999999999999999"])
def test_strict_cast_of_whole_numbers(spark, text):
    with pytest.raises(Exception, match="Invalid bigint for q: "):
        column(texts(spark, [text]), strict_cast(F.col("t"), T.LongType(), F.lit("q")))


def test_lenient_double(spark):
    assert column(texts(spark, ["45", "invalid", None, "31.2"]), lenient_double(F.col("t"))) == [45.0, None, None, 31.2]


def test_csv_fields(spark):
    lines = ["a,b,", '"a,b","say ""hi""",c', ",,", "x", '"",y', " a,　b "]
    fields = column(texts(spark, lines), csv_fields(F.col("t")))
    assert fields == [["a", "b", ""], ["a,b", 'say "hi"', "c"], ["", "", ""], ["x"], ["", "y"], ["a", "b"]]


@pytest.mark.parametrize("line", ['a,"b', 'a,"b"c', 'a"b,c'])
def test_csv_fields_reject_malformed_quotes(spark, line):
    with pytest.raises(Exception, match="Malformed quotes"):
        column(texts(spark, [line]), csv_fields(F.col("t")))


@settings(max_examples=15, deadline=None)
@given(rows=st.lists(st.lists(st.text(alphabet='ab,"東 \u0002', max_size=5), min_size=1, max_size=4), min_size=1, max_size=8))
def test_csv_fields_invert_quoting(spark, rows):
    import csv
    import io

    lines = []
    for row in rows:
        out = io.StringIO()
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="").writerow(row)
        lines.append(out.getvalue())
    found = column(texts(spark, lines), csv_fields(F.col("t")))
    assert found == [[field.strip() for field in row] for row in rows]


def at(spark, *time):
    df = spark.createDataFrame([time], ", ".join(f"{p} string" for p in PARTS))
    row = with_observation_time(df).select("date", iso_timestamp(F.col("observed_at"))).first()
    return row[0].isoformat(), row[1]


@pytest.mark.parametrize(
    ("hour", "minute", "expected"),
    [
        ("14", "00", "2026-09-13T14:00:00+09:00"),
        ("14", "50", "2026-09-13T14:00:00+09:00"),
        ("15", "0", "2026-09-13T15:00:00+09:00"),
        ("0", "59", "2026-09-13T00:00:00+09:00"),
        ("24", "00", "2026-09-14T00:00:00+09:00"),
    ],
)
def test_observed_at_is_floored_and_hour_24_rolls_over(spark, hour, minute, expected):
    assert at(spark, "2026", "09", "13", hour, minute) == ("2026-09-13", expected)


@pytest.mark.parametrize(
    "time",
    [
        ("2026", "09", "13", "24", "01"),
        ("2026", "09", "13", "25", "00"),
        ("2026", "09", "13", "-1", "00"),
        ("2026", "09", "13", "12", "60"),
        ("2026", "02", "30", "12", "00"),
        ("2026", "13", "01", "12", "00"),
        ("2026", "x", "13", "12", "00"),
        ("2026", None, "13", "12", "00"),
        ("2026", "9", "13", None, "00"),
    ],
)
def test_invalid_observation_time(spark, time):
    with pytest.raises(Exception, match="Invalid observation time"):
        at(spark, *time)


def test_observation_time_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert at(spark, "2026", "09", "13", "23", "10") == ("2026-09-13", "2026-09-13T23:00:00+09:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_keys_and_hours(spark):
    df = spark.createDataFrame([(dt.date(2026, 9, 3), dt.datetime(2026, 9, 3, 14, 50))], "d date, t timestamp_ntz")
    row = df.select(snapshot_key(F.col("d")).alias("k"), floor_hour(F.col("t")).alias("h")).first()
    assert row.k == "20260903" and row.h == dt.datetime(2026, 9, 3, 14)
    keys = column(texts(spark, ["20260903", "2026093", "20261340", None]), snapshot_date(F.col("t")))
    assert keys == [dt.date(2026, 9, 3), None, None, None]


def test_today_is_japans_day():
    assert today(dt.datetime(2026, 9, 13, 15, 30, tzinfo=dt.timezone.utc)) == dt.date(2026, 9, 14)
    assert today(dt.datetime(2026, 9, 13, 14, 30, tzinfo=dt.timezone.utc)) == dt.date(2026, 9, 13)
