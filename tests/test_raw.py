import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from fixtures import HEADERS, csv_text, measured, time_parts, write, write_master
from stationday.errors import MissingRawObjects
from stationday.operators import clean
from stationday.schemas import CLEANED_SCHEMAS, MEASUREMENT_BY_NAME, MEASUREMENTS
from stationday.sources import landing as L
from stationday.sources.rawcsv import file_payloads, payload_rows

DAY = dt.date(2026, 9, 13)
LANDED = "snapshot_date date, filename string, content binary"


def payloads(spark, files):
    rows = [(DAY, name, bytearray(text if isinstance(text, bytes) else text.encode("shift_jis"))) for name, text in files]
    return spark.createDataFrame(rows, LANDED)


def cleaned(spark, *files):
    return clean.clean_measurements(clean.landed_measurement_rows(payloads(spark, files)))


def rows_of(name, *values, station="11001", wmo="", time=None):
    return [(station, wmo, time or time_parts(DAY), list(v)) for v in values]


@pytest.mark.parametrize("name", list(HEADERS))
def test_each_measurement_has_its_declared_schema(spark, name):
    text = csv_text(name, rows_of(name, measured(name, 26.3)), 7)  # the header's day is not compared
    table = clean.cleaned_table(cleaned(spark, (f"{name}.csv", text)), name).drop("snapshot_date")
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in CLEANED_SCHEMAS[name]]
    row = table.first().asDict()
    assert row["station_id"] == "11001" and row["wmo_station_id"] is None and row["date"] == DAY
    measures = MEASUREMENT_BY_NAME[name].measures
    assert row[measures[0].name] == 26.3 and row[measures[1].name] == 8
    if len(measures) > 2:
        assert row[measures[2].name] == "北北西" and row[measures[3].name] == 8


def test_missing_measure_is_null_and_zero_is_kept(spark):
    text = csv_text("precipitation", rows_of("precipitation", ("", "5"), ("0.0", " ")), 13)
    found = cleaned(spark, ("precipitation.csv", text)).orderBy("quality").select("value", "quality").collect()
    assert [tuple(r) for r in found] == [(0.0, None), (None, 5)]


def test_files_with_differing_headers_are_read_together(spark):
    order = [10, 3, 9, 0, 1, 2, 8, 7, 6, 5, 4]
    one = csv_text("precipitation", rows_of("precipitation", ("1.5", "8")), 3)
    two = csv_text("precipitation", rows_of("precipitation", ("2.5", "4"), station="22"), 13, order)
    found = cleaned(spark, ("precipitation.csv", one), ("precipitation.csv", two)).orderBy("value").collect()
    assert [(r.station_id, r.value, r.quality) for r in found] == [("11001", 1.5, 8), ("22", 2.5, 4)]


BROKEN = [
    (lambda t: t.replace("13日の値(mm)", "値"), r"Expected exactly one column matching .*値\\\(mm\\\), found \[\]"),
    (lambda t: t.replace("都道府県", "12日の値(mm)"), "Expected exactly one column matching"),
    (lambda t: t.replace("観測所番号", "番号"), "Expected exactly one column matching 観測所番号"),
    (lambda t: t.replace(",8\r\n", ",8,9\r\n"), "Expected 11 fields, found 12"),
    (lambda t: t.replace(",1.5,8\r\n", "\r\n"), "Expected 11 fields, found 9"),
    (lambda t: t.replace("1.5", "many"), "Invalid double for precipitation.csv value: many"),
    (lambda t: t.replace("2026,09", "2026,19"), "Invalid observation time: 2026 19 13"),
]
CHANGES = [
    *(change for change, _ in BROKEN),
    lambda t: t,
    lambda t: "\r\n\r\n" + t,
    lambda t: t.replace("\r\n", "\r\n\r\n"),
    lambda t: t.replace("\r\n", "\r"),
    lambda t: t.rstrip(),
    lambda t: t.replace("県", '"県'),
    lambda t: t.replace("県", '"県"x'),
    lambda t: t.replace("県", '"a\nb"'),
    lambda t: "",
    lambda t: "\r\n",
    lambda t: t.encode("shift_jis").replace(b"11001", b"11001\x81"),
    lambda t: t.encode("shift_jis").replace(b"11001", "①".encode("cp932")),
    lambda t: t.replace("2026,09,13,14", "2026,09,13,24"),
    lambda t: t.replace("2026,09,13,14,00", "2026,09,13,24,10"),
]


@pytest.mark.parametrize(("change", "message"), BROKEN)
def test_broken_files_are_errors(spark, change, message):
    text = csv_text("precipitation", rows_of("precipitation", ("1.5", "8")), 13)
    assert change(text) != text
    with pytest.raises(Exception, match=message):
        cleaned(spark, ("precipitation.csv", change(text))).collect()


def test_direction_pattern_does_not_match_its_quality(spark):
    text = csv_text("max_wind", rows_of("max_wind", ("3.0", "8", "南", "4", "1")), 13)
    row = cleaned(spark, ("max_wind.csv", text)).first()
    assert (row.direction, row.direction_quality) == ("南", 4)


def test_decoding_is_strict(spark):
    text = csv_text("precipitation", rows_of("precipitation", ("1.5", "8")), 13).encode("shift_jis")
    for extra in ("①".encode("cp932"), b"\x81"):
        with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING"):
            cleaned(spark, ("precipitation.csv", text.replace(b"11001", b"11001" + extra))).collect()


def test_one_time_per_file_is_judged_before_rounding(spark):
    def conflicts(*minutes):
        rows = [("1", "", time_parts(DAY, "14", m), ["1.0", "8"]) for m in minutes]
        table = cleaned(spark, ("precipitation.csv", csv_text("precipitation", rows, 13)))
        return clean.time_conflicts(table, ["snapshot_date", "source"]).collect()

    assert conflicts("50", " 50 ") == []
    (found,) = conflicts("10", "50")
    assert (found.times, found["first"], found["last"]) == (2, "2026 09 13 14 10", "2026 09 13 14 50")
    rows = [("1", "", time_parts(DAY, "14", m), ["1.0", "8"]) for m in ("10", "50")]
    table = cleaned(spark, ("precipitation.csv", csv_text("precipitation", rows, 13)))
    with pytest.raises(ValueError, match="Expected one observation time"):
        clean.require_one_time(table, ["snapshot_date", "source"])


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(32 * 1024))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def both_readings(spark, root):
    whole = clean.landed_measurement_rows(file_payloads(spark, root))
    return clean.clean_measurements(whole), clean.clean_measurements(clean.measurement_file_rows(spark, root))


def test_large_files_are_split_and_give_the_same_rows(spark, tmp_path, small_splits):
    root = str(tmp_path)
    for name in HEADERS:
        rows = [(f"{i:05d}", "", time_parts(DAY), measured(name, i / 10)) for i in range(4000)]
        write(f"{root}/20260913/{name}.csv", csv_text(name, rows, 13).encode("shift_jis"))
    write(f"{root}/20260913/notes.txt", b"not a raw object")
    whole, split = both_readings(spark, root)
    assert split.rdd.getNumPartitions() > 10
    assert whole.count() == split.count() == 20_000
    assert whole.exceptAll(split).count() == 0


def test_quoted_line_breaks_across_splits(spark, tmp_path, small_splits):
    """Fields with line breaks, long enough that blocks of the file begin inside them."""
    root = str(tmp_path)
    place = '"' + "地\r\n\r\n点,\n" * 400 + 'x ""y"" z"'
    rows = [(f"{i:05d}", "", time_parts(DAY), [f"{i}.5", "8"]) for i in range(300)]
    text = csv_text("precipitation", rows, 13)
    lines = text.split("\r\n")
    for i in range(10, 290, 7):
        lines[i] = lines[i].replace("地点", place, 1)
    write(f"{root}/20260913/precipitation.csv", "\r\n".join(lines).encode("shift_jis"))
    write(f"{root}/20260913/max_gust.csv", csv_text("max_gust", rows_of("max_gust", measured("max_gust", 1.0)), 13).encode("shift_jis"))
    whole, split = both_readings(spark, root)
    assert whole.where("source = 'precipitation'").count() == 300
    assert whole.exceptAll(split).count() == 0 and split.exceptAll(whole).count() == 0


def test_a_line_break_in_a_wanted_field_is_kept(spark, tmp_path):
    root = str(tmp_path)
    text = csv_text("max_wind", rows_of("max_wind", ("3.0", "8", '"北\r\n西"', "4", "1")), 13)
    write(f"{root}/20260913/max_wind.csv", text.encode("shift_jis"))
    assert [df.first()["direction"] for df in both_readings(spark, root)] == ["北\n西"] * 2


@pytest.mark.parametrize("change", CHANGES, ids=range(len(CHANGES)))
def test_both_readings_agree_on_broken_files(spark, tmp_path, change):
    """The same rows or the same failures, as errors and as messages."""
    root = str(tmp_path)
    text = csv_text("precipitation", rows_of("precipitation", ("1.5", "8"), ("2.5", "4")), 13)
    changed = change(text)
    write(f"{root}/20260913/precipitation.csv", changed if isinstance(changed, bytes) else changed.encode("shift_jis"))

    def outcome(rows):
        cleaned = clean.clean_measurements(rows)
        return sorted(map(repr, map(tuple, cleaned.select("station_id", "value", "failure").collect())))

    whole = outcome(clean.landed_measurement_rows(file_payloads(spark, root), "failure"))
    split = outcome(clean.measurement_file_rows(spark, root, failure="failure"))
    assert whole == split
    failing = any(not row.endswith("None)") for row in whole)
    for strict in both_readings(spark, root):
        if failing:
            with pytest.raises(Exception):
                strict.collect()
        else:
            assert strict.count() == len(whole)


def test_long_table_is_the_inverse_of_cleaned_tables(spark):
    files = [(f"{n}.csv", csv_text(n, rows_of(n, measured(n, 1.0)), 13)) for n in HEADERS]
    table = cleaned(spark, *files)
    again = clean.long_table({m.name: clean.cleaned_table(table, m.name) for m in MEASUREMENTS})
    assert table.drop("observed_text").exceptAll(again.drop("observed_text")).count() == 0
    with pytest.raises(ValueError, match="max_gust"):
        clean.long_table({m.name: table for m in MEASUREMENTS[:-1]})


def test_landing_keeps_bytes_and_describes_them(spark, tmp_path):
    incoming, table = str(tmp_path / "in"), str(tmp_path / "landing")
    payload = "観測所番号\r\n".encode("shift_jis") + bytes(range(256))
    write(f"{incoming}/20260913/max_wind.csv", payload)
    write(f"{incoming}/20260913/pollen.json", b"{}")
    write(f"{incoming}/20260913/other.csv", b"x")
    write(f"{incoming}/unknown/max_wind.csv", b"x")
    stamp = dt.datetime(2026, 9, 13, 5, tzinfo=dt.timezone.utc)

    manifest = L.write_landing(L.landing_rows(spark, incoming, stamp), table)

    assert {r.object_key for r in manifest.collect()} == {"20260913/max_wind.csv", "20260913/pollen.json"}
    rows = {r.filename: r for r in L.read_landing(spark, table).collect()}
    wind = rows["max_wind.csv"]
    assert bytes(wind.content) == payload and wind.size == len(payload)
    assert wind.sha256 == hashlib.sha256(payload).hexdigest() and wind.source_url.endswith("mxwsp00_rct.csv")
    assert wind.content_type == "text/csv" and rows["pollen.json"].content_type == "application/json"
    assert rows["pollen.json"].source_url is None


def test_landing_a_day_again_replaces_that_object_only(spark, tmp_path):
    incoming, table = str(tmp_path / "in"), str(tmp_path / "landing")
    for day in ("20260913", "20260914"):
        for name in ("max_wind.csv", "max_gust.csv"):
            write(f"{incoming}/{day}/{name}", b"old")
    L.write_landing(L.landing_rows(spark, incoming), table)
    write(f"{tmp_path}/new/20260914/max_wind.csv", b"new")
    L.write_landing(L.landing_rows(spark, str(tmp_path / "new")), table)
    kept = {r.object_key: bytes(r.content) for r in L.read_landing(spark, table).collect()}
    assert kept.pop("20260914/max_wind.csv") == b"new"
    assert len(kept) == 3 and set(kept.values()) == {b"old"}


def test_verification_finds_changed_bytes(spark, tmp_path):
    rows = L.landing_rows(spark, write_day(tmp_path)).withColumn("sha256", F.lit("0" * 64))
    with pytest.raises(RuntimeError, match="do not match"):
        L.write_landing(rows, str(tmp_path / "landing"))


def write_day(tmp_path):
    write(f"{tmp_path}/in/20260913/max_wind.csv", b"x")
    return str(tmp_path / "in")


def test_snapshots_are_selected_by_date_and_default_to_today(spark, tmp_path):
    incoming = str(tmp_path / "in")
    days = [L.today(), dt.date(2026, 9, 13)]
    for day in days:
        write(f"{incoming}/{day:%Y%m%d}/max_wind.csv", b"x")
    files = file_payloads(spark, incoming)
    assert [r.snapshot_date for r in L.select_snapshots(files).collect()] == [days[0]]
    assert [r.snapshot_date for r in L.select_snapshots(files, days[1:]).collect()] == [days[1]]


def test_completeness_names_missing_objects(spark):
    landed = spark.createDataFrame([(DAY, m.filename) for m in MEASUREMENTS], "snapshot_date date, filename string")
    expected = L.expected_objects(spark, [DAY])
    assert [r.filename for r in L.missing_objects(expected, landed).collect()] == ["pollen.json"]
    with pytest.raises(MissingRawObjects, match="20260913/pollen.json"):
        L.require_objects(expected, landed)


def test_master_columns_by_header(spark, tmp_path):
    from stationday.operators.stations import read_station_master

    path = write_master(str(tmp_path / "m.csv"), [["1", " 東京①", "35", "41.5", "139", ""]])
    row = read_station_master(spark, path).first()
    assert (row.station_name, row.latitude_minutes, row.longitude_minutes) == ("東京①", "41.5", None)
    bad = write(str(tmp_path / "bad.csv"), "観測所番号,観測所名\r\n1,x\r\n".encode("cp932"))
    with pytest.raises(ValueError, match="Missing required station master columns.*緯度"):
        read_station_master(spark, bad)


def test_payload_rows_keep_other_columns_and_places(spark):
    found = payload_rows(payloads(spark, [("f.csv", "a,b\r\n1,2\r\n\r\n3,4")]), "Shift_JIS", {"x": "b"}).collect()
    assert [(r.filename, r.row_no, r.x) for r in found] == [("f.csv", 1, "2"), ("f.csv", 3, "4")]
