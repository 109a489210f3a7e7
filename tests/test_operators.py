import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fixtures import envelope, result
from stationday.operators import clean
from stationday.operators.conditions import daily_weather_conditions, key_mismatches, require_matching
from stationday.operators.joins import broadcast_if_small, duplicate_keys, keys_without_match
from stationday.errors import DataQualityError
from stationday.operators.merge import daily_weather, extended_codes, full_merge, measure_columns, wide_rows
from stationday.operators.quality import (
    assert_checks,
    expected_groups,
    key_check,
    pollen_value_check,
    source_times,
)
from stationday.operators.responses import require_expected_dates
from stationday.operators.stations import wmo_stations
from stationday.schemas import (
    CONDITIONS_SCHEMA,
    DAILY_WEATHER_SCHEMA,
    LONG_SCHEMA,
    MEASUREMENTS,
    POLLEN_SCHEMA,
    STATION_SCHEMA,
)

DAY, NEXT = dt.date(2026, 9, 13), dt.date(2026, 9, 14)
HOUR = {h: dt.datetime(2026, 9, 13, h - 9, tzinfo=dt.timezone.utc) for h in (13, 14, 15)}


def info(value, *plants):
    return {"value": value, "plants": [{"code": c, "value": v} for c, v in plants]}


def pollen_rows(spark, *results, day=DAY):
    content = bytearray(envelope(list(results)).encode())
    return clean.clean_pollen(spark.createDataFrame([(day, content)], "snapshot_date date, content binary"))


def groups(row):
    return [None if g is None else g.asDict(recursive=True) for g in (row.grass_info, row.tree_info, row.weed_info)]


@pytest.mark.parametrize(
    ("types", "plants", "expected"),
    [
        (
            [("TREE", 4)],
            [("CYPRESS_PINE", "TREE", 4), ("ALDER", "TREE", 2)],
            [None, info(4, ("ALDER", 2), ("CYPRESS_PINE", 4)), None],
        ),
        ([("GRASS", None)], [("GRAMINALES", "GRASS", None)], [info(None, ("GRAMINALES", None)), None, None]),
        ([("WEED", 1)], [], [None, None, info(1)]),
        ([], [("OAK", "TREE", 3)], [None, info(None, ("OAK", 3)), None]),
        (
            [("POLLEN_TYPE_UNSPECIFIED", 1), ("MOLD", 2), ("MOLD", 2)],
            [("PLANT_UNSPECIFIED", "TREE", 1), ("ROSE", "TREE", 1), ("ROSE", "TREE", 1)],
            [None, None, None],
        ),
        ([("TREE", 1)], [("OAK", None, 3)], [None, info(1), None]),
    ],
)
def test_pollen_groups(spark, types, plants, expected):
    assert groups(pollen_rows(spark, result("A", DAY, types, plants)).first()) == expected


def test_pollen_schema_and_order_of_stations(spark):
    table = pollen_rows(spark, result("B", DAY), result("A", DAY))
    assert [(f.name, f.dataType) for f in table.drop("snapshot_date").schema] == [
        (f.name, f.dataType) for f in POLLEN_SCHEMA
    ]
    assert [(r.station_id, r.date) for r in table.orderBy("station_id").collect()] == [("A", DAY), ("B", DAY)]


def broken(**changes):
    entry = result("A", DAY, [("TREE", 1)])
    entry["response"].update(changes)
    return entry


@pytest.mark.parametrize(
    ("entry", "message"),
    [
        (broken(dailyInfo=None), "exactly one pollen forecast day for station A"),
        (broken(dailyInfo=[]), "exactly one pollen forecast day for station A"),
        (result("A", DAY, days=2), "exactly one pollen forecast day for station A"),
        (result("A", DAY, [("TREE", 1), ("TREE", 1)]), "Duplicate pollen type for station A"),
        (result("A", DAY, [], [("OAK", "TREE", 1), ("OAK", "WEED", 2)]), "Duplicate plant for station A"),
        (result("A", DAY, [("TREE", 4.5)]), "MALFORMED_RECORD"),
        (broken(dailyInfo="none"), "MALFORMED_RECORD"),
    ],
)
def test_broken_pollen_responses_are_errors(spark, entry, message):
    with pytest.raises(Exception, match=message):
        pollen_rows(spark, entry).collect()


@pytest.mark.parametrize("text", ["[]", "{}", '{"results": null}', '{"results": 5}', "null", '{"results": ['])
def test_pollen_payload_must_be_an_object_with_results(spark, text):
    payload = spark.createDataFrame([(DAY, bytearray(text.encode()))], "snapshot_date date, content binary")
    with pytest.raises(Exception, match="results list|MALFORMED_RECORD"):
        clean.clean_pollen(payload).collect()


def test_pollen_value_check(spark):
    good = pollen_rows(spark, result("A", DAY, [("TREE", 0), ("WEED", 5), ("GRASS", None)], [("OAK", "TREE", 5)]))
    bad = pollen_rows(
        spark, result("A", DAY, [("TREE", -1), ("WEED", 6)], [("OAK", "TREE", 6)]), result("B", DAY), day=NEXT
    )
    both = pollen_value_check(good.unionByName(bad), ["snapshot_date"]).orderBy("snapshot_date").collect()
    assert [tuple(r) for r in both] == [(DAY, 0, 0, True), (NEXT, 2, 1, False)]
    with pytest.raises(ValueError, match="invalid_pollen_value_count': 2"):
        assert_checks(pollen_value_check(bad, ["snapshot_date"]), "valid_pollen_values")


def responses(spark, *entries):
    rows = [(DAY, e["station_id"], 35.0, 139.0, json.dumps(e["response"], ensure_ascii=False)) for e in entries]
    return spark.createDataFrame(
        rows, "snapshot_date date, station_id string, latitude double, longitude double, response string"
    )


def test_responses_of_another_date_are_refused(spark):
    require_expected_dates(responses(spark, result("A", DAY)))
    undated = result("C", DAY)
    del undated["response"]["dailyInfo"][0]["date"]
    with pytest.raises(ValueError, match=r"Unexpected pollen forecast date for stations: \['B', 'C'\]"):
        require_expected_dates(responses(spark, result("A", DAY), result("B", NEXT), undated))


# --- the long table and the merge


def long(spark, *rows):
    """Rows are ``(source, station, wmo, value, day, hour)`` with defaults for the last two."""
    full = []
    for source, station, wmo, value, *rest in rows:
        day, hour = (*rest, *(DAY, 14)[len(rest) :])
        full.append((day, source, station, wmo, day, HOUR[hour], value, 8, None, None, "t"))
    return spark.createDataFrame(full, LONG_SCHEMA)


ALL = [m.name for m in MEASUREMENTS]


def test_merge_keeps_stations_of_any_source(spark):
    rows = [(s, "A", "1", 1.5) for s in ALL[1:]] + [("precipitation", "B", "2", 0.0)]
    weather = daily_weather(long(spark, *rows)).drop("snapshot_date")
    assert [(f.name, f.dataType) for f in weather.schema] == [(f.name, f.dataType) for f in DAILY_WEATHER_SCHEMA]
    first, second = weather.orderBy("station_id").collect()
    assert (first.station_id, first.precipitation_mm, first.max_gust_speed_ms) == ("A", None, 1.5)
    assert (second.station_id, second.precipitation_mm, second.max_gust_speed_ms) == ("B", 0.0, None)


def test_merge_equals_a_chain_of_full_joins(spark):
    rows = [(s, f"{i % 7}", "x", float(i)) for i, s in enumerate(ALL * 3)]
    table = long(spark, *dict.fromkeys((s, st, w, 1.0) for s, st, w, _ in rows))
    keys = ["station_id", "wmo_station_id", "date"]
    frames = [clean.cleaned_table(table, n).drop("snapshot_date", "observed_at") for n in ALL]
    joined = frames[0]
    for frame in frames[1:]:
        joined = joined.join(frame, keys, "full")
    merged = full_merge(table, keys, measure_columns()).select(*joined.columns)
    assert merged.exceptAll(joined).count() == 0 and merged.count() == joined.count()


def test_merge_by_codes_keeps_every_text(spark, tmp_path):
    """More texts than any list would hold; the table of codes grows by what it lacks."""
    stations = [f"{i:04}" for i in range(600)]
    table = long(spark, *((s, st, "x", 1.0) for s in ("max_wind", "max_gust") for st in stations)).withColumn(
        "direction", F.when(F.col("station_id") != "0007", F.concat("station_id", F.lit("北")))
    )
    path = str(tmp_path / "codes")
    few = extended_codes(table.where("station_id < '0300'"), path)
    assert few.count() == 299
    codes = extended_codes(table, path)
    assert codes.count() == 599 and extended_codes(table, path).count() == 599
    merged = wide_rows(table, codes)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    rows = {r.station_id: (r.max_wind_direction, r.max_gust_direction) for r in merged.collect()}
    assert rows == {st: (None, None) if st == "0007" else (f"{st}北",) * 2 for st in stations}
    assert merged.exceptAll(wide_rows(table)).count() == 0
    spark.createDataFrame([(codes.first()["code"], "another")], "code long, text string").write.mode("append").parquet(path)
    with pytest.raises(DataQualityError, match="several texts"):
        extended_codes(table, path)


def test_rows_without_wmo_id_are_left_out_but_count_for_time_and_date(spark):
    rows = [(s, "A", "1", 1.0, DAY, 15) for s in ALL]
    table = long(spark, *rows, ("max_temperature", "B", None, 2.0, DAY, 14))
    (row,) = daily_weather(table).collect()
    assert row.station_id == "A"
    assert wide_rows(table).select(F.unix_timestamp("observed_at")).first()[0] == int(HOUR[14].timestamp())
    other = long(spark, ("max_wind", "C", None, 1.0, NEXT)).withColumn("snapshot_date", F.lit(DAY))
    with pytest.raises(ValueError, match="one shared observation date"):
        daily_weather(table.unionByName(other))


def test_conflicting_wmo_ids(spark):
    table = long(spark, ("precipitation", "A", "1", 1.0), ("max_wind", "A", "2", 1.0), ("max_wind", "B", "3", 1.0))
    with pytest.raises(ValueError, match=r"Conflicting WMO station ids for station ids: \['A'\]"):
        daily_weather(table)


def test_source_times(spark):
    hours = dict(zip(ALL, (15, 15, 14, 15, 15)))
    row = source_times(long(spark, *((s, "A", "1", 1.0, DAY, h) for s, h in hours.items()))).first()
    assert row.observed_at == row.min_temperature_observed_at < row.newest_observed_at == row.max_wind_observed_at
    assert row.differs


def check(spark, df, **options):
    rows = key_check(df, ["snapshot_date", "source"], **options).orderBy("snapshot_date", "source").collect()
    names = ("null_key_row_count", "duplicate_key_count", "date_count", "observed_at_count", "passed")
    return [(r.source, *(r[n] for n in names)) for r in rows]


def test_key_check(spark):
    table = long(
        spark,
        ("precipitation", "A", None, 1.0),
        ("precipitation", "B", None, 1.0),
        ("max_wind", "A", None, 1.0),
        ("max_wind", "A", None, 2.0),
        ("max_gust", None, None, 1.0),
        ("max_gust", "A", None, 1.0, DAY, 15),
    )
    assert check(spark, table) == [
        ("max_gust", 1, 0, 1, 2, False),
        ("max_wind", 0, 1, 1, 1, False),
        ("precipitation", 0, 0, 1, 1, True),
    ]


def test_key_check_of_null_times_and_without_time(spark):
    table = long(spark, ("max_wind", "A", None, 1.0), ("max_wind", "B", None, 1.0))
    no_time = table.withColumn("observed_at", F.when(F.col("station_id") == "A", F.col("observed_at")))
    assert check(spark, no_time) == [("max_wind", 1, 0, 1, 1, False)]
    assert check(spark, table.drop("observed_at")) == [("max_wind", 0, 0, 1, 1, True)]


def test_key_check_of_a_source_without_rows_fails(spark):
    table = long(spark, ("max_wind", "A", None, 1.0))
    found = check(spark, table, expected=expected_groups(spark, [DAY], ("max_wind", "max_gust")))
    assert found == [("max_gust", 0, 0, 0, 0, False), ("max_wind", 0, 0, 1, 1, True)]


def test_one_bad_day_among_good_ones_is_named(spark):
    table = long(spark, ("max_wind", "A", None, 1.0), ("max_wind", "A", None, 1.0, NEXT), ("max_wind", "A", None, 2.0, NEXT))
    with pytest.raises(ValueError, match="valid_daily_weather_key") as caught:
        assert_checks(key_check(table, ["snapshot_date", "source"]), "valid_daily_weather_key")
    assert [f["snapshot_date"] for f in caught.value.failures] == [NEXT]


# --- stations and conditions


def weather(spark, *stations, day=DAY):
    return wide_rows(long(spark, *((s, st, f"W{st}", 1.5, day) for s in ALL for st in stations)))


MASTER = "place int, station_id string, station_name string, latitude_degrees string, latitude_minutes string, longitude_degrees string, longitude_minutes string"
ALPHA = ("A", "Ume", "37", "24.6", "138", "15.0")


def master(spark, *rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], MASTER)


def test_stations_in_use_with_coordinates(spark):
    unused = [("Z", "Zulu", "1", "1", "1", "1")] * 2
    found = wmo_stations(weather(spark, "A"), master(spark, ALPHA, *unused))
    assert [(f.name, f.dataType) for f in found.table.schema] == [(f.name, f.dataType) for f in STATION_SCHEMA]
    (row,) = found.table.collect()
    assert (row.station_id, row.wmo_station_id, row.station_name) == ("A", "WA", "Ume")
    assert (row.latitude, row.longitude) == (pytest.approx(37.41), pytest.approx(138.25))
    assert found.duplicate_ids == [] and found.duplicate_count == 0


def test_first_of_duplicate_master_rows_is_used_and_reported(spark, caplog):
    later = ("A", "Other", "1", "1", "1", "1")
    found = wmo_stations(weather(spark, "A"), master(spark, ALPHA, later, later))
    assert [r.station_name for r in found.table.collect()] == ["Ume"]
    assert found.duplicate_ids == ["A"] and "Duplicate station master rows" in caplog.text


@pytest.mark.parametrize(
    ("row", "message"),
    [
        (("Z", "Zulu", "1", "1", "1", "1"), r"Missing station master rows for station ids: \['A'\]"),
        (("A", None, "1", "1", "1", "1"), r"Invalid required station master fields for station ids: \['A'\]"),
        (("A", "Alpha", "invalid", "1", "1", "1"), r"Invalid required station master fields for station ids: \['A'\]"),
        (("A", "Alpha", "1", "1", "1", None), r"Invalid required station master fields for station ids: \['A'\]"),
    ],
)
def test_unusable_master_rows(spark, row, message):
    with pytest.raises(ValueError, match=message):
        wmo_stations(weather(spark, "A"), master(spark, row))


def inputs(spark, *stations, day=DAY):
    rows = [(s, f"W{s}", f"Name {s}", 35.0, 139.0) for s in stations]
    return (
        weather(spark, *stations, day=day),
        spark.createDataFrame(rows, STATION_SCHEMA),
        pollen_rows(spark, *(result(s, day, [("TREE", 4)]) for s in stations), day=day),
    )


def test_conditions_join_one_to_one(spark):
    joined = daily_weather_conditions(*inputs(spark, "A", "B"))
    assert [(f.name, f.dataType) for f in joined.schema] == [(f.name, f.dataType) for f in CONDITIONS_SCHEMA]
    rows = joined.orderBy("station_id").collect()
    assert [(r.station_id, r.station_name, r.tree_info.value) for r in rows] == [("A", "Name A", 4), ("B", "Name B", 4)]


def test_conditions_reject_other_stations_dates_and_duplicates(spark):
    good, other, later = inputs(spark, "A"), inputs(spark, "B"), inputs(spark, "A", day=NEXT)
    for wrong in (
        (good[0], good[1], other[2]),
        (good[0], other[1], good[2]),
        (good[0], good[1], later[2]),
        (good[0], good[1], good[2].unionAll(good[2])),
        (good[0], good[1].unionAll(other[1]), good[2]),
    ):
        with pytest.raises(ValueError, match="do not match"):
            require_matching(*wrong)
    with pytest.raises(ValueError, match="not unique"):
        require_matching(good[0], good[1].unionAll(good[1]), good[2])


def test_conditions_cannot_be_empty(spark):
    with pytest.raises(ValueError, match="cannot be empty"):
        require_matching(*(df.limit(0) for df in inputs(spark, "A")))


def test_key_helpers(spark):
    left = spark.createDataFrame([("A", 1), ("A", 1), ("B", 1)], "k string, n int")
    right = spark.createDataFrame([("B", 1)], "k string, n int")
    assert [tuple(r) for r in duplicate_keys(left, ["k"]).collect()] == [("A", 2)]
    assert [tuple(r) for r in key_mismatches(left, right, ["k"]).collect()] == [("A", 2, 0)]
    assert [tuple(r) for r in keys_without_match(left, right, ["k"]).collect()] == [("A",)]


def test_broadcast_hint_depends_on_the_count(spark):
    big, small = spark.range(10), spark.range(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [
            big.join(broadcast_if_small(small, max_rows=n), "id")._jdf.queryExecution().executedPlan().toString()
            for n in (3, 2)
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ["BroadcastHashJoin" in p for p in plans] == [True, False]
