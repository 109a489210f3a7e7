"""Nearest stations of many points against a comparison of all with all."""

import datetime as dt
import glob
import math
import os
import random

import pytest

from stationday.errors import DataQualityError
from stationday.functions.geo import EARTH_RADIUS_KM
from stationday.plans.queries import nearest_to_points

DAY, LATER = dt.date(2025, 3, 8), dt.date(2025, 3, 9)
STATIONS = "date date, station_id string, latitude double, longitude double, note string"
POINTS = "point_id long, date date, latitude double, longitude double"


def km(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(math.sqrt(min(h, 1)))


def brute(stations, points):
    out = []
    for key, day, lat, lon in points:
        near = [(round(km(lat, lon, s[2], s[3]), 6), s[1]) for s in stations if s[0] == day and s[2] is not None and s[3] is not None]
        if near:
            out.append((key, day, *min(near)[::-1]))
    return sorted(out)


def found(spark, stations, points, date=None):
    rows = nearest_to_points(spark.createDataFrame(stations, STATIONS), spark.createDataFrame(points, POINTS), date)
    return sorted((r["point_id"], r["date"], r["station_id"], round(r["distance_km"], 6)) for r in rows.collect())


def test_poles_the_180th_meridian_and_clusters(spark):
    rng = random.Random(1)
    places = [(90.0, 0.0), (-90.0, 50.0), (0.1, 179.9), (0.1, -179.8), (60.0, 180.0), (59.9, -180.0)]
    places += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(150)]
    places += [(35 + rng.uniform(0, 0.01), 139 + rng.uniform(0, 0.01)) for _ in range(150)]
    stations = [(DAY if i % 3 else LATER, f"s{i:04}", *p, "x") for i, p in enumerate(places)]
    stations += [(DAY, "n1", None, 3.0, "x"), (DAY, "n2", 3.0, None, "x")]
    spots = [(89.99, 120.0), (-89.999, -70.0), (0.1, 180.0), (0.1, -180.0), (60.0, -179.95), (35.005, 139.005), (-35.0, -41.0)]
    spots += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(200)]
    points = [(i, DAY if i % 2 else LATER, *p) for i, p in enumerate(spots * 2)]
    assert found(spark, stations, points) == brute(stations, points)


def test_ties_go_to_the_first_station_and_days_without_stations_give_no_row(spark):
    stations = [(DAY, "b", 10.0, 20.0, "x"), (DAY, "a", 10.0, 20.0, "x"), (DAY, "c", -10.0, 20.0, "x")]
    points = [(1, DAY, 0.0, 20.0), (1, DAY, 0.0, 20.0), (2, LATER, 0.0, 20.0), (3, DAY, 10.0, 20.0)]
    assert [(k, s) for k, _, s, _ in found(spark, stations, points)] == [(1, "a"), (1, "a"), (3, "a")]


def test_a_thousand_stations_in_one_spot(spark):
    stations = [(DAY, f"s{i:04}", 35.0, 139.0, "x") for i in range(1000)]
    points = [(i, DAY, 35.0, 139.0 + i / 1000) for i in range(100)]
    assert {s for _, _, s, _ in found(spark, stations, points)} == {"s0000"}


def test_one_day_and_no_rows(spark):
    stations = [(DAY, "a", 10.0, 20.0, "x"), (LATER, "b", 0.0, 20.0, "x")]
    points = spark.createDataFrame([(7, 0.0, 21.0)], "point_id long, latitude double, longitude double")
    rows = nearest_to_points(spark.createDataFrame(stations, STATIONS), points, DAY)
    assert rows.columns == ["point_id", "point_latitude", "point_longitude", "date", "station_id", "latitude", "longitude", "note", "distance_km"]
    assert [(r["point_id"], r["station_id"], r["latitude"], r["point_latitude"]) for r in rows.collect()] == [(7, "a", 10.0, 0.0)]
    assert found(spark, [], [(1, DAY, 0.0, 0.0)]) == [] and found(spark, stations, []) == []


@pytest.mark.parametrize("latitude, longitude", [(90.1, 0.0), (0.0, -180.5), (None, 0.0), (math.nan, 0.0), (0.0, None)])
def test_points_out_of_range_are_an_error_without_stations_too(spark, latitude, longitude):
    with pytest.raises(DataQualityError, match="point"):
        found(spark, [], [(1, DAY, 1.0, 1.0), (2, DAY, latitude, longitude)])


def test_no_join_compares_all_with_all(spark):
    stations = spark.createDataFrame([(DAY, f"s{i}", i / 10, i / 7, "x") for i in range(300)], STATIONS)
    points = spark.createDataFrame([(i, DAY, i / 20, i / 9) for i in range(300)], POINTS)
    rows = nearest_to_points(stations, points)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_points_that_lie_together_share_the_search(spark):
    rng = random.Random(2)
    stations = [(DAY, f"s{i:04}", rng.uniform(-90, 90), rng.uniform(-180, 180), "x") for i in range(2000)]
    stations += [(DAY, f"c{i:04}", 35 + rng.uniform(0, 0.01), 139 + rng.uniform(0, 0.01), "x") for i in range(500)]
    points = [(i, DAY, 48 + rng.uniform(0, 0.1), 11 + rng.uniform(0, 0.1)) for i in range(3000)]
    points += [(3000 + i, DAY, 35.005 + i / 100, 139.005) for i in range(50)]
    rows = nearest_to_points(spark.createDataFrame(stations, STATIONS), spark.createDataFrame(points, POINTS))
    assert "Window" not in rows._jdf.queryExecution().executedPlan().toString()
    some = [p for p in points if p[0] % 40 == 0 or p[0] >= 3000]
    got = {r["point_id"]: (r["date"], r["station_id"], round(r["distance_km"], 6)) for r in rows.collect()}
    assert len(got) == len(points)
    assert [(p[0], *got[p[0]]) for p in some] == brute(stations, some)
    folders = sorted(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/blocks-*"), key=os.path.getmtime)
    assert spark.read.parquet(folders[-1]).count() < 100
