"""Daily weather, stations and pollen joined one to one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.errors import DataQualityError
from stationday.operators.joins import broadcast_if_small, duplicate_keys, raise_if_any
from stationday.schemas import CONDITIONS_SCHEMA

MISMATCH = "Daily weather condition station ids or dates do not match"


def key_mismatches(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that do not occur exactly once on both sides, with their counts.

    Only keys are shuffled, and counted map-side first, so a key given many times is no hot spot.
    """
    sides = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counted = sides.groupBy(*keys).agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))
    return counted.where("left_rows <> 1 OR right_rows <> 1")


def require_matching(weather: DataFrame, stations: DataFrame, pollen: DataFrame) -> None:
    """The three inputs cover the same stations and days, each once, and there is something."""
    if weather.isEmpty() and stations.isEmpty() and pollen.isEmpty():
        raise DataQualityError("Daily weather conditions cannot be empty")
    station_keys = ["station_id", "wmo_station_id"]
    raise_if_any(duplicate_keys(stations, station_keys), "station_id", "Stations are not unique")
    raise_if_any(key_mismatches(weather, pollen, ["station_id", "date"]), "station_id", MISMATCH)
    used = weather.select(*station_keys).distinct()
    raise_if_any(key_mismatches(used, stations, station_keys), "station_id", MISMATCH)


def mismatched_snapshots(weather: DataFrame, pollen: DataFrame) -> DataFrame:
    """``snapshot_date, station_id`` of stations that weather and pollen do not have once each on a date."""
    keys = ["station_id", "date"]
    wrong = key_mismatches(weather, pollen, keys).select(*keys)
    rows = weather.select("snapshot_date", *keys).unionByName(pollen.select("snapshot_date", *keys))
    return rows.join(wrong, keys).select("snapshot_date", "station_id")


def join_conditions(weather: DataFrame, stations: DataFrame, pollen: DataFrame) -> DataFrame:
    """Inner joins on the unique keys, in the published column order.

    The dimension is broadcast only if it is small. The pollen join is keyed by station and day,
    which is unique on both sides, so no day, however large, meets in one task.
    """
    joined = weather.drop("snapshot_date").join(broadcast_if_small(stations), ["station_id", "wmo_station_id"])
    joined = joined.join(pollen.drop("snapshot_date"), ["station_id", "date"])
    return joined.select(*(F.col(f.name).cast(f.dataType) for f in CONDITIONS_SCHEMA))


def daily_weather_conditions(weather: DataFrame, stations: DataFrame, pollen: DataFrame) -> DataFrame:
    """``join_conditions`` after ``require_matching``; the check is an action, the result lazy."""
    require_matching(weather, stations, pollen)
    return join_conditions(weather, stations, pollen)
