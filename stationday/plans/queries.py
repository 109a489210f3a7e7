"""The query surface over the published table.

Each query takes the table and a date; without a date it answers for every day at once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.functions.geo import check_coordinates, distance_km
from stationday.operators.extremes import Named, extreme_rows, named_extremes
from stationday.operators.joins import per_date
from stationday.operators.nearest import nearest_to_points as _nearest_to_points

SUMMARY = (
    Named("max_temperature_c", True, "highest_max_temperature_station_name", "highest_max_temperature_c"),
    Named("min_temperature_c", False, "lowest_min_temperature_station_name", "lowest_min_temperature_c"),
    Named("precipitation_mm", True, "maximum_precipitation_station_name", "maximum_precipitation_mm"),
    Named("max_gust_speed_ms", True, "strongest_gust_station_name", "strongest_gust_speed_ms"),
)


def on_date(conditions: DataFrame, date: dt.date | None) -> DataFrame:
    """Rows of one day; prunes the published table's partitions."""
    return conditions if date is None else conditions.where(F.col("date") == F.lit(date))


def _ordered(df: DataFrame, date: dt.date | None) -> DataFrame:
    """One day by station; all days stay in no order, as sorting them would shuffle the whole table."""
    return df if date is None else df.orderBy("station_id")


def all_weather_conditions(conditions: DataFrame, date: dt.date | None = None) -> DataFrame:
    return _ordered(on_date(conditions, date), date)


def hottest(conditions: DataFrame, date: dt.date | None = None) -> DataFrame:
    return _ordered(extreme_rows(on_date(conditions, date), "max_temperature_c"), date)


def coldest(conditions: DataFrame, date: dt.date | None = None) -> DataFrame:
    return _ordered(extreme_rows(on_date(conditions, date), "min_temperature_c", largest=False), date)


def highest_precipitation(conditions: DataFrame, date: dt.date | None = None) -> DataFrame:
    return _ordered(extreme_rows(on_date(conditions, date), "precipitation_mm"), date)


def strongest_gust(conditions: DataFrame, date: dt.date | None = None) -> DataFrame:
    return _ordered(extreme_rows(on_date(conditions, date), "max_gust_speed_ms"), date)


def nearest_stations(
    conditions: DataFrame, date: dt.date | None, latitude: float, longitude: float
) -> DataFrame:
    """The one station nearest to a point, with ``distance_km``; the first by id among equals.

    The arguments are checked before anything is read. Without a date: one station per day.
    """
    latitude, longitude = check_coordinates(latitude, longitude)
    located = (
        on_date(conditions, date)
        .where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .withColumn(
            "distance_km", distance_km(F.lit(latitude), F.lit(longitude), F.col("latitude"), F.col("longitude"))
        )
    )
    if date is not None:
        return located.orderBy("distance_km", "station_id").limit(1)
    # numbers are hash-aggregated; ids are looked at for the few stations at a day's least distance only
    least = located.groupBy(F.col("date").alias("_day")).agg(F.min("distance_km").alias("_least"))
    ties = located.join(per_date(least), (F.col("date") == F.col("_day")) & (F.col("distance_km") == F.col("_least")))
    first = F.min_by(F.struct(*located.columns), F.struct("station_id")).alias("first")
    return ties.groupBy(F.col("date").alias("_day")).agg(first).select("first.*")


def nearest_to_points(conditions: DataFrame, points: DataFrame, date: dt.date | None = None) -> DataFrame:
    """``nearest_stations`` for a table of points: ``point_id, latitude, longitude`` and, without ``date``, a ``date`` each."""
    if date is not None:
        points = points.withColumn("date", F.lit(date))
    return _nearest_to_points(on_date(conditions, date), points)


def daily_summary(conditions: DataFrame, date: dt.date | None = None) -> DataFrame:
    """One row per day, ten columns; a day without rows gives none."""
    return named_extremes(on_date(conditions, date), SUMMARY, latest="observed_at").orderBy("date")
