"""The query surface in SQL: a view over all snapshots and one table function per query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationday.functions.geo import EARTH_RADIUS_KM
from stationday.plans.queries import SUMMARY
from stationday.sources.published import read_published

VIEW = "weather_conditions"

EXTREMES = {
    "hottest": ("max", "max_temperature_c"),
    "coldest": ("min", "min_temperature_c"),
    "highest_precipitation": ("max", "precipitation_mm"),
    "strongest_gust": ("max", "max_gust_speed_ms"),
}


def _extreme(pick: str, measure: str) -> str:
    return f"""
        SELECT w.* FROM {VIEW} w
        JOIN (SELECT {pick}({measure}) AS bound FROM {VIEW} WHERE date = p_date) e
          ON w.{measure} = e.bound
        WHERE w.date = p_date
        ORDER BY w.station_id"""


def _summary() -> str:
    """Numbers first, in one scan; names for the rows at the extremes only. Rows without a name cannot be named."""
    pick = {s: "max" if s.largest else "min" for s in SUMMARY}
    values = ", ".join(
        f"{pick[s]}({s.measure}) AS {s.value}, {pick[s]}(CASE WHEN station_name IS NOT NULL THEN {s.measure} END) AS bound_{s.value}"
        for s in SUMMARY
    )
    names = ", ".join(
        f"min_by(CASE WHEN {s.measure} = bound_{s.value} THEN station_name END, "
        f"CASE WHEN {s.measure} = bound_{s.value} AND station_name IS NOT NULL THEN struct(station_id) END) AS {s.name}"
        for s in SUMMARY
    )
    hits = " OR ".join(f"{s.measure} = bound_{s.value}" for s in SUMMARY)
    nameless = " AND ".join(f"bound_{s.value} IS NULL" for s in SUMMARY)
    outputs = ", ".join(f"{s.name}, {s.value}" for s in SUMMARY)
    kept = ", ".join(f"max({s.value}) AS {s.value}" for s in SUMMARY)
    measures = ", ".join(dict.fromkeys(s.measure for s in SUMMARY))
    return f"""
        SELECT date, observed_at, {outputs} FROM (
          SELECT date, max(observed_at) AS observed_at, {kept}, {names}
          FROM (SELECT date AS day, max(observed_at) AS observed_at, {values} FROM {VIEW} WHERE date = p_date GROUP BY date)
          JOIN (SELECT date, station_id, station_name, {measures} FROM {VIEW} WHERE date = p_date)
            ON date = day AND (({hits}) AND station_name IS NOT NULL OR {nameless})
          GROUP BY date)"""


def _checked(argument: str, name: str, limit: int) -> str:
    return (
        f"CASE WHEN {argument} BETWEEN -{limit} AND {limit} THEN {argument} "
        f"ELSE raise_error('{name} must be between -{limit} and {limit}') END"
    )


def _nearest(columns: list[str]) -> str:
    # the day's rows are aggregated to one row, which there is on an empty day too: the arguments are checked on it
    names = ", ".join(f"`{c}`" for c in [*columns, "distance_km"])
    return f"""
        SELECT inline(CASE WHEN at_lat IS NULL OR at_lon IS NULL OR nearest IS NULL THEN array() ELSE array(nearest) END) AS ({names})
        FROM (
          SELECT {_checked('p_latitude', 'latitude', 90)} AS at_lat,
                 {_checked('p_longitude', 'longitude', 180)} AS at_lon,
                 min_by(struct(*), struct(distance_km, station_id)) AS nearest
          FROM (
            SELECT *, 2 * {EARTH_RADIUS_KM}D * asin(sqrt(least(1D,
              pow(sin((radians(latitude) - radians(p_latitude)) / 2), 2)
              + cos(radians(p_latitude)) * cos(radians(latitude))
                * pow(sin((radians(longitude) - radians(p_longitude)) / 2), 2)))) AS distance_km
            FROM {VIEW}
            WHERE date = p_date AND latitude IS NOT NULL AND longitude IS NOT NULL))"""


def register_view(conditions: DataFrame) -> None:
    """Make ``weather_conditions`` and the seven table functions over a table in the session."""
    spark = conditions.sparkSession
    conditions.createOrReplaceTempView(VIEW)
    bodies = {
        "all_weather_conditions": f"SELECT * FROM {VIEW} WHERE date = p_date ORDER BY station_id",
        **{name: _extreme(*spec) for name, spec in EXTREMES.items()},
        "daily_summary": _summary(),
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(p_date DATE) RETURNS TABLE RETURN {body}")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION "
        "nearest_stations(p_date DATE, p_latitude DOUBLE, p_longitude DOUBLE) "
        f"RETURNS TABLE RETURN {_nearest(conditions.columns)}"
    )


def register(spark: SparkSession, root: str) -> None:
    """``register_view`` over everything published below ``root``, columns beyond the declared ones included."""
    register_view(read_published(spark, root, undeclared=True))


def fetch(spark: SparkSession, text: str, rows: int | None = None) -> DataFrame:
    """An ad-hoc query, whole or its first ``rows`` in its order; ``.show(vertical=True)`` prints them."""
    found = spark.sql(text)
    return found if rows is None else found.limit(rows)
