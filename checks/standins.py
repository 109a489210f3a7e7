"""Stand-in observations derived from the given tables.

``events`` has five event types over many days and users: a type is a measurement, a user is a
station, a day is a snapshot. ``customer`` describes the stations, ``supplier`` names those with a
WMO id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.functions.geo import decimal_degrees
from stationday.functions.text import lenient_double
from stationday.operators.clean import clean_pollen_results
from stationday.operators.conditions import join_conditions
from stationday.operators.merge import wide_rows
from stationday.schemas import LONG_SCHEMA, PLANT_CODES, STATION_SCHEMA
from stationday.session import work_folder
from stationday.sinks.parquet import write_verified
from stationday.sources.published import read_published
from stationday.sources.rawjson import parse_object, parse_responses

# which measurement an event type stands for
SOURCES = {
    "purchase": "precipitation",
    "click": "max_temperature",
    "view": "min_temperature",
    "signup": "max_wind",
    "error": "max_gust",
}
# which pollen type an event type stands for; the first two are unknown to the engine
TYPES = {"error": "OTHER", "signup": "POLLEN_TYPE_UNSPECIFIED", "click": "TREE", "view": "GRASS", "purchase": "WEED"}
PLANT_TYPES = {"GRAMINALES": "GRASS", "RAGWEED": "WEED", "MUGWORT": "WEED"}
_PUBLISHED: dict[tuple[str, str], str] = {}
CODES = (*PLANT_CODES, "PLANT_UNSPECIFIED", "BAMBOO")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lookup(mapping: dict[str, str], key: str):
    return F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))[F.col(key)]


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("station_id"),
        F.col("ts").cast("date").alias("date"),
        F.col("ts").cast("timestamp").alias("at"),
        "event_type",
        "value",
        "props",
        parse_object(F.col("props"), "struct<k: bigint>")["k"].alias("k"),
    )


def long_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under the long table's schema; wind sources have a direction."""
    events = dated_events(spark, sf_dir)
    wmo = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("station_id"), F.col("s_name").alias("wmo_station_id")
    )
    windy = F.col("event_type").isin("signup", "error")
    at_hour = F.date_trunc("hour", "at")
    return events.join(wmo, "station_id", "left").select(
        F.col("date").alias("snapshot_date"),
        lookup(SOURCES, "event_type").alias("source"),
        "station_id",
        "wmo_station_id",
        "date",
        at_hour.alias("observed_at"),
        "value",
        F.col("k").alias("quality"),
        F.when(windy, F.col("props")).alias("direction"),
        F.when(windy, F.col("k") + 1).alias("direction_quality"),
        F.date_format("at", "yyyy MM dd HH mm").alias("observed_text"),
    ).select(*LONG_SCHEMA.fieldNames())


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_rows(long_events(spark, sf_dir))


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the rows of a station master: names, and degrees and minutes as text."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("place"),
        key.cast("string").alias("station_id"),
        F.col("c_name").alias("station_name"),
        (key % 21 + 24).cast("string").alias("latitude_degrees"),
        (key * 7 % 60).cast("string").alias("latitude_minutes"),
        (key % 23 + 123).cast("string").alias("longitude_degrees"),
        (key * 13 % 60).cast("string").alias("longitude_minutes"),
    )


def located(master_rows: DataFrame) -> DataFrame:
    def degrees(axis: str):
        parts = (lenient_double(F.col(f"{axis}_{unit}")) for unit in ("degrees", "minutes"))
        return decimal_degrees(*parts).alias(axis)

    return master_rows.select("station_id", "station_name", degrees("latitude"), degrees("longitude"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    wmo = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("station_id"), F.col("s_name").alias("wmo_station_id")
    )
    return located(master(spark, sf_dir)).join(wmo, "station_id").select(*STATION_SCHEMA.fieldNames())


def responses(spark: SparkSession, sf_dir: str, index_values: int = 7) -> DataFrame:
    """One pollen response per station and day, as JSON text, with indexes from 0 up.

    Seven index values are one more than the range allows.

    A code has one type and one value (the largest) per station and day, so the lists are bounded
    by the code lists, whatever the number of events. So each code is a column of one aggregate of numbers,
    which is combined map-side; lists and texts are made of its rows after the join.
    """
    events = dated_events(spark, sf_dir)
    index = (F.floor("value") % index_values).cast("long")
    code = F.array(*(F.lit(c) for c in CODES))[(F.col("k") % len(CODES)).cast("int")]
    entries = events.select("station_id", "date", lookup(TYPES, "event_type").alias("type"), code.alias("plant"), index.alias("value"))
    # below every remainder: the code occurs, but never with a value
    none = F.lit(-index_values).cast("long")
    given = F.coalesce("value", none)
    columns = {
        f"{kind}_{i}": (c, F.col(kind).isNull() if c is None else F.col(kind) == c)
        for kind, codes in (("type", TYPES.values()), ("plant", CODES))
        for i, c in enumerate((*dict.fromkeys(codes), None))
    }
    by_day = entries.groupBy("station_id", "date").agg(*(F.max(F.when(own, given)).alias(name) for name, (_, own) in columns.items()))

    def listed(kind: str, *described) -> Column:
        """The codes that occur, each with its value."""
        items = {
            name: F.struct(
                F.lit(c).cast("string").alias("code"),
                F.struct(F.nullif(name, none).alias("value")).alias("indexInfo"),
                *(describe(c) for describe in described),
            )
            for name, (c, _) in columns.items()
            if name.startswith(kind)
        }
        # lists of one put together: a filter over all codes would be interpreted
        return F.concat(*(F.when(F.col(name).isNotNull(), F.array(item)).otherwise(F.array()) for name, item in items.items()))

    def plant_description(c: str | None) -> Column:
        return F.struct(F.lit(PLANT_TYPES.get(c, "TREE")).alias("type")).alias("plantDescription")

    day = F.struct(
        F.struct(F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"))
        .alias("date"),
        listed("type").alias("pollenTypeInfo"),
        listed("plant", plant_description).alias("plantInfo"),
    )
    located_rows = located(master(spark, sf_dir)).select("station_id", "latitude", "longitude")
    return by_day.join(located_rows, "station_id", "left").select(
        F.col("date").alias("snapshot_date"),
        "station_id",
        "latitude",
        "longitude",
        F.to_json(F.struct(F.lit("JP").alias("regionCode"), F.array(day).alias("dailyInfo"))).alias("response"),
    )


def pollen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_pollen_results(parse_responses(responses(spark, sf_dir)))


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_conditions(wide(spark, sf_dir), stations(spark, sf_dir), pollen(spark, sf_dir))


def published_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conditions`` as published: written by day once per application and data set, then read.

    The query surface works on published files, so that dates prune partitions and columns.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PUBLISHED:
        root = work_folder(spark, "conditions")
        write_verified(conditions(spark, sf_dir), root)
        _PUBLISHED[key] = root
    return read_published(spark, _PUBLISHED[key])


def plain(df: DataFrame) -> DataFrame:
    """Dates and instants as text and nested values as JSON, for comparison across engines."""

    def column(name: str, dtype: str):
        if dtype == "date":
            return F.col(name).cast("string").alias(name)
        if dtype in ("timestamp", "timestamp_ntz"):
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
        if dtype.startswith(("struct", "array")):
            return F.to_json(name, {"ignoreNullFields": "false"}).alias(name)
        return F.col(name)

    return df.select(*(column(name, dtype) for name, dtype in df.dtypes))
