"""The station dimension: stations in use, described by the station master."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.functions.geo import decimal_degrees
from stationday.functions.text import csv_fields, lenient_double
from stationday.operators.joins import broadcast_if_small, raise_if_any
from stationday.operators.quality import any_null
from stationday.schemas import STATION_MASTER_CHARSET, STATION_MASTER_HEADERS, STATION_SCHEMA
from stationday.session import java_charsets, work_folder
from stationday.sources.rawcsv import payload_rows

log = logging.getLogger(__name__)

MISSING_STATIONS = "Missing station master rows for station ids"
INVALID_STATIONS = "Invalid required station master fields for station ids"


def missing_columns(header: list[str]) -> list[str]:
    return sorted(set(STATION_MASTER_HEADERS.values()) - set(header))


def read_station_master(spark: SparkSession, path: str) -> DataFrame:
    """The station master file as trimmed texts, with ``place``, the row's place in the file.

    A master in several files, each with a header, is read in the order of the files' names.
    """
    payload = spark.read.format("binaryFile").load(path).select("path", "content")
    with java_charsets(spark):
        texts = payload.select(F.decode("content", STATION_MASTER_CHARSET).alias("text"))
    first_lines = texts.select(F.split("text", r"\r\n|\n|\r")[0].alias("line"))
    names = first_lines.select(F.explode(csv_fields(F.col("line"))).alias("name")).distinct().collect()
    if lacking := missing_columns([row.name for row in names]):
        raise ValueError(f"Missing required station master columns: {lacking!r}")
    columns = {target: re.escape(name) for target, name in STATION_MASTER_HEADERS.items()}
    rows = payload_rows(payload, STATION_MASTER_CHARSET, columns)
    return rows.select(F.struct("path", "row_no").alias("place"), *columns)


def stations_in_use(weather: DataFrame) -> DataFrame:
    return weather.where(F.col("wmo_station_id").isNotNull()).select("station_id", "wmo_station_id").distinct()


def first_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key by ``order``, with the key's row count ``n``; combined map-side."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), order).alias("first"), F.count(F.lit(1)).alias("n"))
        .select(*keys, "n", "first.*")
    )


def describe_stations(in_use: DataFrame, master: DataFrame) -> DataFrame:
    """Stations in use with the first master row of each; ``n`` counts its rows, NULL is none."""
    wanted = master.join(broadcast_if_small(in_use.select("station_id").distinct()), "station_id", "left_semi")
    first = first_rows(wanted, ["station_id"], "place")
    return in_use.join(first, "station_id", "left").select(
        "station_id",
        "wmo_station_id",
        "station_name",
        decimal_degrees(
            lenient_double(F.col("latitude_degrees")), lenient_double(F.col("latitude_minutes"))
        ).alias("latitude"),
        decimal_degrees(
            lenient_double(F.col("longitude_degrees")), lenient_double(F.col("longitude_minutes"))
        ).alias("longitude"),
        "n",
    )


@dataclass(frozen=True)
class Stations:
    table: DataFrame
    duplicate_ids: list[str]
    duplicate_count: int


def described_stations(weather: DataFrame, master: DataFrame) -> DataFrame:
    """``describe_stations`` of the stations in ``weather``, written once."""
    described = describe_stations(stations_in_use(weather), master)
    path = work_folder(weather.sparkSession, "described-stations")
    described.write.parquet(path)
    return weather.sparkSession.read.schema(described.schema).parquet(path)


def refused_stations(described: DataFrame) -> DataFrame:
    """``station_id, reason`` of stations without a master row, or with a name or coordinate missing or unreadable."""
    missing = F.col("n").isNull()
    reason = F.when(missing, MISSING_STATIONS).otherwise(INVALID_STATIONS)
    return described.where(missing | any_null(STATION_SCHEMA.fieldNames())).select("station_id", reason.alias("reason"))


def usable_stations(described: DataFrame) -> Stations:
    """The stations that are described whole; one with several master rows takes the first and is reported."""
    # every station with several master rows; the master is a list of stations, not of observations
    ids = [r[0] for r in described.where("n > 1").select("station_id").distinct().orderBy("station_id").collect()]
    if ids:
        log.warning("Duplicate station master rows, first row used: %d stations, %r", len(ids), ids)
    whole = described.where(F.col("n").isNotNull() & ~any_null(STATION_SCHEMA.fieldNames()))
    return Stations(whole.select(*STATION_SCHEMA.fieldNames()), ids, len(ids))


def wmo_stations(weather: DataFrame, master: DataFrame) -> Stations:
    """The dimension of the stations in ``weather``; ``refused_stations`` are an error."""
    described = described_stations(weather, master)
    refused = refused_stations(described)
    for reason in (MISSING_STATIONS, INVALID_STATIONS):
        raise_if_any(refused.where(F.col("reason") == reason), "station_id", reason)
    return usable_stations(described)
