"""Pollen responses before they are stored: one forecast day each, of the expected date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.functions.pollen import single_day
from stationday.operators.joins import raise_if_any
from stationday.sources.rawjson import parse_responses


def unexpected_dates(responses: DataFrame) -> DataFrame:
    """Stations whose response is not for their snapshot's date (``response`` as JSON text)."""
    day = single_day(F.col("response"), F.col("station_id"))
    date = parse_responses(responses).select("snapshot_date", "station_id", day["date"].alias("got"))
    same = (
        (F.col("got.year") == F.year("snapshot_date"))
        & (F.col("got.month") == F.month("snapshot_date"))
        & (F.col("got.day") == F.dayofmonth("snapshot_date"))
    )
    return date.where(~F.coalesce(same, F.lit(False)))


def require_expected_dates(responses: DataFrame) -> None:
    raise_if_any(unexpected_dates(responses), "station_id", "Unexpected pollen forecast date for stations")
