"""Nested pollen expressions, built from higher-order functions only."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationday.functions.checked import Checked
from stationday.schemas import PLANT_CODES, POLLEN_COLUMNS, POLLEN_INDEX_RANGE, POLLEN_INFO_TYPE

_TYPES = tuple(POLLEN_COLUMNS)


def _or_empty(array: Column) -> Column:
    return F.coalesce(array, F.array())


def checked_day(response: Column, station_id: Column) -> Checked:
    """The one forecast day of a response, else a failure naming the station."""
    days = response["dailyInfo"]
    message = F.concat(
        F.lit("Expected exactly one pollen forecast day for station "), F.coalesce(station_id, F.lit("NULL"))
    )
    # a NULL entry in the list is no forecast day either
    first = F.get(days, F.lit(0))
    one = (F.coalesce(F.size(days), F.lit(0)) == 1) & first.isNotNull()
    return Checked(first, ~F.coalesce(one, F.lit(False)), message)


def single_day(response: Column, station_id: Column) -> Column:
    return checked_day(response, station_id).or_raise()


def unique_codes(items: Column, what: str, station_id: Column) -> Checked:
    """A list of entries; a code given twice is a failure. ``items`` is read several times, so it should be a column of its own."""
    codes = F.transform(items, lambda item: item["code"])
    message = F.concat(
        F.lit(f"Duplicate {what} for station "),
        F.coalesce(station_id, F.lit("NULL")),
        F.lit(": "),
        F.array_join(codes, ", "),
    )
    return Checked(items, F.size(items) != F.size(F.array_distinct(codes)), message)


def known_types(day: Column) -> Column:
    """Type entries with a known code."""
    return F.filter(_or_empty(day["pollenTypeInfo"]), lambda item: item["code"].isin(*_TYPES))


def known_plants(day: Column) -> Column:
    """Plant entries with a known code and a known type."""
    return F.filter(
        _or_empty(day["plantInfo"]),
        lambda item: item["code"].isin(*PLANT_CODES) & item["plantDescription"]["type"].isin(*_TYPES),
    )


def pollen_group(types: Column, plants: Column, code: str) -> Column:
    """``{value, plants}`` of one pollen type, plants by code; NULL where neither names it."""
    entry = F.get(F.filter(types, lambda item: item["code"] == code), F.lit(0))
    own = lambda item: item["plantDescription"]["type"] == code
    members = F.sort_array(
        F.transform(
            F.filter(plants, own),
            lambda item: F.struct(item["code"].alias("code"), item["indexInfo"]["value"].alias("value")),
        )
    )
    group = F.struct(entry["indexInfo"]["value"].alias("value"), members.alias("plants"))
    return F.when(entry.isNotNull() | F.exists(plants, own), group).cast(POLLEN_INFO_TYPE)


def _outside(value: Column) -> Column:
    return F.coalesce(~value.between(*POLLEN_INDEX_RANGE), F.lit(False))


def invalid_type_values(columns: list[Column]) -> Column:
    """How many of a row's groups have a value outside the index range."""
    return reduce(add, (_outside(c["value"]).cast("int") for c in columns))


def invalid_plant_values(columns: list[Column]) -> Column:
    """How many plants of a row have a value outside the index range."""
    return reduce(
        add, (F.size(F.filter(_or_empty(c["plants"]), lambda plant: _outside(plant["value"]))) for c in columns)
    )
