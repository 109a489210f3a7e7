"""Raw rows to typed, cleaned tables.

All measurement files are cleaned in one pass into one long table, where a row has its ``source``
and up to four measures (``SLOTS``). Cleaning is row-wise: each row carries its file's time, so date
and hour come from the row itself and no join is needed. That a file has one time only is checked
by ``time_conflicts``.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationday.errors import DataQualityError
from stationday.functions.checked import first_failure
from stationday.functions.pollen import checked_day, known_plants, known_types, pollen_group, unique_codes
from stationday.functions.text import checked_cast
from stationday.functions.time import with_observation_time
from stationday.operators.joins import first_and_total, in_all
from stationday.schemas import (
    LONG_SCHEMA,
    MEASUREMENT_BY_NAME,
    MEASUREMENT_CHARSET,
    MEASUREMENT_FILES,
    MEASUREMENTS,
    POLLEN_COLUMNS,
    POLLEN_SCHEMA,
    SLOTS,
    STATION_ID_HEADER,
    TIME_HEADERS,
    WMO_ID_HEADER,
)
from stationday.sources.rawcsv import file_rows, line_rows, payload_rows
from stationday.sources.rawjson import pollen_results

KEY = "snapshot_date"
TIME_TEXT = "observed_text"
FAILURE = "failure"
IDS = ("station_id", "wmo_station_id")
FILE_NAMES = "{" + ",".join(MEASUREMENT_FILES) + "}"


def _slot_pattern(slot: int) -> Column:
    """The header pattern of a slot in the row's file; NULL where the file has no such measure."""
    pattern = F.lit(None).cast("string")
    for m in MEASUREMENTS:
        if slot < len(m.measures):
            pattern = F.when(F.col("filename") == m.filename, F.lit(m.measures[slot].header)).otherwise(pattern)
    return pattern


def wanted_columns() -> dict[str, str | Column]:
    """Target names and header patterns of everything read from measurement files."""
    fixed = {"station_id": STATION_ID_HEADER, "wmo_station_id": WMO_ID_HEADER, **TIME_HEADERS}
    return {
        **{name: re.escape(header) for name, header in fixed.items()},
        **{name: _slot_pattern(i) for i, name in enumerate(SLOTS)},
    }


def landed_measurement_rows(landed: DataFrame, failure: str | None = None) -> DataFrame:
    """Text rows of the measurement objects of a landing table."""
    payloads = landed.where(F.col("filename").isin(*MEASUREMENT_FILES)).select(KEY, "filename", "content")
    return payload_rows(payloads, MEASUREMENT_CHARSET, wanted_columns(), failure).drop("row_no")


def chunked_measurement_rows(lines: DataFrame, failure: str | None = None) -> DataFrame:
    """Text rows of the lines of large landed objects (``chunks.chunk_lines``)."""
    return line_rows(lines, MEASUREMENT_CHARSET, wanted_columns(), failure=failure)


def measurement_file_rows(
    spark: SparkSession, folders: str | list[str], names: str | None = FILE_NAMES, **options
) -> DataFrame:
    """Text rows of raw measurement files, read in place (``rawcsv.file_rows``)."""
    return file_rows(spark, folders, MEASUREMENT_CHARSET, wanted_columns(), only=names, **options)


def clean_measurements(rows: DataFrame) -> DataFrame:
    """The long table: typed rows of every measurement, marked by ``source``.

    ``observed_text`` keeps the time as it was written, for ``time_conflicts``. If ``rows`` carry ``failure``, so does
    the table: the first thing wrong with a row, whose values are not to be used then. Otherwise that is an error.
    """
    gathered = FAILURE in rows.columns
    texts = (F.coalesce(F.col(t), F.lit("NULL")) for t in TIME_HEADERS)
    timed = rows.withColumn(TIME_TEXT, F.concat_ws(" ", *texts))
    timed = with_observation_time(timed, failure="_time" if gathered else None)
    measures = {
        name: checked_cast(F.col(name), dtype, F.concat(F.col("filename"), F.lit(f" {name}"))) for name, dtype in SLOTS.items()
    }
    source = F.regexp_replace("filename", r"\.csv$", "").alias("source")
    typed = (
        (m.value if gathered or isinstance(SLOTS[name], T.StringType) else m.or_raise()).alias(name) for name, m in measures.items()
    )
    failures = [F.col(FAILURE), F.col("_time"), *(m.failure for m in measures.values())] if gathered else []
    problem = [first_failure(*failures).alias(FAILURE)] if gathered else []
    return timed.select(KEY, source, *IDS, "date", "observed_at", *typed, TIME_TEXT, *problem)


def cleaned_table(long: DataFrame, name: str) -> DataFrame:
    """One measurement of the long table under its declared schema, with ``snapshot_date``."""
    measures = MEASUREMENT_BY_NAME[name].measures
    return long.where(F.col("source") == name).select(
        KEY, *IDS, "date", "observed_at", *(F.col(slot).alias(m.name) for slot, m in zip(SLOTS, measures))
    )


def long_table(cleaned: dict[str, DataFrame]) -> DataFrame:
    """The long table made of the five cleaned tables, the inverse of ``cleaned_table``."""
    missing = [m.name for m in MEASUREMENTS if m.name not in cleaned]
    if missing:
        raise ValueError(f"Missing cleaned measurements: {missing!r}")

    def to_long(m):
        own = dict(zip(SLOTS, m.measures))
        slots = (
            (F.col(own[slot].name) if slot in own else F.lit(None)).cast(dtype).alias(slot)
            for slot, dtype in SLOTS.items()
        )
        time = F.date_format("observed_at", "yyyy-MM-dd HH:mm").alias(TIME_TEXT)
        return cleaned[m.name].select(KEY, F.lit(m.name).alias("source"), *IDS, "date", "observed_at", *slots, time)

    return reduce(DataFrame.unionByName, map(to_long, MEASUREMENTS)).select(*LONG_SCHEMA.fieldNames())


def time_conflicts(cleaned: DataFrame, groups: list[str]) -> DataFrame:
    """Groups whose rows do not all carry the same time texts; 14:50 and 15:00 differ."""
    return (
        cleaned.select(*groups, TIME_TEXT)
        .distinct()
        .groupBy(*groups)
        .agg(F.count(F.lit(1)).alias("times"), F.min(TIME_TEXT).alias("first"), F.max(TIME_TEXT).alias("last"))
        .where("times > 1")
    )


def require_one_time(cleaned: DataFrame, groups: list[str]) -> None:
    found, total = first_and_total(time_conflicts(cleaned, groups), *groups)
    if total:
        shown = "; ".join(f"{', '.join(str(r[g]) for g in groups)}: {r['first']} … {r['last']}" for r in found)
        raise DataQualityError(f"Expected one observation time per file, found several in {shown}{in_all(found, total)}", failures=found, total=total)


def clean_pollen_results(results: DataFrame) -> DataFrame:
    """One row per station and snapshot with a nested group per pollen type; dated by its key.

    If ``results`` carry ``failure``, so do the rows; otherwise what is wrong with a response is an error.
    """
    gathered = FAILURE in results.columns
    station = F.col("station_id")
    carried = [FAILURE] if gathered else []
    day = checked_day(F.col("response"), station)
    by_day = results.select(KEY, "station_id", (day.value if gathered else day.or_raise()).alias("day"), *(
        [F.coalesce(F.col(FAILURE), day.failure).alias(FAILURE)] if gathered else []
    ))
    # each list is made once, then checked and used by name
    known = by_day.withColumns({"types": known_types(F.col("day")), "plants": known_plants(F.col("day"))})
    types, plants = unique_codes(F.col("types"), "pollen type", station), unique_codes(F.col("plants"), "plant", station)
    if gathered:
        lists = [types.value.alias("types"), plants.value.alias("plants")]
        carried = [first_failure(F.col(FAILURE), types.failure, plants.failure).alias(FAILURE)]
    else:
        lists = [types.or_raise().alias("types"), plants.or_raise().alias("plants")]
    parts = known.select(KEY, "station_id", *lists, *carried)
    groups = (
        pollen_group(F.col("types"), F.col("plants"), code).alias(column) for code, column in POLLEN_COLUMNS.items()
    )
    rows = parts.select(KEY, "station_id", F.col(KEY).alias("date"), *groups, *([FAILURE] if gathered else []))
    return rows.select(KEY, *POLLEN_SCHEMA.fieldNames(), *([FAILURE] if gathered else []))


def clean_pollen(payloads: DataFrame, failure: str | None = None) -> DataFrame:
    return clean_pollen_results(pollen_results(payloads, failure))
