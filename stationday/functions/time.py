"""Observation time, snapshot keys and their text forms, all in Japan time."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationday.functions.checked import Checked
from stationday.schemas import JAPAN_TIME, TIME_HEADERS

PARTS = tuple(TIME_HEADERS)
ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ssXXX"


def today(now: dt.datetime | None = None) -> dt.date:
    """Today's date in Japan."""
    return (now or dt.datetime.now(dt.timezone.utc)).astimezone(ZoneInfo(JAPAN_TIME)).date()


def with_observation_time(df: DataFrame, parts: tuple[str, ...] = PARTS, failure: str | None = None) -> DataFrame:
    """Replace five trimmed time texts by ``date`` and ``observed_at``.

    The wall clock is Japan time and is floored to the hour. Hour 24 is accepted on the full
    hour only; it moves ``observed_at`` to the next midnight and leaves ``date`` alone. Other texts are an
    error, or a message in the column ``failure`` names.
    """
    year, month, day, hour, minute = parts
    shown = F.concat_ws(" ", *(F.coalesce(F.col(p), F.lit("NULL")) for p in parts))
    numbers = df.withColumns({f"_{p}": F.col(p).try_cast("int") for p in parts})
    written = F.concat_ws("-", *(F.col(f"_{p}").cast("string") for p in (year, month, day)))
    whole = reduce(and_, (F.col(f"_{p}").isNotNull() for p in parts))
    valid = (
        whole
        & F.col("_date").isNotNull()
        & F.col(f"_{year}").between(1, 9999)
        & F.col(f"_{hour}").between(0, 24)
        & F.col(f"_{minute}").between(0, 59)
        & ~((F.col(f"_{hour}") == 24) & (F.col(f"_{minute}") > 0))
    )
    message = F.concat(F.lit("Invalid observation time: "), shown)
    date = Checked(F.col("_date"), ~F.coalesce(valid, F.lit(False)), message)
    dated = numbers.withColumn("_date", written.try_cast("date"))
    if failure:
        dated = dated.withColumns({"date": date.value, failure: date.failure})
    else:
        dated = dated.withColumn("date", date.or_raise())
    zero = F.lit(0)
    civil = F.make_timestamp(
        F.year("date"), F.month("date"), F.dayofmonth("date"), zero, zero, zero, F.lit(JAPAN_TIME)
    ) + F.make_dt_interval(zero, F.col(f"_{hour}"))
    # nine hours ahead all year since 1952; looking the zone up row by row is far slower
    fixed = F.timestamp_seconds(F.unix_date("date") * F.lit(86400).cast("long") + (F.col(f"_{hour}") - 9) * 3600)
    at = F.when(F.col(f"_{year}") >= 1952, fixed).otherwise(civil)
    observed = dated.withColumn("observed_at", F.when(F.col("date").isNotNull(), at))
    return observed.drop(*parts, *(f"_{p}" for p in parts), "_date")


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def snapshot_key(date: Column) -> Column:
    """A date as ``YYYYMMDD``."""
    return F.date_format(date, "yyyyMMdd")


def snapshot_date(key: Column) -> Column:
    """``YYYYMMDD`` as a date; NULL where it is no date."""
    compact = F.when(key.rlike(r"^\d{8}$"), F.regexp_replace(key, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"))
    return compact.try_cast("date")


def iso_timestamp(ts: Column) -> Column:
    """An instant as ISO 8601 in Japan time (+09:00), whatever the session's zone is."""
    fields = F.to_json(F.struct(ts.alias("t")), {"timestampFormat": ISO_TIMESTAMP, "timeZone": JAPAN_TIME})
    return F.get_json_object(fields, "$.t")
