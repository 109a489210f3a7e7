"""Data-quality checks, one result row per source and snapshot, and the gate that blocks on them."""

from __future__ import annotations

import logging
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationday.errors import DataQualityError
from stationday.functions.pollen import invalid_plant_values, invalid_type_values
from stationday.functions.time import iso_timestamp
from stationday.operators.joins import first_and_total, in_all
from stationday.schemas import MEASUREMENTS, POLLEN_COLUMNS

log = logging.getLogger(__name__)

KEY_COUNTS = ("null_key_row_count", "duplicate_key_count", "date_count", "observed_at_count")


def any_null(columns: list[str]) -> Column:
    return reduce(or_, (F.col(c).isNull() for c in columns))


def expected_groups(spark: SparkSession, dates, sources=tuple(m.name for m in MEASUREMENTS)) -> DataFrame:
    """Every source of every snapshot, so that a source without rows is checked too."""
    schema = T.StructType([T.StructField("snapshot_date", T.DateType())])
    names = F.explode(F.array(*(F.lit(s) for s in sources))).alias("source")
    return spark.createDataFrame([(d,) for d in sorted(set(dates))], schema).select("snapshot_date", names)


def key_check(
    df: DataFrame,
    groups: list[str],
    keys: tuple[str, ...] = ("station_id", "date"),
    expected: DataFrame | None = None,
) -> DataFrame:
    """Per group: rows with a NULL key, keys given twice, distinct dates and hours, and ``passed``.

    Passes with no NULL, no duplicate, one date and one ``observed_at`` (not looked at where the
    column is absent). Rows are combined map-side, first by key, then by group, so a hot key or a
    hot group costs no more than any other. A group of ``expected`` without rows does not pass.
    """
    has_time = "observed_at" in df.columns
    required = [*keys, *(["observed_at"] if has_time else [])]
    by_key = df.groupBy(*groups, *(k for k in keys if k not in groups)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(any_null(required).cast("long")).alias("nulls")
    )
    counts = by_key.groupBy(*groups).agg(
        F.sum("nulls").alias("null_key_row_count"), F.count_if(F.col("n") > 1).alias("duplicate_key_count")
    )
    # a handful of rows per group is left for the distinct counts; the row count keeps the first
    # grouping in the plan, which would otherwise be merged into an expansion of every row
    named = {"_date": F.col("date"), **({"_time": F.col("observed_at")} if has_time else {})}
    moments = df.groupBy(*groups, *(c.alias(n) for n, c in named.items())).agg(F.count(F.lit(1)).alias("n"))
    times = moments.groupBy(*groups).agg(
        F.count_distinct("_date").alias("date_count"),
        (F.count_distinct("_time") if has_time else F.lit(1).cast("long")).alias("observed_at_count"),
        F.sum("n").alias("row_count"),
    )
    result = counts.join(times, groups)
    if expected is not None:
        result = expected.join(result, groups, "left")
    numbers = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in (*KEY_COUNTS, "row_count")}
    passed = (
        (numbers["null_key_row_count"] == 0)
        & (numbers["duplicate_key_count"] == 0)
        & (numbers["date_count"] == 1)
        & (numbers["observed_at_count"] == 1)
    )
    return result.withColumns(numbers).withColumn("passed", passed)


def profile(cleaned: DataFrame, groups: list[str], value: str | None = None) -> DataFrame:
    """Per group, in one scan, all that checks and metrics ask of a cleaned table.

    Rows are combined by key first, then by group. ``first_text`` and ``last_text`` are digests of the time texts, which differ
    where the texts do. ``failed_rows`` counts rows with a ``failure``, ``null_count`` those without ``value``.
    """
    has = cleaned.columns
    at = F.col("observed_at") if "observed_at" in has else F.lit(None).cast("timestamp")
    text = F.xxhash64("observed_text") if "observed_text" in has else F.lit(0).cast("long")
    failed = F.col("failure").isNotNull() if "failure" in has else F.lit(False)
    required = ["station_id", "date", *(c for c in ("observed_at",) if c in has)]
    by_key = cleaned.groupBy(*groups, "station_id", "date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(any_null(required).cast("long")).alias("nulls"),
        F.count_if(failed).alias("failed"),
        F.count_if(F.col(value).isNull() if value else F.lit(False)).alias("empty"),
        F.min(at).alias("first_at"),
        F.max(at).alias("last_at"),
        F.min(text).alias("first_text"),
        F.max(text).alias("last_text"),
    )
    return by_key.groupBy(*groups).agg(
        F.sum("n").alias("row_count"),
        F.sum("nulls").alias("null_key_row_count"),
        F.count_if(F.col("n") > 1).alias("duplicate_key_count"),
        F.sum("failed").alias("failed_rows"),
        F.sum("empty").alias("null_count"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        *(f(c).alias(c) for f, c in ((F.min, "first_at"), (F.max, "last_at"), (F.min, "first_text"), (F.max, "last_text"))),
    )


def keys_are_valid(row) -> bool:
    """Whether a row of ``profile`` passes ``key_check``."""
    one_time = row["first_at"] == row["last_at"]
    one_date = row["first_date"] is not None and row["first_date"] == row["last_date"]
    return row["null_key_row_count"] == 0 and row["duplicate_key_count"] == 0 and one_date and one_time


def pollen_value_check(df: DataFrame, groups: list[str]) -> DataFrame:
    """Per group: type and plant values outside the index range, and ``passed``."""
    columns = [F.col(c) for c in POLLEN_COLUMNS.values()]
    # a NULL group has no plants: size of its coalesced empty list is 0
    result = df.groupBy(*groups).agg(
        F.sum(invalid_type_values(columns)).cast("long").alias("invalid_pollen_value_count"),
        F.sum(invalid_plant_values(columns)).cast("long").alias("invalid_plant_value_count"),
    )
    return result.withColumn(
        "passed", (F.col("invalid_pollen_value_count") == 0) & (F.col("invalid_plant_value_count") == 0)
    )


def assert_checks(result: DataFrame, name: str) -> None:
    """Block: raise with the counts of failing groups, so that nothing downstream is built."""
    groups = [c for c in ("snapshot_date", "source") if c in result.columns]
    rows, total = first_and_total(result.where(~F.coalesce("passed", F.lit(False))), *groups)
    if total:
        failed = [row.asDict() for row in rows]
        raise DataQualityError(f"Check {name} failed: {failed!r}{in_all(failed, total)}", failures=failed, total=total)


def date_conflicts(cleaned: DataFrame) -> DataFrame:
    """Snapshots whose sources do not share one observation date."""
    return (
        cleaned.select("snapshot_date", "date")
        .distinct()
        .groupBy("snapshot_date")
        .agg(F.count("date").alias("dates"), F.min("date").alias("first"), F.max("date").alias("last"))
        .where("dates <> 1")
    )


def source_times(cleaned: DataFrame) -> DataFrame:
    """Per snapshot: the oldest and newest hour over all sources, whether they differ, each source's own."""
    return (
        cleaned.groupBy("snapshot_date", "source")
        .agg(F.min("observed_at").alias("at"))
        .groupBy("snapshot_date")
        .agg(
            F.min("at").alias("observed_at"),
            F.max("at").alias("newest_observed_at"),
            *(
                F.min(F.when(F.col("source") == m.name, F.col("at"))).alias(f"{m.name}_observed_at")
                for m in MEASUREMENTS
            ),
        )
        .withColumn("differs", F.col("observed_at") < F.col("newest_observed_at"))
    )


def warn_of_differing_hours(times: DataFrame) -> int:
    """Log the snapshots whose sources are of different hours (``source_times``); returns how many there are."""
    rows, total = first_and_total(times.where("differs"), "snapshot_date")
    if total:
        shown = [(str(r.snapshot_date), str(r.observed_at), str(r.newest_observed_at)) for r in rows]
        log.warning("Sources differ in their hour, the oldest is used: %r%s", shown, in_all(shown, total))
    return total


def null_counts(df: DataFrame, groups: list[str], columns: list[str]) -> DataFrame:
    """Rows and NULLs per group."""
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("row_count"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}_count") for c in columns),
    )
