"""The five-way merge of cleaned measurements to one wide row per station and day."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationday.errors import DataQualityError
from stationday.operators.joins import broadcast_if_small, duplicate_keys, first_and_total, in_all, per_date, raise_if_any
from stationday.operators.quality import date_conflicts
from stationday.schemas import DAILY_WEATHER_SCHEMA, MEASUREMENTS, SLOTS
from stationday.session import work_folder


def full_merge(long: DataFrame, keys: list[str], columns: dict[str, Column]) -> DataFrame:
    """Full outer merge of the sources of a long table, keys coalesced, as one aggregation.

    Each source has a key once at most (``key_check``), so the maximum of a column is its one
    value. One exchange replaces the exchanges of a chain of full outer joins.
    """
    return long.groupBy(*keys).agg(*(F.max(c).alias(name) for name, c in columns.items()))


def measure_columns(slots: dict[str, Column] | None = None) -> dict[str, Column]:
    """The wide table's measures as expressions over the long table, or over other slot columns."""
    slots = {**{name: F.col(name) for name in SLOTS}, **(slots or {})}
    return {
        measure.name: F.when(F.col("source") == m.name, slots[slot])
        for m in MEASUREMENTS
        for slot, measure in zip(SLOTS, m.measures)
    }


def text_code(text: Column) -> Column:
    """A number that stands for a text; ``text_codes`` maps it back."""
    return F.when(text.isNotNull(), F.xxhash64(text))


def text_codes(df: DataFrame, column: str = "direction") -> DataFrame:
    """``code, text`` of each distinct text of a column."""
    return df.where(F.col(column).isNotNull()).select(text_code(F.col(column)).alias("code"), F.col(column).alias("text")).distinct()


def with_ordered_codes(df: DataFrame, column: str = "direction") -> tuple[DataFrame, DataFrame]:
    """``df`` with the texts of a column as codes in the order of the texts, and ``code, text``.

    Numbered by range partitions, so that the largest code stands for the largest text where a key is given twice. Written, so
    that the numbers stay what they are and the size is known when the codes are joined.
    """
    path = work_folder(df.sparkSession, "codes")
    texts = df.where(F.col(column).isNotNull()).select(F.col(column).alias("text")).distinct()
    texts.repartitionByRange("text").sortWithinPartitions("text").select(
        F.monotonically_increasing_id().alias("code"), "text"
    ).write.parquet(path)
    codes = df.sparkSession.read.schema("code long, text string").parquet(path)
    by_text = codes.withColumnRenamed("text", column)
    small = broadcast_if_small(by_text)
    if small is not by_text:
        # one scan, as no row moves for a broadcast
        return df.join(small, column, "left").drop(column), codes
    # rows without a text do not meet in a shuffle
    coded = df.where(F.col(column).isNotNull()).join(by_text, column).drop(column)
    rest = df.where(F.col(column).isNull()).drop(column).withColumn("code", F.lit(None).cast("long"))
    return coded.unionByName(rest), codes


def extended_codes(cleaned: DataFrame, path: str, column: str = "direction") -> DataFrame:
    """The kept table of codes below ``path`` with the texts of ``cleaned`` that it lacked."""
    spark = cleaned.sparkSession
    found = text_codes(cleaned, column)
    try:
        known = spark.read.schema("code long, text string").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        found = found.join(known, ["code", "text"], "left_anti")
    found.write.mode("append").parquet(path)
    return _unambiguous(spark.read.schema("code long, text string").parquet(path))


def _unambiguous(codes: DataFrame) -> DataFrame:
    raise_if_any(duplicate_keys(codes.distinct(), ["code"]), "code", "Codes that stand for several texts")
    return codes.distinct()


def wide_rows(cleaned: DataFrame, codes: DataFrame | None = None, oldest: DataFrame | None = None) -> DataFrame:
    """``daily_weather`` of every snapshot of the long table, without the eager checks.

    ``observed_at`` is the oldest hour of all sources, rows without a WMO id included; the merge
    itself leaves those rows out.

    Spark aggregates text by sorting but numbers by hashing, which is about twice as fast here. So wind
    directions are merged as codes: digests that the table ``codes`` knows, or, without it, numbers given here. They are joined
    back to their texts afterwards.
    """
    keys = ["snapshot_date", "station_id", "wmo_station_id", "date"]
    if oldest is None:
        oldest = cleaned.groupBy("snapshot_date").agg(F.min("observed_at").alias("observed_at"))
    with_id = cleaned.where(F.col("wmo_station_id").isNotNull())
    if codes is None:
        with_id, codes = with_ordered_codes(with_id)
        code = F.col("code")
    else:
        code = text_code(F.col("direction"))
    wide = full_merge(with_id, keys, measure_columns({"direction": code}))
    for column in [c for c in wide.columns if c.endswith("_direction")]:
        texts = codes.select(F.col("code").alias(column), F.col("text").alias("_text"))
        wide = wide.join(texts, column, "left").drop(column).withColumnRenamed("_text", column)
    return wide.join(per_date(oldest), "snapshot_date").select("snapshot_date", *DAILY_WEATHER_SCHEMA.fieldNames())


def require_one_date(cleaned: DataFrame) -> None:
    found, total = first_and_total(date_conflicts(cleaned), "snapshot_date")
    if total:
        shown = "; ".join(f"{r['snapshot_date']}: {r['first']} … {r['last']}" for r in found)
        raise DataQualityError(
            f"Daily weather requires one shared observation date per snapshot: {shown}{in_all(found, total)}",
            failures=found,
            total=total,
        )


def conflicting_ids(weather: DataFrame) -> DataFrame:
    """Stations that occur with more than one WMO id on a day."""
    return duplicate_keys(weather, ["station_id", "date"])


def require_consistent_ids(weather: DataFrame) -> None:
    raise_if_any(conflicting_ids(weather), "station_id", "Conflicting WMO station ids for station ids")


def daily_weather(cleaned: DataFrame) -> DataFrame:
    """``wide_rows`` after its two checks; the checks are actions, the result stays lazy."""
    require_one_date(cleaned)
    weather = wide_rows(cleaned)
    require_consistent_ids(weather)
    return weather
