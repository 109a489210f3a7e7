"""The build: landed raw objects to the published table, for any number of snapshots at once.

Tables are written between the stages. That cuts lineage and leaves a cleaned table in place when one of its
checks blocks what follows. A snapshot that fails is left behind, the others go on.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.functions.time import snapshot_key, today
from stationday.operators import clean
from stationday.operators.blocking import RAW_OBJECTS, Ledger
from stationday.operators.conditions import MISMATCH, join_conditions, mismatched_snapshots
from stationday.operators.joins import broadcast_if_small
from stationday.operators.merge import conflicting_ids, extended_codes, wide_rows
from stationday.operators.quality import (
    expected_groups,
    key_check,
    keys_are_valid,
    null_counts,
    pollen_value_check,
    profile,
    source_times,
    warn_of_differing_hours,
)
from stationday.operators.stations import (
    described_stations,
    read_station_master,
    refused_stations,
    stations_in_use,
    usable_stations,
)
from stationday.schemas import CLEANED_SCHEMAS, LANDING_SCHEMA, MEASUREMENT_FILES, MEASUREMENTS, POLLEN_COLUMNS, POLLEN_FILE
from stationday.session import work_folder
from stationday.sinks.documents import geojson_documents, write_documents
from stationday.sinks.metrics import append_metrics, metric_rows
from stationday.sinks.parquet import write_verified, written_files
from stationday.sources.chunks import chunk_lines, chunk_rows, read_manifest, write_chunks
from stationday.sources.landing import (
    MAX_PAYLOAD_BYTES,
    day_folders,
    expected_objects,
    landing_rows,
    missing_objects,
    read_landing,
    select_snapshots,
    write_landing,
)
from stationday.sources.published import read_declared, read_published
from stationday.sources.rawcsv import file_payloads

SOURCE_KEY = ["snapshot_date", "source"]


@dataclass(frozen=True)
class Warehouse:
    """Where the tables of a build live, below one root."""

    root: str

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def landing(self) -> str:
        return self._at("landing")

    @property
    def chunks(self) -> str:
        """Objects that are too large for one value, and their manifest."""
        return self._at("landing_chunks")

    @property
    def cleaned(self) -> str:
        return self._at("cleaned")

    @property
    def pollen(self) -> str:
        return self._at("pollen_cleaned")

    @property
    def conditions(self) -> str:
        return self._at("daily_weather_conditions")

    @property
    def geojson(self) -> str:
        return self._at("daily_weather_conditions_geojson")

    @property
    def metrics(self) -> str:
        return self._at("metrics")

    @property
    def codes(self) -> str:
        """Numbers of the texts that are merged, extended by each build."""
        return self._at("text_codes")

    @property
    def failures(self) -> str:
        """What was wrong with snapshots that were not built, one line for each check and source."""
        return self._at("failures")


@dataclass(frozen=True)
class BuildReport:
    run_id: str
    dates: list[dt.date]
    rows: int
    checksum: int
    duplicate_stations: list[str] = field(default_factory=list)


def _keep(df: DataFrame, path: str) -> DataFrame:
    """Write a table by snapshot and read it back.

    Nothing is shuffled for it: a task reads the objects of a few days and writes files for those.
    """
    df.write.partitionBy("snapshot_date").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return read_declared(df.sparkSession, path, df.schema)


def _stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared work folder, as it is partitioned, and read it back."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return read_declared(df.sparkSession, path, df.schema)


def _profiles(rows: DataFrame) -> list[dict]:
    """A few numbers for each source and snapshot; the calendar bounds them."""
    return [row.asDict() for row in rows.collect()]


def _block_failed_rows(ledger: Ledger, staged: DataFrame, profiles: list[dict], check: str) -> None:
    """Snapshots with rows that could not be read; their messages are looked up only if there are some."""
    if any(p["failed_rows"] for p in profiles):
        ledger.block(staged.where("failure IS NOT NULL"), check, F.col("failure"))


def clean_measurements(rows: DataFrame, warehouse: Warehouse, ledger: Ledger) -> tuple[DataFrame, list[dict]]:
    """Clean the measurement rows and keep the table of each snapshot whose files can be read and have one time each.

    Returns the table and its profile, one scan for every check and metric. What fails is in the ledger.
    """
    spark = rows.sparkSession
    staged = select_snapshots(_stage(clean.clean_measurements(rows), "cleaned"), ledger.good)
    profiles = _profiles(profile(staged, SOURCE_KEY, "value"))
    _block_failed_rows(ledger, staged, profiles, "raw_files")
    if any(p["first_text"] != p["last_text"] for p in profiles):
        conflicts = clean.time_conflicts(staged.where("failure IS NULL"), SOURCE_KEY)
        shown = F.concat(F.lit("Expected one observation time per file, found "), F.col("first"), F.lit(" … "), F.col("last"))
        ledger.block(conflicts, "one_time_per_file", shown)
    if not ledger.good:
        return staged, profiles
    # good tables are replaced by good ones only
    cleaned = _keep(select_snapshots(staged, ledger.good).drop("failure"), warehouse.cleaned)
    cleaned = select_snapshots(cleaned, ledger.good)
    by_source = {(p["snapshot_date"], p["source"]): p for p in profiles}
    wanted = [(day, m.name) for day in ledger.good for m in MEASUREMENTS]
    failing = sorted({day for day, name in wanted if (day, name) not in by_source or not keys_are_valid(by_source[day, name])})
    if failing:
        checks = key_check(select_snapshots(cleaned, failing), SOURCE_KEY, expected=expected_groups(spark, failing))
        ledger.block_rows(checks.where(~F.coalesce("passed", F.lit(False))), "valid_daily_weather_key")
    for day in ledger.good:
        dates = {by_source[day, m.name][bound] for m in MEASUREMENTS for bound in ("first_date", "last_date")}
        if len(dates) > 1:
            ledger.add("one_date", day, f"Daily weather requires one shared observation date per snapshot: {min(dates)} … {max(dates)}")
    return select_snapshots(cleaned, ledger.good), profiles


def clean_pollen(landed: DataFrame, warehouse: Warehouse, ledger: Ledger) -> DataFrame:
    """Clean the pollen envelopes, keep the tables that can be read, and check them."""
    payloads = landed.where(F.col("filename") == POLLEN_FILE).select("snapshot_date", "content")
    staged = _stage(clean.clean_pollen(payloads, "failure"), "pollen")
    profiles = _profiles(profile(staged, ["snapshot_date"]))
    _block_failed_rows(ledger, staged, profiles, "pollen_payloads")
    if not ledger.good:
        return staged
    pollen = _keep(select_snapshots(staged, ledger.good).drop("failure"), warehouse.pollen)
    pollen = select_snapshots(pollen, ledger.good)
    values = pollen_value_check(pollen, ["snapshot_date"])
    ledger.block_rows(values.where(~F.coalesce("passed", F.lit(False))), "valid_pollen_values")
    by_day = {p["snapshot_date"]: p for p in profiles}
    failing = [day for day in ledger.good if day not in by_day or not keys_are_valid(by_day[day])]
    if failing:
        expected = expected_groups(landed.sparkSession, failing, ("pollen",)).drop("source")
        checks = key_check(select_snapshots(pollen, failing), ["snapshot_date"], expected=expected)
        ledger.block_rows(checks.where(~F.coalesce("passed", F.lit(False))), "valid_daily_weather_key")
    return select_snapshots(pollen, ledger.good)


def _station_metrics(dimension: DataFrame, duplicates: int) -> DataFrame:
    counts = dimension.agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(duplicates).cast("long").alias("duplicate_station_count")
    )
    return metric_rows(counts.withColumn("snapshot_date", F.lit(None).cast("date")), "wmo_stations")


def _file_metrics(spark: SparkSession, path: str, days: list[dt.date]) -> DataFrame:
    """Address, size and sha256 of each file that was written for the days."""
    if not days:
        return spark.createDataFrame([], "snapshot_date date, table_name string, metric string, value string")
    files = written_files(spark, path, days).withColumn("snapshot_date", F.to_date("day")).drop("day")
    name = path.rsplit("/", 1)[-1]
    return metric_rows(files.withColumn("source", F.element_at(F.split("uri", "/"), -1)), name)


def _metrics(
    cleaned_counts: DataFrame, weather: DataFrame, pollen: DataFrame, conditions: DataFrame, hours: DataFrame
) -> DataFrame:
    """Counts, NULLs, dates and hours of every table, by snapshot; all small aggregates."""
    weather_counts = weather.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(weather.columns)).alias("column_count"),
        F.min("date").alias("observation_date"),
    )
    pollen_dates = pollen.groupBy("snapshot_date").agg(
        F.lit(len(pollen.columns)).alias("column_count"), F.min("date").alias("observation_date")
    )
    conditions_counts = conditions.groupBy(F.col("date").alias("snapshot_date")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(conditions.columns)).alias("column_count"),
        F.min("observed_at").alias("observed_at"),
    )
    parts = [
        metric_rows(cleaned_counts, "cleaned"),
        metric_rows(weather_counts, "daily_weather"),
        metric_rows(hours, "daily_weather"),
        metric_rows(pollen_dates, "pollen_cleaned"),
        metric_rows(null_counts(pollen, ["snapshot_date"], list(POLLEN_COLUMNS.values())), "pollen_cleaned"),
        metric_rows(conditions_counts, "daily_weather_conditions"),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def _profile_table(spark: SparkSession, profiles: list[dict], days: list[dt.date]) -> DataFrame:
    """What the metrics tell of the cleaned sources, from their profile."""
    rows = [
        (
            p["snapshot_date"],
            p["source"],
            p["row_count"],
            len(CLEANED_SCHEMAS[p["source"]]),
            p["null_count"],
            p["first_date"],
            p["first_at"],
            f"{p['snapshot_date']:%Y%m%d}/{p['source']}.csv",
        )
        for p in profiles
        if p["snapshot_date"] in set(days)
    ]
    schema = (
        "snapshot_date date, source string, row_count long, column_count int, null_count long, "
        "observation_date date, observed_at timestamp, object_key string"
    )
    return spark.createDataFrame(rows, schema)


def rebuild(
    spark: SparkSession,
    warehouse: Warehouse,
    station_master: str,
    dates: Iterable[dt.date] | None = None,
    measurements: str | None = None,
) -> BuildReport:
    """Build the published table of the given snapshots (today's by default) from landed objects.

    All six objects of every snapshot must be landed. With ``measurements``, a folder of raw files,
    the measurement files are read in place, as large files have to be.

    Snapshots do not depend on each other: one that fails a check is left behind with its reason, the others are
    published. Then the failures are appended to ``warehouse.failures`` and raised.
    """
    run_id = uuid.uuid4().hex
    ledger = Ledger(sorted(set(dates)) if dates is not None else [today()])
    report = _rebuild(spark, warehouse, station_master, ledger, measurements, run_id)
    ledger.write(spark, warehouse.failures, run_id)
    ledger.raise_failures()
    return report


def _rebuild(
    spark: SparkSession, warehouse: Warehouse, station_master: str, ledger: Ledger, measurements: str | None, run_id: str
) -> BuildReport:
    nothing = BuildReport(run_id, [], 0, 0)
    landed = select_snapshots(_landed(spark, warehouse.landing), ledger.days)
    objects = landed.select("snapshot_date", "filename")
    large = read_manifest(spark, warehouse.chunks)
    if large is not None:
        large = select_snapshots(large, ledger.days)
        objects = objects.unionByName(large.select(*objects.columns))
    folders = day_folders(spark, measurements, ledger.days) if measurements else []
    if folders:
        objects = objects.unionByName(file_payloads(spark, folders).select(*objects.columns))
    missing = missing_objects(expected_objects(spark, ledger.days), objects)
    key = F.concat_ws("/", snapshot_key(F.col("snapshot_date")), F.col("filename"))
    ledger.block(missing, RAW_OBJECTS, F.concat(F.lit("Raw objects missing: "), key))
    if not ledger.good:
        return nothing

    landed = select_snapshots(landed, ledger.good)
    if folders:
        wanted = {f"{day:%Y%m%d}" for day in ledger.good}
        rows = clean.measurement_file_rows(spark, [f for f in folders if f[-8:] in wanted], failure="failure")
    else:
        rows = clean.landed_measurement_rows(landed, "failure")
        if large is not None and not large.isEmpty():
            lines = chunk_lines(spark, warehouse.chunks, F.col("snapshot_date").isin(*ledger.good))
            rows = rows.unionByName(clean.chunked_measurement_rows(lines, "failure"))
    cleaned, profiles = clean_measurements(rows, warehouse, ledger)
    if not ledger.good:
        return nothing

    counts = _profile_table(spark, profiles, ledger.good)
    hours = _stage(source_times(counts), "hours")
    warn_of_differing_hours(hours)
    codes = extended_codes(cleaned, warehouse.codes)
    weather = _stage(wide_rows(cleaned, codes, hours.select("snapshot_date", "observed_at")), "daily_weather")
    conflicting = weather.join(conflicting_ids(weather).drop("n"), ["station_id", "date"])
    ledger.block(conflicting, "one_wmo_id", F.concat(F.lit("Conflicting WMO station ids for station ids: "), F.col("station_id")))

    described = described_stations(weather, read_station_master(spark, station_master))
    refused = weather.join(broadcast_if_small(refused_stations(described)), "station_id")
    ledger.block(refused, "station_master", F.concat_ws(": ", "reason", "station_id"))
    if not ledger.good:
        return nothing
    pollen = clean_pollen(select_snapshots(landed, ledger.good), warehouse, ledger)
    if not ledger.good:
        return nothing
    weather = select_snapshots(weather, ledger.good)
    wrong = mismatched_snapshots(weather, pollen)
    ledger.block(wrong, "same_keys", F.concat(F.lit(f"{MISMATCH}: "), F.col("station_id")))
    if not ledger.good:
        return nothing

    weather, pollen = select_snapshots(weather, ledger.good), select_snapshots(pollen, ledger.good)
    stations = usable_stations(described)
    written = write_verified(join_conditions(weather, stations.table, pollen), warehouse.conditions)
    published = read_published(spark, warehouse.conditions).where(F.col("date").isin(written["partitions"]))
    write_documents(geojson_documents(published), warehouse.geojson, "date")

    rows = _metrics(_profile_table(spark, profiles, ledger.good), weather, pollen, published, select_snapshots(hours, ledger.good))
    used = stations_in_use(weather).join(stations.table, ["station_id", "wmo_station_id"])
    rows = rows.unionByName(_station_metrics(used, stations.duplicate_count))
    for name in (warehouse.conditions, warehouse.geojson):
        rows = rows.unionByName(_file_metrics(spark, name, written["partitions"]))
    append_metrics(rows, warehouse.metrics, run_id)
    return BuildReport(run_id, written["partitions"], written["rows"], written["checksum"], stations.duplicate_ids)


def _landed(spark: SparkSession, landing: str) -> DataFrame:
    """The landing table; one that does not exist has no rows."""
    try:
        return read_landing(spark, landing)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LANDING_SCHEMA)


def build(
    spark: SparkSession,
    warehouse: Warehouse,
    incoming: str,
    station_master: str,
    dates: Iterable[dt.date] | None = None,
    downloaded_at: dt.datetime | None = None,
    max_bytes: int = MAX_PAYLOAD_BYTES,
) -> BuildReport:
    """Land the raw objects below ``incoming``, those above ``max_bytes`` in chunks, then ``rebuild``."""
    days = sorted(set(dates)) if dates is not None else [today()]
    # only the folders of these days are read
    folders = day_folders(spark, incoming, days)
    write_landing(landing_rows(spark, folders, downloaded_at, max_bytes=max_bytes), warehouse.landing)
    sizes = file_payloads(spark, folders).where((F.col("length") > max_bytes) & F.col("filename").isin(*MEASUREMENT_FILES))
    large = [row.path for row in sizes.select("path").collect()]  # a few files a day
    if large:
        write_chunks(chunk_rows(spark, large, max_bytes), warehouse.chunks)
    return rebuild(spark, warehouse, station_master, days)


def published_files(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Size and sha256 of the published data files."""
    return written_files(spark, warehouse.conditions)
