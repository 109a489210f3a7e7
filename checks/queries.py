"""One query per operator, each over whole tables; every query is lazy but for the engine's own checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.standins import (
    TYPES,
    conditions,
    dated_events,
    located,
    long_events,
    lookup,
    master,
    plain,
    pollen,
    published_conditions,
    responses,
    stations,
    table,
    wide,
)
from stationday.errors import DataQualityError
from stationday.functions.text import csv_fields, lenient_double, strict_cast, strip_text
from stationday.functions.time import (
    PARTS,
    floor_hour,
    iso_timestamp,
    snapshot_date,
    snapshot_key,
    with_observation_time,
)
from stationday.operators import clean
from stationday.operators.conditions import key_mismatches
from stationday.operators.joins import duplicate_keys, keys_without_match
from stationday.operators.merge import conflicting_ids, wide_rows
from stationday.operators.quality import (
    date_conflicts,
    key_check,
    null_counts,
    pollen_value_check,
    profile,
    source_times,
)
from stationday.operators.responses import unexpected_dates
from stationday.operators.stations import describe_stations, first_rows, refused_stations, stations_in_use
from stationday.plans import queries as q
from stationday.plans import sql
from stationday.plans.build import Warehouse, rebuild
from stationday.schemas import (
    CONDITIONS_SCHEMA,
    MEASUREMENT_CHARSET,
    MEASUREMENTS,
    POLLEN_COLUMNS,
    POLLEN_ENVELOPE_DDL,
    POLLEN_RESPONSE_DDL,
    STATION_MASTER_CHARSET,
    STATION_MASTER_HEADERS,
    TIME_HEADERS,
)
from stationday.session import java_charsets, work_folder
from stationday.sinks.documents import geojson_documents, geojson_features, read_documents, write_documents
from stationday.sinks.envelope import land_pollen, pollen_envelopes
from stationday.sinks.metrics import metric_rows
from stationday.sinks.parquet import write_verified
from stationday.sources.landing import expected_objects, landing_rows, missing_objects, payload_manifest, write_landing
from stationday.sources.published import read_declared, read_published
from stationday.sources.rawcsv import file_payloads
from stationday.sources.rawjson import parse_object

DAY = dt.date(2024, 1, 5)
POINT = (35.0, 139.0)
PARTS_PATTERN = r"key=(\d{8})/file=([^/]+)/part-[^/]+$"
PAD = "　  \t"


# --- merge and query surface


def wide_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(wide(spark, sf_dir).drop("snapshot_date"))


def all_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(q.all_weather_conditions(published_conditions(spark, sf_dir), DAY))


def _by_day(query, date=None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(query(published_conditions(spark, sf_dir), date).drop(*POLLEN_COLUMNS.values()))

    return run


def nearest_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = q.nearest_stations(published_conditions(spark, sf_dir), DAY, *POINT)
    return plain(found.select("date", "station_id", "station_name", F.round("distance_km", 6).alias("distance_km")))


def nearest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = q.nearest_stations(published_conditions(spark, sf_dir), None, *POINT)
    return plain(found.select("date", "station_id", "station_name", F.round("distance_km", 6).alias("distance_km")))


def _around_the_world(key, days: int) -> list:
    """A day and coordinates from a key: the whole globe, both poles and both sides of the 180th meridian."""
    return [
        F.date_add(F.lit(DAY), (key % days).cast("int")).alias("date"),
        ((key * 7919 % 180001).cast("double") / F.lit(1000.0) - F.lit(90.0)).alias("latitude"),
        ((key * 104729 % 360001).cast("double") / F.lit(1000.0) - F.lit(180.0)).alias("longitude"),
    ]


def nearest_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as points, customers as stations, dealt over the globe and ten days; stations lack on three of them."""
    stations = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("station_id"),
        F.col("c_name").alias("station_name"),
        *_around_the_world(F.col("c_custkey") + 17, 7),
    )
    points = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("point_id"), *_around_the_world(F.col("o_orderkey"), 10)
    )
    found = q.nearest_to_points(stations, points)
    return plain(found.select("point_id", "date", "station_id", "station_name", F.round("distance_km", 6).alias("distance_km")))


def nearest_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published stations of one day around points that lie close together, by their suppliers."""
    key = F.col("s_suppkey")
    points = table(spark, sf_dir, "supplier").select(
        key.alias("point_id"),
        ((key * 37 % 2100).cast("double") / F.lit(100.0) + F.lit(24.003)).alias("latitude"),
        ((key * 53 % 2300).cast("double") / F.lit(100.0) + F.lit(123.007)).alias("longitude"),
    )
    found = q.nearest_to_points(published_conditions(spark, sf_dir), points, DAY)
    return plain(found.select("point_id", "date", "station_id", "station_name", F.round("distance_km", 6).alias("distance_km")))


def _sql(text: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sql.register_view(published_conditions(spark, sf_dir))
        return plain(spark.sql(text).drop(*POLLEN_COLUMNS.values()))

    return run


# --- expressions


def dms_to_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = located(master(spark, sf_dir))
    return rows.select("station_id", *(F.round(c, 9).alias(c) for c in ("latitude", "longitude")))


def strip_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole pages between white space, and white space alone."""
    pages = table(spark, sf_dir, "pages")
    padded = pages.select("page_id", F.concat(F.lit(PAD), "html", F.lit(PAD)).alias("t"), F.lit(PAD).alias("blank"))
    return padded.select("page_id", F.sha2(strip_text(F.col("t")).cast("binary"), 256).alias("html"), strip_text(F.col("blank")).alias("blank"))


def lenient_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, prices and dates as numbers where they are numbers."""
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("key"), F.col("text").alias("t"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.explode(F.array(F.col("o_totalprice").cast("string"), F.col("o_orderdate").cast("date").cast("string"))).alias("t"),
    )
    rows = docs.unionByName(orders)
    return rows.select("key", F.round(lenient_double(F.col("t")), 6).alias("number"))


def lenient_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.regexp_extract("url", r"/([^/?#]*)(?:[?#].*)?$", 1)
    return table(spark, sf_dir, "pages").select("page_id", last.alias("part"), lenient_double(last).alias("number"))


def strict_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").cast("string").alias("price"),
        F.col("l_partkey").cast("string").alias("part"),
    )
    return items.select(
        "l_orderkey",
        "l_linenumber",
        strict_cast(F.col("price"), CONDITIONS_SCHEMA["latitude"].dataType, F.lit("price")).alias("price"),
        strict_cast(F.col("part"), CONDITIONS_SCHEMA["max_wind_quality"].dataType, F.lit("part")).alias("part"),
    )


def csv_line_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as quoted CSV fields, taken apart again."""
    docs = table(spark, sf_dir, "documents")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    lines = docs.select("doc_id", F.concat_ws(",", "lang", quoted, "source", F.lit("")).alias("line"))
    fields = lines.select("doc_id", csv_fields(F.col("line")).alias("f"))
    return fields.select(
        "doc_id",
        F.size("f").cast("long").alias("width"),
        F.col("f")[0].alias("lang"),
        F.sha2(F.col("f")[1], 256).alias("text_sha256"),
        F.col("f")[2].alias("source"),
    )


def observed_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = dated_events(spark, sf_dir)
    return plain(events.select("event_id", floor_hour(F.col("at")).alias("hour")))


def hour24(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as five time texts, hours 0 to 24, back to date and instant."""
    key = F.col("o_orderkey")
    hour = key % 25
    texts = {
        "year": F.date_format("o_orderdate", "yyyy"),
        "month": F.date_format("o_orderdate", "MM"),
        "day": F.date_format("o_orderdate", "dd"),
        "hour": F.lpad(hour.cast("string"), 2, "0"),
        "minute": F.when(hour == 24, F.lit("00")).otherwise((key % 60).cast("string")),
    }
    parts = table(spark, sf_dir, "orders").select("o_orderkey", *(texts[p].alias(p) for p in PARTS))
    timed = with_observation_time(parts)
    return plain(timed.withColumn("observed_at", iso_timestamp(F.col("observed_at"))))


def refused_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time texts out of range: hours up to 26, minutes up to 62, days up to 33."""
    key = F.col("o_orderkey")
    texts = {
        "year": F.date_format("o_orderdate", "yyyy"),
        "month": F.date_format("o_orderdate", "MM"),
        "day": (key % 33 + 1).cast("string"),
        "hour": (key % 27).cast("string"),
        "minute": (key % 63).cast("string"),
    }
    parts = table(spark, sf_dir, "orders").select("o_orderkey", *(texts[p].alias(p) for p in PARTS))
    timed = with_observation_time(parts, failure="failure")
    return plain(timed.where("failure IS NOT NULL").select("o_orderkey", "date", "failure"))


def snapshot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).count()
    key = days.select("date", snapshot_key(F.col("date")).alias("key"), F.col("count").alias("n"))
    return plain(key.withColumn("back", snapshot_date(F.col("key"))))


def json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated_events(spark, sf_dir).select("event_id", "k", (F.col("k").between(0, 5)).cast("int").alias("in_range"))


# --- checks


def _with_lacking_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, some of them without a station."""
    return long_events(spark, sf_dir).withColumn("station_id", F.when(F.col("quality") % 31 != 0, F.col("station_id")))


def _group_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = key_check(_with_lacking_keys(spark, sf_dir), ["snapshot_date", "source"])
    names = ["null_key_row_count", "duplicate_key_count", "date_count", "observed_at_count", "row_count"]
    return plain(result.select("snapshot_date", "source", *names, F.col("passed").cast("int").alias("passed")))


def source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one scan tells of each source and day."""
    found = profile(_with_lacking_keys(spark, sf_dir), ["snapshot_date", "source"], "direction")
    names = ["null_key_row_count", "duplicate_key_count", "row_count", "null_count", "first_at", "last_at", "first_date", "last_date"]
    mixed = (F.col("first_text") != F.col("last_text")).cast("int").alias("several_times")
    return plain(found.select("snapshot_date", "source", *names, mixed))


def duplicate_event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(duplicate_keys(long_events(spark, sf_dir), ["station_id", "date"]))


def conflicting_wmo_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conflicts arise when events of a type count under another id than the rest."""
    rows = long_events(spark, sf_dir).withColumn(
        "wmo_station_id",
        F.when(F.col("source") == "precipitation", F.concat("wmo_station_id", F.lit("-B"))).otherwise(
            F.col("wmo_station_id")
        ),
    )
    return plain(conflicting_ids(wide_rows(rows)))


def shared_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates that do not agree: snapshots by week, dates by day."""
    rows = long_events(spark, sf_dir).withColumn("snapshot_date", F.date_trunc("week", "date").cast("date"))
    return plain(date_conflicts(rows))


def file_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(clean.time_conflicts(long_events(spark, sf_dir), ["snapshot_date", "source"]))


def oldest_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = source_times(long_events(spark, sf_dir))
    return plain(times.withColumn("differs", F.col("differs").cast("int")))


def null_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(null_counts(wide(spark, sf_dir), ["date"], [m.value for m in MEASUREMENTS]))


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = null_counts(long_events(spark, sf_dir), ["snapshot_date", "source"], ["wmo_station_id", "direction"])
    return plain(metric_rows(counts, "cleaned"))


def key_set_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of one measurement against keys of all others."""
    long = long_events(spark, sf_dir)
    first = F.col("source") == "max_temperature"
    return plain(key_mismatches(long.where(first), long.where(~first), ["station_id", "date"]))


# --- stations


def missing_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("station_id"))
    return keys_without_match(dated_events(spark, sf_dir), known, ["station_id"])


def first_duplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = dated_events(spark, sf_dir).select("station_id", "event_id", "event_type", "value", "k")
    return first_rows(events, ["station_id"], "event_id").select("station_id", "n", "event_id", "event_type", "value", "k")


def station_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations in use, described by customers; suppliers give later, duplicate rows."""
    rows = master(spark, sf_dir)
    again = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 10_000_000_000).alias("place"),
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.col("s_name").alias("station_name"),
        *(F.lit("1").alias(c) for c in rows.columns if c.endswith(("degrees", "minutes"))),
    )
    described = describe_stations(stations_in_use(long_events(spark, sf_dir)), rows.unionByName(again))
    return described.withColumns({c: F.round(c, 9) for c in ("latitude", "longitude")})


def refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations whose master row lacks, or cannot be read: every fifth customer is left out, every seventh has a broken degree."""
    rows = master(spark, sf_dir).where("place % 5 <> 0")
    broken = F.when(F.col("place") % 7 == 0, F.lit("3x")).otherwise(F.col("latitude_degrees"))
    in_use = stations_in_use(long_events(spark, sf_dir))
    return refused_stations(describe_stations(in_use, rows.withColumn("latitude_degrees", broken)))


def lacking_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw objects that each day needs and does not have: all pollen, and one measurement every seventh day."""
    long = long_events(spark, sf_dir)
    dates = [row[0] for row in long.select("date").distinct().collect()]  # the calendar
    landed = long.where(~((F.dayofmonth("date") % 7 == 3) & (F.col("source") == "max_gust"))).select(
        "snapshot_date", F.concat("source", F.lit(".csv")).alias("filename")
    )
    return plain(missing_objects(expected_objects(spark, dates), landed))


# --- pollen


def repeated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses whose list names a known type twice: one entry for each event of a station and day."""
    entries = dated_events(spark, sf_dir).select(
        F.col("date").alias("snapshot_date"), "station_id", lookup(TYPES, "event_type").alias("code"), F.lit(1).cast("long").alias("value")
    )
    info = F.struct(F.struct("value").alias("indexInfo"), "code")
    ddl = POLLEN_RESPONSE_DDL
    listed = entries.groupBy("snapshot_date", "station_id").agg(F.collect_list(info).alias("pollenTypeInfo"))
    response = F.to_json(F.struct(F.array(F.struct("pollenTypeInfo")).alias("dailyInfo")))
    results = listed.select("snapshot_date", "station_id", parse_object(response, ddl).alias("response"), F.lit(None).cast("string").alias("failure"))
    failed = clean.clean_pollen_results(results).where(F.col("failure").startswith("Duplicate pollen type for station"))
    return plain(failed.select("snapshot_date", "station_id"))


def _groups(pollen_rows: DataFrame) -> DataFrame:
    return plain(pollen_rows.select("station_id", "date", *POLLEN_COLUMNS.values()))


def nested_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _groups(pollen(spark, sf_dir))


def envelope_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses into envelopes and, as landed bytes, out of them again."""
    envelopes = pollen_envelopes(responses(spark, sf_dir), results_per_envelope=50)
    payloads = envelopes.select("snapshot_date", F.encode("payload", "UTF-8").alias("content"))
    return _groups(clean.clean_pollen(payloads))


def envelope_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelopes = pollen_envelopes(responses(spark, sf_dir))
    parsed = parse_object(F.col("payload"), POLLEN_ENVELOPE_DDL)["results"]
    counted = envelopes.select("snapshot_date", "station_count", F.size(parsed).cast("long").alias("results"))
    sums = (F.sum(c).alias(c) for c in ("station_count", "results"))
    return plain(counted.groupBy("snapshot_date").agg(*sums))


def pollen_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = pollen_value_check(pollen(spark, sf_dir), ["date"])
    return plain(check.withColumn("passed", F.col("passed").cast("int")))


def forecast_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses dated by the order, snapshots up to two days later."""
    orders = table(spark, sf_dir, "orders")
    date = F.col("o_orderdate").cast("date")
    day = F.struct(
        F.struct(F.year(date).alias("year"), F.month(date).alias("month"), F.dayofmonth(date).alias("day")).alias("date")
    )
    rows = orders.select(
        F.date_add(date, (F.col("o_orderkey") % 3).cast("int")).alias("snapshot_date"),
        F.col("o_orderkey").cast("string").alias("station_id"),
        F.to_json(F.struct(F.array(day).alias("dailyInfo"))).alias("response"),
    )
    got = F.make_date("got.year", "got.month", "got.day").alias("got")
    return plain(unexpected_dates(rows).select("snapshot_date", "station_id", got))


# --- joins and sinks


def joined_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(conditions(spark, sf_dir))


def payload_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("content"))
    return payload_manifest(pages, "page_id", "content")


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_folder(spark, "published")
    write_verified(conditions(spark, sf_dir), root)
    return plain(read_published(spark, root))


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that differ in columns, their order and their types, under one schema."""
    root = work_folder(spark, "mixed")
    events = dated_events(spark, sf_dir).drop("at")
    clicks = F.col("event_type") == "click"
    events.where(clicks).drop("k").write.parquet(f"{root}/part=1")
    columns = ["k", *(c for c in events.columns if c != "k")]
    narrow = events.where(~clicks).withColumn("k", F.col("k").cast("int"))
    narrow.select(*columns).write.parquet(f"{root}/part=2")
    return plain(read_declared(spark, root, events.schema))


def union_undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that differ in columns and number types, all kept: as the view over published days shows them."""
    root = work_folder(spark, "undeclared")
    events = dated_events(spark, sf_dir).drop("at")
    odd = F.dayofmonth("date") % 2 == 1
    declared = T.StructType([f for f in events.schema if f.name not in ("k", "value")])
    events.where(~odd).drop("value").write.partitionBy("date").parquet(root)
    narrow = events.where(odd).withColumn("k", F.col("k").cast("int"))
    narrow.write.mode("append").partitionBy("date").parquet(root)
    return plain(read_published(spark, root, declared, undeclared=True))


def geojson_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature's text, parsed again: geometry, and properties back to the published columns."""
    features = geojson_features(published_conditions(spark, sf_dir))
    properties = ", ".join(
        f"{f.name}: {'string' if f.name == 'observed_at' else f.dataType.simpleString()}"
        for f in CONDITIONS_SCHEMA
        if f.name not in ("latitude", "longitude")
    )
    ddl = (
        "struct<type: string, geometry: struct<type: string, coordinates: array<double>>, "
        f"properties: struct<{properties}>>"
    )
    parsed = features.select(parse_object(F.col("feature"), ddl).alias("f"))
    return plain(
        parsed.select(
            F.col("f.type").alias("feature_type"),
            F.col("f.geometry.type").alias("geometry_type"),
            F.round(F.col("f.geometry.coordinates")[0], 9).alias("longitude"),
            F.round(F.col("f.geometry.coordinates")[1], 9).alias("latitude"),
            "f.properties.*",
        )
    )


def written_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every written document, parsed: how many a day has, and the features and stations in them."""
    root = work_folder(spark, "geojson")
    write_documents(geojson_documents(published_conditions(spark, sf_dir)), root, "date")
    collection = "struct<type: string, features: array<struct<type: string, properties: struct<station_id: string>>>>"
    lines = read_documents(spark, root, CONDITIONS_SCHEMA["date"])
    parsed = lines.select("date", F.monotonically_increasing_id().alias("document"), parse_object(F.col("line"), collection).alias("d"))
    features = parsed.where("d.type = 'FeatureCollection'").select("date", "document", F.explode("d.features").alias("f"))
    return plain(
        features.groupBy("date").agg(
            F.count_distinct("document").alias("documents"),
            F.count_if(F.col("f.type") == "Feature").alias("features"),
            F.count_distinct("f.properties.station_id").alias("stations"),
        )
    )


# --- raw files


def _write_raw(spark: SparkSession, rows: DataFrame, root: str, spoil=lambda name, files: files) -> None:
    """Long rows as raw measurement files: one header per file, legacy encoding, a fixed hour a day.

    Hours run from 1 to 24; the file of a 24th reads 24:00. ``spoil`` may change the files of a measurement.
    """
    day = F.dayofmonth("date")
    texts = {
        "year": F.date_format("date", "yyyy"),
        "month": F.date_format("date", "MM"),
        "day": F.date_format("date", "dd"),
        "hour": F.pmod(day, F.lit(25)).cast("string"),
        "minute": F.when(F.pmod(day, F.lit(25)) == 24, F.lit("00")).otherwise(F.lit("50")),
    }
    headers = {
        "precipitation": ("7日の値(mm)", "7日の値の品質情報"),
        "max_temperature": ("7日の最高気温(℃)", "7日の最高気温の品質情報"),
        "min_temperature": ("7日の最低気温(℃)", "7日の最低気温の品質情報"),
        "max_wind": ("7日の最大値(m/s)", "7日の最大値の品質情報", "7日の最大値観測時の風向", "7日の最大値観測時の風向の品質情報"),
        "max_gust": ("7日の最大値(m/s)", "7日の最大値の品質情報", "7日の最大値観測時の風向", "7日の最大値観測時の風向の品質情報"),
    }
    for name, measures in headers.items():
        slots = ("value", "quality", "direction", "direction_quality")[: len(measures)]
        files = rows.where(F.col("source") == name).select(
            snapshot_key(F.col("date")).alias("key"),
            F.lit(f"{name}.csv").alias("file"),
            F.col("station_id").alias("観測所番号"),
            F.col("wmo_station_id").alias("国際地点番号"),
            *(texts[p].alias(header) for p, header in TIME_HEADERS.items()),
            *(F.col(s).cast("string").alias(h) for s, h in zip(slots, measures)),
        )
        files = spoil(name, files)
        writer = files.hint("rebalance", "key").write.partitionBy("key", "file").mode("append")
        with java_charsets(spark):
            writer.option("header", "true").option("escape", '"').option("encoding", MEASUREMENT_CHARSET).csv(root)


def _raw_roundtrip(whole: bool):
    """Raw files back to rows, as whole payloads or as lines of files cut anywhere."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_folder(spark, "raw")
        _write_raw(spark, long_events(spark, sf_dir), root)
        if whole:
            rows = clean.landed_measurement_rows(file_payloads(spark, root, PARTS_PATTERN))
        else:
            rows = clean.measurement_file_rows(spark, root, pattern=PARTS_PATTERN, names=None)
        cleaned = clean.clean_measurements(rows).withColumn("observed_at", iso_timestamp(F.col("observed_at")))
        return plain(cleaned.drop("observed_text"))

    return run


def _rebuilt(spark: SparkSession, sf_dir: str, spoil=lambda name, files: files, spoil_pollen=lambda rows: rows, through=rebuild):
    """Raw files and pollen responses, landed, cleaned, checked, merged and published; the warehouse and what failed."""
    root = work_folder(spark, "full")
    warehouse = Warehouse(f"{root}/warehouse")
    keys = ["snapshot_date", "source", "station_id", "wmo_station_id", "date"]
    names = ("value", "quality", "direction", "direction_quality")
    long = long_events(spark, sf_dir).groupBy(*keys).agg(*(F.max(c).alias(c) for c in names))
    _write_raw(spark, long, f"{root}/incoming", spoil)
    described = master(spark, sf_dir)
    renamed = described.select(*(F.col(c).alias(h) for c, h in STATION_MASTER_HEADERS.items()))
    with java_charsets(spark):
        renamed.write.option("header", "true").option("encoding", STATION_MASTER_CHARSET).csv(f"{root}/master")
    stamp = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    write_landing(landing_rows(spark, f"{root}/incoming", stamp, PARTS_PATTERN), warehouse.landing)
    in_use = long.where(F.col("wmo_station_id").isNotNull()).select("station_id", "snapshot_date").distinct()
    pollen_rows = responses(spark, sf_dir, index_values=6).join(in_use, ["station_id", "snapshot_date"])
    spoil_pollen(pollen_rows).write.parquet(f"{root}/responses")
    land_pollen(spark.read.parquet(f"{root}/responses"), warehouse.landing, stamp)
    # one date per snapshot: the calendar bounds the list
    dates = [row[0] for row in long.select("date").distinct().collect()]
    try:
        through(spark, warehouse, f"{root}/master/*.csv", dates)
        failures = []
    except DataQualityError as error:
        failures = error.failures
    return warehouse, failures


def _published(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    published = read_published(spark, warehouse.conditions)
    return plain(published.withColumn("observed_at", iso_timestamp(F.col("observed_at"))))


def full_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end: every day is good."""
    warehouse, failures = _rebuilt(spark, sf_dir)
    if failures:
        raise DataQualityError(f"Unexpected failures: {failures!r}")
    return _published(spark, warehouse)


def _spoiled(name: str, files: DataFrame) -> DataFrame:
    """What is wrong on some days: a value, a time, a lacking file, a row given twice, two WMO ids of a station."""

    def on(*days: int):
        return F.substring("key", 7, 2).cast("int").isin(*days)

    def change(column: str, day: int, text: str) -> DataFrame:
        return files.withColumn(column, F.when(on(day), F.lit(text)).otherwise(F.col(column)))

    if name == "precipitation":
        return change("7日の値の品質情報", 4, "many").withColumn(
            "国際地点番号", F.when(on(22), F.concat("国際地点番号", F.lit("-B"))).otherwise(F.col("国際地点番号"))
        )
    if name == "max_wind":
        return change(TIME_HEADERS["hour"], 7, "25")
    if name == "max_gust":
        return files.where(~on(10))
    if name == "min_temperature":
        return files.unionByName(files.where(on(13)))
    return files


def _spoiled_pollen(rows: DataFrame) -> DataFrame:
    """A type given twice, an index out of range, stations without a response."""
    day = F.dayofmonth("snapshot_date")
    info = (
        F.lit('"pollenTypeInfo":[{"code":"TREE"},{"code":"TREE"}],"plantInfo":[]'),
        F.lit('"pollenTypeInfo":[{"code":"TREE","indexInfo":{"value":9}}],"plantInfo":[]'),
    )
    head = F.date_format("snapshot_date", "'{\"dailyInfo\":[{\"date\":{\"year\":'yyyy',\"month\":'M',\"day\":'d'},'")
    text = F.when(day == 16, F.concat(head, info[0], F.lit("}]}"))).when(day == 19, F.concat(head, info[1], F.lit("}]}")))
    rows = rows.withColumn("response", F.coalesce(text, "response"))
    lacking = rows.where(day == 25).agg(F.min("station_id").alias("lacking"))
    kept = rows.join(F.broadcast(lacking), (day == 25) & (F.col("station_id") == F.col("lacking")), "left_anti")
    return kept


def rebuild_with_bad_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight days fail, each in its own way; exactly the others are published."""
    warehouse, _ = _rebuilt(spark, sf_dir, _spoiled, _spoiled_pollen)
    return _published(spark, warehouse)


def failed_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, but what the table of failures says."""
    warehouse, _ = _rebuilt(spark, sf_dir, _spoiled, _spoiled_pollen)
    failures = spark.read.parquet(warehouse.failures)
    return plain(failures.select("snapshot_date", "source", "check").distinct())


QUERIES = {
    "wide_daily": wide_daily,
    "daily_summary_all": _by_day(q.daily_summary),
    "daily_summary_one": _by_day(q.daily_summary, DAY),
    "hottest_all": _by_day(q.hottest),
    "coldest_all": _by_day(q.coldest),
    "highest_precipitation_all": _by_day(q.highest_precipitation),
    "strongest_gust_all": _by_day(q.strongest_gust),
    "all_conditions": all_conditions,
    "nearest_one": nearest_one,
    "nearest_all": nearest_all,
    "nearest_many": nearest_many,
    "nearest_suppliers": nearest_suppliers,
    "sql_all_conditions": _sql("SELECT * FROM all_weather_conditions(DATE '2024-01-05')"),
    "sql_hottest": _sql("SELECT * FROM hottest(DATE '2024-01-05')"),
    "sql_coldest": _sql("SELECT * FROM coldest(p_date => DATE '2024-01-05')"),
    "sql_highest_precipitation": _sql("SELECT * FROM highest_precipitation(DATE '2024-01-05')"),
    "sql_strongest_gust": _sql("SELECT * FROM strongest_gust(DATE '2024-01-05')"),
    "sql_daily_summary": _sql("SELECT * FROM daily_summary(DATE '2024-01-05')"),
    "sql_nearest": _sql(
        "SELECT date, station_id, station_name, round(distance_km, 6) AS distance_km "
        "FROM nearest_stations(DATE '2024-01-05', 35.0, 139.0)"
    ),
    "sql_adhoc": _sql(
        "SELECT station_name, count(*) AS days, max(max_temperature_c) AS hottest "
        "FROM weather_conditions WHERE max_temperature_c > 20 GROUP BY station_name ORDER BY station_name"
    ),
    "dms_to_decimal": dms_to_decimal,
    "strip_text": strip_titles,
    "lenient_cast": lenient_numbers,
    "lenient_texts": lenient_texts,
    "strict_cast": strict_numbers,
    "csv_line_fields": csv_line_fields,
    "observed_hour": observed_hour,
    "hour24": hour24,
    "refused_times": refused_times,
    "snapshot_keys": snapshot_keys,
    "json_values": json_values,
    "key_check": _group_check,
    "source_profile": source_profile,
    "duplicate_keys": duplicate_event_keys,
    "conflicting_ids": conflicting_wmo_ids,
    "date_conflicts": shared_dates,
    "time_conflicts": file_times,
    "source_times": oldest_hours,
    "null_counts": null_measures,
    "run_metrics": run_metrics,
    "key_mismatches": key_set_mismatches,
    "missing_master": missing_master,
    "first_duplicate": first_duplicate,
    "station_dimension": station_dimension,
    "refused_stations": refused,
    "missing_objects": lacking_objects,
    "repeated_codes": repeated_codes,
    "nested_groups": nested_groups,
    "envelope_roundtrip": envelope_roundtrip,
    "envelope_counts": envelope_counts,
    "pollen_values": pollen_values,
    "forecast_dates": forecast_dates,
    "conditions": joined_conditions,
    "payload_manifest": payload_digests,
    "publish_roundtrip": publish_roundtrip,
    "union_by_name": union_by_name,
    "union_undeclared": union_undeclared,
    "geojson_roundtrip": geojson_roundtrip,
    "geojson_documents": written_geojson,
    "raw_csv_roundtrip": _raw_roundtrip(whole=True),
    "raw_csv_split_roundtrip": _raw_roundtrip(whole=False),
    "full_rebuild": full_rebuild,
    "rebuild_with_bad_days": rebuild_with_bad_days,
    "failed_snapshots": failed_snapshots,
}
