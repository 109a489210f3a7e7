"""The landing table: raw objects kept byte for byte, one row per object.

Partitioned by ``snapshot_date`` and ``filename``, as the objects' keys are, so that landing a
day again replaces that day's object only, and a reader of one measurement opens no other files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationday.errors import MissingRawObjects, VerificationError
from stationday.functions.time import snapshot_key, today
from stationday.operators.joins import SHOWN_IDS, first_and_total, in_all
from stationday.schemas import LANDING_SCHEMA, POLLEN_FILE, RAW_FILENAMES, SOURCE_URLS
from stationday.sources.published import read_declared
from stationday.session import work_folder
from stationday.sources.rawcsv import OBJECT_KEY, file_payloads


def digest(content: Column) -> Column:
    return F.sha2(content, 256)


def payload_manifest(objects: DataFrame, key: str, content: str) -> DataFrame:
    """``key``, byte length and sha256 of each payload."""
    return objects.select(
        key, F.octet_length(F.col(content)).cast("long").alias("size"), digest(F.col(content)).alias("sha256")
    )


MAX_PAYLOAD_BYTES = 256 * 1024 * 1024


def require_landable(files: DataFrame, max_bytes: int = MAX_PAYLOAD_BYTES) -> None:
    """A landed pollen envelope is one value, held by one task; larger ones have to come in parts."""
    too_large = files.where((F.col("length") > max_bytes) & (F.col("filename") == POLLEN_FILE))
    large = [r.path for r in too_large.select("path").limit(SHOWN_IDS).collect()]
    if large:
        raise ValueError(
            f"Objects above {max_bytes} bytes cannot be landed: {large!r}. Large pollen envelopes are landed in several parts."
        )


def landing_rows(
    spark: SparkSession,
    incoming: str | list[str],
    downloaded_at: dt.datetime | None = None,
    pattern: str = OBJECT_KEY,
    max_bytes: int = MAX_PAYLOAD_BYTES,
) -> DataFrame:
    """The raw objects below ``incoming`` (``YYYYMMDD/filename``, or such folders) as rows of the landing table.

    Other files are left alone, and measurement files above ``max_bytes``, which ``chunks.chunk_rows`` takes.
    """
    files = file_payloads(spark, incoming, pattern).where(
        F.col("filename").isin(*RAW_FILENAMES) & F.col("snapshot_date").isNotNull()
    )
    require_landable(files)
    files = files.where((F.col("filename") == POLLEN_FILE) | (F.col("length") <= max_bytes))
    urls = F.create_map(*(F.lit(x) for pair in SOURCE_URLS.items() for x in pair))
    is_pollen = F.col("filename") == POLLEN_FILE
    stamp = F.col("modificationTime") if downloaded_at is None else F.lit(downloaded_at)
    return files.select(
        F.concat_ws("/", snapshot_key(F.col("snapshot_date")), F.col("filename")).alias("object_key"),
        F.when(~is_pollen, urls[F.col("filename")]).alias("source_url"),
        F.when(is_pollen, "application/json").otherwise("text/csv").alias("content_type"),
        stamp.cast("timestamp").alias("downloaded_at"),
        F.octet_length("content").cast("long").alias("size"),
        digest(F.col("content")).alias("sha256"),
        "content",
        "snapshot_date",
        "filename",
    )


def write_landing(rows: DataFrame, landing: str) -> DataFrame:
    """Write rows of the landing table, read them back and compare their bytes' digests.

    Returns the manifest of the objects written.
    """
    spark = rows.sparkSession
    rows.write.partitionBy("snapshot_date", "filename").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(landing)
    # what was sent, part by part: several parts may share one object's key
    part = ["object_key", "size", "sha256"]
    path = work_folder(spark, "sent")
    rows.groupBy("snapshot_date", *part).agg(F.count(F.lit(1)).alias("parts")).write.parquet(path)
    sent = spark.read.parquet(path)
    stored = read_landing(spark, landing).join(
        F.broadcast(sent.select("snapshot_date").distinct()), "snapshot_date", "left_semi"
    )
    wrong = stored.where((digest(F.col("content")) != F.col("sha256")) | (F.octet_length("content") != F.col("size")))
    keys = [row[0] for row in wrong.select("object_key").limit(SHOWN_IDS).collect()]
    if keys:
        raise VerificationError(f"Landed bytes do not match their payload: {keys!r}")
    kept = stored.groupBy(*part).agg(F.count(F.lit(1)).alias("parts"))
    lost, total = first_and_total(sent.join(kept, [*part, "parts"], "left_anti").select("object_key").distinct(), "object_key")
    if total:
        keys = [row[0] for row in lost]
        raise VerificationError(f"Objects not landed whole: {keys!r}{in_all(keys, total)}")
    return stored.drop("content")


def read_landing(spark: SparkSession, landing: str) -> DataFrame:
    return read_declared(spark, landing, LANDING_SCHEMA)


def select_snapshots(landed: DataFrame, dates: Iterable[dt.date] | None = None) -> DataFrame:
    """Rows of the given snapshots, today's in Japan by default; prunes partitions."""
    wanted = [today()] if dates is None else list(dates)
    return landed.where(F.col("snapshot_date").isin(*wanted))


def expected_objects(spark: SparkSession, dates: Iterable[dt.date]) -> DataFrame:
    """The six objects every snapshot needs."""
    schema = T.StructType([T.StructField("snapshot_date", T.DateType())])
    names = F.explode(F.array(*(F.lit(n) for n in RAW_FILENAMES))).alias("filename")
    return spark.createDataFrame([(d,) for d in sorted(set(dates))], schema).select("snapshot_date", names)


def missing_objects(expected: DataFrame, landed: DataFrame) -> DataFrame:
    return expected.join(landed.select("snapshot_date", "filename"), ["snapshot_date", "filename"], "left_anti")


def require_objects(expected: DataFrame, landed: DataFrame) -> None:
    missing, total = first_and_total(missing_objects(expected, landed), "snapshot_date", "filename")
    if total:
        names = [f"{row.snapshot_date:%Y%m%d}/{row.filename}" for row in missing]
        raise MissingRawObjects(f"Raw objects missing: {names!r}{in_all(names, total)}")


def day_folders(spark: SparkSession, root: str, dates: Iterable[dt.date]) -> list[str]:
    """The folders ``YYYYMMDD`` below ``root`` that hold files, of the given days only; none is an error.

    The root is listed once; no file is opened.
    """
    wanted = {f"{day:%Y%m%d}" for day in dates}
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = []
    else:
        key = F.regexp_extract("path", r"/(\d{8})/[^/]+$", 1)
        found = [row[0] for row in files.select(key.alias("key")).where(F.col("key").isin(*wanted)).distinct().collect()]
    if not found:
        shown = sorted(wanted)[:SHOWN_IDS]
        raise MissingRawObjects(f"Raw objects missing: no folder of {shown!r} below {root}{in_all(shown, len(wanted))}")
    return [f"{root.rstrip('/')}/{key}" for key in sorted(found)]
