"""JSON documents, one per day, each whole by itself and read back after writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationday.errors import VerificationError
from stationday.functions.time import ISO_TIMESTAMP
from stationday.operators.joins import per_group
from stationday.schemas import JAPAN_TIME
from stationday.session import work_folder

GEOJSON_HEAD, GEOJSON_TAIL = '{"type":"FeatureCollection","features":[', "]}"
#: Features of one document, some 15 MB of text. A day with more has several documents, none is left out.
FEATURES_PER_DOCUMENT = 20_000


def to_compact_json(value: Column) -> Column:
    """Compact JSON text: NULL members kept, characters unescaped, instants in Japan time."""
    return F.to_json(
        value, {"ignoreNullFields": "false", "timeZone": JAPAN_TIME, "timestampFormat": ISO_TIMESTAMP}
    )


def geojson_feature(columns: list[str]) -> Column:
    """A Point feature at ``[longitude, latitude]`` with every other column as a property."""
    properties = F.struct(*(F.col(c) for c in columns if c not in ("longitude", "latitude")))
    geometry = F.struct(
        F.lit("Point").alias("type"), F.array(F.col("longitude"), F.col("latitude")).alias("coordinates")
    )
    return F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties"))


def geojson_features(conditions: DataFrame) -> DataFrame:
    """``date, station_id, feature``: newline-delimited features, which need no order at all."""
    return conditions.select(
        "date", "station_id", to_compact_json(geojson_feature(conditions.columns)).alias("feature")
    )


def day_documents(items: DataFrame, day: str, order: str, text: Column, head: str, tail: str, limit: int) -> DataFrame:
    """``day, document, features, line``: every line is a complete document of about ``limit`` items at most.

    A day of up to ``limit`` items is one document; a larger day is dealt by hash into several, so that
    no row holds more than a bounded share of it. Items are in the order of ``order`` within a document.
    """
    sizes = items.groupBy(F.col(day).alias("_day")).agg(F.expr(f"(count(1) - 1) div {limit} + 1").alias("_documents"))
    document = F.expr(f"pmod(xxhash64({order}), _documents)").alias("document")
    features = F.sort_array(F.collect_list(F.struct(F.col(order).alias("key"), text.alias("text"))))
    gathered = (
        items.join(per_group(sizes, day), F.col(day) == F.col("_day"))
        .groupBy(day, document)
        .agg(features.alias("features"))
    )
    line = F.concat(F.lit(head), F.concat_ws(",", "features.text"), F.lit(tail))
    return gathered.select(day, "document", F.size("features").cast("long").alias("features"), line.alias("line"))


def _line_metrics(day: str, line: str, features: Column) -> list[Column]:
    checksum = F.sum(F.xxhash64(day, line).cast("decimal(38,0)"))
    return [
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum(features), F.lit(0)).alias("features"),
        F.coalesce(checksum, F.lit(0)).alias("checksum"),
    ]


def write_documents(documents: DataFrame, path: str, day: str) -> dict[str, int]:
    """Write the documents of each day, one a line, read them back and compare; returns the metrics.

    A day with one document is one file, which is JSON by itself. Read back are the texts, and the
    features that a JSON parser finds in them: first in a folder of the run, and only if all is well there
    the days below ``path`` are replaced, and compared again.
    """
    spark = documents.sparkSession
    seen = Observation()
    draft = work_folder(spark, "draft-documents")
    observed = documents.observe(
        seen, *_line_metrics(day, "line", F.col("features")), F.collect_set(day).alias("days")
    ).select(day, "line")
    observed.write.partitionBy(day).text(draft)
    sent = seen.get
    days = sent.pop("days")
    if not days:
        return sent
    _same_documents(sent, spark, draft, documents.schema[day], days)
    # a document is one line; the lines of a day stay in its own files
    lines = read_documents(spark, draft, documents.schema[day])
    lines.write.partitionBy(day).mode("overwrite").option("partitionOverwriteMode", "dynamic").text(path)
    return _same_documents(sent, spark, path, documents.schema[day], days)


def _same_documents(sent: dict, spark: SparkSession, path: str, day: T.StructField, days: list) -> dict:
    kept = read_documents(spark, path, day).where(F.col(day.name).isin(sorted(days)))
    found = F.coalesce(F.json_array_length(F.get_json_object("line", "$.features")), F.lit(-1))
    back = kept.agg(*_line_metrics(day.name, "line", found)).first().asDict()
    if sent != back:
        raise VerificationError(f"Documents read back from {path} differ from those written: {sent} != {back}")
    return back


def read_documents(spark: SparkSession, path: str, day: T.StructField) -> DataFrame:
    """``line`` and the day of every written document."""
    return spark.read.schema(T.StructType([T.StructField("line", T.StringType()), day])).text(path)


def geojson_documents(conditions: DataFrame, limit: int = FEATURES_PER_DOCUMENT) -> DataFrame:
    text = to_compact_json(geojson_feature(conditions.columns))
    return day_documents(conditions, "date", "station_id", text, GEOJSON_HEAD, GEOJSON_TAIL, limit)
