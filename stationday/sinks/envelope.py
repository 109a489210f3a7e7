"""Pollen envelopes: checked station responses as payloads of the landing table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.functions.time import snapshot_key
from stationday.operators.joins import per_date
from stationday.operators.responses import require_expected_dates
from stationday.schemas import LANDING_SCHEMA, POLLEN_FILE
from stationday.sinks.documents import to_compact_json
from stationday.sources.landing import digest, write_landing

RESULTS_PER_ENVELOPE = 5_000


def pollen_envelopes(responses: DataFrame, results_per_envelope: int = RESULTS_PER_ENVELOPE) -> DataFrame:
    """``snapshot_date, part, station_count, payload`` from ``snapshot_date, station_id, latitude,
    longitude, response`` (``response`` as JSON text, which is put in as it is).

    A day's stations make one envelope. A day with more than ``results_per_envelope`` is spread by
    a hash of the station over several, each complete in itself, so that no group grows with the
    data.
    """
    parts = responses.groupBy("snapshot_date").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(results_per_envelope)).alias("parts")
    )
    spread = responses.join(per_date(parts), "snapshot_date").withColumn(
        "part", F.expr("pmod(xxhash64(station_id), parts)")
    )
    opening = F.regexp_replace(to_compact_json(F.struct("station_id", "latitude", "longitude")), r"\}$", "")
    text = F.concat(opening, F.lit(',"response":'), F.col("response"), F.lit("}"))
    grouped = (
        spread.select("snapshot_date", "part", F.struct("station_id", text.alias("text")).alias("item"))
        .groupBy("snapshot_date", "part")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    payload = F.concat(F.lit('{"results":['), F.array_join("items.text", ","), F.lit("]}"))
    return grouped.select(
        "snapshot_date", "part", F.size("items").cast("long").alias("station_count"), payload.alias("payload")
    )


def envelope_rows(envelopes: DataFrame, source_url: str | None, downloaded_at: dt.datetime) -> DataFrame:
    """Envelopes as rows of the landing table."""
    content = F.encode("payload", "UTF-8")
    # an object's key is its own: further parts of a day carry their number
    stem, suffix = POLLEN_FILE.rsplit(".", 1)
    name = F.when(F.col("part") == 0, F.lit(POLLEN_FILE)).otherwise(F.concat(F.lit(f"{stem}-"), F.col("part"), F.lit(f".{suffix}")))
    rows = envelopes.select(
        F.concat_ws("/", snapshot_key(F.col("snapshot_date")), name).alias("object_key"),
        F.lit(source_url).cast("string").alias("source_url"),
        F.lit("application/json").alias("content_type"),
        F.lit(downloaded_at).cast("timestamp").alias("downloaded_at"),
        content.alias("content"),
        "snapshot_date",
        F.lit(POLLEN_FILE).alias("filename"),
    )
    rows = rows.withColumns({"size": F.octet_length("content").cast("long"), "sha256": digest(F.col("content"))})
    return rows.select(*LANDING_SCHEMA.fieldNames())


def land_pollen(
    responses: DataFrame, landing: str, downloaded_at: dt.datetime, source_url: str | None = None
) -> DataFrame:
    """Check that every response is for its snapshot's date, then land the envelopes.

    Nothing is stored if one is not.
    """
    require_expected_dates(responses)
    return write_landing(envelope_rows(pollen_envelopes(responses), source_url, downloaded_at), landing)
