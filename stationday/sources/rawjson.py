"""Raw JSON documents: the pollen envelope of one snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationday.schemas import POLLEN_ENVELOPE_DDL, POLLEN_RESPONSE_DDL


def parse_object(text: Column, ddl: str) -> Column:
    """A JSON object of a declared shape.

    Broken text, a document that is no object, and members of another type than declared (a
    fractional index, say) are errors.
    """
    return F.from_json(text, ddl, {"mode": "FAILFAST"})


def pollen_results(payloads: DataFrame, failure: str | None = None) -> DataFrame:
    """``snapshot_date, station_id, response`` for every station of every envelope.

    An envelope that cannot be read is an error, or one row with a message in the column ``failure`` names.
    """
    lacking = "Pollen payload must contain a results list"
    text = F.decode("content", "UTF-8")
    if failure is None:
        parsed = payloads.select("snapshot_date", parse_object(text, POLLEN_ENVELOPE_DDL).alias("envelope"))
        listed = F.col("envelope.results").isNotNull()
        results = F.when(listed, F.col("envelope.results")).otherwise(F.raise_error(F.lit(lacking)))
        return parsed.select("snapshot_date", F.explode(results).alias("result")).select(
            "snapshot_date", "result.station_id", "result.response"
        )
    # permissive parsing keeps the text of what it cannot read
    ddl = POLLEN_ENVELOPE_DDL.replace("struct<", "struct<_broken: string, ", 1)
    readable = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    parsed = payloads.select(
        "snapshot_date", F.from_json(readable, ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("envelope")
    )
    problem = F.when(
        F.col("envelope").isNull() | F.col("envelope._broken").isNotNull(),
        F.concat(F.lit("Malformed pollen payload: "), F.coalesce(F.substring("envelope._broken", 1, 200), F.lit("no text in UTF-8"))),
    ).when(F.col("envelope.results").isNull(), F.lit(lacking))
    checked = parsed.withColumn("_problem", problem)
    results = F.when(F.col("_problem").isNull(), F.col("envelope.results"))
    rows = checked.select("snapshot_date", "_problem", F.explode_outer(results).alias("result"))
    # an empty list has no rows, a broken envelope one
    rows = rows.where(F.col("result").isNotNull() | F.col("_problem").isNotNull())
    return rows.select("snapshot_date", "result.station_id", "result.response", F.col("_problem").alias(failure))


def parse_responses(responses: DataFrame) -> DataFrame:
    """Replace the text column ``response`` by its parsed form.

    The text is named twice, so that it stays a column where it was just made: as a part of ``from_json`` its expression
    would be interpreted for every row.
    """
    text = F.col("response")
    return responses.withColumn("response", F.when(text.isNotNull(), parse_object(text, POLLEN_RESPONSE_DDL)))
