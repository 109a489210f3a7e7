"""Verified, partitioned Parquet: one partition per day, a day written again replaces itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationday.errors import VerificationError
from stationday.session import work_folder
from stationday.sources.published import read_declared


def content_metrics(columns: list[str]) -> list[Column]:
    """Row count and an order-independent checksum over whole rows."""
    checksum = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(checksum, F.lit(0)).alias("checksum")]


def _same(sent: dict, kept: dict, path: str) -> None:
    if (sent["rows"], sent["checksum"]) != (kept["rows"], kept["checksum"]):
        raise VerificationError(f"Rows read back from {path} differ from those written: {sent} != {kept}")


def write_verified(
    df: DataFrame, path: str, partition: str = "date", sort: tuple[str, ...] = ("station_id",)
) -> dict[str, int]:
    """Write ``df`` by partition, read back what was written and compare; returns the metrics.

    First to a folder of the run, which is compared; only then are the days below ``path`` replaced, from that folder, and
    compared again. A write that went wrong leaves the old days as they were. The rows are counted and summed while they
    are written, so the plan runs once. Rebalancing by partition keeps files few, and AQE splits a partition
    that is large into several files.
    """
    spark = df.sparkSession
    seen = Observation()
    columns = df.columns
    draft = work_folder(spark, "draft")
    (
        df.hint("rebalance", partition)
        .sortWithinPartitions(partition, *sort)
        .observe(seen, *content_metrics(columns), F.collect_set(partition).alias("partitions"))
        .write.partitionBy(partition)
        .parquet(draft)
    )
    sent = seen.get
    written = sorted(sent["partitions"])
    if written:
        _same(sent, read_declared(spark, draft, df.schema).agg(*content_metrics(columns)).first().asDict(), draft)
        publish(spark, draft, path, df.schema, partition, sort)
        back = read_declared(spark, path, df.schema).where(F.col(partition).isin(written))
        _same(sent, back.agg(*content_metrics(columns)).first().asDict(), path)
    return {"rows": sent["rows"], "checksum": sent["checksum"], "partitions": written}


def publish(spark: SparkSession, draft: str, path: str, schema: T.StructType, partition: str, sort: tuple[str, ...]) -> None:
    """Replace the days of a verified draft below ``path``; other days stay."""
    (
        read_declared(spark, draft, schema)
        .hint("rebalance", partition)
        .sortWithinPartitions(partition, *sort)
        .write.partitionBy(partition)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def written_files(spark: SparkSession, path: str, days: list | None = None) -> DataFrame:
    """Key, size and sha256 of every data file below a published folder, or of the given days only.

    Files are bounded by the writer's file size; hashing reads them whole, one per row.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path if days is None else [f"{path}/date={d}" for d in days])
        .select(
            F.col("path").alias("uri"),
            F.regexp_extract("path", r"date=([^/]+)/", 1).alias("day"),
            F.col("length").alias("file_size_bytes"),
            F.sha2("content", 256).alias("sha256"),
        )
    )
