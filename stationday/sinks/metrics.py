"""Run metrics: what each table of a build holds, as rows of one appended table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.functions.time import iso_timestamp

METRIC_COLUMNS = ("snapshot_date", "table_name", "metric", "value")


def _text(df: DataFrame, column: str):
    dtype = dict(df.dtypes)[column]
    return iso_timestamp(F.col(column)) if dtype == "timestamp" else F.col(column).cast("string")


def metric_rows(df: DataFrame, table_name: str) -> DataFrame:
    """Turn one row of metrics per snapshot (and ``source``) into one row per metric, values as text."""
    names = [c for c in df.columns if c not in ("snapshot_date", "source")]
    pairs = F.array(*(F.struct(F.lit(n).alias("metric"), _text(df, n).alias("value")) for n in names))
    label = F.concat(F.lit(f"{table_name}."), F.col("source")) if "source" in df.columns else F.lit(table_name)
    return df.select("snapshot_date", label.alias("table_name"), F.inline(pairs))


def append_metrics(rows: DataFrame, path: str, run_id: str) -> None:
    """Append a run's metrics."""
    rows.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(path)
