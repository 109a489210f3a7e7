"""Joins with a small side, and one-to-one validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.errors import DataQualityError

BROADCAST_ROWS = 500_000
SHOWN_IDS = 20


def broadcast_if_small(
    small: DataFrame, max_rows: int = BROADCAST_ROWS, bounded_by: DataFrame | None = None
) -> DataFrame:
    """Hint a broadcast after counting rows; above the limit Spark joins by shuffle, skew handled by AQE.

    ``bounded_by`` is a cheaper frame with at least as many rows to count instead.
    """
    rows = (small if bounded_by is None else bounded_by).count()
    return F.broadcast(small) if rows <= max_rows else small


def per_date(by_date: DataFrame) -> DataFrame:
    """Hint a broadcast of a frame grouped by date alone.

    The calendar bounds it, not the data: a century of days is 36,525 rows of a few numbers.
    """
    return F.broadcast(by_date)


def per_group(by_group: DataFrame, by: str) -> DataFrame:
    """``per_date`` of a frame grouped by a date; grouped by another column its rows are counted first."""
    return per_date(by_group) if by in ("date", "snapshot_date") else broadcast_if_small(by_group)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``n``; combined map-side before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def keys_without_match(df: DataFrame, master: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of ``df`` that ``master`` does not have."""
    return df.select(*keys).distinct().join(master.select(*keys), keys, "left_anti")


def raise_if_any(df: DataFrame, id_column: str, message: str) -> None:
    """Raise an error that names offending ids (the first of them, in order) and counts them all."""
    shown, total = first_and_total(df.select(id_column).distinct(), id_column)
    if total:
        ids = [row[0] for row in shown]
        raise DataQualityError(f"{message}: {ids!r}{in_all(ids, total)}", failures=ids, total=total)


def first_and_total(df: DataFrame, *order: str) -> tuple[list, int]:
    """The first rows of a table of failures, for a message, and how many there are."""
    shown = df.orderBy(*order).limit(SHOWN_IDS).collect()
    return shown, len(shown) if len(shown) < SHOWN_IDS else df.count()


def in_all(shown: list, total: int) -> str:
    return "" if total <= len(shown) else f" and more, {total} in all"
