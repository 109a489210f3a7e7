"""Extreme rows per day, with all ties or the first station only.

Both are made of a small aggregate per day, joined back to the rows: the aggregate is combined
map-side on plain numbers, its result has one row per calendar day, and the rows themselves are
neither sorted nor shuffled. On a dry day every station ties at 0 mm; those rows stay where they
are, where a window by day would bring the whole day into one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.operators.joins import per_group


def extreme_rows(df: DataFrame, measure: str, largest: bool = True, by: str = "date") -> DataFrame:
    """All rows at each day's extreme of ``measure``; rows without a value never count."""
    pick = F.max if largest else F.min
    bounds = df.groupBy(by).agg(pick(measure).alias("_bound")).where("_bound IS NOT NULL")
    bounds = bounds.withColumnRenamed(by, "_day")
    joined = df.join(per_group(bounds, by), (F.col(by) == F.col("_day")) & (F.col(measure) == F.col("_bound")))
    return joined.drop("_day", "_bound")


@dataclass(frozen=True)
class Named:
    """An extreme value and the name of the first station that has it."""

    measure: str
    largest: bool
    name: str
    value: str


def named_extremes(
    df: DataFrame,
    specs: Sequence[Named],
    latest: str,
    by: str = "date",
    name: str = "station_name",
    station: str = "station_id",
) -> DataFrame:
    """Per day: the maximum of ``latest``, each measure's extreme and the name of its first station.

    As for ``arg_max``, rows without a name cannot be named, so the named value may lie below the
    extreme one. Two scans: one for the values, on numbers only, and one for the few rows at them.
    """
    values = df.groupBy(F.col(by).alias("_day")).agg(
        F.max(latest).alias(f"_{latest}"),
        *((F.max if s.largest else F.min)(s.measure).alias(f"_{s.value}") for s in specs),
        *(
            (F.max if s.largest else F.min)(F.when(F.col(name).isNotNull(), F.col(s.measure))).alias(f"_{s.name}")
            for s in specs
        ),
    )
    hits = {s: F.col(name).isNotNull() & (F.col(s.measure) == F.col(f"_{s.name}")) for s in specs}
    # a day that names nothing keeps its rows, so that its values are not lost
    nameless = reduce(and_, (F.col(f"_{s.name}").isNull() for s in specs))
    ties = (
        df.select(by, station, name, *dict.fromkeys(s.measure for s in specs))
        .join(per_group(values, by), F.col(by) == F.col("_day"))
        .where(reduce(or_, hits.values()) | nameless)
    )
    order = F.struct(F.col(station).isNull(), F.col(station))
    outputs = [F.max(f"_{latest}").alias(latest)]
    for s, hit in hits.items():
        outputs.append(F.min_by(F.when(hit, F.col(name)), F.when(hit, order)).alias(s.name))
        outputs.append(F.max(f"_{s.value}").alias(s.value))
    return ties.groupBy(by).agg(*outputs)
