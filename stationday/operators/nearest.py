"""The nearest station of many points at once, without comparing all of them with all stations.

Places become points of the unit sphere in space, where the straight line between two grows with their
great-circle distance and neither the poles nor the 180th meridian are special. The cube around the sphere is cut in
cells, each level in four along each axis. Places and points go down together: a block is a cell that holds points, with
the box around them and the cells of places that may hold the nearest of one of them. Cells whose box lies farther than
another box can reach are dropped. A block whose cells have many places is cut, and so are those of its cells that hold many; the children
of a block share what is around it, so no row is made for a point and a cell. What each point is compared with in the end
are the few places around its block, wherever it lies.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationday.functions.geo import distance_km
from stationday.operators.joins import broadcast_if_small, per_date, raise_if_any
from stationday.session import work_folder

#: Bits of a cell's number along an axis at the first and the deepest level, and how many a level adds.
FIRST, DEEPEST, STEP = 2, 20, 2
#: A cell of a day with more places is cut where a block needs it.
PLACES_IN_CELL = 16
#: A block is cut while the cells around it hold more places together.
PLACES_AROUND = 256
#: Room for rounding when lengths of straight lines are compared (the radius is 1); 6 mm on the ground.
SLACK = 1e-9
AXES = ("x", "y", "z")
BOX = tuple(f"{name}_{c}" for c in AXES for name in ("low", "high"))


def sphere_point(latitude: Column, longitude: Column) -> dict[str, Column]:
    """The point of the unit sphere at decimal degrees."""
    lat, lon = F.radians(latitude), F.radians(longitude)
    return {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}


def _spread(number: Column) -> Column:
    """The bits of a number below 2 ** 21, two zeros between each and the next."""
    for shift, mask in (
        (32, 0x1F00000000FFFF),
        (16, 0x1F0000FF0000FF),
        (8, 0x100F00F00F00F00F),
        (4, 0x10C30C30C30C30C3),
        (2, 0x1249249249249249),
    ):
        number = number.bitwiseOR(F.shiftleft(number, shift)).bitwiseAND(F.lit(mask))
    return number


def deepest_cell(point: dict[str, Column]) -> Column:
    """The deepest cell of a point: a one, then bits of the three axes in turn, so the cell above is a prefix of it.

    The leading one tells the levels apart: no two cells of any levels have the same number.
    """
    largest = (1 << DEEPEST) - 1
    numbers = (F.least(F.floor((c + 1) / 2 * (1 << DEEPEST)), F.lit(largest)).cast("long") for c in point.values())
    return reduce(add, (F.shiftleft(_spread(n), i) for i, n in enumerate(numbers)), F.lit(1 << 3 * DEEPEST))


def _cell(deepest: Column, level: int) -> Column:
    return F.shiftright(deepest, 3 * (DEEPEST - level))


def _located(df: DataFrame, latitude: str, longitude: str) -> DataFrame:
    df = df.withColumns(sphere_point(F.col(latitude), F.col(longitude)))
    return df.withColumn("deepest", deepest_cell({c: F.col(c) for c in AXES}))


def _places(stations: DataFrame) -> DataFrame:
    """Each place of each day once, with its first station."""
    located = stations.where("latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) AND NOT isnan(longitude)")
    places = located.groupBy("date", "latitude", "longitude").agg(F.min("station_id").alias("station_id"))
    return _located(places, "latitude", "longitude")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cut(rows: DataFrame, wanted: DataFrame, level: int) -> DataFrame:
    """The cells of a level that lie in the wanted cells ``date, above``, with their rows' number and the box around them."""
    bounds = [f(c).alias(f"{name}_{c}") for c in AXES for f, name in ((F.min, "low"), (F.max, "high"))]
    numbers = (_cell(F.col("deepest"), n).alias(name) for n, name in ((level, "cell"), (level - STEP, "above")))
    cells = rows.select("date", *AXES, *numbers).join(wanted, ["date", "above"], "left_semi")
    return cells.groupBy("date", "above", "cell").agg(F.count(F.lit(1)).alias("n"), *bounds)


def _line(*parts: Column) -> Column:
    return F.sqrt(reduce(add, (p * p for p in parts)))


def _bounded(items: str, low, high) -> Column:
    """The items of an array that lie no farther from the row's box than another one reaches; ``low`` and ``high`` give their sides."""

    def near(item: Column) -> Column:
        return _line(*(F.greatest(low(item, c) - F.col(f"high_{c}"), F.col(f"low_{c}") - high(item, c), F.lit(0.0)) for c in AXES))

    def far(item: Column) -> Column:
        return _line(*(F.greatest(high(item, c) - F.col(f"low_{c}"), F.col(f"high_{c}") - low(item, c)) for c in AXES))

    # the bound is the one item of an array, as a column of its own might be put into the filter and found for each item anew
    least = F.array(F.array_min(F.transform(items, far)))
    return F.get(F.transform(least, lambda u: F.filter(items, lambda item: near(item) <= u + SLACK)), F.lit(0))


def _blocks(spots: DataFrame, places: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Blocks that are not cut any more, ``date, block, box, cells``, and those that are, ``date, block``; both by level."""
    boxes = (F.lit(0.0).alias(c) for c in BOX)
    root = F.struct(F.lit(1).cast("long").alias("cell"), F.lit(1 << 62).alias("n"), *boxes)
    days = places.select("date").distinct()
    front = days.select("date", F.lit(1).cast("long").alias("block"), F.array(root).alias("cells"))
    many = F.aggregate("cells", F.lit(0).cast("long"), lambda n, c: n + c["n"]) > PLACES_AROUND
    # a single place among cells that are not cut stays as it is
    many &= F.exists("cells", lambda c: c["n"] > PLACES_IN_CELL) | reduce(or_, (F.col(f"low_{c}") < F.col(f"high_{c}") for c in AXES))
    whole, cut = [], []
    blocks = per_date(front.select("date", "block"))
    for level in range(FIRST, DEEPEST + 1, STEP):
        around = front.select("date", "block", F.explode("cells").alias("c")).select("date", "block", "c.*")
        large = around.where(F.col("n") > PLACES_IN_CELL).withColumnRenamed("cell", "above").select("date", "block", "above")
        parts = _cut(places, broadcast_if_small(large.select("date", "above").distinct()), level)
        cells = around.where(F.col("n") <= PLACES_IN_CELL).unionByName(large.join(parts, ["date", "above"]).drop("above"))
        cells = cells.groupBy("date", "block").agg(F.collect_list(F.struct("cell", "n", *BOX)).alias("cells"))
        inner = _cut(spots, blocks.withColumnRenamed("block", "above"), level).drop("n")
        inner = inner.join(cells.withColumnRenamed("block", "above"), ["date", "above"]).withColumnRenamed("cell", "block")
        kept = _bounded("cells", lambda item, c: item[f"low_{c}"], lambda item, c: item[f"high_{c}"])
        found = _written(inner.select("date", "block", *BOX, kept.alias("cells")), "blocks")
        front = found.where(many)
        if level == DEEPEST or front.isEmpty():
            return [*whole, found], cut
        whole.append(found.where(~many))
        blocks = broadcast_if_small(front.select("date", "block"))
        cut.append(blocks)


def _around(blocks: list[DataFrame], places: DataFrame) -> DataFrame:
    """``date, block, places``: the places that may be the nearest of a point of the block."""
    pairs = reduce(DataFrame.unionByName, blocks).select("date", "block", *BOX, F.explode("cells.cell").alias("cell"))
    numbers = F.array(*(_cell(F.col("deepest"), FIRST + STEP * i) for i in range(len(blocks))))
    place = F.struct(*AXES, "latitude", "longitude", "station_id")
    members = places.select("date", F.explode(numbers).alias("cell"), place.alias("place"))
    members = members.join(broadcast_if_small(pairs.select("date", "cell").distinct()), ["date", "cell"], "left_semi")
    members = members.groupBy("date", "cell").agg(F.collect_list("place").alias("places"))
    kept = _bounded("places", lambda item, c: item[c], lambda item, c: item[c]).alias("places")
    parts = pairs.join(members, ["date", "cell"]).select("date", "block", *BOX, kept)
    whole = parts.groupBy("date", "block", *BOX).agg(F.flatten(F.collect_list("places")).alias("places"))
    return whole.select("date", "block", kept)


def require_coordinates(points: DataFrame) -> None:
    """Points out of range, and NULL or NaN coordinates, are an error, whether or not there are stations that day."""
    bad = ~F.coalesce(F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180), F.lit(False))
    raise_if_any(points.where(bad), "point_id", "latitude must be between -90 and 90, longitude between -180 and 180, for points")


def nearest_to_points(stations: DataFrame, points: DataFrame) -> DataFrame:
    """For each point the station of its day nearest to it, the first by id among equals.

    ``stations``: ``date, station_id, latitude, longitude`` and more, a station once a day. ``points``: ``point_id, date, latitude,
    longitude``. Result: ``point_id, point_latitude, point_longitude``, the station's columns and ``distance_km``; no row for a
    point without stations on its day. Points that lie close together are looked up together.
    """
    require_coordinates(points)
    places = _written(_places(stations), "places")
    at = (F.col(c).cast("double").alias(f"at_{c}") for c in ("latitude", "longitude"))
    points = points.select("point_id", "date", *at).join(per_date(places.select("date").distinct()), "date", "left_semi")
    spots = _located(_written(points, "points"), "at_latitude", "at_longitude")
    blocks, cut = _blocks(spots, places)
    points = spots.withColumn("block", _cell(F.col("deepest"), FIRST))
    for i, of_level in enumerate(cut, 1):
        inner = F.when(F.col("cut"), _cell(F.col("deepest"), FIRST + STEP * i)).otherwise(F.col("block"))
        points = points.join(of_level.withColumn("cut", F.lit(True)), ["date", "block"], "left").withColumn("block", inner).drop("cut")

    def line(place: Column) -> Column:
        return _line(*(place[c] - F.col(c) for c in AXES))

    def measured(place: Column) -> Column:
        distance = distance_km(F.col("at_latitude"), F.col("at_longitude"), place["latitude"], place["longitude"])
        return F.struct(distance.alias("distance_km"), place["station_id"].alias("station_id"))

    # straight lines tell the few that are near, great circles the nearest of these
    least = F.array(F.array_min(F.transform("places", line)))
    near = F.flatten(F.transform(least, lambda u: F.filter("places", lambda place: line(place) <= u + SLACK)))
    best = F.inline(F.array(F.array_min(F.transform(near, measured))))
    points = points.drop("deepest").join(_around(blocks, places), ["date", "block"])
    found = points.select("point_id", "date", "at_latitude", "at_longitude", best).join(stations, ["date", "station_id"])
    return found.select(
        "point_id",
        F.col("at_latitude").alias("point_latitude"),
        F.col("at_longitude").alias("point_longitude"),
        *stations.columns,
        "distance_km",
    )
