"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Documents with equal texts form a group. Each group goes to the shard where the dot product of its
vector (shares of all bytes, tokens and rows) with the shard's residual capacity is highest, larger
groups first. Small groups are placed in cells, by the hash of their text, of which there is a fixed
number; only cells and the groups that exceed a cell's share pass through the driver. A group larger than a
shard's fair share in any measure is split by document id.

Defined results: null texts are one group of size 1, apart from empty texts. Equal sizes are placed in order of
their hash, equal dot products on the lowest shard. Extra columns of the input are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.llm.common import stage

SHARDS = 16
#: Cells of small groups for each shard. Bounds what the driver places: cells, and groups above a cell's share.
CELLS_PER_SHARD = 1024
#: Pieces of a split group, for each shard's share that it fills.
SPLIT = 8
#: Rows of one slot range; ranges are numbered in parallel.
SLOT_RANGE = 50_000
MEASURES = ("size", "tokens", "rows")


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, tokens, rows, key`` of every row; ``key`` stands for the text."""
    text = F.col("text")
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("tokens"),
        F.lit(1).cast("long").alias("rows"),
        F.xxhash64(text.isNull(), text).alias("key"),
    )


def place(vectors: np.ndarray, totals: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each vector: largest first, highest dot product with the residual capacity."""
    share = vectors / np.maximum(totals, 1)
    residual = np.full((shards, share.shape[1]), 1.0 / shards)
    out = np.zeros(len(share), np.int32)
    for i in np.argsort(-share.max(1), kind="stable"):
        out[i] = shard = int(np.argmax(residual @ share[i]))
        residual[shard] -= share[i]
    return out


def assign(docs: DataFrame, shards: int = SHARDS, cells_per_shard: int = CELLS_PER_SHARD) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row."""
    spark, cells = docs.sparkSession, shards * cells_per_shard
    rows = stage(measured(docs), "measured")
    sums = [F.sum(m).alias(m) for m in MEASURES]
    totals = np.array([v or 0 for v in rows.agg(*sums).first()], float)

    # groups above a cell's share in any measure: at most len(MEASURES) * cells of them
    groups = rows.groupBy("key").agg(*sums)
    above = lambda share: " or ".join(f"{m} > {t * share}" for m, t in zip(MEASURES, totals))
    large = groups.where(above(1 / cells)).collect()
    pieces = {}
    for g in large:
        filled = max(g[m] * shards / max(t, 1) for m, t in zip(MEASURES, totals))
        # a group that no shard can hold is split, but not finer than its rows allow
        pieces[g["key"]] = 1 if filled <= 1 else int(min(np.ceil(filled * SPLIT), g["rows"]))
    wide = spark.createDataFrame(list(pieces.items()) or [(0, 0)], "key long, pieces int").where("pieces > 0")

    # a cell is a piece of a large group, or all small groups of one hash
    cell = F.when(
        F.col("pieces").isNotNull(),
        F.xxhash64("key", F.pmod(F.xxhash64("doc_id"), F.col("pieces")), F.lit("piece")),
    ).otherwise(F.pmod(F.xxhash64("key", F.lit("cell")), F.lit(cells)))
    celled = rows.join(F.broadcast(wide), "key", "left").withColumn("cell", cell)
    loads = celled.groupBy("cell").agg(*sums).orderBy("cell").collect()  # bounded by cells and pieces
    shard_of = place(np.array([[r[m] for m in MEASURES] for r in loads], float).reshape(-1, len(MEASURES)), totals, shards)
    plan = spark.createDataFrame(
        [(r["cell"], int(s)) for r, s in zip(loads, shard_of)] or [(0, -1)], "cell long, shard int"
    ).where("shard >= 0")
    ranges = int(totals[2] // (SLOT_RANGE * shards)) + 1
    placed = celled.join(F.broadcast(plan), "cell").select(
        "doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id", F.lit("slot")), F.lit(ranges)).alias("range")
    )
    return numbered(placed).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def numbered(placed: DataFrame) -> DataFrame:
    """Slots from 0 without gaps in each shard: a place within its range, plus the rows of earlier ranges."""
    from pyspark.sql import Window

    counts = placed.groupBy("shard", "range").count()
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "range").orderBy("doc_id")
    return placed.withColumn("place", F.row_number().over(within)).join(before, ["shard", "range"]).withColumn(
        "slot", F.col("before") + F.col("place") - 1
    )
