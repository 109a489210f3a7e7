"""Centroid clustering over blocks of vectors with zone maps along a space-filling curve.

Vectors become integers, are put in the order of their place on a Hilbert curve and cut into blocks of neighbours.
A block is a row: ids, vectors, and the smallest and largest value of each component (its box) with the sum of its vectors.
In each round a block compares centroids by its box first. A centroid cannot be nearest if for some other one the
difference of both squared distances, which is linear in the vector, favours that other everywhere in the box. Vectors
are compared with what remains; a block with one candidate adds its stored sum. Sums are exact integers, so neither
blocks nor partitions change a result.

Defined results: rows whose vector is null, has another length, or holds a null or non-finite component take no part. Rows
that repeat count each; equal ids with equal digests start as centroids in the order of their vectors. With fewer
vectors than clusters there are as many centroids as vectors; without vectors the result is empty. A null id is digested
as an empty one. Integer components are held to +-2^27 (values of +-131,072), where squared distances still fit a long.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.llm.common import stage

SIZE, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Vectors of a block, and bits of each component that place it on the curve.
BLOCK, BITS = 256, 3
LARGEST = 1 << 27


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (rows of ``cells``, components below ``2 ** bits``) on a Hilbert curve, as rows of bytes to compare.

    After Skilling's transform the bits of all components, highest first, spell the place.
    """
    x = cells.T.astype(np.uint32).copy()
    n = len(x)
    top = np.uint32(1 << (bits - 1))
    q = top
    while q > 1:
        low = q - np.uint32(1)
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low).astype(np.uint32)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
        q >>= np.uint32(1)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    carry = np.zeros(x.shape[1], np.uint32)
    q = top
    while q > 1:
        carry ^= np.where(x[n - 1] & q, q - np.uint32(1), 0).astype(np.uint32)
        q >>= np.uint32(1)
    x ^= carry
    spelled = np.concatenate([(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)])
    return np.packbits(spelled.T.astype(np.uint8), axis=1)


def _integers(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows take part, and their vectors as integers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    right = pa.compute.fill_null(pa.compute.equal(pa.compute.list_value_length(column), size), False)
    rows = np.flatnonzero(right.to_numpy(zero_copy_only=False))
    values = column.filter(right).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    finite = np.isfinite(values).all(1)
    whole = np.floor(values[finite] * SCALE)
    return rows[finite], np.clip(whole, -LARGEST, LARGEST).astype(np.int64)


def vectors(table: DataFrame, size: int) -> DataFrame:
    """``vec_id, v``: integer vectors as little-endian 32-bit values, of rows that take part."""
    kind = table.schema["vec_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken, values = _integers(batch.column("embedding"), size)
            packed = pa.array([row.tobytes() for row in values.astype("<i4")], pa.binary())
            yield pa.record_batch([batch.column("vec_id").take(pa.array(taken)), packed], names=["vec_id", "v"])

    return table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(
        rows, f"vec_id {kind}, v binary"
    )


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, size).astype(np.int64)


def _bounds(kept: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Smallest and largest value of each component over all rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch.column("v"), size)
                low = m.min(0) if low is None else np.minimum(low, m.min(0))
                high = m.max(0) if high is None else np.maximum(high, m.max(0))
        if low is not None:
            yield pa.record_batch([pa.array(np.arange(size)), pa.array(low), pa.array(high)], names=["i", "low", "high"])

    found = kept.select("v").mapInArrow(rows, "i long, low long, high long").groupBy("i").agg(F.min("low"), F.max("high"))
    found = sorted(map(tuple, found.collect()))  # one row for each component
    return (np.array([r[1] for r in found]), np.array([r[2] for r in found])) if found else None


def blocks(kept: DataFrame, low: np.ndarray, high: np.ndarray, size: int, most: int = BLOCK) -> DataFrame:
    """``ids, vectors, low, high, total``: neighbours on the curve in blocks of ``most``."""
    step = np.maximum(1, (high - low) // (1 << BITS) + 1)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = hilbert_keys((_matrix(batch.column("v"), size) - low) // step, BITS)
            keys = pa.array([row.tobytes() for row in keys], pa.binary())
            yield pa.record_batch([keys, batch.column("vec_id"), batch.column("v")], names=["place", "vec_id", "v"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            rest.append(batch)
            held += batch.num_rows
            if held >= most:
                whole = pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
                full = held // most * most
                yield _block_rows(whole.slice(0, full), size, most)
                rest, held = [whole.slice(full)], held - full
        if held:
            yield _block_rows(pa.Table.from_batches(rest).combine_chunks().to_batches()[0], size, most)

    kind = kept.schema["vec_id"].dataType.simpleString()
    # equal vectors may be many: their ids, then their rows' numbers spread them over partitions
    order = ["place", "vec_id", "row"]
    along = stage(
        kept.mapInArrow(placed, f"place binary, vec_id {kind}, v binary").withColumn("row", F.monotonically_increasing_id()), "curve"
    )
    return (
        along.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("vec_id", "v")
        .mapInArrow(cut, f"ids array<{kind}>, vectors binary, low binary, high binary, total binary")
    )


def _block_rows(batch: pa.RecordBatch, size: int, most: int) -> pa.RecordBatch:
    out: list[list] = [[], [], [], [], []]
    ids, m = batch.column("vec_id"), _matrix(batch.column("v"), size)
    for start in range(0, batch.num_rows, most):
        part = m[start : start + most]
        row = (ids.slice(start, most).to_pylist(), part.astype("<i4").tobytes(), *(
            x.astype("<i8").tobytes() for x in (part.min(0), part.max(0), part.sum(0))
        ))
        for column, value in zip(out, row):
            column.append(value)
    types = [pa.list_(ids.type), *[pa.binary()] * 4]
    return pa.record_batch([pa.array(c, t) for c, t in zip(out, types)], names=["ids", "vectors", "low", "high", "total"])


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to a vector of the box."""
    n = len(centroids)
    # |x - a|^2 - |x - b|^2 = 2 x (b - a) + |a|^2 - |b|^2 for all pairs; its largest value in the box
    apart = centroids[None, :, :] - centroids[:, None, :]  # [a, b]: b - a
    most = 2 * np.where(apart > 0, apart * high, apart * low).sum(2)
    squares = (centroids**2).sum(1)
    most += squares[:, None] - squares[None, :]
    # a is nearer than b everywhere, or never farther and of a smaller number
    beats = (most < 0) | ((most == 0) & (np.arange(n)[:, None] < np.arange(n)[None, :]))
    return np.flatnonzero(~beats.any(0))


def nearest(m: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest centroid and its squared distance, by exact integers; ties go to the smaller number."""
    best = np.full(len(m), np.iinfo(np.int64).max)
    of = np.zeros(len(m), np.int64)
    for c in among:
        d = ((m - centroids[c]) ** 2).sum(1)
        better = d < best
        best[better], of[better] = d[better], c
    return of, best


def _numbers(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, size)


def _sums(cut: DataFrame, centroids: np.ndarray, size: int) -> list[tuple[int, list[int]]]:
    """Of each cluster its number of vectors and the sum of its vectors; tasks add up in arrays, so few rows leave each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(centroids), size + 1), np.int64)
        for batch in batches:
            lows, highs, sums = (_numbers(batch.column(c), size) for c in ("low", "high", "total"))
            for i in range(batch.num_rows):
                among = candidates(lows[i], highs[i], centroids)
                packed = batch.column("vectors")[i].as_py()
                if len(among) == 1:
                    totals[among[0], :size] += sums[i]
                    totals[among[0], size] += len(packed) // (4 * size)
                    continue
                m = np.frombuffer(packed, "<i4").reshape(-1, size).astype(np.int64)
                of, _ = nearest(m, centroids, among)
                for c in among:
                    totals[c, :size] += m[of == c].sum(0)
                    totals[c, size] += (of == c).sum()
        cluster, i = np.divmod(np.arange(totals.size), size + 1)
        yield pa.record_batch([pa.array(cluster), pa.array(i), pa.array(totals.ravel())], names=["cluster", "i", "n"])

    found = (
        cut.select("vectors", "low", "high", "total")
        .mapInArrow(rows, "cluster long, i long, n long")
        .groupBy("cluster", "i")
        .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
        .collect()  # clusters x (components + 1) rows
    )
    out = np.zeros((len(centroids), size + 1), object)
    for row in found:
        out[row["cluster"], row["i"]] = int(row["n"])
    return [(int(row[size]), list(row[:size])) for row in out]


def _assigned(cut: DataFrame, centroids: np.ndarray, size: int, kind: str) -> DataFrame:
    """``vec_id, cluster, distance`` of each vector."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, highs = (_numbers(batch.column(c), size) for c in ("low", "high"))
            for i in range(batch.num_rows):
                m = np.frombuffer(batch.column("vectors")[i].as_py(), "<i4").reshape(-1, size).astype(np.int64)
                of, distance = nearest(m, centroids, candidates(lows[i], highs[i], centroids))
                yield pa.record_batch(
                    [batch.column("ids").slice(i, 1).flatten(), pa.array(of.astype(np.int32)), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"],
                )

    return cut.select("ids", "vectors", "low", "high").mapInArrow(rows, f"vec_id {kind}, cluster int, distance long")


def fit(
    cut: DataFrame, start: np.ndarray, rounds: int = ROUNDS
) -> np.ndarray:
    """Centroids after ``rounds`` of assigning all vectors and moving each centroid to the floor of its vectors' mean."""
    centroids = start
    for _ in range(rounds):
        moved = _sums(cut, centroids, start.shape[1])
        centroids = np.array([[x // n for x in total] if n else list(c) for (n, total), c in zip(moved, centroids)], np.int64)
    return centroids


def cluster(
    table: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, seed: int = SEED, block: int = BLOCK
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that takes part."""
    kind = table.schema["vec_id"].dataType.simpleString()
    kept = stage(vectors(table, size), "vectors")
    bounds = _bounds(kept, size)
    empty = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if bounds is None:
        return kept.sparkSession.createDataFrame([], empty)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.orderBy(digest, "v").limit(clusters).collect()  # one row for each cluster
    centroids = np.array([np.frombuffer(row["v"], "<i4") for row in first], np.int64)
    cut = stage(blocks(kept, *bounds, size, block), "blocks")
    centroids = fit(cut, centroids, rounds)
    assigned = stage(_assigned(cut, centroids, size, kind), "assigned")
    inertia = {row["cluster"]: row["n"] for row in assigned.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    facts = [
        (c, int(inertia[c]), sum(map(int, inertia.values())), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for c in sorted(inertia)
    ]  # one row for each cluster
    facts = kept.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, seed: int = SEED) -> str:
    """DuckDB: each round as a pair of named queries over components."""
    parts = [
        f"""kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {size} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))))""",
        "e AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM kept)",
        f"""first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM kept
  QUALIFY row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) <= {clusters})""",
        "c0 AS MATERIALIZED (SELECT c, i, x FROM e JOIN first USING (vec_id))",
    ]
    for r in range(rounds + 1):
        parts.append(f"""d{r} AS (SELECT vec_id, c, sum((e.x - k.x) * (e.x - k.x))::BIGINT AS d FROM e JOIN c{r} k USING (i) GROUP BY vec_id, c)""")
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, min(c) AS c, min(d) AS d FROM (
  SELECT *, min(d) OVER (PARTITION BY vec_id) AS least FROM d{r}) WHERE d = least GROUP BY vec_id)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT k.c, k.i, coalesce(m.x, k.x) AS x FROM c{r} k LEFT JOIN (
    SELECT c, i, (sum(x)::HUGEINT - ((sum(x)::HUGEINT % count(*)) + count(*)) % count(*)) // count(*) AS x
    FROM e JOIN a{r} USING (vec_id) GROUP BY c, i) m ON m.c = k.c AND m.i = k.i)""")
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
  sum(d) OVER ()::BIGINT AS inertia, h AS centroid_sha256
FROM a{rounds} a JOIN (SELECT c, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c) USING (c)"""
    )
