"""Approximate nearest neighbours over balanced posting lists.

Vectors are posted under their nearest centroid; those near a boundary are posted under several. Centroids
are fitted on a bounded sample and searched through an in-memory graph. A query opens the lists whose
centroid is not much farther than the nearest one, and further ones while those opened may hold too few
vectors. Long lists are cut in parts that are scanned apart.

Equal vectors collapse first: of each, only the smallest ids can be among the nearest, so a vector that a
third of all rows hold costs no more than any other.

Defined results: vectors that are null, empty, zero, hold null or non-finite components, or have another
length than most take no part, neither as query nor as candidate; nor do rows without an id. A row that
repeats is one candidate. Fewer candidates than asked for are all returned. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationday.llm.common import id_hash_rank, stage

#: Vectors of a posting list on average, most centroids, and sampled vectors for each centroid.
LIST, MOST_CENTROIDS, SAMPLE_EACH = 64, 4096, 16
#: Most vectors of a list's part.
PART = 2048
#: A vector is posted under at most so many lists, none farther than the nearest by more than this factor.
REPLICAS, BOUNDARY = 4, 1.15
#: A query opens at most so many lists, none farther than the nearest by more than this factor.
PROBES, RATIO = 128, 2.0
#: Links of a centroid in the graph, and centroids kept while it is searched.
LINKS, BEAM = 24, 128
ROUNDS = 8


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of the rows that take part, without repeats."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select("vec_id", v.alias("v"))
    rows = rows.where(
        (F.size("v") > 0)
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0.0)
    )
    size = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("v") == (size["size"] if size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision, each from its own row only, so equal vectors get equal values."""
    scale = np.sqrt((query * query).sum()) * np.sqrt((vectors * vectors).sum(1))
    return (vectors * query).sum(1) / scale


@dataclass
class Graph:
    """Centroids linked with their nearest neighbours and a few far ones, searched best first, many queries at once."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    @classmethod
    def build(cls, centroids: np.ndarray) -> Graph:
        n = len(centroids)
        rng = np.random.default_rng(5)
        near = min(LINKS, n - 1)
        links = np.zeros((n, near + min(4, n)), np.int64)
        for start in range(0, n, 1024):
            sims = centroids[start : start + 1024] @ centroids.T
            sims[np.arange(len(sims)), np.arange(start, start + len(sims))] = -2
            if near:
                links[start : start + 1024, :near] = np.argpartition(-sims, near - 1, axis=1)[:, :near]
        links[:, near:] = rng.integers(0, n, (n, links.shape[1] - near))
        return cls(centroids, links, rng.permutation(n)[: min(n, 32)])

    def search(self, queries: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids found for each query and their similarities, nearest first."""
        n, beam = len(self.centroids), min(max(BEAM, want), len(self.centroids))
        rows = np.arange(len(queries))[:, None]
        seen = np.zeros((len(queries), n), bool)
        opened = np.zeros((len(queries), n), bool)
        ids = np.repeat(self.entries[None, :], len(queries), 0)
        sims = queries @ self.centroids[self.entries].T
        seen[:, self.entries] = True
        while True:
            waiting = np.where(opened[rows, ids] | (ids < 0), -3.0, sims)
            next_ = waiting.argmax(1)
            going = waiting[rows[:, 0], next_] > -3
            if not going.any():
                break
            at = ids[rows[:, 0], next_]
            opened[rows[going, 0], at[going]] = True
            new = self.links[at]
            fresh = ~seen[rows, new] & going[:, None]
            seen[np.broadcast_to(rows, new.shape)[fresh], new[fresh]] = True
            found = np.where(fresh, np.einsum("qld,qd->ql", self.centroids[new], queries), -3.0)
            ids, sims = np.concatenate([ids, np.where(fresh, new, -1)], 1), np.concatenate([sims, found], 1)
            if ids.shape[1] > beam:
                best = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
                ids, sims = ids[rows, best], sims[rows, best]
        order = np.argsort(-sims, axis=1, kind="stable")[:, :want]
        return ids[rows, order], sims[rows, order]


def fit_centroids(sample: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means, in which a full cluster's price rises so that sizes stay even."""
    rng = np.random.default_rng(3)
    centroids = sample[rng.permutation(len(sample))[:count]]
    price = np.zeros(len(centroids))
    for _ in range(ROUNDS):
        nearest = np.concatenate([(part @ centroids.T - price).argmax(1) for part in np.array_split(sample, len(sample) // 4096 + 1)])
        sizes = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        empty = np.linalg.norm(sums, axis=1) < 1e-9
        sums[empty] = sample[rng.integers(0, len(sample), empty.sum())]
        centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
        price = 0.02 * np.log(np.maximum(sizes, 1) * len(centroids) / len(sample))
    return centroids


def _postings(graph: Graph, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) of each posting: the nearest list, and near ones that no chosen list shields."""
    ids, sims = graph.search(v, 2 * REPLICAS)
    distance = 1 - sims
    rows, lists = [], []
    for i in range(len(v)):
        chosen: list[int] = []
        for c, d in zip(ids[i], distance[i]):
            if c < 0 or len(chosen) == REPLICAS or (chosen and d > BOUNDARY * distance[i, 0]):
                break
            if all(1 - graph.centroids[c] @ graph.centroids[o] > d for o in chosen):
                chosen.append(int(c))
        rows.extend([i] * len(chosen))
        lists.extend(chosen)
    return np.array(rows, np.int64), np.array(lists, np.int64)


def _probes(graph: Graph, v: np.ndarray, probes: int, ratio: float, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) of the lists that each query opens: near ones, and as many more as hold ``least`` postings."""
    ids, sims = graph.search(v, probes)
    distance = 1 - sims
    opened = (ids >= 0) & (distance <= ratio * distance[:, :1] + 1e-9)
    rows, at = np.nonzero(opened)
    lists = ids[rows, at]
    short = np.flatnonzero(np.bincount(rows, sizes[lists], len(v)) < least)
    if len(short):
        keep = ~np.isin(rows, short)
        rows, lists = [rows[keep]], [lists[keep]]
        for i in short:
            near = ids[i][opened[i]]
            # all lists, those opened first, then by distance
            order = np.argsort(-(graph.centroids @ v[i]), kind="stable")
            order = np.concatenate([near, order[~np.isin(order, near)]])
            order = order[: np.searchsorted(np.cumsum(sizes[order]), least) + 1]
            rows.append(np.full(len(order), i))
            lists.append(order)
        rows, lists = np.concatenate(rows), np.concatenate(lists)
    return rows, lists


def _placed(df: DataFrame, graph: Graph, place, kind: str) -> DataFrame:
    held = df.sparkSession.sparkContext.broadcast(graph)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                at, lists = place(held.value, _unit(_matrix(part.column("v"))))
                took = part.take(pa.array(at))
                yield pa.record_batch([pa.array(lists, pa.int64()), took.column("class"), took.column("v")], names=["list", "class", "v"])

    return df.select("class", "v").mapInArrow(rows, "list long, class long, v array<double>").withColumn("kind", F.lit(kind))


def search(vectors: DataFrame, every: int = 50, k: int = 5, probes: int = PROBES, ratio: float = RATIO) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id ``every`` divides, its ``k`` nearest found."""
    spark = vectors.sparkSession
    rows = stage(usable(vectors).distinct(), "vectors")  # rows that repeat count once
    # of equal vectors only the k + 1 smallest ids can be among k nearest; Spark keeps so many a task before the shuffle
    order = Window.partitionBy("v").orderBy("vec_id")
    smallest = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    classes = stage(
        smallest.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).select(F.col("ids")[0].alias("class"), "v", "ids"),
        "classes",
    )
    queries = stage(
        rows.where(F.col("vec_id") % every == 0).distinct().join(classes.select("class", "v"), "v").select("vec_id", "class", "v"), "queries"
    )
    count = classes.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not count:
        return spark.createDataFrame([], schema)
    lists = int(min(MOST_CENTROIDS, max(1, count // LIST)))
    sample = id_hash_rank(classes.select("class", "v"), "class", SAMPLE_EACH * lists).toPandas()["v"]
    graph = Graph.build(fit_centroids(_unit(np.array(sample.tolist(), np.float64)), lists))
    posted = stage(_placed(classes, graph, _postings, "vector"), "postings")
    sizes = posted.groupBy("list").count().select("list", F.expr(f"count div {PART} + 1").alias("parts"))  # one row a centroid
    held = np.zeros(len(graph.centroids), np.int64)
    for row in posted.groupBy("list").count().collect():  # one row a centroid
        held[row["list"]] = row["count"]
    least = REPLICAS * (k + 1)  # a vector has at most REPLICAS postings, so these are k + 1 vectors at least
    asked = _placed(
        queries.select("class", "v").dropDuplicates(["class"]), graph, lambda g, v: _probes(g, v, probes, ratio, held, least), "query"
    )
    # vectors lie in one part of their list, queries visit each
    both = (
        posted.join(F.broadcast(sizes), "list")
        .withColumn("part", F.expr("pmod(xxhash64(class), parts)"))
        .drop("parts")
        .unionByName(asked.join(F.broadcast(sizes), "list").withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)"))).drop("parts"))
    )

    def scanned(group: pd.DataFrame) -> pd.DataFrame:
        is_query = (group["kind"] == "query").to_numpy()
        out = []
        if is_query.any() and not is_query.all():
            v = np.array(group["v"][~is_query].tolist(), np.float64)
            ids, unit = group["class"][~is_query].to_numpy(), _unit(v)
            asked = np.array(group["v"][is_query].tolist(), np.float64)
            for query, q, sims in zip(group["class"][is_query], asked, _unit(asked) @ unit.T):
                most = min(len(ids), k + 1)
                # a little slack, so that rounding in the product decides nothing
                near = np.flatnonzero(sims >= np.partition(sims, len(ids) - most)[len(ids) - most] - 1e-9)
                exact = cosines(q, v[near])
                best = np.lexsort((ids[near], -exact))[: k + 1]
                out.extend((query, int(ids[near[b]]), float(exact[b])) for b in best)
        return pd.DataFrame(out, columns=["query", "class", "score"]).astype({"query": "int64", "class": "int64", "score": "float64"})

    found = both.groupBy("list", "part").applyInPandas(scanned, "query long, class long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    nearest = (
        found.groupBy("query", "class")
        .agg(F.max("score").alias("score"))
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k + 1)  # own class and k others at least; each has an id to give
    )
    candidates = (
        nearest.join(classes.select("class", "ids"), "class")
        .select("query", F.explode("ids").alias("vec_id"), "score")
        .groupBy("query")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("order"), "vec_id", "score"))).alias("all"))  # (k + 1) squared at most
    )
    own = F.filter("all", lambda c: c["vec_id"] != F.col("query_id"))
    return (
        queries.select(F.col("vec_id").alias("query_id"), F.col("class").alias("query"))
        .join(candidates, "query")
        .select("query_id", F.posexplode(F.slice(own, 1, k)).alias("place", "c"))
        .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "c.vec_id", "c.score")
    )
