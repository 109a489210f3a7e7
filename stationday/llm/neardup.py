"""Near duplicates by an inverted join over signature coordinates.

Texts with equal shingle sets collapse first. Each remaining set has a MinHash signature and is posted
under its coordinate-value pairs. Two sets that share at least ``SHARED`` of the posted coordinates also share one of
the rarest ``n - SHARED + 1`` pairs that each shares with any other set, so only this prefix is joined,
and sets with fewer shared pairs are left out whole. Collisions are then counted on the signatures themselves.

Long posting lists never give all pairs. First every set meets the most popular members of its lists; links
are confirmed on full shingle sets and components are formed. Then only members of one list that lie in
different components are compared, block against block, each pair under the first coordinate that it shares.
So no link between components is lost.

Defined results: null and empty texts, and texts without words, have no shingles and no links. Rows that
repeat are one set. Rows with a null id take no part (null component, kept). Extra columns are ignored;
an empty table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationday.llm.common import Words, mix, stage, text_slices
from stationday.llm.graph import components

#: Signature coordinates; how many of them are posted under their value.
COORDINATES, POSTED = 128, 64
#: Least collisions of a pair. At a similarity of 0.8 a pair has 51.2 and 102.4 on average, and fewer than
#: these with a chance of about 1 in 50,000.
SHARED, MATCHES = 37, 83
#: Popular members that a set is compared with first.
HUBS = 2
#: One-byte coordinates, and least collisions, of the finer signature by which members of one list are compared.
#: 819.2 collide on average at a similarity of 0.8.
FINE, FINE_MATCHES = 1024, 764
#: Sets of one posting list that are compared in one block.
BLOCK = 1024
#: Dropped ids up to this number are broadcast, else the join is shuffled.
BROADCAST_IDS = 1_000_000

_RNG = np.random.default_rng(7)
_FACTORS = (_RNG.integers(0, 2**32, COORDINATES + FINE, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_SHIFTS = _RNG.integers(0, 2**32, COORDINATES + FINE, dtype=np.uint64).astype(np.uint32)


def shingle_sets(column: pa.Array, words: Words, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words; with fewer words, of all of them."""
    hashes, _, _, first = words(column)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    out = [np.zeros(0, np.uint64)] * len(counts)
    if len(hashes) >= width:
        size = len(hashes) - width + 1
        run = hashes[:size].copy()
        for j in range(1, width):
            run = mix(run) + hashes[j : j + size] * np.uint64(2 * j + 1)
        run = mix(run)
        whole = owner[:size] == owner[width - 1 :]
        run, run_owner = run[whole], owner[:size][whole]
        ends = np.searchsorted(run_owner, np.arange(len(counts) + 1))
        for i in np.flatnonzero(counts >= width):
            out[i] = np.unique(run[ends[i] : ends[i + 1]])
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        value = np.array([counts[i]], np.uint64)
        for h in hashes[first[i] : first[i + 1]]:
            value = mix(value) + h
        out[i] = mix(value)
    return out


def signatures(sets: list[np.ndarray], coordinates: range = range(COORDINATES)) -> np.ndarray:
    """MinHash coordinates, one row per set; empty sets have zeros."""
    out = np.zeros((len(sets), len(coordinates)), np.uint32)
    filled = [i for i, s in enumerate(sets) if len(s)]
    if filled:
        values = (np.concatenate([sets[i] for i in filled]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *(len(sets[i]) for i in filled[:-1])])
        for place, k in enumerate(coordinates):
            out[filled, place] = np.minimum.reduceat(values * _FACTORS[k] + _SHIFTS[k], starts)
    return out


def _as_lists(matrix: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(matrix).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]), flat)


def described(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, f1, f2, sig``: the set's size, its fingerprint and its signature."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for part in text_slices(batches):
            sets = shingle_sets(part.column("text"), words, width)
            prints = [[s.sum(dtype=np.uint64) for s in sets], [mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets]]
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *(pa.array(np.array(p, np.uint64).view(np.int64)) for p in prints),
                    _as_lists(signatures(sets).view(np.int32)),
                ],
                names=["doc_id", "n", "f1", "f2", "sig"],
            )

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, n long, f1 long, f2 long, sig array<int>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """``id, shingles, fine`` of each document: the hashes as bytes, and the finer signature."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for part in text_slices(batches):
            sets = shingle_sets(part.column("text"), words, width)
            fine = (signatures(sets, range(COORDINATES, COORDINATES + FINE)) & np.uint32(255)).astype(np.uint8).view(np.int8)
            yield pa.record_batch(
                [part.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary()), _as_lists(fine)], names=["id", "shingles", "fine"]
            )

    return docs.select("doc_id", "text").mapInArrow(rows, "id long, shingles binary, fine array<byte>")


def posting_lists(reps: DataFrame) -> DataFrame:
    """``token, rep, popularity, mask``: the prefix of each set's shared pairs, rarest first."""
    tokens = reps.select("rep", F.posexplode(F.slice("sig", 1, POSTED)).alias("place", "value")).select(
        "rep", F.expr("shiftleft(cast(place as long), 32) + cast(value as long) + 2147483648L").alias("token")
    )
    counts = tokens.groupBy("token").count().where("count > 1")
    shared = (
        tokens.join(counts, "token")
        .groupBy("rep")
        .agg(F.sort_array(F.collect_list(F.struct("count", "token"))).alias("all"))  # at most POSTED
        .where(F.size("all") >= SHARED)
        .withColumn("popularity", F.expr("aggregate(all, 0L, (acc, x) -> acc + x.count)"))
        .withColumn("prefix", F.expr(f"slice(all, 1, size(all) - {SHARED - 1})"))
        .withColumn("mask", F.expr("aggregate(prefix, 0L, (acc, x) -> acc | shiftleft(1L, cast(shiftright(x.token, 32) as int)))"))
    )
    return shared.select(F.explode("prefix.token").alias("token"), "rep", "popularity", "mask")


def collisions(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda acc, x: acc + x)


def similar_sizes(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def popular_pairs(lists: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Each set with the most popular members that its lists hold, where enough coordinates collide.

    Two pairs a set at most: they only bring the bulk of a group together, crossing pairs find the rest.
    """
    hubs = lists.groupBy("token").agg(F.max(F.struct("popularity", "rep")).alias("hub"))
    pairs = (
        lists.select("token", "rep")
        .join(hubs, "token")
        .where("rep != hub.rep")
        .groupBy("rep")
        .agg(F.slice(F.sort_array(F.collect_set("hub"), asc=False), 1, HUBS).alias("hubs"))  # of at most POSTED
        .select("rep", F.explode("hubs.rep").alias("hub"))
        .select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
        .distinct()
    )
    left = reps.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a"))
    right = reps.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(similar_sizes(F.col("n_a"), F.col("n_b"), percent))
        .where(collisions(F.col("sig_a"), F.col("sig_b")) >= MATCHES)
        .select("a", "b")
    )


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
        .mapInArrow(rows, "a long, b long")
    )


def crossing_pairs(lists: DataFrame, reps: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs of one list in different components with enough collisions, each from one list only.

    With ``nearest``, of each set and list only the pair with the most collisions.
    """
    labelled = lists.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    mixed = (
        labelled.groupBy("token")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
        .where("low < high")
        .select("token", F.expr(f"size div {BLOCK} + 1").alias("blocks"))
    )
    # a list of several blocks is compared block against block; a row goes to each pair that its block is in
    keyed = (
        labelled.join(mixed, "token")
        .withColumn("block", F.expr("pmod(xxhash64(rep), blocks)"))
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select("token", "rep", "mask", "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )
    rows = (
        keyed.join(reps.select("rep", "n", "sig"), "rep")
        .join(sets.select(F.col("id").alias("rep"), "fine"), "rep")
        .repartition("token", "i", "j")
        .sortWithinPartitions("token", "i", "j")
    )

    def compared(group: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        coordinate = np.uint64(1) << np.uint64(int(group["token"][0]) >> 32)
        same_block = group["i"][0] == group["j"][0]
        left = np.flatnonzero(group["block"] == group["i"][0])
        right = left if same_block else np.flatnonzero(group["block"] == group["j"][0])
        if not len(left) or not len(right):
            return
        rep, comp, n, mask, sig, fine = (group[c][right] for c in ("rep", "component", "n", "mask", "sig", "fine"))
        a, b = [], []
        for x in left:
            other = (comp != group["component"][x]) & (100 * np.minimum(n, group["n"][x]) >= percent * np.maximum(n, group["n"][x]))
            if same_block and not nearest:
                other &= rep > group["rep"][x]
            at = np.flatnonzero(other)
            if not len(at):
                continue
            equal = sig[at] == group["sig"][x]
            at, equal = at[(close := equal.sum(1) >= MATCHES)], equal[close]
            if not len(at):
                continue
            if not nearest:
                bits = np.packbits(equal[:, :POSTED], axis=1, bitorder="little").view(np.uint64)[:, 0]
                both = bits & mask[at] & group["mask"][x]
                at = at[(both & (~both + np.uint64(1))) == coordinate]  # the first list that holds both
            alike = (fine[at] == group["fine"][x]).sum(1)
            at, alike = at[alike >= FINE_MATCHES], alike[alike >= FINE_MATCHES]
            if nearest and len(at):
                at = at[[alike.argmax()]]
            a.extend([group["rep"][x]] * len(at))
            b.extend(rep[at])
        if a:
            low, high = np.minimum(a, b), np.maximum(a, b)
            yield pa.record_batch([pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["a", "b"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "rep", "component", "block", "i", "j", "n")}
            new["mask"] = batch.column("mask").to_numpy(zero_copy_only=False).view(np.uint64)
            for c, width in (("sig", COORDINATES), ("fine", FINE)):
                new[c] = batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            if held is not None:
                new = {c: np.concatenate([held[c], v]) for c, v in new.items()}
            key = np.stack([new["token"], new["i"], new["j"]])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1)]
            for start, end in zip(cuts, cuts[1:]):
                yield from compared({c: v[start:end] for c, v in new.items()})
            held = {c: v[cuts[-1] :] for c, v in new.items()}  # may go on in the next batch
        if held is not None:
            yield from compared(held)

    return rows.mapInArrow(runs, "a long, b long")


def link(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row."""
    whole = stage(described(docs, width), "signatures")
    key = ["n", "f1", "f2"]
    classes = whole.where("n > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    reps = stage(classes, "sets")
    lists = stage(posting_lists(reps), "lists")
    listed = lists.select(F.col("rep").alias("doc_id")).distinct()
    sets = stage(full_sets(only(docs, listed, "left_semi"), width).dropDuplicates(["id"]), "shingles")
    edges = stage(confirmed(popular_pairs(lists, reps, percent), sets, percent), "links")
    labels = components(edges)
    for nearest in (True, False):  # the nearest pairs join most of what is left, so that few pairs cross at last
        pairs = crossing_pairs(lists, reps, sets, labels, percent, nearest).distinct()
        more = stage(confirmed(pairs, sets, percent), "links")
        if not more.isEmpty():
            edges = edges.unionByName(more)
            labels = components(edges)
    known = reps.select(*key, "rep").join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return (
        whole.select("doc_id", *key)
        .join(known, key, "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )


def only(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Documents with (``left_semi``) or without (``left_anti``) the given ids: broadcast up to a checked number."""
    ids = stage(ids.select("doc_id").distinct(), "ids")
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how)


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document, that of the smallest id, of each group of near duplicates."""
    dropped = link(docs, width, percent).where("not kept")
    return only(docs, dropped, "left_anti").select(*docs.columns)
