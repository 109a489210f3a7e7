"""Importance resampling towards a target: features in hashed buckets, weights from an array of gains, distributed quickselect.

Words are runs of ASCII letters and digits and of all other characters beyond ASCII, ``A-Z`` lowered.
Features are runs of one to three words; each counts in the bucket of its crc32. A bucket's gain is the scaled
logarithm of its share in the target against its share in the corpus; a document's weight is the sum of its
features' gains. Gumbel noise from a digest of the id turns weights into scores whose largest are a draw
without replacement. The k-th key is found by quickselect: each round counts, over all rows still between
the bounds, how many lie below, at and above a few random pivot keys. Only the winners are sorted.

Defined results: a null or empty text has no features and weight 0. A null id is digested as an empty one and
comes last among equal scores. Rows that repeat count each; equal ids with equal scores are ranked by fewer features first.
Extra columns are ignored. An empty target leaves all counts of it 0; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.llm.blocks import run_positions, word_blocks
from stationday.llm.common import stage, text_slices, utf8

BUCKETS = 10000
#: Longer words are digested one by one.
LONG_WORD = 48
#: Pivot keys of a round of the quickselect.
PIVOTS = 15
SEED = 42

INSIDE = np.zeros(256, bool)
INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    """The byte table of the reflected polynomial 0xEDB88320."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, np.uint32(0xEDB88320) ^ (out >> np.uint32(1)), out >> np.uint32(1))
    return out


TABLE = _crc_table()


def _step(state: np.ndarray, byte) -> np.ndarray:
    return TABLE[(state ^ byte) & np.uint32(0xFF)] ^ (state >> np.uint32(8))


class _Appender:
    """Runs crc32 states through the words of a block, byte column by byte column, longest words first."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        sizes = ends - starts
        self.data, self.long = data, [(i, starts[i], ends[i]) for i in np.flatnonzero(sizes > LONG_WORD)]
        sizes = np.where(sizes > LONG_WORD, 0, sizes)
        self.order = np.argsort(-sizes, kind="stable")
        self.at = starts[self.order]
        per_size = np.bincount(sizes, minlength=2)
        #: how many words have more than j bytes
        self.longer = len(sizes) - np.cumsum(per_size)[:-1]

    def __call__(self, state: np.ndarray) -> np.ndarray:
        moved = state[self.order]
        for j, n in enumerate(self.longer):
            if n:
                moved[:n] = _step(moved[:n], self.data[self.at[:n] + j])
        out = np.empty_like(state)
        out[self.order] = moved
        for i, start, end in self.long:
            out[i] = zlib.crc32(memoryview(self.data[start:end]), int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
        return out


def feature_buckets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Text numbers and buckets of features, and how many words they come from, block by block."""
    raw, offsets = utf8(column)
    start, space = np.uint32(0xFFFFFFFF), np.uint32(32)
    last_text, last_place, last_one, last_two = -1, 0, start, start
    for starts, ends, text in word_blocks(raw, offsets, INSIDE):
        low = int(starts[0])
        append = _Appender(LOWER[raw[low : int(ends[-1])]], starts - low, ends - low)
        place = run_positions(text)
        if text[0] == last_text:  # the text goes on from the block before
            place[text == last_text] += last_place + 1
        one = append(np.full(len(starts), start))
        two = append(_step(np.concatenate([[last_one], one[:-1]]).astype(np.uint32), space))
        three = append(_step(np.concatenate([[last_two], two[:-1]]).astype(np.uint32), space))
        last_text, last_place, last_one, last_two = text[-1], int(place[-1]), one[-1], two[-1]
        for run, state in enumerate((one, two, three)):
            has = place >= run
            yield text[has], ((state[has] ^ start) % np.uint32(BUCKETS)).astype(np.int64), len(starts) if run == 0 else 0


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all texts fall in each bucket: tasks count in an array, so ``BUCKETS`` rows leave each."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for part in text_slices(batches):
            for _, buckets, _ in feature_buckets(part.column("text")):
                counts += np.bincount(buckets, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    rows = texts.select("text").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in rows.collect():  # at most BUCKETS rows
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            n = part.num_rows
            out = np.zeros((3, n), np.int64)
            for text, buckets, words in feature_buckets(part.column("text")):
                count = np.bincount(text, minlength=n)
                out[0] += count if words else 0
                out[1] += count
                out[2] += np.bincount(text, weights=gain[buckets], minlength=n).astype(np.int64)
            yield pa.record_batch([part.column("doc_id"), *map(pa.array, out)], names=["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(summed, f"doc_id {kind}, n_words long, n_features long, weight long")


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """All rows with their score, and ``row``, which tells rows that repeat apart."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return weighed(docs, gain).withColumn("score", F.col("weight") + noise).withColumn("row", F.monotonically_increasing_id())


def _order(df: DataFrame) -> DataFrame:
    """Adds the composite key, smaller is better: largest score, then smallest id, then what repeats."""
    return (
        df.withColumn("k0", -F.col("score"))
        .withColumn("k1", F.col("doc_id").isNull().cast("long"))
        .withColumn("k2", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)))
        .withColumn("k3", F.col("n_features"))
        .withColumn("k4", F.col("row"))
    )


KEY = ("k0", "k1", "k2", "k3", "k4")


def _below(key: tuple, or_equal: bool = False):
    """Whether a row's composite key is smaller than ``key``."""
    out = F.lit(or_equal)
    for name, value in zip(reversed(KEY), reversed(key)):
        out = (F.col(name) < value) | ((F.col(name) == value) & out)
    return out


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS) -> tuple:
    """The ``k``-th smallest composite key (from 1) by distributed quickselect; ``rows`` has more than ``k - 1`` rows."""
    inside, below, turn = rows.select(*KEY), 0, 0
    while True:
        turn += 1
        drawn = inside.orderBy(F.xxhash64(*KEY, F.lit(turn)), *KEY).limit(pivots).collect()  # a few rows
        keys = sorted({tuple(row) for row in drawn})
        # 2 i + 1 for a row at pivot i, 2 i for one between its neighbours
        place = sum(((~_below(p)).cast("int") + (~_below(p, True)).cast("int") for p in keys), F.lit(0))
        counts = {row["place"]: row["count"] for row in inside.groupBy(place.alias("place")).count().collect()}
        for place_of, key in ((i, keys[i // 2] if i % 2 else None) for i in range(2 * len(keys) + 1)):
            n = counts.get(place_of, 0)
            if below + n >= k:
                if key is not None:
                    return key
                break
            below += n
        i = place_of // 2
        if i > 0:
            inside = inside.where(~_below(keys[i - 1], True))
        if i < len(keys):
            inside = inside.where(_below(keys[i]))


def ranked(winners: DataFrame) -> DataFrame:
    """Ranks by range partitions: each is sorted and numbered alone, then moved by how many rows lie before it."""
    spots = stage(
        winners.repartitionByRange(*KEY).sortWithinPartitions(*KEY).withColumn("spot", F.monotonically_increasing_id()), "ranked"
    )
    part = F.shiftright("spot", 33)
    sizes = sorted(map(tuple, spots.groupBy(part.alias("part")).count().collect()))  # one row for each partition
    before = dict(zip((p for p, _ in sizes), np.cumsum([0, *(n for _, n in sizes)]).tolist()))
    moved = spots.sparkSession.createDataFrame(list(before.items()) or [(0, 0)], "part long, before long")
    return spots.withColumn("part", part).join(F.broadcast(moved), "part").withColumn(
        "rank", F.col("before") + F.col("spot").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    )


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; ``rank`` is null where a row is not drawn."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    rows = _order(stage(scored(docs, gain, seed), "scored"))
    able = rows.where(F.col("n_words") >= least_words)
    k = percent * able.count() // 100
    if k == 0:
        return _shown(rows.withColumn("rank", F.lit(None).cast("long")))
    drawn = (F.col("n_words") >= least_words) & _below(kth_key(able, k), True)
    return _shown(ranked(rows.where(drawn))).unionByName(_shown(rows.where(~drawn).withColumn("rank", F.lit(None).cast("long"))))


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def oracle(percent: int = 5, least_words: int = 20, seed: int = SEED) -> str:
    """DuckDB: crc32 by its byte table, made from the polynomial; each distinct feature once."""
    lists = "list_filter(regexp_split_to_array({}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')".format(
        "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )
    runs = " UNION ALL ".join(
        f"SELECT r, array_to_string(ws[i:i + {k}], ' ') AS f FROM (SELECT r, ws, unnest(range(1, len(ws) - {k - 1})) AS i FROM lists)"
        for k in range(3)
    )
    return rf"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n::BIGINT)) AS t),
lists AS (
  SELECT row_number() OVER () AS r, doc_id, {lists} AS ws FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, {lists} FROM benchmark),
features AS MATERIALIZED ({runs}),
bytes AS (SELECT f, hex(f) AS h FROM (SELECT DISTINCT f FROM features)),
hashed AS MATERIALIZED (
  SELECT f, xor(4294967295, list_reduce(list_transform(range(1, length(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT),
    lambda s, b: xor(t[(xor(s, b) & 255) + 1], s >> 8), 4294967295::BIGINT)) % {BUCKETS} AS bucket FROM bytes, crc),
used AS MATERIALIZED (SELECT r, bucket FROM features JOIN hashed USING (f)),
counts AS (SELECT bucket, count(*) FILTER (r > 0) AS s, count(*) FILTER (r < 0) AS t FROM used GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (S_ + {BUCKETS})::DOUBLE) / ((s + 1)::DOUBLE * (T_ + {BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM counts, (SELECT sum(s)::BIGINT AS S_, sum(t)::BIGINT AS T_ FROM counts)),
weights AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS w FROM used JOIN gains USING (bucket) GROUP BY r),
noise AS (
  SELECT r, doc_id, len(ws) AS words, coalesce(n, 0)::BIGINT AS n_features, coalesce(w, 0)::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || sha256('{seed}:' || doc_id)[1:8])::BIGINT::DOUBLE + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS z
  FROM lists LEFT JOIN weights USING (r) WHERE r > 0),
drawn AS (
  SELECT r, row_number() OVER (ORDER BY weight + z DESC, doc_id) AS rank FROM noise WHERE words >= {least_words}
  QUALIFY rank <= {percent} * count(*) OVER () // 100)
SELECT doc_id, n_features, weight, weight + z AS score, rank FROM noise LEFT JOIN drawn USING (r)"""
