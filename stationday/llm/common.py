"""Helpers of the operators: stage tables, bounded samples, vectorised words of Arrow text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.session import work_folder

#: Documents are handled in slices of about so many bytes of text; a longer document is a slice of its own.
SLICE_BYTES = 1 << 19


#: Bytes of the batches that go to Python workers and back, so that neither side holds more at a time but for a longer row.
BATCH_BYTES = 8 << 20
_BATCH_LIMIT, _DEFAULT_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's limit of a batch's bytes, unless it has one of its own."""
    if spark.conf.get(_BATCH_LIMIT, _DEFAULT_LIMIT) == _DEFAULT_LIMIT:
        spark.conf.set(_BATCH_LIMIT, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder of ``spark.checkpoint.dir`` and read back: lineage ends here."""
    spark = df.sparkSession
    bound_batches(spark)
    path = work_folder(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_hash_rank(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The ``rows`` rows whose hashed key is smallest: a bounded sample that does not depend on partitions."""
    return df.orderBy(F.xxhash64(key), key).limit(rows)


def held_out(key, folds: int, fold: int):
    return F.crc32(key.cast("string")) % folds == fold


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Record batches cut into slices of about ``SLICE_BYTES`` of text."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
        total = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(total):
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + SLICE_BYTES, side="right")))
            yield batch.slice(start, end - start)
            start = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pa.compute.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit with even odds."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """Hashes of the words of many texts at once, without a Python object per word.

    A word is a run of bytes for which ``inside`` holds. Its hash is a polynomial over random values
    of its bytes, taken as the difference of two prefix sums, then mixed. ``A-Z`` count as ``a-z``.
    """

    def __init__(self, separators: bytes = b" \t\n\v\f\r"):
        self.inside = np.ones(256, bool)
        self.inside[list(separators)] = False
        values = np.random.default_rng(20240131).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
        values[65:91] = values[97:123]
        self.values = values
        self.base = 0x9E3779B97F4A7C15
        self.inverse = pow(self.base, -1, 2**64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        def powers(base: int) -> np.ndarray:
            out = np.full(size, base, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        if len(self.powers) < size:
            size = 1 << (size - 1).bit_length()
            self.powers, self.inverses = powers(self.base), powers(self.inverse)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, byte starts and byte ends of all words, and for each text the index of its first (n + 1)."""
        data, offsets = utf8(column)
        size = len(data)
        if not size:
            none = np.zeros(0, np.int64)
            return none.astype(np.uint64), none, none, np.zeros(len(offsets), np.int64)
        self._grow(size + 1)
        inside = self.inside[data]
        first = np.zeros(size + 1, bool)
        first[offsets] = True  # a text begins (or the last ends) here
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | first[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | first[1:-1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[:size], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.inverses[starts])
        return hashes, starts, ends, np.searchsorted(starts, offsets)
