"""Long repeats of word runs by recompression.

A text's words get names; rounds then replace runs of one name, and pairs of a left and a right name, by new
names. A name is a digest of its parts, and whether it is left or right is a bit of it, so all tasks give
equal parts the same name and no round needs a shuffle: the rounds of a block of words run in one task. What
becomes of a symbol depends on its neighbours only; the words that it depends on are kept with it (its reach). Equal
word runs therefore hold the same symbols wherever these reach no word outside.

Every window of ``width`` words is put under the first symbol of the highest round that reaches nothing outside the
window: its anchor. Equal windows have equal anchors in the same place. Neighbouring windows under one anchor form a
stretch, posted once with the anchor's name and a digest of the stretch's words. Then

1. names are counted. A name that occurs once holds no repeat. If all its stretches are equal (64 bits beside the 64 of the
   name), they repeat as wholes;
2. only stretches under a name with different stretches are taken apart into windows, whose 128-bit digests are counted;
3. words under windows that occur twice or more are removed.

All counts are combined before they are shuffled, and no pairs of occurrences are formed. A text goes by a 64-bit digest
and its marks are digests of its own stretches and windows, so texts that shared a digest would not take each other's marks.

Defined results: a null text has no words; texts of fewer than ``width`` words lose nothing. Rows that repeat are
repeats of each other: each loses all words of its windows. A null id is kept as it is. Extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.llm.blocks import WordDigests, Windows, word_blocks
from stationday.llm.common import SLICE_BYTES, mix, stage, text_slices, utf8

WIDTH = 35
#: Rounds of pair naming, and those of them that name runs first. To name a run, a symbol has to see both neighbours, so
#: each such round widens the reaches: runs of later rounds would leave fewer anchors of high rounds in a window.
ROUNDS, RUNS = 7, (0,)
#: Words of a long text that are handled at once; neighbours share ``width - 1`` words, so every window lies in one.
#: A slice of several texts has fewer.
CHUNK = SLICE_BYTES // 2
SEPARATORS = b" \t\n\v\f\r"
INSIDE = np.ones(256, bool)
INSIDE[list(SEPARATORS)] = False
FAR = 1 << 40


class Symbols:
    """The symbols of a sequence of words: names, and the first and last + 1 of the words they depend on."""

    def __init__(self, names: np.ndarray, begins: np.ndarray):
        """``begins`` marks words before which a text or chunk begins; the word before such a one is unknown."""
        n = len(names)
        self.names = names
        self.low = np.arange(n, dtype=np.int64)
        self.high = self.low + 1
        self.begins = begins.copy()

    def _after(self, values: np.ndarray, fill) -> np.ndarray:
        """For each symbol its right neighbour's value."""
        out = np.empty_like(values)
        out[:-1] = values[1:]
        out[-1:] = fill
        return out

    def _before(self, values: np.ndarray, fill) -> np.ndarray:
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[:1] = fill
        return out

    def _ends(self) -> np.ndarray:
        return self._after(self.begins, True)

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Reach to the left with the left neighbour, and to the right with the right one; an unknown one is far off."""
        low = np.where(self.begins, -FAR, self._before(self.low, -FAR))
        high = np.where(self._ends(), FAR, self._after(self.high, FAR))
        return low, high

    def name_runs(self, turn: int) -> None:
        """Runs of one name become a symbol; each symbol has then seen both its neighbours."""
        low, high = self._neighbours()
        first = self.begins | (self.names != self._before(self.names, 0))
        at = np.flatnonzero(first)
        size = np.diff(np.append(at, len(first)))
        last = at + size - 1
        names = self.names[at]
        runs = size > 1
        names[runs] = mix(names[runs] * np.uint64(0x9E3779B97F4A7C15) + mix(size[runs].astype(np.uint64) + np.uint64(turn << 40)))
        self.names, self.low, self.high, self.begins = names, low[at], high[last], self.begins[at]

    def name_pairs(self, turn: int) -> None:
        """A left symbol followed by a right one become one; others have seen the neighbour that could have joined."""
        low, high = self._neighbours()
        right = (mix(self.names ^ np.uint64(0xC2B2AE3D27D4EB4F + turn)) & np.uint64(1)).astype(bool)
        joins = ~right & self._after(right, False) & ~self._ends()
        joined = self._before(joins, False)
        new_high = np.where(right, self.high, high)  # a left symbol has seen the one after it
        new_low = np.where(right, low, self.low)
        after = self._after(self.names, 0)
        names = np.where(joins, mix((self.names ^ mix(after + np.uint64(turn))) * np.uint64(0x9FB21C651E98DF25) + after), self.names)
        new_high = np.where(joins, self._after(self.high, FAR), new_high)
        keep = ~joined
        self.names, self.low, self.high, self.begins = names[keep], new_low[keep], new_high[keep], self.begins[keep]


def anchors(names: np.ndarray, begins: np.ndarray, width: int, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """Stretches of windows under one anchor: first window, number of windows, anchor's name.

    ``names`` are the words of one or more sequences, ``begins`` marks the first word of each.
    """
    symbols = Symbols(names, begins)
    levels = [(symbols.names, symbols.low, symbols.high)]
    for turn in range(rounds):
        if turn in RUNS:
            symbols.name_runs(turn)
        symbols.name_pairs(turn)
        levels.append((symbols.names, symbols.low, symbols.high))
    n = len(names)
    first = np.flatnonzero(begins)
    ends = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))  # the end of each word's sequence
    open_ = np.flatnonzero(np.arange(n) + width <= ends)  # windows without an anchor yet
    level_of, symbol_of = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    for level in range(rounds, -1, -1):
        _, low, high = levels[level]
        # reaches grow to the right on both sides, so the first symbol that begins inside is the one that ends first
        low = np.maximum.accumulate(np.maximum(low, -1))
        at = np.searchsorted(low, open_, side="left")
        fits = at < len(low)
        fits[fits] = high[at[fits]] <= open_[fits] + width
        level_of[open_[fits]], symbol_of[open_[fits]] = level, at[fits]
        open_ = open_[~fits]
    placed = np.flatnonzero(level_of >= 0)
    if not len(placed):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    level, symbol = level_of[placed], symbol_of[placed]
    new = np.ones(len(placed), bool)
    new[1:] = (placed[1:] != placed[:-1] + 1) | (level[1:] != level[:-1]) | (symbol[1:] != symbol[:-1])
    at = np.flatnonzero(new)
    named = np.zeros(len(at), np.uint64)
    for k in range(rounds + 1):
        here = level[at] == k
        named[here] = mix(levels[k][0][symbol[at][here]] + np.uint64(k + 1))
    return placed[at], np.diff(np.append(at, len(placed))), named


def chunks(column: pa.Array, width: int) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """Words of a slice of texts: text numbers, the place of the first word in its text, both digests.

    Several texts come at once and whole; a single text comes in chunks of ``CHUNK`` words and the ``width - 1`` after them.
    """
    data, offsets = utf8(column)
    digests = WordDigests()
    held: list[tuple[np.ndarray, ...]] = []
    count = base = 0

    def joined() -> tuple[np.ndarray, ...]:
        return tuple(map(np.concatenate, zip(*held)))

    for starts, ends, text in word_blocks(data, offsets, INSIDE):
        low, high = int(starts[0]), int(ends[-1])
        held.append((text, *digests(data[low:high], starts - low, ends - low)))
        count += len(starts)
        while len(column) == 1 and count >= CHUNK + width:
            text, first, second = joined()
            size = CHUNK + width - 1
            yield text[:size], base, first[:size], second[:size]
            held[:] = [(text[CHUNK:], first[CHUNK:], second[CHUNK:])]
            base, count = base + CHUNK, count - CHUNK
    if held:
        text, first, second = joined()
        yield text, base, first, second


def stretches(column: pa.Array, width: int) -> Iterator[tuple]:
    """Per chunk: text number, first window, windows, name and digest of each stretch, and what gives digests of windows."""
    for text, base, first, second in chunks(column, width):
        begins = np.ones(len(text), bool)
        begins[1:] = text[1:] != text[:-1]
        at, n, names = anchors(first, begins, width)
        windows = Windows(first, second)
        yield text, base, at, n, names, windows(at, at + n - 1 + width)[0], windows


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def posted(docs: DataFrame, width: int) -> DataFrame:
    """``key, name, content`` of each stretch of each row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            keys = part.column("key").to_numpy(zero_copy_only=False)
            for text, _, at, _, names, contents, _ in stretches(part.column("text"), width):
                yield pa.record_batch([pa.array(keys[text[at]]), _long(names), _long(contents)], names=["key", "name", "content"])

    return docs.mapInArrow(rows, "key long, name long, content long")


def window_digests(docs: DataFrame, width: int) -> DataFrame:
    """``key, f1, f2`` of each window in the stretches of ``docs`` that column ``contents`` lists."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            keys = part.column("key").to_numpy(zero_copy_only=False)
            listed = _marks(part.column("contents"))
            for text, _, at, n, _, contents, windows in stretches(part.column("text"), width):
                wanted = np.isin(_marked(contents, text[at]), listed)
                starts = np.repeat(at[wanted], n[wanted]) + _counted(n[wanted])
                f1, f2 = windows(starts, starts + width)
                yield pa.record_batch([pa.array(keys[text[starts]]), _long(f1), _long(f2)], names=["key", "f1", "f2"])

    return docs.mapInArrow(rows, "key long, f1 long, f2 long")


def _counted(n: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the lengths ``n``."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _marked(digests: np.ndarray, text: np.ndarray) -> np.ndarray:
    return digests ^ mix(text.astype(np.uint64) + np.uint64(1))


def _marks(column: pa.Array) -> np.ndarray:
    """The listed digests of all rows, each mixed with its row's number."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return _marked(values, np.repeat(np.arange(len(column)), sizes))


def removed(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` from texts with the digests of their repeated stretches and windows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            stretch_marks, window_marks = _marks(part.column("contents")), _marks(part.column("windows"))
            covered: dict[int, list[tuple[int, int]]] = {}
            if len(stretch_marks) or len(window_marks):
                for text, base, at, n, _, contents, windows in stretches(part.column("text"), width):
                    whole = np.isin(_marked(contents, text[at]), stretch_marks)
                    starts = np.repeat(at, n) + _counted(n)
                    hit = np.repeat(whole, n) | np.isin(_marked(windows(starts, starts + width)[0], text[starts]), window_marks)
                    starts = starts[hit]
                    if len(starts):
                        first = np.searchsorted(text, text[starts], side="left")
                        new = np.ones(len(starts), bool)
                        new[1:] = (starts[1:] > starts[:-1] + width) | (text[starts[1:]] != text[starts[:-1]])
                        a = np.flatnonzero(new)
                        b = np.append(a[1:], len(starts)) - 1
                        spans = zip(text[starts[a]].tolist(), (starts[a] - first[a] + base).tolist(), (starts[b] - first[b] + base + width).tolist())
                        for i, low, high in spans:
                            covered.setdefault(i, []).append((low, high))
            out: list[tuple] = []
            for i, text in enumerate(part.column("text").to_pylist()):
                words = (text or "").encode().split()
                gone = np.zeros(len(words), bool)
                for low, high in covered.get(i, ()):
                    gone[low:high] = True
                count = int(gone.sum())
                kept = compress(words, (~gone).tolist()) if count else words
                out.append((len(words), count, hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pa.record_batch(
                [part.column("doc_id"), *map(pa.array, zip(*out))], names=["doc_id", "n_words", "n_removed", "kept_sha256"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(rows, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Every row's ``doc_id, n_words, n_removed, kept_sha256`` after words under repeated windows are taken out."""
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    posts = stage(posted(texts.select("key", "text"), width), "posts")
    shared = stage(
        posts.groupBy("name")
        .agg(F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high"))
        .where("n > 1")
        .select("name", (F.col("low") == F.col("high")).alias("alike")),
        "shared",
    )
    found = stage(
        posts.join(shared, "name")
        .groupBy("key")
        .agg(
            F.collect_set(F.when(F.col("alike"), F.col("content"))).alias("contents"),
            F.collect_set(F.when(~F.col("alike"), F.col("content"))).alias("mixed"),
        ),
        "found",
    )
    mixed = found.where(F.size("mixed") > 0).select("key", F.col("mixed").alias("contents"))
    digests = stage(window_digests(texts.select("key", "text").join(mixed, "key"), width), "windows")
    again = stage(digests.groupBy("f1", "f2").count().where("count > 1").select("f1", "f2"), "again")
    windows = digests.join(again, ["f1", "f2"]).groupBy("key").agg(F.collect_set("f1").alias("windows"))
    marks = stage(found.select("key", "contents").join(windows, "key", "left"), "marks")
    return removed(texts.join(marks, "key", "left").select("doc_id", "text", "contents", "windows"), width)


def oracle(width: int = WIDTH) -> str:
    """DuckDB: all windows as texts, counted."""
    return rf"""
WITH lists AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(
    regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
words AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pos FROM lists),
spots AS (SELECT r, ws, unnest(range(1, len(ws) - {width - 2})) AS pos FROM lists),
windows AS (SELECT r, pos, array_to_string(list_slice(ws, pos, pos + {width - 1}), ' ') AS w FROM spots),
again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
hits AS (SELECT r, pos FROM windows JOIN again USING (w)),
gone AS (
  SELECT words.r, words.pos, words.w, max(CASE WHEN hits.pos IS NULL THEN 0 ELSE 1 END)
    OVER (PARTITION BY words.r ORDER BY words.pos ROWS BETWEEN {width - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM words LEFT JOIN hits ON hits.r = words.r AND hits.pos = words.pos),
kept AS (SELECT r, sum(gone)::BIGINT AS n, string_agg(CASE WHEN gone = 0 THEN w END, ' ' ORDER BY pos) AS t FROM gone GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM lists LEFT JOIN kept USING (r)"""
