"""Bounded-space online packing of tokenised documents into sequences of a fixed length.

Each partition streams its documents with a fixed number of open windows: full windows are cut from a
document, its rest goes to the open window that it fills best; when none fits and all are open, the
fullest is emitted. Windows still open at a partition's end are merged between partitions, in rounds over
groups of fixed size that see window sizes only, never tokens.

Defined results: a null or empty text is one end id. Every id lies in exactly one piece. Rows that
repeat are packed each. Extra columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import bisect
import json
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.llm.common import stage, text_slices

LENGTH = 1024
#: Open windows of a partition, and partitions or groups whose leftovers meet in one merge.
OPEN, FAN_IN = 256, 32
#: Texts between spaces whose ids a worker remembers.
CACHE = 400_000
#: A space before white space or the end.
NO_BOUNDARY = re.compile(r" (?:\s|\Z)")
#: Marks that end a word, none of which begins a contraction.
MARKS = ".,;:!?)"
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
END_ID = (0).to_bytes(4, "little")
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, window long, offset long, left boolean"


class _Known(dict):
    """Ids of texts that follow a space; a text that is not known yet is encoded once and remembered."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encoder.ids_after_space(chunk)
        if len(chunk) <= 40:
            if len(self) >= CACHE:
                self.clear()
            self[chunk] = ids
        return ids


class Encoder:
    """Ids of a byte-level BPE vocabulary as little-endian 32-bit bytes, equal to those of the ``tokenizers`` library.

    A piece boundary of this vocabulary's pattern lies before each space that follows no white space and
    precedes none. Texts between such spaces repeat, so their ids are remembered. Letters after a space are one piece, and so are
    marks after letters; these need no pattern. ``added`` tokens are cut out of the text before and get their own ids.
    """

    def __init__(self, ranks_path: str, pattern: str, added: dict[str, int] | None = None):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known = _Known(self)
        self.marks: dict[str, bytes] = {}
        self.added = {token: i.to_bytes(4, "little") for token, i in (added or {}).items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def _ids(self, text: str) -> bytes:
        return self.bpe.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        return array("I", self.bpe._encode_single_piece(piece)).tobytes() if LITTLE else self._ids(piece)

    def ids_after_space(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self._piece(" " + chunk)
        word = chunk.rstrip(MARKS)
        if word.isalpha():
            marks = chunk[len(word) :]
            if marks not in self.marks:
                if len(marks) > 40:
                    return self._ids(" " + chunk)
                if len(self.marks) >= CACHE:
                    self.marks.clear()
                self.marks[marks] = self._piece(marks)
            return self.known[word] + self.marks[marks]
        return self._ids(" " + chunk)

    def __call__(self, text: str) -> bytes:
        if not any(token in text for token in self.added):
            return self._plain(text)
        return b"".join(self.added.get(part) or self._plain(part) for part in self.cut.split(text))

    def _plain(self, text: str) -> bytes:
        chunks = text.split(" ")
        if NO_BOUNDARY.search(text):
            # cut only before a text that follows a space and no other white space
            cuts = [0]
            cuts += [i for i in range(1, len(chunks)) if chunks[i] and not chunks[i][0].isspace() and (chunks[i - 1] or i == 1)]
            chunks = [" ".join(chunks[i:j]) for i, j in zip(cuts, [*cuts[1:], len(chunks)])]
        first = chunks.pop(0)
        return (self._ids(first) if first else b"") + b"".join(map(self.known.__getitem__, chunks))


@lru_cache(maxsize=2)
def public_encoder(ranks: str = "byte_bpe_50k.tiktoken") -> Encoder:
    """The encoder of a vocabulary file of ``public_tokenizers``, with the added tokens of its JSON form.

    A worker process keeps it, and the ids it remembers, for all its tasks.
    """
    import public_tokenizers

    with open(public_tokenizers.path(ranks.removesuffix(".tiktoken") + ".json"), encoding="utf-8") as file:
        added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
    return Encoder(public_tokenizers.path(ranks), public_tokenizers.PATTERN, added)


class Windows:
    """A fixed number of open windows: best fit, else the fullest goes out."""

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.open: list[tuple[int, int]] = []  # (room, window), sorted
        self.items: dict[int, list] = {}
        self.next = 0

    def place(self, size: int, item) -> Iterator[list]:
        """Put an item of ``size`` into a window; yields windows that are emitted by this, as lists of (item, offset)."""
        at = bisect.bisect_left(self.open, (size, -1))
        if at < len(self.open):
            room, window = self.open.pop(at)
        else:
            if len(self.open) == self.most:
                yield self.items.pop(self.open.pop(0)[1])
            room, window = self.length, self.next
            self.next += 1
            self.items[window] = []
        self.items[window].append((item, self.length - room))
        if room > size:
            bisect.insort(self.open, (room - size, window))
        else:
            yield self.items.pop(window)

    def rest(self) -> Iterator[tuple[int, list]]:
        """The filled length and the items of each window that is still open."""
        for room, window in self.open:
            yield self.length - room, self.items[window]


def pieces(docs: DataFrame, encoder: Callable[[], Callable[[str], bytes]], length: int, most: int) -> DataFrame:
    """One row per piece with its partition's window; ``left`` marks windows that were open at the end."""
    names = [c.split()[0] for c in PIECES.split(", ")]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, windows = encoder(), Windows(length, most)
        base = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []
        count = 0

        def add(window: list, left: bool) -> None:
            nonlocal count
            rows.extend((*item, base + count, offset, left) for item, offset in window)
            count += 1

        def flush() -> Iterator[pa.RecordBatch]:
            if rows:
                yield pa.record_batch([pa.array(c) for c in zip(*rows)], names=names).cast(_SCHEMA)
                rows.clear()

        for part in text_slices(batches):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                ids = encode(text or "") + END_ID
                total = len(ids) // 4
                for start in range(0, total, length):
                    size = min(length, total - start)
                    item = (doc_id, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), total)
                    if size == length:
                        add([(item, 0)], False)
                    else:
                        for window in windows.place(size, item):
                            add(window, False)
            yield from flush()
        for _, window in windows.rest():
            add(window, True)
        yield from flush()

    return docs.select("doc_id", "text").mapInArrow(packed, PIECES)


_SCHEMA = pa.schema(
    [(n, pa.bool_() if n == "left" else pa.int64()) for n in (c.split()[0] for c in PIECES.split(", "))]
)


def merge_round(roots: DataFrame, length: int, most: int, fan_in: int) -> DataFrame:
    """Pack the windows of each group of ``fan_in`` neighbours; at most ``most`` of a group stay open for the next round."""

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["fill", "root"], ascending=[False, True])
        windows = Windows(length, len(rows) + 1)
        closed = []
        for root, fill in zip(rows["root"], rows["fill"]):
            closed.extend(windows.place(int(fill), (int(root), int(fill))))
        left = sorted((f, w) for f, w in windows.rest())
        done = [(w, False, length) for w in closed] + [(w, i < most, f) for i, (f, w) in enumerate(left)]
        out = [
            (int(rows["part"].iloc[0]) // fan_in, root, window[0][0][0], offset, fill, is_open)
            for window, is_open, fill in done
            for (root, _), offset in window
        ]
        return pd.DataFrame(out, columns=["part", "root", "new_root", "add", "fill", "open"])

    schema = "part long, root long, new_root long, add long, fill long, open boolean"
    return roots.groupBy(F.expr(f"part div {fan_in}").alias("_group")).applyInPandas(
        lambda key, rows: merged(rows), schema
    )


def pack(
    docs: DataFrame,
    encoder: Callable[[], Callable[[str], bytes]] = public_encoder,
    length: int = LENGTH,
    most: int = OPEN,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """All documents as pieces: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    placed = stage(pieces(docs, encoder, length, most), "pieces")
    left = placed.where("left")
    size = F.sum("length").alias("fill")
    roots = left.groupBy(F.col("window").alias("root")).agg(size).withColumn("part", F.expr("shiftright(root, 36)"))
    places = left.select("window").distinct().select("window", F.col("window").alias("root"), F.lit(0).cast("long").alias("base"))
    last = roots.agg(F.max("part")).first()[0]
    while last is not None:
        merged = stage(merge_round(roots, length, most, fan_in), "merged")
        places = (
            places.join(merged.select("root", "new_root", "add"), "root", "left")
            .select("window", F.coalesce("new_root", "root").alias("root"), (F.col("base") + F.coalesce("add", F.lit(0))).alias("base"))
        )
        if last < fan_in:
            break
        last //= fan_in
        roots = merged.where("open").select(F.col("new_root").alias("root"), "fill", "part").distinct()
    moved = left.join(places, "window").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("root").alias("sequence_id"), (F.col("offset") + F.col("base")).alias("offset")
    )
    whole = placed.where("not left").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("window").alias("sequence_id"), "offset")
    return whole.unionByName(moved)
