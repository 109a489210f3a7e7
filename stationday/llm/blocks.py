"""Words of many texts in bounded blocks: byte positions, and digests of words without a Python object per word."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

from stationday.llm.common import mix

#: Bytes handled at once; only a longer single word makes a longer block.
BLOCK_BYTES = 1 << 20
#: Longer words are digested one by one.
LONG_WORD = 256


def word_blocks(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, most: int = BLOCK_BYTES
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Byte starts, byte ends and text numbers of the words in ``data``, a block of about ``most`` bytes at a time.

    A word is a run of bytes for which ``inside`` holds; it ends with its text. ``offsets`` are the n + 1
    bounds of the texts. Words are never cut by a block.
    """
    size, at = len(data), 0
    while at < size:
        end = min(size, at + most)
        while end < size and inside[data[end]] and inside[data[end - 1]]:
            # the word at the cut ends before the next other byte, or with its text
            text_end = offsets[np.searchsorted(offsets, end, side="left")]
            if text_end == end:
                break
            rest = inside[data[end : min(text_end, end + most)]]
            end += len(rest) if rest.all() else int(rest.argmin())
            if end == text_end:
                break
        marked = np.zeros(end - at + 2, bool)
        marked[1:-1] = inside[data[at:end]]
        bounds = offsets[np.searchsorted(offsets, at, side="right") : np.searchsorted(offsets, end, side="left")] - at
        starts = marked[1:-1] & ~marked[:-2]
        ends = marked[1:-1] & ~marked[2:]
        starts[bounds] = marked[1:-1][bounds]
        ends[bounds - 1] = marked[1:-1][bounds - 1]
        starts, ends = np.flatnonzero(starts) + at, np.flatnonzero(ends) + at + 1
        if len(starts):
            yield starts, ends, np.searchsorted(offsets, starts, side="right") - 1
        at = end


def run_positions(key: np.ndarray) -> np.ndarray:
    """For each element its place in its run of equal neighbours, from 0."""
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(first)
    return np.arange(len(key)) - np.repeat(at, np.diff(np.append(at, len(key))))


class WordDigests:
    """Two independent 64-bit digests of each word; together they stand for the word."""

    def __init__(self):
        rng = np.random.default_rng(20240607)
        self.values = rng.integers(1, 2**63, (2, 256), dtype=np.uint64) | np.uint64(1)
        self.base = 0x9E3779B97F4A7C15
        self.inverse = pow(self.base, -1, 2**64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            size = 1 << (size - 1).bit_length()
            self.powers, self.inverses = powers(self.base, size), powers(self.inverse, size)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros((2, len(starts)), np.uint64)
        short = ends - starts <= LONG_WORD
        lo, hi = starts[short], ends[short]
        if len(lo):
            # only bytes of short words are summed, so a long word costs no memory
            place = np.zeros(len(lo) + 1, np.int64)
            np.cumsum(hi - lo, out=place[1:])
            part = data[np.repeat(lo - place[:-1], hi - lo) + np.arange(place[-1])]
            self._grow(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            for k in range(2):
                np.cumsum(self.values[k][part] * self.powers[: len(part)], out=sums[1:])
                out[k, short] = mix((sums[place[1:]] - sums[place[:-1]]) * self.inverses[place[:-1]])
        for i in np.flatnonzero(~short):
            digest = hashlib.blake2b(memoryview(data[starts[i] : ends[i]]), digest_size=16).digest()
            out[:, i] = np.frombuffer(digest, np.uint64)
        return out[0], out[1]


def powers(base: int, size: int) -> np.ndarray:
    """``base ** 0, 1, ...`` modulo 2 ** 64."""
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Windows:
    """Digests of runs of words by two prefix sums of their digests."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        n = len(first)
        self.inverses, grown = [], []
        for base, digests in ((0xD6E8FEB86659FD93, first), (0xA0761D6478BD642F, second)):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(digests * powers(base, n), out=sums[1:])
            grown.append(sums)
            self.inverses.append(powers(pow(base, -1, 2**64), n + 1))
        self.sums = grown

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = mix((ends - starts).astype(np.uint64))
        a, b = (mix((s[ends] - s[starts]) * inv[starts]) for s, inv in zip(self.sums, self.inverses))
        return a ^ size, b + size
