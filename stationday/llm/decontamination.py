"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages, documents into overlapping windows of words. Terms are hashed and
weighed by their inverse document frequency over all documents. A distributed randomised singular value
decomposition of the benchmark's passages gives a latent space; windows whose cosine with a passage there is
high enough are candidates. So is every window that holds enough of a passage's rarer words: none that
covers enough of a passage can do without them, however common its words are. A candidate counts if the longest common subsequence of words covers enough of the
passage, or covers less but holds the passage's answer (the item's ``answer`` if that column exists, else its last words).

Defined results: null and empty texts are clean; items without words match nothing. Documents that repeat
get equal results; items that repeat are all named, those
without an id first and once. Extra columns are ignored. An empty benchmark
leaves every document clean; an empty table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stationday.llm.common import Words, stage, text_slices
from stationday.llm.neardup import only

#: Hashed terms, rank of the latent space, extra directions of the random start.
TERMS, RANK, EXTRA = 1 << 16, 96, 16
#: Words of a block. A window is two blocks for passages of up to one block, else four; windows begin at each block.
BLOCK = 16
PASSAGE = 3 * BLOCK
#: Terms in more than this share of the documents, and some more, weigh nothing: they tell no passage apart.
COMMON, COMMON_MORE = 0.1, 20
#: Least cosine, as a share of the passage's own length in the latent space.
COSINE = 0.33
#: Share of a passage's words that a common subsequence covers: alone, and where it holds the answer.
COVERED, COVERED_WITH_ANSWER = 0.7, 0.5
ANSWER_WORDS = 5
#: A passage of fewer words counts only where it is covered whole.
SHORT = 8
#: Passages that one pass holds in memory; more are searched in several passes.
PASSAGES_AT_ONCE = 20_000
#: Passages whose rarer words are counted together.
TOGETHER = 256
#: Windows and passages that are compared together.
PAIRS = 256
#: Term rows that travel together while sums are formed.
_STRIPE = 256

#: Letters, digits and everything beyond ASCII make words.
_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())


def term_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, terms``: the hashed words of each text as 16-bit numbers, in order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(_SEPARATORS)
        for part in text_slices(batches, text):
            hashes, _, _, first = words(pc.utf8_lower(part.column(text)))
            terms = (hashes >> np.uint64(48)).astype(np.uint16)
            lists = [terms[a:b].tobytes() for a, b in zip(first, first[1:])]
            yield pa.record_batch([part.column(key), pa.array(lists, pa.binary())], names=[key, "terms"])

    return df.select(key, text).mapInArrow(rows, f"{key} {dict(df.dtypes)[key]}, terms binary")


def _terms(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint16) if value.is_valid else np.zeros(0, np.uint16)


def frequencies(terms: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For each hashed term its weight, the logarithm of documents over documents that hold it, and its share of all words."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, words, rows = np.zeros(TERMS, np.int64), np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                at, times = np.unique(_terms(value), return_counts=True)
                counts[at] += 1
                words[at] += times
                rows += 1
        at = np.flatnonzero(counts)
        yield pa.record_batch(
            [pa.array([-1, *at], pa.int32()), pa.array([rows, *counts[at]], pa.int64()), pa.array([0, *words[at]], pa.int64())],
            names=["term", "n", "words"],
        )

    sums = terms.select("terms").mapInArrow(counted, "term int, n long, words long")
    sums = sums.groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect()
    found = {r["term"]: r["n"] for r in sums}  # at most TERMS + 1 rows
    total = found.pop(-1, 0)
    share = np.zeros(TERMS)
    for row in sums:
        if row["term"] >= 0:
            share[row["term"]] = row["words"]
    share /= max(share.sum(), 1)
    out = np.full(TERMS, np.log((total + 1) / 0.5), np.float32)
    if found:
        n = np.fromiter(found.values(), float)
        out[list(found)] = np.where(n > COMMON * total + COMMON_MORE, 0.0, np.log((total + 1) / (n + 0.5)))
    return np.maximum(out, 0), share


def rarer_words(terms: np.ndarray, need: int, share: np.ndarray, window: int) -> tuple[np.ndarray, int]:
    """Distinct rarer terms of a passage, and how many words of a window must be among them.

    A window that covers ``need`` of the passage's words covers ``need - d`` at least of those that are left
    without the ``d`` most common. ``d`` is the one that chance meets least, by a Poisson estimate.
    """
    order = terms[np.lexsort((terms, share[terms]))]
    best, out = np.inf, (np.unique(order), need)
    for least in range(need, 0, -1):
        left = np.unique(order[: len(order) - (need - least)])
        expected = max(window * share[left].sum(), 1e-9)
        chance = least * np.log(expected / least) + least - expected if least > expected else 0.0
        if chance < best:
            best, out = chance, (left, least)
    return out


def passages(items: DataFrame) -> DataFrame:
    """``item_id, terms, answer``: items cut into passages; a longer item's last passage ends with the item."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            answers = batch.column("answer_terms") if "answer_terms" in batch.schema.names else [None] * batch.num_rows
            for item, value, answer in zip(batch.column("item_id").to_pylist(), batch.column("terms"), answers):
                terms = _terms(value)
                given = _terms(answer) if answer is not None else terms[:0]
                starts = [*range(0, max(1, len(terms) - PASSAGE), PASSAGE)]
                if len(terms) > PASSAGE:
                    starts.append(len(terms) - PASSAGE)
                for s in starts if len(terms) else []:
                    part = terms[s : s + PASSAGE]
                    out.append((item, part.tobytes(), (given if len(given) else part[-ANSWER_WORDS:]).tobytes()))
            columns = [*zip(*out)] or [[], [], []]
            kinds = (batch.schema.field("item_id").type, pa.binary(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["item_id", "terms", "answer"])

    return items.mapInArrow(rows, f"item_id {dict(items.dtypes)['item_id']}, terms binary, answer binary")


def _weighted(value: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A passage's terms and their tf-idf values, of unit length (zeros where no term weighs anything)."""
    at, counts = np.unique(value, return_counts=True)
    tfidf = counts * weights[at]
    return at, (tfidf / max(np.linalg.norm(tfidf), 1e-9)).astype(np.float32)


def used_terms(parts: DataFrame) -> np.ndarray:
    """The distinct terms of all passages, sorted; at most ``TERMS``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(TERMS, bool)
        for batch in batches:
            for value in batch.column(0):
                seen[_terms(value)] = True
        yield pa.record_batch([pa.array(np.flatnonzero(seen), pa.int32())], names=["term"])

    found = parts.select("terms").mapInArrow(rows, "term int").distinct().collect()
    return np.sort(np.array([r["term"] for r in found], np.int64))


def latent_space(parts: DataFrame, weights: np.ndarray, used: np.ndarray, rank: int = RANK, rounds: int = 2) -> np.ndarray:
    """Right singular vectors (used terms by rank) of all passages: randomised subspace iteration.

    Each round multiplies by the passage matrix and its transpose, one partition at a time, and sums the
    partitions' rows of terms in Spark; only a matrix of used terms by rank, of bounded size, reaches the driver.
    """
    spark = parts.sparkSession
    width = rank + EXTRA
    rows_of = -(-max(1, len(used)) // _STRIPE) * _STRIPE  # whole stripes

    def multiplied(basis: np.ndarray) -> np.ndarray:
        held = spark.sparkContext.broadcast((weights, used, basis))

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, used, basis = held.value
            sums = np.zeros((rows_of, width), np.float32)
            for batch in batches:
                for value in batch.column(0):
                    terms, tfidf = _weighted(_terms(value), weights)
                    at = np.searchsorted(used, terms)
                    sums[at] += np.outer(tfidf, tfidf @ basis[at])
            stripes = sums.reshape(-1, _STRIPE * width)
            filled = np.flatnonzero(stripes.any(1))
            yield pa.record_batch(
                [pa.array(filled, pa.int32()), pa.array([stripes[i].tobytes() for i in filled], pa.binary())], names=["stripe", "values"]
            )

        def added(rows):
            total = sum(np.frombuffer(v, np.float32).astype(np.float64) for v in rows["values"])
            rows = rows[["stripe"]].head(1).copy()
            rows["values"] = [total.astype(np.float32).tobytes()]
            return rows

        schema = "stripe int, values binary"
        out = np.zeros((rows_of // _STRIPE, _STRIPE * width), np.float32)
        for row in parts.select("terms").mapInArrow(partial, schema).groupBy("stripe").applyInPandas(added, schema).collect():
            out[row["stripe"]] = np.frombuffer(row["values"], np.float32)
        held.unpersist()
        return out.reshape(rows_of, width)

    basis = np.random.default_rng(11).standard_normal((rows_of, width), np.float32)
    for _ in range(rounds):
        q = np.linalg.qr(multiplied(basis))[0]
        basis = np.zeros((rows_of, width), np.float32)
        basis[:, : q.shape[1]] = q
    _, vectors = np.linalg.eigh(basis.T.astype(np.float64) @ multiplied(basis))
    return (basis @ vectors[:, ::-1][:, :rank]).astype(np.float32)[: len(used)]


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit operations on whole rows."""
    places: dict[int, int] = {}
    for i, x in enumerate(b.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    full = row = (1 << len(b)) - 1
    for x in a.tolist():
        match = row & places.get(x, 0)
        row = ((row + match) | (row - match)) & full
    return len(b) - row.bit_count()


@dataclass
class Index:
    """Passages in the latent space and by their rarer words, by the number of blocks of the windows they are searched in."""

    weights: np.ndarray
    share: np.ndarray
    used: np.ndarray
    space: np.ndarray
    items: list
    terms: list[np.ndarray]
    answers: list[np.ndarray]

    def __post_init__(self):
        self.row = np.full(TERMS, -1, np.int64)  # of each term in the space, where it weighs anything
        weighing = (self.weights[self.used] > 0) & np.abs(self.space).any(1)
        self.row[self.used[weighing]] = np.flatnonzero(weighing)
        vectors = np.zeros((len(self.terms), self.space.shape[1]), np.float32)
        self.places = np.full((len(self.terms), PASSAGE), TERMS, np.int64)  # TERMS: no word
        for i, t in enumerate(self.terms):
            at, tfidf = _weighted(t, self.weights)
            vectors[i] = tfidf @ self.space[np.searchsorted(self.used, at)]
            self.places[i, : len(t)] = t
        self.lengths = np.linalg.norm(vectors, axis=1)
        self.unit = vectors / np.maximum(self.lengths, 1e-9)[:, None]
        self.sizes = np.array([len(t) for t in self.terms], np.int64)
        self.need = np.where(self.sizes < SHORT, 1.0, COVERED_WITH_ANSWER) * self.sizes
        self.groups = [(2, np.flatnonzero(self.sizes <= BLOCK)), (4, np.flatnonzero(self.sizes > BLOCK))]
        self.present = None
        # rarer words by parts of the passages: a row for each term (row 0: other terms), and the passages that have it
        self.rarer = []
        for width, group in self.groups:
            parts = []
            for part in np.array_split(np.arange(len(group)), -(-len(group) // TOGETHER) or 1):
                chosen = [rarer_words(self.terms[i], int(np.ceil(self.need[i])), self.share, width * BLOCK) for i in group[part]]
                if chosen:
                    terms, rows = np.unique(np.concatenate([c[0] for c in chosen]), return_inverse=True)
                    which = np.repeat(np.arange(len(part)), [len(c[0]) for c in chosen])
                    parts.append((part, terms, rows + 1, which, np.array([c[1] for c in chosen], np.uint8)))
            self.rarer.append(parts)

    def _overlaps(self, parts, terms, starts, low, high) -> tuple[np.ndarray, np.ndarray]:
        """(window, passage of the group) wherever a window has enough words among the passage's rarer ones."""
        windows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for part, used, rows, which, least in parts:
            held = np.zeros((len(used) + 1, len(part)), np.uint8)
            held[rows, which] = 1
            row = np.zeros(TERMS, np.int32)
            row[used] = np.arange(1, len(used) + 1)
            row = np.append(row[terms], 0)
            sizes = np.diff(starts, append=len(terms))
            # sums wrap around, their differences do not: a window has at most 64 words
            sums = np.zeros((len(starts) + 1, len(part)), np.uint8)
            for k in range(BLOCK):
                sums[1:] += held[row[np.where(k < sizes, starts + k, -1)]]
            np.cumsum(sums, 0, dtype=np.uint8, out=sums)
            for chunk in np.array_split(np.arange(len(low)), len(low) // 1024 + 1):
                w, p = np.nonzero(sums[high[chunk]] - sums[low[chunk]] >= least)
                windows.append(chunk[w])
                found.append(part[p])
        return np.concatenate(windows), np.concatenate(found)

    def search(self, texts: list[np.ndarray]) -> list[dict]:
        """For each document the items found in it, with the share of their passage that is covered."""
        found: list[dict] = [{} for _ in texts]
        sizes = np.array([len(t) for t in texts], np.int64)
        if not sizes.sum() or not len(self.terms):
            return found
        terms = np.concatenate(texts)
        # blocks never reach over two documents
        ends = np.cumsum(sizes)
        blocks = -(-sizes // BLOCK)
        first_block = np.cumsum(blocks) - blocks
        owner = np.repeat(np.arange(len(texts)), blocks)
        starts = (ends - sizes)[owner] + (np.arange(len(owner)) - first_block[owner]) * BLOCK
        weights = self.weights[terms]
        squares = np.concatenate([[0.0], np.cumsum(np.add.reduceat(weights * weights, starts), dtype=np.float64)])
        row = self.row[terms]
        at = np.flatnonzero(row >= 0)
        sums = np.zeros((len(starts) + 1, self.space.shape[1]), np.float64)
        if len(at):
            touched, first = np.unique(np.searchsorted(starts, at, side="right") - 1, return_index=True)
            sums[touched + 1] = np.add.reduceat(self.space[row[at]] * weights[at, None], first)
            np.cumsum(sums, 0, out=sums)
        last_block = (first_block + blocks)[owner]
        for (width, group), rarer in zip(self.groups, self.rarer):
            if not len(group):
                continue
            low = np.arange(len(starts))
            low = low[(low + width <= last_block) | (low == first_block[owner])]  # a short document is one window
            high = np.minimum(low + width, last_block[low])
            window = (sums[high] - sums[low]).astype(np.float32)
            norms = np.sqrt(np.maximum(squares[high] - squares[low], 1e-12)).astype(np.float32)
            share = np.linalg.norm(window, axis=1) / norms
            # no passage can come closer to a window than the window's own part in the space
            close = np.flatnonzero(share >= COSINE * self.lengths[group].min())
            pairs = []
            for chunk in np.array_split(close, len(close) // 1024 + 1):
                cosine = (window[chunk] / norms[chunk, None]) @ self.unit[group].T
                w, p = np.nonzero(cosine >= np.maximum(COSINE * self.lengths[group], 1e-3))
                pairs.append(chunk[w] * len(group) + p)
            w, p = self._overlaps(rarer, terms, starts, low, high)
            w, p = np.divmod(np.unique(np.concatenate([*pairs, w * len(group) + p])), len(group))
            begin = starts[low]
            end = np.where(high == last_block[low], ends[owner[low]], np.append(starts, len(terms))[high])
            for part in np.array_split(np.arange(len(w)), len(w) // PAIRS + 1):
                self._compare(begin, end, owner[low], w[part], group[p[part]], terms, found)
        return found

    def _compare(self, begin, end, owner, windows, passages, terms, found: list[dict]) -> None:
        # a common subsequence is no longer than the terms in common
        if self.present is None:  # made where it is used: it need not travel
            self.present = np.zeros((PAIRS + 1, TERMS + 1), bool)
        distinct, at = np.unique(windows, return_inverse=True)
        sizes = end[distinct] - begin[distinct]
        each = np.repeat(np.arange(len(distinct)), sizes)
        words = terms[np.arange(len(each)) + np.repeat(begin[distinct] - (np.cumsum(sizes) - sizes), sizes)]
        self.present[each, words] = True
        enough = self.present[at[:, None], self.places[passages]].sum(1) >= self.need[passages]
        self.present[each, words] = False
        for which, passage in zip(windows[enough], passages[enough]):
            window, so_far = terms[begin[which] : end[which]], found[owner[which]]
            wanted, answer, item = self.terms[passage], self.answers[passage], self.items[passage]
            common = common_subsequence(wanted, window)
            covered = common / len(wanted)
            if common < self.need[passage] or so_far.get(item, 0) >= covered:
                continue
            if covered >= COVERED or common_subsequence(answer, window) == len(answer):
                so_far[item] = covered


def search(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """``doc_id, contaminated, items, covered`` of every row: items found, in order, and the best share covered."""
    spark = docs.sparkSession
    terms = stage(term_rows(docs, "doc_id", "text"), "terms")
    weights, share = frequencies(terms)
    items = term_rows(benchmark, "item_id", "text")
    if "answer" in benchmark.columns:
        answers = term_rows(benchmark, "item_id", "answer").withColumnRenamed("terms", "answer_terms")
        items = items.join(answers.dropDuplicates(["item_id"]), "item_id", "left")
    parts = stage(passages(items), "passages")
    used = used_terms(parts)
    space = latent_space(parts, weights, used, rank)
    passes = -(-parts.count() // PASSAGES_AT_ONCE) or 1
    kind = dict(benchmark.dtypes)["item_id"]
    listed = pa.list_(to_arrow_type(benchmark.schema["item_id"].dataType))
    results = None
    for k in range(passes):
        rows = parts.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(passes)) == k).orderBy("item_id", "terms").collect()
        numbers = [np.frombuffer(r["terms"], np.uint16) for r in rows]
        held = spark.sparkContext.broadcast(
            Index(weights, share, used, space, [r["item_id"] for r in rows], numbers, [np.frombuffer(r["answer"], np.uint16) for r in rows])
        )

        def searched(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = held.value
            for batch in batches:
                for part in text_slices([batch], "terms"):
                    found = index.search([_terms(v) for v in part.column("terms")])
                    yield pa.record_batch(
                        [
                            part.column("doc_id"),
                            pa.array([sorted(f, key=lambda i: (i is not None, i)) for f in found], listed),
                            pa.array([max(f.values(), default=0.0) for f in found], pa.float64()),
                        ],
                        names=["doc_id", "items", "covered"],
                )

        found = terms.mapInArrow(searched, f"doc_id long, items array<{kind}>, covered double")
        results = found if results is None else results.unionByName(found)
    if passes > 1:
        results = results.groupBy("doc_id").agg(
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("covered").alias("covered")
        )
    return results.select("doc_id", (F.size("items") > 0).alias("contaminated"), "items", "covered")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones."""
    return only(docs, search(docs, benchmark).where("contaminated"), "left_anti").select(*docs.columns)
