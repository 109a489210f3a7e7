"""Toxicity by a lexicon trie run together with Levenshtein automata, weighed by its context.

The lexicon (words, and word beginnings marked ``*``) is learned from a bounded sample of labelled
training rows. One lazily built deterministic automaton follows the trie and counts edits, so a
misspelled term costs one table lookup a character. Hits are told apart by spelling and by whether
they stand in a quotation; the densest window of words counts extra. A logistic model weighs these.

Defined results: a null or empty text has no hits and gets the model's base score. Equal texts get
equal scores; rows that repeat are scored each. Without toxic training rows every score is 0. Extra
columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.llm.common import held_out, id_hash_rank, text_slices

FOLDS, HELD_OUT = 5, 0
#: Bounds: labelled rows to learn from, entries of the lexicon.
SAMPLE, ENTRIES = 12000, 400
#: Words of the context window.
WINDOW = 50
#: Words looked back for an open quotation.
QUOTE_REACH = 30
#: Share of its weight that a quoted hit keeps; a misspelled one is divided by one plus its edits.
QUOTED = 0.25
CACHE = 300_000
N_FEATURES = 6
_WORD = re.compile(r"\w+")
_MARKS = re.compile(r"[\"“”„«»]")


def terms_of(text: str) -> set[str]:
    """Words of a text, and their beginnings of 4 to 7 characters marked ``*``."""
    words = {w for w in _WORD.findall(text.lower()) if 3 <= len(w) <= 40 and not w.isdigit()}
    return words | {w[:n] + "*" for w in words for n in range(4, 8) if len(w) > n}


class Automaton:
    """All words within the allowed edits of a lexicon term: Levenshtein automata run along a trie.

    A state is a set of (trie node, edits so far), kept under a number; transitions are found once and
    remembered. ``match`` gives (term, edits) of the cheapest hit. Terms of 5 to 8 characters allow one
    edit, longer ones two, shorter ones and beginnings none.
    """

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word: list[int] = [-1]
        self.stem: list[int] = [-1]
        self.allowed: list[int] = [0]
        for number, term in enumerate(terms):
            is_stem = term.endswith("*")
            plain = term.rstrip("*")
            edits = 0 if is_stem or len(plain) < 5 else 1 if len(plain) < 9 else 2
            node = 0
            self.allowed[0] = max(self.allowed[0], edits)
            for c in plain:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.word.append(-1)
                    self.stem.append(-1)
                    self.allowed.append(0)
                node = self.children[node][c]
                self.allowed[node] = max(self.allowed[node], edits)
            (self.stem if is_stem else self.word)[node] = number
        self.edits_of = [0 if t.endswith("*") or len(t) < 5 else 1 if len(t) < 9 else 2 for t in terms]
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.stems: list[int] = []
        self.start = self._number(self._closed({0: 0}))

    def _closed(self, least: dict[int, int]) -> frozenset:
        """Add nodes reached by leaving out term characters; each node keeps its fewest edits."""
        todo = list(least.items())
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits + 1 <= self.allowed[child] and edits + 1 < least.get(child, 99):
                    least[child] = edits + 1
                    todo.append((child, edits + 1))
        return frozenset(least.items())

    def _number(self, state: frozenset) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            ends = [(e, self.word[n]) for n, e in state if self.word[n] >= 0 and e <= self.edits_of[self.word[n]]]
            self.accepts.append(min(ends) if ends else None)
            exact = [self.stem[n] for n, e in state if e == 0 and self.stem[n] >= 0]
            self.stems.append(exact[0] if exact else -1)
        return self.numbers[state]

    def _move(self, number: int, c: str) -> int:
        least: dict[int, int] = {}
        for node, edits in self.states[number]:
            child = self.children[node].get(c)
            if child is not None and edits <= self.allowed[child]:
                least[child] = min(edits, least.get(child, 99))
            if edits + 1 <= self.allowed[node]:  # a character too many
                least[node] = min(edits + 1, least.get(node, 99))
            for child in self.children[node].values():  # another character
                if edits + 1 <= self.allowed[child]:
                    least[child] = min(edits + 1, least.get(child, 99))
        return self._number(self._closed(least)) if least else -1

    def match(self, word: str) -> tuple[int, int] | None:
        state, stem = self.start, -1
        for c in word:
            moves = self.moves[state]
            after = moves.get(c)
            if after is None:
                after = moves[c] = self._move(state, c)
            if after < 0:
                return (stem, 0) if stem >= 0 else None
            state = after
            if self.stems[state] >= 0:
                stem = self.stems[state]
        end = self.accepts[state]
        if end is not None and (end[0] == 0 or stem < 0):
            return end[1], end[0]
        return (stem, 0) if stem >= 0 else None


@dataclass
class Lexicon:
    terms: list[str]
    weights: list[float]
    _ready: tuple | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"terms": self.terms, "weights": self.weights, "_ready": None}

    def hits(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(place, term, edits) of every word that matches."""
        if self._ready is None:
            self._ready = (Automaton(self.terms), {})
        automaton, known = self._ready
        if len(known) > CACHE:
            known.clear()
        found = []
        for i, w in enumerate(words):
            try:
                hit = known[w]
            except KeyError:
                hit = automaton.match(w)  # it stops where no term is left within the allowed edits
                if len(w) <= 60:  # longer ones are not worth remembering
                    known[w] = hit
            if hit is not None:
                found.append((i, *hit))
        return found

    def features(self, text: str | None) -> list[float]:
        """Weights summed, in the densest window, of the strongest hit and by length; distinct terms; misspelled ones."""
        lower = (text or "").lower()
        words = _WORD.findall(lower)
        found = self.hits(words)
        if not found:
            return [0.0] * N_FEATURES
        quoted = self._quoted(lower, found)
        placed = [
            (i, self.weights[term] / (1 + edits) * (QUOTED if q else 1.0), term) for (i, term, edits), q in zip(found, quoted)
        ]
        densest = window = 0.0
        start = 0
        for i, w, _ in placed:
            window += w
            while placed[start][0] <= i - WINDOW:
                window -= placed[start][1]
                start += 1
            densest = max(densest, window)
        total = sum(w for _, w, _ in placed)
        return [
            math.log1p(total),
            math.log1p(densest),
            math.log1p(len({t for _, _, t in placed})),
            max(w for _, w, _ in placed),
            math.log1p(100 * total / len(words)),
            math.log1p(sum(self.weights[t] for (_, t, e) in found if e)),
        ]

    @staticmethod
    def _quoted(lower: str, found: list[tuple[int, int, int]]) -> list[bool]:
        """Whether each hit stands between quotation marks of which the first is at most ``QUOTE_REACH`` words back."""
        if not _MARKS.search(lower):
            return [False] * len(found)
        state, opened, place = False, 0, 0
        at = {i: n for n, (i, _, _) in enumerate(found)}
        inside, pending = [False] * len(found), []
        for m in re.finditer(r"\w+|[\"“”„«»]", lower):
            if m[0][0] in "\"“”„«»":
                if state:
                    for n in pending:
                        inside[n] = True
                pending, opened, state = [], place, not state
                continue
            if state and place - opened > QUOTE_REACH:
                state, pending = False, []
            if state and place in at:
                pending.append(at[place])
            place += 1
        return inside


def learn_lexicon(sample: DataFrame, entries: int = ENTRIES) -> Lexicon:
    """Terms far more frequent in toxic documents; ``sample`` is bounded and has ``toxic`` and ``text``."""

    def count(known: set[str] | None):
        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: Counter[str] = Counter()
            for part in text_slices(batches):
                for text in part.column("text").to_pylist():
                    total.update(terms_of(text or "") if known is None else terms_of(text or "") & known)
                    total[""] += 1
            yield pa.record_batch([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["term", "n"])

        return counted

    def totals(toxic: int, known: set[str] | None, least: int) -> dict[str, int]:
        rows = sample.where(F.col("toxic") == toxic).select("text").mapInArrow(count(known), "term string, n long")
        summed = rows.groupBy("term").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("term") == ""))
        # the most frequent terms of a bounded sample
        return {r["term"]: r["n"] for r in summed.orderBy(F.desc(F.col("term") == ""), F.desc("n"), "term").limit(20000).collect()}

    bad = totals(1, None, 4)
    n_bad = bad.pop("", 0)
    if not n_bad:
        return Lexicon([], [])
    good = totals(0, set(bad), 1)
    n_good = good.pop("", 0)
    rated = []
    for term, n in bad.items():
        m = good.get(term, 0)
        odds = math.log((n + 0.5) / (n_bad + 1)) - math.log((m + 0.5) / (n_good + 1))
        error = math.sqrt(1 / (n + 0.5) + 1 / (m + 0.5))
        if odds - 2.0 * error > 1.0:
            rated.append((n * odds, term, odds))
    covering: dict[str, int] = {}  # of each beginning, the documents of its most frequent word
    for term, n in bad.items():
        if not term.endswith("*"):
            for size in range(4, 8):
                covering[term[:size] + "*"] = max(n, covering.get(term[:size] + "*", 0))
    # a beginning earns its place only where no single word explains it
    rated = [r for r in rated if not r[1].endswith("*") or bad[r[1]] > 1.5 * covering.get(r[1], 0)]
    rated.sort(key=lambda r: (-r[0], r[1]))
    chosen: list[tuple[str, float]] = []
    taken: set[str] = set()
    for _, term, odds in rated:
        if len(chosen) == entries:
            break
        plain = term.rstrip("*")
        if any(plain[:size] + "*" in taken for size in range(4, len(plain) + 1)):
            continue  # a chosen beginning covers it
        taken.add(term)
        chosen.append((term, round(odds, 6)))
    return Lexicon([t for t, _ in chosen], [w for _, w in chosen])


@dataclass
class Scorer:
    lexicon: Lexicon
    coefficients: list[float] | None
    base: float = 0.0

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.coefficients is None:
            return np.zeros(len(texts))
        x = np.array([self.lexicon.features(t) for t in texts]).reshape(len(texts), N_FEATURES)
        return 1 / (1 + np.exp(-(x @ np.array(self.coefficients) + self.base)))

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            score = self.score(part.column("text").to_pylist())
            yield pa.record_batch([part.column("doc_id"), pa.array(score)], names=["doc_id", "score"])


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 60) -> tuple[list[float], float]:
    """Ridge-penalised logistic regression by Newton steps."""
    design = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(design.shape[1], penalty * len(x))
    ridge[-1] = 1e-6
    w = np.zeros(design.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design.T * (p * (1 - p) + 1e-9)) @ design + np.diag(ridge), design.T @ (p - y) + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w[:-1]], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Scorer:
    """Learn the lexicon and the weights from at most ``rows`` labelled rows outside the held-out fold."""
    usable = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"), FOLDS, HELD_OUT))
    chosen = id_hash_rank(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id", rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").persist()  # at most `rows` ids
    try:
        lexicon = learn_lexicon(sample.select("toxic", "text"))
        if not lexicon.terms:
            return Scorer(lexicon, None)

        def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in text_slices(batches):
                x = [lexicon.features(t) for t in part.column("text").to_pylist()]
                yield pa.record_batch([part.column("toxic").cast(pa.int32()), pa.array(x, pa.list_(pa.float64()))], names=["toxic", "x"])

        found = sample.select("toxic", "text").mapInArrow(rows_of, "toxic int, x array<double>").collect()  # bounded sample
    finally:
        sample.unpersist()
    x = np.array([r["x"] for r in found])
    y = np.array([r["toxic"] for r in found], float)
    order = np.lexsort(np.column_stack([x, y]).T)
    return Scorer(lexicon, *logistic(x[order], y[order]))


def score(docs: DataFrame, model: Scorer) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    return (
        docs.select("doc_id", "text")
        .mapInArrow(model, "doc_id long, score double")
        .select(
            "doc_id",
            held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
            "score",
            (F.col("score") >= 0.5).cast("int").alias("predicted"),
        )
    )
