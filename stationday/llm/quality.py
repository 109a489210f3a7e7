"""Quality classifier by positive-unlabelled learning with a non-negative risk estimate.

Trusted positives are the training rows of ``labels`` with quality 1; unlabelled text is a bounded sample
of all documents. The share of good documents among the unlabelled ones (the class prior) is estimated by
the best bin of a positive-against-unlabelled classifier. The model then minimises
``prior * R(positives, 1) + max(0, R(unlabelled, 0) - prior * R(positives, 0))``.

Defined results: a null or empty text is scored by its (all zero) features. Equal texts get equal
scores. Rows that repeat are scored each. Without positives every score is 0.5. Extra columns of the
input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.llm.common import Words, held_out, id_hash_rank, text_slices, utf8

FOLDS, HELD_OUT = 3, 1
#: Bounds of the rows that the model is fitted on.
POSITIVES = UNLABELLED = 6000
HIDDEN = 16

_GROUPS = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b"#$%&*+=<>{}[]\\^~_@/",
    b"!?",
    b"|",
    b".,;:",
    b"\"'()-",
    b"\n",
    b" \t",
    bytes(range(128, 256)),
)
N_FEATURES = len(_GROUPS) + 12


def features(column: pa.Array, words: Words) -> np.ndarray:
    """One row of numbers for each text: shares of kinds of bytes, and how words and lines repeat."""
    data, offsets = utf8(column)
    hashes, starts, ends, first = words(column)
    lengths = ends - starts
    symbol = np.zeros(256, bool)
    symbol[list(_GROUPS[3] + _GROUPS[4] + _GROUPS[5])] = True
    of_kind = np.zeros((256, len(_GROUPS)))
    for k, group in enumerate(_GROUPS):
        of_kind[list(group), k] = 1
    out = np.zeros((len(offsets) - 1, N_FEATURES))
    for i in range(len(out)):
        a, b = offsets[i], offsets[i + 1]
        lo, hi = first[i], first[i + 1]
        if lo == hi:
            continue
        text, h, size = data[a:b], hashes[lo:hi], lengths[lo:hi]
        n = hi - lo
        shares = np.bincount(text, minlength=256) @ of_kind / (b - a)
        letters = shares[0] + shares[1] + 1e-9
        _, counts = np.unique(h, return_counts=True)
        lines = bytes(text).split(b"\n")
        last = data[ends[lo:hi] - 1]
        out[i] = [
            *shares,
            shares[0] / letters,
            np.log1p(n),
            len(counts) / n,
            counts.max() / n,
            float((h[1:] == h[:-1]).sum()) / n,
            len(counts) / n**0.75,
            size.mean() / 10,
            size.std() / 10,
            (size == 1).mean(),
            symbol[last].mean(),
            1 - len(set(lines)) / len(lines),
            np.log1p(n / len(lines)),
        ]
    return out


@dataclass
class Network:
    """One hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    @classmethod
    def new(cls, x: np.ndarray, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        scale = x.std(0)
        return cls(
            x.mean(0), np.where(scale > 1e-6, scale, 1.0),
            rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0,
        )

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.tanh(self.standard(x) @ self.w1 + self.b1) @ self.w2 + self.b2
        return 1 / (1 + np.exp(-z))

    def fit(self, x: np.ndarray, slope, steps: int = 400, rate: float = 0.02, decay: float = 1e-4) -> Network:
        """Adam over all rows; ``slope(score)`` gives the risk's derivative by each row's logit."""
        x = self.standard(x)
        values = [self.w1, self.b1, self.w2, np.array([self.b2])]
        first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
        for step in range(1, steps + 1):
            hidden = np.tanh(x @ values[0] + values[1])
            out = 1 / (1 + np.exp(-(hidden @ values[2] + values[3][0])))
            d = slope(out)
            back = np.outer(d, values[2]) * (1 - hidden**2)
            grads = [x.T @ back + decay * values[0], back.sum(0), hidden.T @ d + decay * values[2], np.array([d.sum()])]
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                m, v = first[i] / (1 - 0.9**step), second[i] / (1 - 0.999**step)
                values[i] = values[i] - rate * m / (np.sqrt(v) + 1e-8)
        self.w1, self.b1, self.w2, self.b2 = values[0], values[1], values[2], float(values[3][0])
        return self


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.05) -> float:
    """Share of positives among the unlabelled: the smallest ratio of both upper tails, with its sampling error added."""
    thresholds = np.quantile(positive, np.linspace(0, 1 - least, 200))
    upper = lambda x: 1 - np.searchsorted(np.sort(x), thresholds, side="left") / len(x)
    p, u = upper(positive), upper(unlabelled)
    error = np.sqrt(np.log(400) / 2) * (len(positive) ** -0.5 + len(unlabelled) ** -0.5)
    best = int(((u + error) / np.maximum(p, least)).argmin())
    return float(np.clip(u[best] / max(p[best], least), 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> tuple[Network, float]:
    """The non-negative risk model, and the class prior it used."""
    x = np.concatenate([positive, unlabelled])
    n, m = len(positive), len(unlabelled)
    is_positive = np.arange(len(x)) < n
    if prior is None:
        # fitted on one half, judged on the other: what is learned by heart does not count
        half, good = np.arange(len(x)) % 2 == 0, is_positive
        pull = np.where(good[half], 1 / max(1, good[half].sum()), 1 / max(1, (~good[half]).sum())) / 2
        separating = Network.new(x[half], 1).fit(x[half], lambda s: (s - good[half]) * pull, steps=100, decay=1e-2)
        seen = separating.score(x[~half])
        prior = class_prior(seen[good[~half]], seen[~good[~half]]) if n > 1 and m > 1 else 0.5

    def slope(score: np.ndarray) -> np.ndarray:
        score = np.clip(score, 1e-6, 1 - 1e-6)
        negative = -np.log1p(-score)  # the loss of calling a row bad's opposite
        rest = negative[n:].mean() - prior * negative[:n].mean()
        if rest >= 0:
            return np.where(is_positive, prior * (score - 1) / n - prior * score / n, score / m)
        return np.where(is_positive, prior * score / n, -score / m)  # only the negative part is stepped back

    return Network.new(x, 2).fit(x, slope, steps=300, decay=1e-3), prior


@dataclass
class Scorer:
    network: Network | None
    prior: float = 0.5

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for part in text_slices(batches):
            if self.network is None:
                score = np.full(part.num_rows, 0.5)
            else:
                score = self.network.score(features(part.column("text"), words))
            yield pa.record_batch([part.column("doc_id"), pa.array(score)], names=["doc_id", "score"])


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for part in text_slices(batches):
        rows = pa.array(list(features(part.column("text"), words)), pa.list_(pa.float64()))
        yield pa.record_batch([part.column("good"), part.column("web"), rows], names=["good", "web", "x"])


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Scorer:
    """Fit on at most ``positives`` trusted documents and ``unlabelled`` others, both chosen by hashed id."""
    trusted = labels.where((F.col("quality") == 1) & ~held_out(F.col("doc_id"), FOLDS, HELD_OUT))
    good = id_hash_rank(trusted.select("doc_id").distinct(), "doc_id", positives).withColumn("good", F.lit(True))
    web = id_hash_rank(docs.select("doc_id").distinct(), "doc_id", unlabelled).withColumn("web", F.lit(True))
    wanted = good.join(web, "doc_id", "full").na.fill(False)
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(wanted), "doc_id")  # at most positives + unlabelled ids
        .mapInArrow(_feature_rows, "good boolean, web boolean, x array<double>")
        .collect()  # the bounded sample's features
    )
    x = np.array([r["x"] for r in rows]).reshape(len(rows), N_FEATURES)
    is_good, is_web = (np.array([r[c] for r in rows], bool) for c in ("good", "web"))
    if not is_good.any() or not is_web.any():
        return Scorer(None)
    order = np.lexsort(x.T)  # the same model whatever order the rows arrive in
    x, is_good, is_web = x[order], is_good[order], is_web[order]
    network, prior = fit(x[is_good], x[is_web])
    return Scorer(network, prior)


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


def keep_good(docs: DataFrame, model: Scorer) -> DataFrame:
    """``docs`` without the rows that the model rejects; all columns stay as they are.

    Only texts go to Python and only scores come back; rows are left out in the JVM.
    """
    if model.network is None:
        return docs

    @F.arrow_udf("double")
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Words()
        for column in texts:
            batch = pa.record_batch([column], names=["text"])
            found = [model.network.score(features(part.column("text"), words)) for part in text_slices([batch])]
            yield pa.array(np.concatenate([np.zeros(0), *found]))

    return docs.where(scores("text") >= 0.5)
