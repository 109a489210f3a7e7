"""Secret scans: fixed patterns, and character Markov models that tell random strings from ordinary ones.

DataFrame functions only. Two models of character pairs, one of random strings and one of ordinary
words and identifiers, are trained from labelled samples. A long token is a secret where the mean
log-likelihood ratio of its pairs is above the threshold that lies between the means of both samples.

Defined results: a null or empty text has no spans. Repeated rows get equal results. Positions count
code points, ends are exclusive. Extra columns of the input are ignored. Where a table is empty or holds
no ordinary tokens, all pairs of the ordinary model are equally likely.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.llm.common import id_hash_rank

#: The base patterns, in the order of their kinds. The pair is (pattern, least length).
#: For access and hex the least length is part of the pattern, which finds the same spans: a run is taken whole.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
#: Tokens that the models judge.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
REDACTED = "[SECRET]"


def spans_of(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost matches that do not overlap, as ``array<struct<start, end, value>>``.

    The matches and the texts between them alternate, so that their lengths give the positions.
    """
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    found = F.filter(pieces, lambda p: p["match"].isNotNull())
    kind = "array<struct<start:long,end:long,value:string>>"
    return F.aggregate(
        found,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["gap"]) + F.length(p["match"])).alias("at"),
            F.array_append(
                acc["spans"],
                F.struct(
                    (acc["at"] + F.length(p["gap"])).alias("start"),
                    (acc["at"] + F.length(p["gap"]) + F.length(p["match"])).alias("end"),
                    p["value"].alias("value"),
                ),
            ).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )


def none() -> Column:
    return F.array().cast("array<struct<start:long,end:long,value:string>>")


def pairs(token: Column) -> Column:
    """Places of a token's character pairs in the table of all pairs, from 1."""
    place = lambda i: F.instr(F.lit(ALPHABET), F.substring(token, i, 1))
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(token) - 1, F.lit(1))),
        lambda i: (place(i) - 1) * len(ALPHABET) + place(i + 1),
    )


@dataclass(frozen=True)
class PairModels:
    """Log-likelihood ratio (random over ordinary) of each character pair, and the threshold of its mean."""

    ratios: tuple[float, ...]
    threshold: float

    def score(self, token: Column) -> Column:
        table = F.split(F.lit(",".join(f"{r:.6f}" for r in self.ratios)), ",").cast("array<double>")
        total = F.aggregate(pairs(token), F.lit(0.0), lambda acc, p: acc + F.element_at(table, p))
        return total / F.greatest(F.length(token) - 1, F.lit(1))


def random_samples(spark: SparkSession, rows: int) -> DataFrame:
    """Random strings in usual spellings, made from digests: hexadecimal, base 64, and letters with digits."""
    digest = lambda salt: F.sha2(F.concat(F.col("id").cast("string"), F.lit(salt)).cast("binary"), 256)
    base64 = lambda salt: F.base64(F.unhex(digest(salt)))
    forms = F.array(
        F.substring(digest("a"), 1, 40),
        F.substring(base64("b"), 1, 43),
        F.translate(F.substring(base64("c"), 1, 40), "+/=", "x7K"),
        F.translate(F.upper(F.substring(base64("d"), 1, 40)), "+/=", "4QZ"),
        F.translate(F.lower(F.substring(base64("e"), 1, 40)), "+/=", "m3q"),
    )
    return spark.range(rows).select(F.explode(forms).alias("token"))


def ordinary_samples(docs: DataFrame, rows: int) -> DataFrame:
    """Ordinary words, and identifiers joined from neighbouring words, of a bounded sample of documents.

    Strings that the base patterns find are taken out first.
    """
    sample = id_hash_rank(docs.select("doc_id"), "doc_id", rows).distinct()
    text = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        text = F.regexp_replace(text, pattern, " ")
    words = F.regexp_extract_all(text, F.lit("[A-Za-z][A-Za-z0-9]{2,}"), F.lit(0))
    joined = lambda a, i: F.when(i % 5 == 0, F.concat(a, F.lit("_"), F.element_at("words", i + 2))).when(
        i % 5 == 1, F.concat(a, F.initcap(F.element_at("words", i + 2)))
    ).when(i % 5 == 2, F.concat(a, F.lit("-"), F.element_at("words", i + 2))).when(
        i % 5 == 3, F.concat(F.upper(a), F.lit("_"), F.upper(F.element_at("words", i + 2)))
    ).otherwise(a)
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id", "left_semi")  # at most `rows` ids
        .where("text is not null")
        .select(words.alias("words"))
        .where(F.size("words") > 1)
        .select(F.explode(F.transform(F.slice("words", 1, F.size("words") - 1), joined)).alias("token"))
    )


def train(docs: DataFrame, sample_docs: int = 1000, random_rows: int = 2000) -> PairModels:
    """Count character pairs of both samples; add-one smoothing within each first character.

    ``sample_docs`` bounds the documents whose words are counted, ``random_rows`` the digests.
    """
    spark, size = docs.sparkSession, len(ALPHABET)
    labelled = random_samples(spark, random_rows).withColumn("kind", F.lit(0)).unionByName(
        ordinary_samples(docs, sample_docs).withColumn("kind", F.lit(1))
    )
    counted = (
        labelled.where(F.length("token") > 1)
        .select("kind", F.explode(pairs(F.col("token"))).alias("pair"))
        .groupBy("kind", "pair")
        .count()
        .collect()  # at most two tables of all pairs
    )
    counts = [[1.0] * (size * size) for _ in range(2)]
    for row in counted:
        counts[row["kind"]][row["pair"] - 1] += row["count"]
    logs = []
    for table in counts:
        sums = [sum(table[i * size : (i + 1) * size]) for i in range(size)]
        logs.append([math.log(n / sums[i // size]) for i, n in enumerate(table)])
    ratios = tuple(round(a - b, 6) for a, b in zip(*logs))
    means = [sum(r * (n - 1) for r, n in zip(ratios, table)) / max(1.0, sum(table) - len(table)) for table in counts]
    return PairModels(ratios, sum(means) / 2)


def spans(docs: DataFrame, models: PairModels) -> DataFrame:
    """``docs`` with ``spans``: ``array<struct<start, kind, end>>`` in order of start, then kind.

    Base spans stay as they are; tokens that touch one are not judged by the models.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    long_enough = lambda x: F.length(x["value"]) >= ASSIGN_LEAST
    # each kind is searched only in texts where it occurs
    base = (
        docs.withColumn("_assign", F.when(text.rlike(ASSIGN), F.filter(spans_of(text, ASSIGN, 2), long_enough)).otherwise(none()))
        .withColumn("_access", F.when(F.contains(text, F.lit("AKIA")), spans_of(text, ACCESS)).otherwise(none()))
        .withColumn("_hex", F.when(text.rlike(HEX), spans_of(text, HEX)).otherwise(none()))
        .withColumn("_tokens", F.when(text.rlike(TOKEN), spans_of(text, TOKEN)).otherwise(none()))
    )
    taken = F.concat("_assign", "_access", "_hex")
    free = F.filter(
        "_tokens",
        lambda t: (models.score(t["value"]) > models.threshold)
        & ~F.exists(taken, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    placed = lambda column, kind: F.transform(
        column, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))
    )
    merged = F.concat(*(placed(c, k) for k, c in enumerate((F.col("_assign"), F.col("_access"), F.col("_hex"), free))))
    return base.withColumn("spans", F.array_sort(merged)).drop("_assign", "_access", "_hex", "_tokens")


def written(column: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            column,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def digest(docs: DataFrame, models: PairModels) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans, for every row."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return spans(docs.select("doc_id", "text"), models).select(
        "doc_id",
        of(0).alias("n_assign"),
        of(1).alias("n_access"),
        of(2).alias("n_hex"),
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, models: PairModels) -> DataFrame:
    """``docs`` with each span, or run of overlapping spans, replaced by ``[SECRET]``; other columns stay.

    ``n_chars`` follows the new text where the column exists. A null text stays null.
    """
    text = F.col("text")
    clean = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(REDACTED)).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))),
        lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), F.length(text))),
    )
    packed = docs.select(F.col("text"), F.struct("*").alias("row"))  # so that no column of the input can clash
    out = spans(packed, models).withColumn("text", F.when(F.size("spans") > 0, clean).otherwise(text))
    kept = F.when(text.isNull(), F.col("row.n_chars")).otherwise(F.length("text").cast("long")) if "n_chars" in docs.columns else None
    return out.select(*({"text": text, "n_chars": kept}.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
