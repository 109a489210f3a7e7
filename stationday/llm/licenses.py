"""Licence scans by sentence rules: sentences become identifiers, identifier sequences become licences.

DataFrame functions only, one pass, no shuffle: each text is cut into sentences, each sentence is
normalised and looked up in a small hash set, and the few identifiers found are matched in order.
A known sentence may be wrapped over several lines, behind comment signs, and follow a number.

Defined results: a null or empty text has no sentences and no licence. Sentences that repeat count
each time; a licence found twice is named once. Extra columns of the input are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentences of public licences and notices, by identifier.
SENTENCES = {
    "ApacheUnder": "Licensed under the Apache License, Version 2.0",
    "ApacheUnderYouMayNot": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
    "ApacheCopy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "ApacheAsIs": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "ApacheLimits": "See the License for the specific language governing permissions and limitations under the License",
    "MitReleased": "Released under the MIT License",
    "MitLicensed": "Licensed under the MIT License",
    "MitGrant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "MitNotice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "GplThree": "This work is licensed under the GNU General Public License, version 3",
    "GplTwo": "This work is licensed under the GNU General Public License, version 2",
    "GplFree": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "GplHope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "BsdRedistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BsdSource": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "BsdBinary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "BsdEndorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "IscGrant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "CcBy": "Licensed under CC BY 4.0",
    "CcBySa": "Licensed under CC BY-SA 4.0",
    "CcByNc": "Licensed under CC BY-NC 4.0",
    "CcByNcNd": "Licensed under CC BY-NC-ND 4.0",
    "CcZero": "Released under CC0 1.0",
    "MplTwo": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "PublicDomain": "This work is in the public domain",
    "AllRights": "All rights reserved",
}

#: Ordered rules. A rule that matches uses up its identifiers, so longer sequences come first.
RULES = (
    ("Apache-2.0", ("ApacheUnderYouMayNot", "ApacheCopy", "ApacheAsIs", "ApacheLimits")),
    ("Apache-2.0", ("ApacheUnder", "ApacheCopy")),
    ("Apache-2.0", ("ApacheUnderYouMayNot",)),
    ("Apache-2.0", ("ApacheUnder",)),
    ("MIT", ("MitGrant", "MitNotice")),
    ("MIT", ("MitReleased",)),
    ("MIT", ("MitLicensed",)),
    ("GPL-3.0-or-later", ("GplFree", "GplHope")),
    ("GPL-3.0-or-later", ("GplFree",)),
    ("GPL-3.0", ("GplThree",)),
    ("GPL-2.0", ("GplTwo",)),
    ("BSD-3-Clause", ("BsdRedistribution", "BsdSource", "BsdBinary", "BsdEndorse")),
    ("BSD-2-Clause", ("BsdRedistribution", "BsdSource", "BsdBinary")),
    ("ISC", ("IscGrant",)),
    ("CC-BY-4.0", ("CcBy",)),
    ("CC-BY-SA-4.0", ("CcBySa",)),
    ("CC-BY-NC-4.0", ("CcByNc",)),
    ("CC-BY-NC-ND-4.0", ("CcByNcNd",)),
    ("CC0-1.0", ("CcZero",)),
    ("MPL-2.0", ("MplTwo",)),
    ("Public-Domain", ("PublicDomain",)),
    ("Proprietary", ("AllRights",)),
)

#: A sentence ends at a mark before white space or the end, and at a line end. "2.0" is no end.
SENTENCE_END = r"[.!?;:]+([\x20\x09-\x0D]+|\z)|[\x0A-\x0D]+"
#: Runs of ASCII characters other than lower-case letters, digits and the end sign.
NOISE = r"[\x02-\x2F\x3A-\x60\x7B-\x7F]+"
END = "\x01"
#: Line ends with the marks that open the next line, marks that end a sentence, and noise, where line ends are kept apart.
#: None of them steps back, so a page of dots costs neither stack nor time in the square of its length.
LINE_END = r"[\x0A-\x0D][\x09-\x0D\x20]*+(?:[.!?;:]++(?:[\x09-\x0D\x20]++|\z))*+"
MARK_END = r"(?<![.!?;:])[.!?;:]++([\x20\x09-\x0D\x02]++|\z)"
LINE_NOISE = r"[\x03-\x2F\x3A-\x60\x7B-\x7F]+"
LINE, KNOWN = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(sentence: str) -> str:
    """One sentence as the scan sees it."""
    text = re.sub(r"[.!?;:]+$", "", sentence.strip())
    text = re.sub(r"[.!?;:]+[\x20\x09-\x0D]+|[\x0A-\x0D]+", " ", text)
    return re.sub(NOISE, " ", text.translate(str.maketrans(UPPER, LOWER))).strip()


def known_parts(sentences: dict[str, str]) -> tuple[dict[str, str], dict[str, tuple[str, ...]]]:
    """Normalised sentence to identifier, and identifier to its parts.

    A known text that the scan cuts in several sentences becomes several identifiers (``Id.1``, ``Id.2``).
    """
    lookup: dict[str, str] = {}
    parts: dict[str, tuple[str, ...]] = {}
    for name, text in sentences.items():
        pieces = [p for p in (normalised(x) for x in re.split(r"(?:[.!?;:]+(?:[\x20\x09-\x0D]+|$))|[\x0A-\x0D]+", text)) if p]
        ids = []
        for i, piece in enumerate(pieces, 1):
            ids.append(lookup.setdefault(piece, name if len(pieces) == 1 else f"{name}.{i}"))
        parts[name] = tuple(ids)
    return lookup, parts


@dataclass(frozen=True)
class Rules:
    """Sentences and ordered rules in the form the scan uses."""

    sentences: dict[str, str] = field(default_factory=lambda: dict(SENTENCES))
    rules: tuple = RULES

    @property
    def lookup(self) -> dict[str, str]:
        return known_parts(self.sentences)[0]

    @property
    def patterns(self) -> list[tuple[str, str]]:
        """Each rule's licence and its identifier sequence as text."""
        parts = known_parts(self.sentences)[1]
        return [(name, "".join(f"<{i}>" for s in ids for i in parts[s])) for name, ids in self.rules]


def flat(text: Column) -> Column:
    """A text's words, with ``END`` after each sentence and ``LINE`` at each other line end."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER + END + LINE, LOWER + "  ")
    cut = F.regexp_replace(F.regexp_replace(lower, LINE_END, LINE), MARK_END, END)
    return F.regexp_replace(cut, LINE_NOISE, " ")


def sentences(flat: Column) -> Column:
    """The normalised sentences of a text that are not empty; each line end ends one."""
    return F.filter(F.transform(F.split(flat, f"[{END}{LINE}]", -1), lambda s: F.trim(s)), lambda s: s != "")


def unwrapped(flat: Column, lookup: dict[str, str]) -> Column:
    """The same sentences, but known ones whole, without line ends and numbers before them; unknown ones without letters left out."""
    known = "|".join(re.sub(" +", f"[ {LINE}]+", re.escape(s).replace("\\ ", " ")) for s in sorted(lookup, key=len, reverse=True))
    marked = F.regexp_replace(
        F.concat(F.lit(END), flat), f"[{END}{LINE}][ ]*(?:[0-9]+ +)?({known})(?=[ ]*(?:[{END}{LINE}]|\\z))", f"{END}{KNOWN}$1{END}"
    )
    pieces = F.flatten(
        F.transform(
            F.split(marked, END, -1),
            lambda s: F.when(F.startswith(s, F.lit(KNOWN)), F.array(F.regexp_replace(s, f"[ {LINE}{KNOWN}]+", " "))).otherwise(F.split(s, LINE, -1)),
        )
    )
    return F.filter(F.transform(pieces, lambda s: F.trim(s)), lambda s: s.isin(*lookup) | ~s.rlike("^[0-9 ]*$"))


def scan(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """``doc_id, n_sentences, identifiers, licenses, n_unmatched`` for every row.

    ``n_sentences`` counts lines apart. ``identifiers`` lists known sentences in order, with ``<->`` where unknown ones lie between;
    ``licenses`` the licences whose rules match, in rule order; ``n_unmatched`` the identifiers no rule used.
    """
    rules = rules or Rules()
    lookup = rules.lookup
    names = F.create_map(*(F.lit(x) for pair in lookup.items() for x in pair))
    found = F.filter(
        F.transform(F.col("sentences"), lambda s, i: F.struct(i.alias("i"), s.alias("s"))),
        lambda x: x["s"].isin(*lookup),
    )
    joined = F.aggregate(
        F.col("found"),
        F.struct(F.lit("").alias("text"), F.lit(-1).alias("last")),
        lambda acc, x: F.struct(
            F.concat(
                acc["text"],
                F.when((acc["last"] >= 0) & (x["i"] > acc["last"] + 1), "<->").otherwise(""),
                F.lit("<"),
                F.element_at(names, x["s"]),
                F.lit(">"),
            ).alias("text"),
            x["i"].alias("last"),
        ),
        lambda acc: acc["text"],
    )
    ordered = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(p).alias("ids")) for n, p in rules.patterns))
    matched = F.aggregate(
        ordered,
        F.struct(F.col("identifiers").alias("rest"), F.array().cast("array<string>").alias("names")),
        lambda acc, rule: F.struct(
            F.replace(acc["rest"], rule["ids"], F.lit("<+>")).alias("rest"),
            F.when(F.contains(acc["rest"], rule["ids"]), F.array_append(acc["names"], rule["name"]))
            .otherwise(acc["names"])
            .alias("names"),
        ),
    )
    nothing = F.struct(F.lit("").alias("rest"), F.array().cast("array<string>").alias("names"))
    return (
        docs.select("doc_id", flat(F.col("text")).alias("flat"))
        .select("doc_id", F.size(sentences(F.col("flat"))).cast("long").alias("n_sentences"), unwrapped(F.col("flat"), lookup).alias("sentences"))
        .select("doc_id", "n_sentences", found.alias("found"))
        .select("doc_id", "n_sentences", F.when(F.size("found") > 0, joined).otherwise("").alias("identifiers"))
        .withColumn("matched", F.when(F.col("identifiers") != "", matched).otherwise(nothing))
        .select(
            "doc_id",
            "n_sentences",
            "identifiers",
            F.array_join(F.array_distinct("matched.names"), ",").alias("licenses"),
            F.regexp_count("matched.rest", F.lit("<[^+>-][^>]*>")).cast("long").alias("n_unmatched"),
        )
    )


def oracle(rules: Rules | None = None) -> str:
    """The same result in DuckDB SQL."""
    rules = rules or Rules()
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    steps, before = [], "joined"
    for i, (name, ids) in enumerate(rules.patterns):
        steps.append(
            f"r{i} AS (SELECT doc_id, n_sentences, identifiers, replace(rest, {quote(ids)}, '<+>') AS rest, "
            f"CASE WHEN contains(rest, {quote(ids)}) AND NOT list_contains(names, {quote(name)}) "
            f"THEN list_append(names, {quote(name)}) ELSE names END AS names FROM {before})"
        )
        before = f"r{i}"
    known = ", ".join(f"({quote(s)}, {quote(i)})" for s, i in rules.lookup.items())
    return f"""
WITH known(s, id) AS (VALUES {known}),
flat AS (
  SELECT doc_id, regexp_replace(regexp_replace(
    translate(coalesce(text, ''), '{UPPER}' || chr(1), '{LOWER} '),
    '{SENTENCE_END}', chr(1), 'g'), '{NOISE}', ' ', 'g') AS flat FROM documents),
cut AS (
  SELECT doc_id, list_filter(list_transform(string_split(flat, chr(1)), lambda x: trim(x, ' ')), lambda x: x <> '') AS ss
  FROM flat),
listed AS (
  SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM cut),
hits AS (
  SELECT doc_id, i, id, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS last FROM listed JOIN known USING (s)),
texts AS (
  SELECT doc_id, string_agg(CASE WHEN i > last + 1 THEN '<->' ELSE '' END || '<' || id || '>', '' ORDER BY i) AS identifiers
  FROM hits GROUP BY doc_id),
joined AS (
  SELECT cut.doc_id, len(ss)::BIGINT AS n_sentences, coalesce(identifiers, '') AS identifiers,
    coalesce(identifiers, '') AS rest, []::VARCHAR[] AS names
  FROM cut LEFT JOIN texts USING (doc_id)),
{", ".join(steps)}
SELECT doc_id, n_sentences, identifiers, array_to_string(names, ',') AS licenses,
  len(regexp_extract_all(rest, '<[^+>-][^>]*>'))::BIGINT AS n_unmatched
FROM {before}"""
