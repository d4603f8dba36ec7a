"""License statements by diagonal voting.

Every run of `GRAM` words of a text is looked up among the runs of all templates. A hit at word p
of the text and word t of the template votes for the diagonal p - t. Votes are counted per text,
template and diagonal, neighbouring diagonals (words added or left out) are merged, and a merged
span is verified: it must hold enough of the template's runs and not be stretched. Where a template
names a version, the first version named from the span's last run on, within `REACH` words, must be
that version; without one the span is dropped.

Only DataFrame functions are used. The templates are a fixed list, so their table of runs is small
and broadcast; the runs of the texts are not shuffled, only the few hits are. Word runs are
compared as text, not only by hash. Beside the method, `base_scan` finds the places of fixed
phrases in the row itself.

Defined results: a null or empty text has no words, labels '' and score 0. Repeated ids are told
apart by their text; equal rows get equal results. Other columns stay.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower

#: Fixed phrases and labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Fixed wording of license statements, in words of lower-case letters and digits; label -> texts.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer",
    ],
    "cc-by-nc-4.0": ["licensed under cc by nc 4 0"],
    "cc-by-sa-4.0": ["licensed under cc by sa 4 0"],
    "cc-by-4.0": ["licensed under cc by 4 0", "creative commons attribution 4 0 international license"],
    "gpl-2.0": [
        "licensed under the gnu general public license version 2",
        "under the terms of the gnu general public license version 2",
    ],
    "gpl-3.0": [
        "licensed under the gnu general public license version 3",
        "under the terms of the gnu general public license version 3",
    ],
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction",
    ],
    "mpl-2.0": ["subject to the terms of the mozilla public license v 2 0"],
}

GRAM = 3
#: Diagonals this near belong to one span.
SHIFT = 2
#: Share of a template's runs that a span must hold, and the most words it may take per template word.
COVERAGE = 0.6
STRETCH = 1.5
#: Words after a span's last run in which its version may follow ("either version 2 of the license").
REACH = 10
#: A named version, its words set apart by single spaces; the first number tells the templates apart.
VERSION = r" (?:(?:version|license|v) |[a-z]*v)([0-9]{1,2}) "

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_TEXTS = [(label, text.split()) for label, texts in TEMPLATES.items() for text in texts]
_GRAMS = [
    (n, label, len(words), t, " ".join(words[t : t + GRAM]))
    for n, (label, words) in enumerate(_TEXTS)
    for t in range(len(words) - GRAM + 1)
]
_VERSIONS = [m[1] if (m := re.search(VERSION, f" {' '.join(words)} ")) else "" for _, words in _TEXTS]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), WORD_GAP), "")


def _at(words: str, phrase: str) -> Column:
    """Starts of a phrase among the words, looked for only where the text of the words has it."""
    parts = phrase.split()

    def stands(i):
        hit = F.get(words, i) == parts[0]
        for o, part in enumerate(parts[1:], 1):
            hit = hit & (F.get(words, i + o) == part)
        return hit

    last = F.size(words) - len(parts)
    return F.when(
        (last >= 0) & F.contains(F.array_join(words, " "), F.lit(phrase)),
        F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), stands),
    ).otherwise(F.array().cast("array<int>"))


def base_scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, n_base, first_word, last_word and the list `base` of labels."""
    df = docs.withColumn("_words", words_of(F.col(text)))
    df = df.withColumns({f"_at{i}": _at("_words", phrase) for i, phrase in enumerate(PHRASES)})
    starts = F.concat(*[f"_at{i}" for i in range(len(PHRASES))])
    labels = [F.when(F.size(f"_at{i}") > 0, F.lit(label)) for i, label in enumerate(PHRASES.values())]
    return df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "n_base": F.size(starts).cast("long"),
            "first_word": F.array_min(starts).cast("long"),
            "last_word": F.array_max(starts).cast("long"),
            "base": F.sort_array(F.array_compact(F.array(*labels))),
        }
    ).drop("_words", *[f"_at{i}" for i in range(len(PHRASES))])


def _version(words: str, p: Column) -> Column:
    """The first version named in the run at p or soon after it, '' if none."""
    near = F.array_join(F.slice(words, p + 1, GRAM + REACH), " ")
    return F.regexp_extract(F.concat(F.lit(" "), near, F.lit(" ")), VERSION, 1)


def spans(texts: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """Verified spans: key, label, first_word, words, coverage.

    Texts with equal keys must be equal; each place counts once.
    """
    spark = texts.sparkSession
    templates = spark.createDataFrame(
        [(*g, _VERSIONS[g[0]]) for g in _GRAMS],
        "template int, label string, size int, t int, gram string, version string",
    )
    edges = [sorted({g[4].split()[o] for g in _GRAMS}) for o in (0, GRAM - 1)]
    df = texts.select(*key, words_of(F.col(text)).alias("_words")).filter(F.size("_words") >= GRAM)
    # runs that begin and end as some template's run does
    df = df.withColumn(
        "_near",
        F.filter(
            F.sequence(F.lit(0), F.size("_words") - GRAM),
            lambda i: F.get("_words", i).isin(edges[0]) & F.get("_words", i + GRAM - 1).isin(edges[1]),
        ),
    )
    run = F.transform(
        "_near",
        lambda i: F.struct(i.alias("p"), F.concat_ws(" ", *[F.get("_words", i + o) for o in range(GRAM)]).alias("gram")),
    )
    known = F.filter(run, lambda g: g["gram"].isin(sorted({g[4] for g in _GRAMS})))
    grams = df.select(
        *key,
        F.explode(
            F.transform(
                known,
                lambda g: F.struct(g["p"].alias("p"), g["gram"].alias("gram"), _version("_words", g["p"]).alias("named")),
            )
        ).alias("g"),
    ).select(*key, "g.p", "g.gram", "g.named")
    span = [*key, "template", "label", "size", "version"]
    hits = grams.join(F.broadcast(templates), "gram").select(
        *span, "t", "p", "named", (F.col("p") - F.col("t")).alias("diagonal")
    )
    voted = (
        hits.distinct()
        .groupBy(*span, "diagonal")
        .agg(
            F.count("*").alias("votes"), F.min("p").alias("first"), F.max(F.struct("p", "named")).alias("last")
        )
    )
    line = Window.partitionBy(*key, "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(line) > SHIFT).cast("int")
    merged = (
        voted.withColumn("_apart", F.coalesce(apart, F.lit(0)))
        .withColumn("_island", F.sum("_apart").over(line))
        .groupBy(*span, "_island")
        .agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"))
    )
    taken = F.col("last.p") - F.col("first") + GRAM
    coverage = F.least(F.lit(1.0), F.col("votes") / (F.col("size") - (GRAM - 1)))
    versioned = (F.col("version") == "") | (F.col("version") == F.col("last.named"))
    return merged.filter(versioned).select(
        *key, "label", F.col("first").alias("first_word"), taken.alias("words"), coverage.alias("coverage"), "size"
    ).filter((F.col("coverage") >= COVERAGE) & (F.col("words") <= F.col("size") * STRETCH)).drop("size")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the base columns, `labels` and `score`, the best coverage (1 with a base label)."""
    key = ["_id", "_hash"]
    keyed = docs.withColumns(
        {"_id": F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "_hash": F.xxhash64(F.col(text))}
    )
    found = (
        spans(keyed, key, text).groupBy(*key).agg(F.collect_set("label").alias("_found"), F.max("coverage").alias("_best"))
    )
    joined = base_scan(keyed, text).drop(text).join(found, key, "left")
    none = F.array().cast("array<string>")
    return joined.withColumns(
        {
            "base_labels": F.array_join("base", ","),
            "labels": F.array_join(F.array_sort(F.array_union("base", F.coalesce("_found", none))), ","),
            "score": F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0))),
        }
    ).drop(*key, "base", "_found", "_best")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return scan(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def _sql() -> str:
    rows = ", ".join(f"({n}, '{label}', {size}, {t}, '{gram}', '{_VERSIONS[n]}')" for n, label, size, t, gram in _GRAMS)
    hit = " UNION ALL ".join(
        f"SELECT k, i, '{label}' AS label FROM p WHERE "
        + " AND ".join(f"{word} = '{part}'" for word, part in zip("abc", phrase.split()))
        for phrase, label in PHRASES.items()
    )
    return rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
u AS (SELECT k, unnest(words) AS a, unnest(range(len(words))) AS i FROM d),
p AS (SELECT k, i, a, lead(a) OVER (PARTITION BY k ORDER BY i) AS b, lead(a, 2) OVER (PARTITION BY k ORDER BY i) AS c FROM u),
b AS (SELECT k, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
  list_distinct(list(label)) AS base FROM ({hit}) GROUP BY k),
g(template, label, size, t, gram, version) AS (VALUES {rows}),
h AS (SELECT p.k, g.template, g.label, g.size, g.version, p.i AS p, p.i - g.t AS diagonal FROM p JOIN g
  ON a || ' ' || b || ' ' || c = g.gram),
v AS (SELECT k, template, label, size, version, diagonal, count(*) AS votes, min(p) AS p0, max(p) AS p1 FROM h GROUP BY ALL),
l AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY k, template ORDER BY diagonal) > {SHIFT}
  THEN 1 ELSE 0 END AS apart FROM v),
m AS (SELECT *, sum(apart) OVER (PARTITION BY k, template ORDER BY diagonal) AS island FROM l),
s AS (SELECT k, label, version, max(p1) AS p1, least(1e0, CAST(sum(votes) AS DOUBLE) / (size - {GRAM - 1})) AS coverage, size,
  max(p1) - min(p0) + {GRAM} AS taken FROM m GROUP BY k, template, label, size, version, island),
f AS (SELECT k, list_distinct(list(label)) AS found, max(coverage) AS best FROM s JOIN d USING (k)
  WHERE coverage >= {COVERAGE} AND taken <= size * {STRETCH} AND (version = '' OR version =
    regexp_extract(' ' || array_to_string(words[p1 + 1 : p1 + {GRAM + REACH}], ' ') || ' ', '{VERSION}', 1)) GROUP BY k)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(found, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1e0 ELSE coalesce(best, 0e0) END AS score
FROM d LEFT JOIN b USING (k) LEFT JOIN f USING (k)
"""


#: The digest stated for DuckDB.
SQL = _sql()
