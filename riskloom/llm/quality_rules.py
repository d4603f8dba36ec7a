"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per text. The ledger keeps the measurements and one bit per rule, so
that any policy (a named set of rules) is a mask over the bits, and the effect of leaving a rule
out comes from counting bit patterns: at most 2 ** rules groups, however large the corpus.

Only DataFrame functions are used and no row leaves its task; nothing is shuffled but the bit
pattern counts of `ablations`. Defined results: a null or empty text has no words, all
measurements 0, and fails `few_words` only. Repeated rows and repeated ids each get their own row.
Columns of the input stay; a column with the name of a measurement is replaced. Windows of three
words are compared by a 64-bit hash inside one text.
"""

from __future__ import annotations

from string import ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, space_words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim")

#: Rule -> SQL predicate that is true for a failing text, in bit order. Never reorder: add at the end.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 25 * n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 16 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "shouting": "100 * n_upper > 40 * word_chars",
    "exclaiming": "100 * n_exclaim > 25 * n_words",
}
BASE_RULES = ("few_words", "repeated_windows")

#: Policy version -> rules it enforces.
POLICIES = {
    "1": BASE_RULES,
    "2": (*BASE_RULES, "symbols", "word_length"),
    "3": tuple(RULES),
}
LATEST = "3"


def mask(rules: tuple[str, ...] | list[str]) -> int:
    """The bits of some rules."""
    return sum(1 << list(RULES).index(r) for r in rules)


def _count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements of every whole text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_words", space_words(F.col(text)))
    df = df.withColumns(
        {
            "_lines": F.filter(F.split(whole, "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != ""),
            "_windows": F.when(
                F.size("_words") >= 3,
                F.transform(
                    F.sequence(F.lit(0), F.size("_words") - 3),
                    lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    )
    # windows next to their equals once sorted; texts without any skip the sort
    df = df.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<w:bigint,i:int>>")),
    )
    df = df.withColumn(
        "_starts",
        F.sort_array(
            F.transform(
                F.filter(
                    "_sorted",
                    lambda s, j: s["w"].eqNullSafe(F.get("_sorted", j + 1)["w"])
                    | s["w"].eqNullSafe(F.get("_sorted", j - 1)["w"]),
                ),
                lambda s: s["i"],
            )
        ),
    )
    # each window covers three words, of which those up to the next window's start are new
    covered = F.aggregate(
        F.zip_with(
            "_starts",
            F.slice("_starts", 2, F.greatest(F.size("_starts"), F.lit(1))),
            lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    measures = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.translate(whole, SPACE_CHARS, "")),
        "n_symbols": _count_of(whole, "#*$%&|<>"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": covered,
        "n_lines": F.size("_lines"),
        "n_upper": _count_of(whole, ascii_uppercase),
        "n_exclaim": _count_of(whole, "!"),
    }
    # one row of measurements, generated: a filter on them is not copied below this step, where every
    # mention would evaluate the whole chain again
    row = F.struct(*[c.cast("long").alias(name) for name, c in measures.items()])
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in MEASURES]
    return df.select(*kept, F.inline(F.array(row)))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` with their measurements and `failed_bits`, one bit per failed rule."""
    bits = [F.when(F.expr(rule), 1 << i).otherwise(0).cast("long") for i, rule in enumerate(RULES.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs, text).withColumn("failed_bits", failed)


def apply_policy(rows: DataFrame, version: str = LATEST) -> DataFrame:
    """Add `kept`: whether no rule of the policy failed."""
    return rows.withColumn("kept", F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0)


def passing(rows: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of the rows that the applied policy keeps."""
    return rows.filter("kept").select(*columns)


def ablations(rows: DataFrame, version: str = LATEST) -> DataFrame:
    """Per rule of the policy: texts that fail it, and texts that only it rejects."""
    rules = POLICIES[version]
    patterns = (
        rows.select(F.col("failed_bits").bitwiseAND(F.lit(mask(rules))).alias("bits")).groupBy("bits").count()
    )
    each = patterns.select(
        "bits", "count", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).cast("long").alias("bit")) for r in rules])).alias("r")
    ).select("bits", "count", "r.rule", "r.bit")
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("count"))), F.lit(0)).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("count"))), F.lit(0)).alias("failed_alone"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, with the ledger's bits."""
    base = F.col("failed_bits").bitwiseAND(F.lit(mask(BASE_RULES))) != 0
    return apply_policy(ledger(docs.select("doc_id", "text"))).select("doc_id", *MEASURES, "failed_bits", base.alias("base_failed"), "kept")


_RULE_BITS = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES.values()))

#: The digest stated for DuckDB.
SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
p AS (SELECT k, unnest(words) AS a, unnest(range(len(words))) AS i FROM w),
g AS (SELECT k, i, a, lead(a) OVER (PARTITION BY k ORDER BY i) AS b, lead(a, 2) OVER (PARTITION BY k ORDER BY i) AS c FROM p),
h AS (SELECT k, i, count(*) OVER (PARTITION BY k, a, b, c) AS n FROM g WHERE c IS NOT NULL),
c AS (SELECT k, count(DISTINCT i + o) AS n FROM h, (VALUES (0), (1), (2)) AS v(o) WHERE n > 1 GROUP BY k),
m AS (SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
  CAST(len(lines) AS BIGINT) AS n_lines,
  CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper,
  CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS n_exclaim
  FROM t JOIN w USING (k) LEFT JOIN c USING (k))
SELECT *, CAST({_RULE_BITS} AS BIGINT) AS failed_bits,
  ({RULES["few_words"]}) OR ({RULES["repeated_windows"]}) AS base_failed,
  NOT ({" OR ".join(f"({r})" for r in RULES.values())}) AS kept
FROM m
"""
