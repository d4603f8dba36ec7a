"""Language of texts and of spans in mixed texts.

The script of a word (by ranges of code points) leaves the languages that were seen in that script.
Each remaining language scores the word by its letter runs, and Viterbi's algorithm labels the
words of a text with a fixed penalty for each change of language. A text's language is the one that
holds most of its letters.

Fitting counts letter runs in hashed tables of fixed size, so what reaches the driver is bounded by
languages x `BUCKETS`; it reads about `rows` labelled texts per language (chosen by a hash of the id;
a parameter), and all of a language that has fewer. Prediction covers every whole text, in one pass without a shuffle.

Defined results: a null text and one without letters are `und` with score 0, as is every text when
nothing could be learned. Words in scripts never seen say nothing; a text of such words alone gets
the commonest learned language with score 0. Repeated rows stay; other columns stay, a column with
a new column's name is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from .arrow import add_columns
from .common import crc_of_id

LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Size of each language's table of letter runs, and the longest run.
BUCKETS = 1 << 15
LONGEST = 4
#: What a change of language costs, and the most that one word may say.
SWITCH = 12.0
LIMIT = 6.0
#: A language is a candidate in a script that holds this share of its words.
SCRIPT_SHARE = 0.01
#: Words a worker remembers.
REMEMBERED = 300_000
UNKNOWN = "und"

#: Fixed code point ranges of scripts: first code point -> name, up to the next entry.
SCRIPTS = {
    0x0000: "latin",
    0x0370: "greek",
    0x0400: "cyrillic",
    0x0530: "armenian",
    0x0590: "hebrew",
    0x0600: "arabic",
    0x0700: "other",
    0x0900: "devanagari",
    0x0980: "bengali",
    0x0A00: "indic",
    0x0E00: "thai",
    0x0E80: "other",
    0x10A0: "georgian",
    0x1100: "hangul",
    0x1200: "ethiopic",
    0x1380: "other",
    0x1E00: "latin",
    0x1F00: "greek",
    0x2000: "other",
    0x2C60: "latin",
    0x2C80: "other",
    0x3040: "kana",
    0x3100: "other",
    0x3130: "hangul",
    0x3190: "other",
    0x31F0: "kana",
    0x3200: "other",
    0x3400: "han",
    0xA000: "other",
    0xAC00: "hangul",
    0xD800: "other",
    0xF900: "han",
    0xFB00: "other",
    0x20000: "han",
    0x30000: "other",
}
_STARTS, _NAMES = list(SCRIPTS), list(SCRIPTS.values())


def scripts_of(words: list[str]) -> np.ndarray:
    """Index into `SCRIPTS` of the range of each word's first letter."""
    first = np.fromiter((ord(w[0]) for w in words), dtype=np.int64, count=len(words))
    return np.searchsorted(_STARTS, first, side="right") - 1


def runs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter runs of all words, their ends marked, and the word each belongs to."""
    marked = [f" {w} ".encode("utf-8", "replace") for w in words]
    data = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(words)), [len(m) for m in marked])
    buckets, owners = [], []
    for n in range(2, LONGEST + 1):
        stop = len(data) - n + 1
        mixed = np.full(stop, n, dtype=np.uint32)
        for o in range(n):
            mixed = mixed * np.uint32(16777619) ^ data[o : o + stop]
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(739982445)
        mixed ^= mixed >> np.uint32(12)
        inside = owner[:stop] == owner[n - 1 :]
        buckets.append(mixed[inside] % BUCKETS)
        owners.append(owner[:stop][inside])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


@dataclass(frozen=True)
class Model:
    languages: list[str]  # the commonest first
    table: np.ndarray  # (BUCKETS, languages) float32, log odds against the mean of the languages
    scripts: dict[str, np.ndarray]  # script -> bool per language


def fit(docs: DataFrame, rows: int = 5_000, text: str = "text", lang: str = "lang") -> Model:
    """Learn from the rows with a language."""
    known = docs.filter(F.col(lang).isNotNull())
    counts = {r[lang]: r["count"] for r in known.groupBy(lang).count().collect()}
    languages = sorted(counts, key=lambda x: (-counts[x], x))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), dtype=np.float32), {})
    shares = docs.sparkSession.createDataFrame(
        [(name, min(1.0, rows / n)) for name, n in counts.items()], "_lang string, _share double"
    )
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables, scripts = {}, {}
        for part in parts:
            for name, own in part.groupby("lang"):
                words = Counter(w for t in own["text"] for w in LETTERS.findall((t or "").lower()))
                table = tables.setdefault(name, np.zeros(BUCKETS, dtype=np.int64))
                seen = scripts.setdefault(name, Counter())
                if not words:
                    continue
                n = np.fromiter(words.values(), dtype=np.int64, count=len(words))
                at, owner = runs(list(words))
                table += np.bincount(at, weights=n[owner], minlength=BUCKETS).astype(np.int64)
                for script, k in zip(scripts_of(list(words)).tolist(), n.tolist()):
                    seen[_NAMES[script]] += k
        for name, table in tables.items():
            at = np.flatnonzero(table)
            if not len(at):
                continue
            yield pd.DataFrame({"lang": name, "script": "", "bucket": at.astype("int32"), "n": table[at]})
            yield pd.DataFrame({"lang": name, "script": list(scripts[name]), "bucket": -1, "n": list(scripts[name].values())})

    counted = (
        known.join(F.broadcast(shares), F.col(lang) == F.col("_lang"))
        .filter(draw < F.col("_share"))
        .select(F.col(lang).alias("lang"), F.col(text).alias("text"))
        .mapInPandas(count, "lang string, script string, bucket int, n long")
        .groupBy("lang", "script", "bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    at = {name: i for i, name in enumerate(languages)}
    table = np.full((BUCKETS, len(languages)), 0.5)
    words = {}
    for r in counted:
        if r["bucket"] >= 0:
            table[r["bucket"], at[r["lang"]]] += r["n"]
        else:
            words.setdefault(r["script"], np.zeros(len(languages)))[at[r["lang"]]] += r["n"]
    logs = np.log(table / table.sum(axis=0))
    logs -= logs.mean(axis=1, keepdims=True)
    all_words = np.maximum(sum(words.values()), 1) if words else np.ones(len(languages))
    return Model(languages, logs.astype(np.float32), {s: n / all_words >= SCRIPT_SHARE for s, n in words.items()})


class Labeller:
    """Labels words with languages; remembers the scores of words it has met."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.scores = np.zeros((0, len(model.languages)), dtype=np.float32)
        none = np.zeros(len(model.languages), dtype=bool)
        self.fits = np.array([model.scripts.get(name, none) for name in _NAMES])

    def learn(self, words: set[str]) -> None:
        """Score the words not met before."""
        if not self.model.languages:
            return
        if len(self.known) > REMEMBERED:
            self.known, self.scores = {}, self.scores[:0]
        new = [w for w in words if w not in self.known]
        if not new:
            return
        buckets, owner = runs(new)
        found = np.column_stack(
            [np.bincount(owner, weights=column[buckets], minlength=len(new)) for column in self.model.table.T]
        )
        fits = self.fits[scripts_of(new)]
        found = np.where(fits, found, -np.inf)
        seen = fits.any(axis=1)
        found[seen] = np.maximum(found[seen] - found[seen].max(axis=1, keepdims=True), -LIMIT)
        found[~seen] = 0
        self.known.update(zip(new, range(len(self.scores), len(self.scores) + len(new))))
        self.scores = np.concatenate([self.scores, found.astype(np.float32)])

    def labels(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Language index and scores of each word (lower-case, learned before)."""
        at = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        scores = self.scores[at]
        best = int(np.argmax(scores.sum(axis=0, dtype=np.float64)))
        if self._constant(scores, best):
            return np.full(len(words), best), scores
        return viterbi(scores), scores

    @staticmethod
    def _constant(scores: np.ndarray, best: int) -> bool:
        """Whether no stretch of other languages can pay for the changes to them and back."""
        others = np.delete(scores, best, axis=1)
        if not others.shape[1]:
            return True
        gain = others.max(axis=1).astype(np.float64) - scores[:, best]
        path = np.concatenate([[0.0], np.cumsum(gain)])
        inner = (path - np.minimum.accumulate(path)).max()
        head, tail = path.max(), path[-1] - path.min()
        return inner <= 2 * SWITCH and head <= SWITCH and tail <= SWITCH


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best labels when each change costs `switch`; ties stay with the earlier language."""
    n, languages = scores.shape
    back = np.empty((n, languages), dtype=np.int16)
    own = np.arange(languages)
    total = scores[0].astype(np.float64)
    back[0] = own
    for i in range(1, n):
        top = int(total.argmax())
        stay = total >= total[top] - switch
        back[i] = np.where(stay, own, top)
        total = np.where(stay, total, total[top] - switch) + scores[i]
    path = np.empty(n, dtype=np.int64)
    path[-1] = total.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add `lang_pred` and `score`, the share of the text's letters in that language."""

    def make():
        labeller = Labeller(model)
        languages = model.languages

        def one(words):
            if not words or not languages:
                return UNKNOWN, 0.0
            labels, scores = labeller.labels(words)
            if not scores.any():
                return languages[0], 0.0
            letters = np.bincount(labels, weights=[len(w) for w in words], minlength=len(languages))
            best = int(letters.argmax())
            return languages[best], float(letters[best] / letters.sum())

        def work(batch):
            texts = [LETTERS.findall((t or "").lower()) for t in batch.column(text).to_pylist()]
            labeller.learn(set().union(*texts))
            found = [one(words) for words in texts]
            return [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]

        return work

    return add_columns(docs, [StructField("lang_pred", StringType()), StructField("score", DoubleType())], make)


SPAN = StructType(
    [StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("lang", StringType())]
)


def spans(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add `spans`: stretches of words of one language, with their code point offsets."""

    def make():
        labeller = Labeller(model)

        def one(t):
            found = list(LETTERS.finditer(t or ""))
            if not found or not model.languages:
                return []
            words = [m[0].lower() for m in found]
            labeller.learn(set(words))
            labels, _ = labeller.labels(words)
            cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(found)]
            return [
                {"start": found[a].start(), "end": found[b - 1].end(), "lang": model.languages[labels[a]]}
                for a, b in zip(cuts, cuts[1:])
            ]

        def work(batch):
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
            return [pa.array([one(t) for t in batch.column(text).to_pylist()], kind)]

        return work

    return add_columns(docs, [StructField("spans", ArrayType(SPAN))], make)


def held_out(doc_id):
    return F.pmod(crc_of_id(doc_id), F.lit(5)) == 0


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns; learned from rows that are not held out."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(rows, model).drop("text")
