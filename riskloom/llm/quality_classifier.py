"""Text quality by compression.

Two zstandard dictionaries are built from samples of good and of bad labelled text. A text is cut
into pieces of `PIECE` bytes, each is compressed with both dictionaries, and the difference of the
summed sizes, divided by the text's own bytes, says which kind it resembles. A logistic curve over
that difference and the text's shortness, fitted on labelled rows that the dictionaries have not
seen, turns it into a score: the chance of label 1.

Fitting takes about `rows` labelled rows per label at most (chosen by a hash of the id) and a
stretch of at most `stretch` characters of each; that sample alone reaches the driver. Scoring
covers every whole text, in one pass without a shuffle.

Defined results: a null or empty text gets the score of "no evidence", the curve at difference 0.
Without labels of both kinds every score is the share of label 1, or 0.5 without any label. Labels
other than 0 and 1, and null ids, are not learned from. Repeated rows stay; other columns stay, a
column with a new column's name is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from .arrow import add_columns
from .common import crc_of_id

PIECE = 1024
DICTIONARY_BYTES = 110_000
#: Bytes of text at which shortness is one half.
SHORT = 64
LEVEL = 3


@dataclass(frozen=True)
class Model:
    """Dictionaries of bad and good text (empty: none) and the curve over their difference."""

    bad: bytes
    good: bytes
    intercept: float
    slope: float
    shortness: float

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        return [_compressor(d) for d in (self.bad, self.good)]

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = features(self.compressors(), texts)
        return _sigmoid(self.intercept + self.slope * x[:, 0] + self.shortness * x[:, 1])


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def _pieces(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8", "replace")
    return [data[i : i + PIECE] for i in range(0, len(data), PIECE)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def features(compressors: list[zstandard.ZstdCompressor], texts: list[str | None]) -> np.ndarray:
    """Per text: size with the bad dictionary less size with the good one, by byte, and shortness."""
    bad, good = compressors
    out = np.empty((len(texts), 2))
    for row, text in enumerate(texts):
        pieces = _pieces(text)
        size = sum(map(len, pieces))
        more = sum(len(bad.compress(p)) - len(good.compress(p)) for p in pieces)
        out[row] = more / size if size else 0.0, SHORT / (SHORT + size)
    return out


def _dictionary(texts: list[str]) -> bytes:
    pieces = [p for t in texts for p in _pieces(t)]
    size = min(DICTIONARY_BYTES, sum(map(len, pieces)) // 8)
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little text to build one
        return b""


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Newton's method; the ridge keeps separable samples finite."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(50):
        p = _sigmoid(a @ w)
        slope = a.T @ (weight * (p - y)) + penalty @ w
        curve = (a * (weight * p * (1 - p))[:, None]).T @ a + penalty
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -10, 10)
        if np.abs(step).max() < 1e-8:
            break
    return w


def sample(docs: DataFrame, labels: DataFrame, rows: int, stretch: int, label: str = "quality") -> tuple[list, dict]:
    """Labelled stretches (label, fold, text) for fitting, and the number of labelled rows per label."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("_label")).filter(
        F.col("_label").isin(0, 1) & F.col("doc_id").isNotNull()
    )
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    if not counts:
        return [], counts
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("_label") == 1, rows / counts.get(1, 1)).otherwise(rows / counts.get(0, 1))
    # about 2 * rows rows by the share drawn
    few = known.filter(draw < share).dropDuplicates(["doc_id", "_label"])
    start = F.lit(1) + F.pmod(
        F.xxhash64("doc_id"), F.greatest(F.length("text") - F.lit(stretch - 1), F.lit(1))
    ).cast("int")
    taken = (
        docs.select("doc_id", "text")
        .join(F.broadcast(few), "doc_id")
        .select(
            "doc_id", "_label",
            F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fold")), F.lit(2)).alias("fold"),
            F.substr(F.coalesce("text", F.lit("")), start, F.lit(stretch)).alias("text"),
        )
        .dropDuplicates(["doc_id", "_label"])
        .collect()
    )
    return sorted((r["_label"], r["fold"], r["text"]) for r in taken), counts


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = 3000, stretch: int = 4096, label: str = "quality"
) -> Model:
    """Learn from the labelled rows of `docs`: half of the sample for dictionaries, half for the curve."""
    taken, counts = sample(docs, labels, rows, stretch, label)
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.5
    flat = Model(b"", b"", float(np.log((prior + 1e-6) / (1 - prior + 1e-6))), 0.0, 0.0)
    by = {(q, fold): [t for a, b, t in taken if (a, b) == (q, fold)] for q in (0, 1) for fold in (0, 1)}
    if not all(by.values()):
        return flat
    bad, good = (_dictionary(by[q, 0]) for q in (0, 1))
    x = features([_compressor(bad), _compressor(good)], by[0, 1] + by[1, 1])
    y = np.repeat([0.0, 1.0], [len(by[0, 1]), len(by[1, 1])])
    weight = np.where(y == 1, prior / len(by[1, 1]), (1 - prior) / len(by[0, 1])) * len(y)
    return Model(bad, good, *map(float, _logistic(x, y, weight)))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add `score` and `predicted` (1 if the score is at least 0.5)."""

    def make():
        compressors = model.compressors()
        weights = np.array([model.slope, model.shortness])

        def work(batch):
            p = _sigmoid(model.intercept + features(compressors, batch.column(text).to_pylist()) @ weights)
            return [pa.array(p, pa.float64()), pa.array((p >= 0.5).astype("int32"))]

        return work

    return add_columns(docs, [StructField("score", DoubleType()), StructField("predicted", IntegerType())], make)


def held_out(doc_id):
    return F.pmod(crc_of_id(doc_id), F.lit(3)) == 1


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns; labels are learned from rows that are not held out."""
    model = fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return score(rows, model).drop("text")
