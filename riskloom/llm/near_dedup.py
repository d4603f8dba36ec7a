"""Near-duplicate documents by SetSketch registers.

A document is the set of its runs of five words. Its sketch holds `REGISTERS` registers, each a
minimum of exponential variables over the set, truncated to powers of `BASE`; the minima of a union
are the minima of the sketches, and registers agree about as often as the sets do. Runs of
registers (bands) that agree make two documents candidates. From how many registers are higher,
lower and equal, with the set sizes, the similarity is estimated by maximum likelihood; pairs that
could reach the threshold are verified on their full sets.

The steps, none of which lists all pairs of a group:

1. One pass over the texts makes a narrow table: id, digest of the words, set size, sketch. Equal
   texts go on as one, under their smallest id.
2. Bands that several documents share: each document is paired with the smallest id of the band.
   Pairs whose estimate can reach the threshold are verified; their links make first classes.
3. Where a band still holds several classes, its documents are compared block by block inside
   tasks, each pair in the first band it shares. Pairs across classes whose estimate can reach the
   threshold are verified there on the full sets, and as many links as join the classes come out.
   So every pair that shares a band is linked, in one class already, or ruled out.
4. Classes are the connected components of all verified links.

With the bands chosen, two documents at the threshold share none with a chance below
`MISS`; nothing else is given up. Large groups are dealt to slots and blocks (`BLOCK` documents), so
that no task gathers one. Narrow tables are written to the shared folder.

Defined results: a document without words has an empty set and is linked with nothing; one with
fewer than five words has its whole sequence as its only run. A row without id is linked with
nothing and kept. Rows that repeat an id follow their own text; equal rows are treated alike.
"""

from __future__ import annotations

import hashlib
import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components, with_least
from ..session import work_dir

RUN = 5
REGISTERS = 256
#: Base of the powers that registers count, and the rate of the exponential variables.
BASE = 1.001
RATE = 20.0
#: Most that a pair at the threshold may be missed by all bands.
MISS = 1e-5
#: How far below the threshold an estimate may lie (over five standard deviations).
MARGIN = 0.12
#: Documents of a band compared with each other at a time; larger bands meet block by block.
BLOCK = 512
REMEMBERED = 100_000

_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_rows(threshold: int) -> int:
    """Registers per band: the most that keep the chance of a miss at `threshold` percent below `MISS`."""
    similar = threshold / 100
    fits = [r for r in range(1, 33) if (1 - similar**r) ** (REGISTERS // r) <= MISS]
    return max(fits, default=1)


# ---- sets and sketches, inside tasks


class Shingler:
    """Hashes of runs of words; remembers the hashes of words."""

    def __init__(self):
        class Known(dict):
            def __missing__(self, word):
                if len(self) > REMEMBERED:
                    self.clear()
                self[word] = found = xxhash.xxh3_64_intdigest(word)
                return found

        self.known = Known()

    @staticmethod
    def words(text: str | None) -> list[bytes]:
        # bytes methods know ASCII letters and ASCII white space only
        return (text or "").encode("utf-8", "replace").lower().split()

    def runs(self, words: list[bytes]) -> np.ndarray:
        """Sorted distinct hashes of the runs."""
        if not words:
            return np.empty(0, dtype=np.uint64)
        own = np.fromiter(map(self.known.__getitem__, words), dtype=np.uint64, count=len(words))
        width = min(RUN, len(own))
        stop = len(own) - width + 1
        mixed = np.full(stop, width, dtype=np.uint64)
        for o in range(width):
            mixed = _scramble(mixed * np.uint64(0x9E3779B97F4A7C15) + own[o : o + stop])
        return np.unique(mixed)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sketch(runs: np.ndarray) -> np.ndarray:
    """Registers of a set (all 0 for the empty set)."""
    if not len(runs):
        return np.zeros(REGISTERS, dtype="<u2")
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(runs), 64):
        np.minimum(least, (runs[at : at + 64, None] * _MULTIPLIERS).min(axis=0), out=least)
    smallest = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / math.log(BASE)), 0, 65535).astype("<u2")


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


_GRID = np.linspace(0, 1, 201)


def estimate(higher: np.ndarray, lower: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely similarity, given how many registers of a are higher and lower than those of b."""
    out = np.empty(len(higher))
    for at in range(0, len(higher), 1024):
        s = slice(at, at + 1024)
        a, b = n_a[s, None].astype(float), n_b[s, None].astype(float)
        u, v = a / (a + b), b / (a + b)
        top = np.minimum(u / v, v / u)  # no similarity is higher than the ratio of the sizes
        j = _GRID * top
        up, down = _chance(u - v * j), _chance(v - u * j)
        same = np.maximum(1 - up - down, 1e-12)
        equal = REGISTERS - higher[s, None] - lower[s, None]
        fit = higher[s, None] * np.log(up) + lower[s, None] * np.log(down) + equal * np.log(same)
        out[s] = np.take_along_axis(j, fit.argmax(axis=1)[:, None], axis=1)[:, 0]
    return out


def _chance(x: np.ndarray) -> np.ndarray:
    return np.maximum(-np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / math.log(BASE), 1e-12)


def near_pairs(
    a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, wanted: np.ndarray, floor: float, rows: int, band: int
) -> tuple:
    """Wanted pairs of two blocks of sketches that share no band before `band` and whose estimate reaches `floor`.

    Gives the indices, most similar first.
    """
    equal = np.zeros((len(a), len(b)), dtype=np.int16)
    wanted = wanted & (np.minimum(n_a[:, None], n_b[None, :]) >= floor * np.maximum(n_a[:, None], n_b[None, :]))
    for first in range(0, REGISTERS, rows):
        whole = np.ones(equal.shape, dtype=bool)
        for r in range(first, min(first + rows, REGISTERS)):
            same = a[:, r, None] == b[None, :, r]
            equal += same
            whole &= same
        if first // rows < band:
            wanted &= ~whole
    x, y = np.nonzero(wanted & (equal >= (floor - 0.05) * REGISTERS))
    likely = np.empty(len(x))
    for at in range(0, len(x), 1024):
        s = slice(at, at + 1024)
        i, j = x[s], y[s]
        likely[s] = estimate((a[i] > b[j]).sum(axis=1), (a[i] < b[j]).sum(axis=1), n_a[i], n_b[j])
    order = np.argsort(-likely, kind="stable")[: int((likely >= floor).sum())]
    return x[order], y[order]


def links_of(part: pd.DataFrame, floor: float, threshold: int, rows: int) -> pd.DataFrame:
    """Links between classes in two blocks of a band, verified on the sets; as many as join the classes."""
    low, high = part["low"].iloc[0], part["high"].iloc[0]
    a = part[part["block"] == low].reset_index(drop=True)
    b = part[part["block"] == high].reset_index(drop=True) if high != low else a
    wanted = a["class"].to_numpy()[:, None] != b["class"].to_numpy()[None, :]
    if high == low:
        wanted &= np.triu(np.ones(wanted.shape, dtype=bool), 1)
    x, y = near_pairs(
        _registers(a["sketch"]), _registers(b["sketch"]), a["n_shingles"].to_numpy(), b["n_shingles"].to_numpy(),
        wanted, floor, rows, int(part["number"].iloc[0]),
    )
    root = {c: c for c in part["class"]}

    def find(c):
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    a_class, b_class, found = a["class"], b["class"], []
    for i, j in zip(x, y):
        one, other = find(a_class[i]), find(b_class[j])
        if one != other and reaches(a["runs"][i], b["runs"][j], threshold):
            root[one] = other
            found.append((a["node"][i], b["node"][j]))
    return pd.DataFrame(found, columns=["src", "dst"], dtype="int64")


def reaches(a: bytes, b: bytes, threshold: int) -> bool:
    """Whether two full sets (sorted hashes) are similar to `threshold` percent."""
    x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    shared = int((y[at] == x).sum())
    return 100 * shared >= threshold * (len(x) + len(y) - shared)


def _registers(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<u2").reshape(-1, REGISTERS)


# ---- steps over tables


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest of the words, n_shingles, sketch; one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, recent = Shingler(), OrderedDict()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                digests, sizes, made = [], [], []
                for t in piece.column(1).to_pylist():
                    words = shingler.words(t)
                    digest = hashlib.md5(b" ".join(words)).digest()
                    if digest not in recent:  # copies tend to come again
                        runs = shingler.runs(words)
                        recent[digest] = len(runs), sketch(runs).tobytes()
                        if len(recent) > 4096:
                            recent.popitem(last=False)
                    size, registers = recent[digest]
                    digests.append(digest)
                    sizes.append(size)
                    made.append(registers)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(made, pa.binary())],
                    names=["doc_id", "digest", "n_shingles", "sketch"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, digest binary, n_shingles long, sketch binary")


def _bands(nodes: DataFrame, rows: int) -> DataFrame:
    """(node, number, band): a row per document and band."""
    width = 2 * rows
    return nodes.select(
        F.col("node"),
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.lit(REGISTERS // rows - 1)),
                lambda i: F.xxhash64(i, F.substring("sketch", i * width + 1, F.lit(width))),
            )
        ).alias("number", "band"),
    )


def _estimated(pairs: DataFrame, nodes: DataFrame, floor: float) -> DataFrame:
    """The pairs (src, dst) whose estimate reaches `floor`."""
    side = lambda end: nodes.select(
        F.col("node").alias(end), F.col("n_shingles").alias(f"n_{end}"), F.col("sketch").alias(f"s_{end}")
    )
    both = pairs.join(side("src"), "src").join(side("dst"), "dst")
    both = both.filter(F.least("n_src", "n_dst") >= floor * F.greatest("n_src", "n_dst"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in parts:
            for at in range(0, len(whole), 2048):
                part = whole.iloc[at : at + 2048]
                a, b = _registers(part["s_src"]), _registers(part["s_dst"])
                found = estimate((a > b).sum(axis=1), (a < b).sum(axis=1), part["n_src"].to_numpy(), part["n_dst"].to_numpy())
                yield part.loc[found >= floor, ["src", "dst"]]

    return both.mapInPandas(run, "src long, dst long")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, runs): the full sets of the wanted nodes. `docs`: (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                made = [shingler.runs(shingler.words(t)).tobytes() for t in piece.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(made, pa.binary())], names=["node", "runs"])

    texts = docs.join(wanted.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    return _stored(texts.select("doc_id", "text").mapInArrow(run, "node long, runs binary"), "near-sets")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose full sets reach `threshold` percent."""
    side = lambda end: sets.select(F.col("node").alias(end), F.col("runs").alias(f"r_{end}"))
    both = pairs.join(side("src"), "src").join(side("dst"), "dst")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(batch.schema.get_field_index(c)) for c in ("r_src", "r_dst"))
            good = [reaches(x.as_buffer(), y.as_buffer(), threshold) for x, y in zip(left, right)]
            yield batch.select(["src", "dst"]).filter(pa.array(good, pa.bool_()))

    return both.select("src", "dst", "r_src", "r_dst").mapInArrow(run, "src long, dst long")


def _across(members: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: int, rows: int) -> DataFrame:
    """Verified links between documents of one band and of different classes.

    `members`: (band, number, node, class, n), n being the band's documents. Blocks of a band meet
    in pairs.
    """
    floor = threshold / 100 - MARGIN
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    key = ["band", "low", "high"]
    met = (
        members.withColumn("block", F.pmod(F.xxhash64("node"), blocks.cast("long")).cast("int"))
        .select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
        .select(
            "band", "number", "node", "class", "block",
            F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        )
    )
    full = met.join(nodes.select("node", "n_shingles", "sketch"), "node").join(sets, "node")
    slots = max(64, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return full.repartition(slots, *key).groupBy(*key).applyInPandas(
        lambda part: links_of(part, floor, threshold, rows), "src long, dst long"
    )


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def classes(docs: DataFrame, threshold: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest, n_shingles, component_id of every row; links from `threshold` percent on."""
    rows = band_rows(threshold)
    floor = threshold / 100 - MARGIN
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    narrow = _stored(sketches(docs, doc_id, text), "near-sketches")
    known = narrow.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()).select("doc_id", "digest", "n_shingles")
    same = _stored(with_least(known, "digest", "doc_id", "node"), "near-same")
    first = same.filter(F.col("doc_id") == F.col("node")).select("node").distinct()
    nodes = narrow.join(first, narrow["doc_id"] == first["node"], "left_semi").select(
        F.col("doc_id").alias("node"), "n_shingles", "sketch"
    )
    nodes = _stored(nodes.dropDuplicates(["node", "sketch"]), "near-nodes")

    bands = _bands(nodes, rows)
    shared = bands.groupBy("band").agg(F.min("node").alias("first"), F.count("*").alias("n")).filter("n > 1")
    shared = _stored(shared, "near-bands")
    members = _stored(bands.join(shared, "band"), "near-members")
    stars = members.filter(F.col("node") != F.col("first")).select(F.col("first").alias("src"), F.col("node").alias("dst"))
    stars = _stored(_estimated(stars.distinct(), nodes, floor), "near-stars")
    ends = stars.select(F.explode(F.array("src", "dst")).alias("node"))
    sets = _sets(texts, ends.unionByName(members.filter("n > 2").select("node")).distinct())
    links = _stored(_verified(stars, sets, threshold), "near-links")
    found = _stored(connected_components(links), "near-classes")

    # bands of more than two documents that are not of one class yet
    labelled = members.filter("n > 2").join(found.withColumnRenamed("id", "node"), "node", "left").select(
        "band", "number", "node", "n", F.coalesce("component", "node").alias("class")
    )
    labelled = _stored(labelled, "near-labelled")
    mixed = labelled.groupBy("band").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high")
    mixed = _stored(mixed.select("band"), "near-mixed")
    more = _stored(_across(labelled.join(mixed, "band"), nodes, sets, threshold, rows), "near-more")
    final = _stored(connected_components(links.unionByName(more)), "near-components")

    placed = same.join(final.withColumnRenamed("id", "node"), "node", "left").select(
        "doc_id", "digest", "n_shingles", F.coalesce("component", "node").alias("component_id")
    )
    alone = narrow.filter((F.col("n_shingles") == 0) | F.col("doc_id").isNull()).select(
        "doc_id", "digest", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return placed.unionByName(alone)


def kept(doc_id: Column, component_id: Column) -> Column:
    return doc_id.eqNullSafe(component_id)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return classes(docs).select(
        "doc_id", "n_shingles", "component_id", kept(F.col("doc_id"), F.col("component_id")).alias("kept")
    )


def keep_one(docs: DataFrame, threshold: int = 80) -> DataFrame:
    """One document of each class, with the columns of `docs`; rows equal to a kept one go."""
    chosen = classes(docs, threshold).filter(kept(F.col("doc_id"), F.col("component_id"))).select("doc_id").distinct()
    named = docs.filter(F.col("doc_id").isNotNull()).join(chosen, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.filter(F.col("doc_id").isNull()))
