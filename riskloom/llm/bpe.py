"""Byte-level BPE encoding and decoding with forced boundaries.

A pair of bytes that stands inside no token of the vocabulary can never be joined, so between such
bytes a cut is certain. Words (as the tokenizer's own pattern splits them) are cut there, the
fragments are merged each on its own, and their ids are concatenated. The results equal those of
the tokenizers library for the same file, special tokens in the text included.

The vocabulary file is read by each Python worker from `path`, which must exist on every executor.
Ids are given as binary, packed as little-endian unsigned 32-bit integers.

Defined results: a null or empty text has no ids and decodes to an empty text. Repeated rows stay.
Other columns stay; a column with a new column's name is replaced.
"""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField
from tokenizers.models import BPE

from .arrow import add_columns

#: Fixed pattern of byte-level tokenizers: how a text falls into words before merging.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Words whose ids a worker remembers.
REMEMBERED = 150_000
#: Longest word that is remembered.
SHORT = 48


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabulary files."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        vocabulary = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: token for token, i in vocabulary.items()} | {i: t.encode() for t, i in added.items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.model = BPE(vocab=spec["model"]["vocab"], merges=merges)
        self.letters = dict(enumerate(byte_letters()))
        self.joinable = [set() for _ in range(256)]
        for token in vocabulary:
            for a, b in pairwise(token):
                self.joinable[a].add(b)
        self.words = regex.compile(WORDS)
        self.added = added
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        codec = self

        class Known(dict):
            def __missing__(self, word):
                packed = np.array(codec.encode_word(word), dtype="<u4").tobytes()
                if len(word) <= SHORT:
                    if len(self) >= REMEMBERED:
                        self.clear()
                    self[word] = packed
                return packed

        self.known = Known()

    def fragments(self, word: bytes) -> list[bytes]:
        """`word` cut at every pair of bytes that no token holds."""
        cuts = [i for i, (a, b) in enumerate(pairwise(word), 1) if b not in self.joinable[a]]
        return [word[a:b] for a, b in pairwise([0, *cuts, len(word)])]

    def encode_word(self, word: str) -> list[int]:
        ids = []
        for fragment in self.fragments(word.encode("utf-8", "replace")):
            ids += [token.id for token in self.model.tokenize(fragment.decode("latin-1").translate(self.letters))]
        return ids

    def encode(self, text: str) -> bytes:
        known, packed, at = self.known, [], 0
        for special in self.special.finditer(text) if self.special else ():
            packed += [known[w] for w in self.words.findall(text[at : special.start()])]
            packed.append(self.added[special[0]].to_bytes(4, "little"))
            at = special.end()
        packed += [known[w] for w in self.words.findall(text[at:])]
        return b"".join(packed)

    def decode(self, packed: bytes) -> str:
        of = self.bytes_of
        return b"".join([of[i] for i in np.frombuffer(packed, dtype="<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and file."""
    return Codec(path)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of every whole text."""

    def make():
        own = codec(path)
        return lambda batch: [pa.array([own.encode(t or "") for t in batch.column(text).to_pylist()], pa.binary())]

    return add_columns(docs, [StructField(ids, BinaryType())], make)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of packed ids."""

    def make():
        own = codec(path)
        return lambda batch: [pa.array([own.decode(i or b"") for i in batch.column(ids).to_pylist()], pa.string())]

    return add_columns(rows, [StructField(text, StringType())], make)


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add both, in one pass through Python."""

    def make():
        own = codec(path)

        def work(batch):
            packed = [own.encode(t or "") for t in batch.column(text).to_pylist()]
            return [pa.array(packed, pa.binary()), pa.array([own.decode(p) for p in packed], pa.string())]

        return work

    return add_columns(docs, [StructField(ids, BinaryType()), StructField(decoded, StringType())], make)


def digest(docs: DataFrame, path: str) -> DataFrame:
    """The contract's columns."""
    return round_trip(docs.select("doc_id", "text"), path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
