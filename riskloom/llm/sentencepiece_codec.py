"""SentencePiece encoding and decoding by a table of distinct chunks.

Where no piece of the model holds a white-space marker after another character, merging can't join
two characters on either side of such a place. A text (its spaces written as markers, one marker put
before it) is cut there; the distinct chunks of a stretch of texts form a table, each is segmented
once by the sentencepiece library, and the ids are joined back to the chunks' places. A worker keeps
the table between stretches, up to `REMEMBERED` bytes. All chunk work is on whole Arrow buffers.

A model that normalizes characters, drops spaces or has pieces across markers is not cut: each
distinct text is then a chunk of its own, so the ids are the library's for any model.

The model file is read by each Python worker from `path`, which must exist on every executor.

Defined results: a null or empty text has no ids but the end id, and decodes to an empty text. Null
ids decode to an empty text, ids that the model doesn't have to null. Repeated rows stay. Other
columns stay; a column with a new column's name is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField
from sentencepiece import SentencePieceProcessor

from .arrow import add_columns

#: Fixed character that stands for a space in pieces.
MARKER = "▁"
SPACE = 0x20
#: Bytes of text that are cut and looked up at a time; a longer text is taken alone.
STRETCH = 1 << 22
#: Bytes of chunks and ids that a worker remembers.
REMEMBERED = 48 << 20
#: Bytes that an entry of the table takes beside its contents, about.
ENTRY = 200


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield number, message[at : at + size]
            at += size


def keeps_text(model: bytes) -> bool:
    """Whether the model's normalizer only puts one marker first and writes spaces as markers."""
    # fixed numbers: 3 is the normalizer; in it 2 holds character rules, 3 to 5 are flags, true if unset
    spec = dict(_fields(dict(_fields(model)).get(3, b"")))
    return not spec.get(2) and bool(spec.get(3, 1)) and not spec.get(4, 1) and bool(spec.get(5, 1))


def crosses(piece: str) -> bool:
    """Whether a marker stands after another character in the piece."""
    return MARKER in piece.lstrip(MARKER)


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        self.model = SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        pieces = [self.model.id_to_piece(i) for i in ids]
        self.cuts = keeps_text(self.model.serialized_model_proto()) and not any(map(crosses, pieces))
        self.lone = np.array([self.model.piece_to_id(MARKER)], dtype="<i4").tobytes()
        self.end = self.model.eos_id()
        of_byte = {i: bytes([int(pieces[i][1:-1], 16)]) for i in ids if self.model.is_byte(i)}
        self.plain = np.array([not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)) for i in ids])
        self.byte = np.array([i in of_byte for i in ids])
        surface = [of_byte.get(i, pieces[i].replace(MARKER, " ").encode()) if self.plain[i] else b"" for i in ids]
        self.surface = pa.array(surface, pa.large_binary())
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def _segment(self, chunks: list[bytes]) -> list[bytes]:
        """Packed ids of distinct chunks, from the table where it has them."""
        known = self.known
        new = [c for c in chunks if c not in known]
        if new:
            # the library puts a marker first, so the chunk's own first one goes
            texts = [c[1:].decode() if self.cuts else c.decode() for c in new]
            made = [np.array(ids, dtype="<i4").tobytes() for ids in self.model.encode(texts, num_threads=1)]
            if self.cuts:
                made = [self.lone if c == b" " else ids for c, ids in zip(new, made)]
            if self.held > REMEMBERED:
                old = {c: known[c] for c in chunks if c in known}
                known.clear()
                known.update(old)
                self.held = sum(len(c) + len(ids) + ENTRY for c, ids in old.items())
            known.update(zip(new, made))
            self.held += sum(len(c) + len(ids) + ENTRY for c, ids in zip(new, made))
        return [known[c] for c in chunks]

    def _chunks(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """All chunks of the texts in order, and how many each text has."""
        if not self.cuts:
            return pa.array([t for t in texts if t], pa.large_binary()), np.array([bool(t) for t in texts], dtype=np.int64)
        marked = [b" " + t.replace(MARKER.encode(), b" ") if t else b"" for t in texts]
        flat = b"".join(marked)
        sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
        ends = np.cumsum(sizes)
        space = np.frombuffer(flat, dtype=np.uint8) == SPACE
        opens = space.copy()
        opens[1:] &= ~space[:-1]
        opens[(ends - sizes)[sizes > 0]] = True
        starts = np.flatnonzero(opens)
        bounds = np.append(starts, len(flat)).astype("<i8")
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(flat)])
        counts = np.searchsorted(starts, ends) - np.searchsorted(starts, ends - sizes)
        return chunks, counts

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        chunks, counts = self._chunks(texts)
        table = chunks.dictionary_encode()
        packed = self._segment(table.dictionary.to_pylist())
        sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
        ids = np.frombuffer(b"".join(packed), dtype="<i4")
        lists = pa.LargeListArray.from_arrays(np.append(0, np.cumsum(sizes)), pa.array(ids, pa.int32()))
        places = table.indices.to_numpy(zero_copy_only=False)
        joined = lists.take(pa.array(places)).flatten().to_numpy(zero_copy_only=False)
        upto = np.append(0, np.cumsum(sizes[places]))
        ends = np.append(0, np.cumsum(counts))
        return [joined[upto[a] : upto[b]] for a, b in zip(ends[:-1], ends[1:])]

    def encode(self, texts: list[str | None], end: bool = True) -> pa.Array:
        """Lists of ids, with the end id last if asked for."""
        made, group, size = [], [], 0
        for text in texts:
            raw = (text or "").encode("utf-8", "replace")
            if group and size + len(raw) > STRETCH:
                made += self._encode(group)
                group, size = [], 0
            group.append(raw)
            size += len(raw)
        made += self._encode(group) if group else []
        last = np.array([self.end] if end else [], dtype="<i4")
        made = [np.concatenate([ids, last]) for ids in made]
        sizes = np.fromiter(map(len, made), dtype=np.int32, count=len(made))
        values = np.concatenate(made) if made else last[:0]
        return pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype("<i4"), pa.array(values, pa.int32()))

    def _library(self, ids: np.ndarray) -> str | None:
        try:
            return self.model.decode(ids.tolist())
        except IndexError:
            return None

    def _text(self, ids: np.ndarray) -> str | None:
        """The text of one list: joined surfaces where they say all, else the library's answer."""
        body = ids[:-1] if len(ids) and ids[-1] == self.end else ids
        if not len(body):
            return ""
        if not self.cuts or body.min() < 0 or body.max() >= len(self.plain) or not self.plain[body].all() or self.byte[body[0]]:
            return self._library(ids)
        raw = b"".join(pc.take(self.surface, pa.array(body)).to_pylist()) if len(body) < 64 else _joined(self.surface, body)
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            return self._library(ids)
        return text[1:] if text.startswith(" ") else text

    def decode(self, lists: pa.Array) -> pa.Array:
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ends = np.append(0, np.cumsum(sizes))
        return pa.array([self._text(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.string())


def _joined(surface: pa.Array, ids: np.ndarray) -> bytes:
    taken = surface.take(pa.array(ids))
    bounds = np.frombuffer(taken.buffers()[1], dtype="<i8", count=len(taken) + 1 + taken.offset)
    return taken.buffers()[2].slice(bounds[taken.offset], bounds[-1] - bounds[taken.offset]).to_pybytes()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and file."""
    return Codec(path)


def _adding(df: DataFrame, path: str, columns: list[StructField], work: Callable[[Codec, pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    def make():
        own = codec(path)
        return lambda batch: work(own, batch)

    return add_columns(df, columns, make)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of every whole text, the end id last."""
    return _adding(
        docs, path, [StructField(ids, ArrayType(IntegerType()))], lambda own, batch: [own.encode(batch.column(text).to_pylist())]
    )


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of ids."""
    return _adding(rows, path, [StructField(text, StringType())], lambda own, batch: [own.decode(batch.column(ids))])


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add both, in one pass through Python."""

    def work(own, batch):
        made = own.encode(batch.column(text).to_pylist())
        return [made, own.decode(made)]

    return _adding(docs, path, [StructField(ids, ArrayType(IntegerType())), StructField(decoded, StringType())], work)


def digest(docs: DataFrame, path: str) -> DataFrame:
    """The contract's columns."""
    return round_trip(docs.select("doc_id", "text"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
