"""SentencePiece ids against the library, distinct-chunk tables and odd texts."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from riskloom.llm import sentencepiece_codec as sc

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "   a", "a ", "a  ", "  a  b ", "a▁b", "▁", "▁▁a", "a\tb\n c", "　x y", "ﬁ Å̊", "<s></s>x", "<unk>",
    "<0x41>", "\0x", "☃𝒳", "​ a", "x" * 3000, " " * 500 + "y", "word " * 4000, "我用Python写代码", "🙂🙂 🙂",
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def texts():
    rng = random.Random(5)
    made = ["".join(rng.choice("ab cde  \n\t▁éß漢🙂.,") for _ in range(rng.randrange(60))) for _ in range(400)]
    return ODD + made


def test_query_equals_the_library(spark, sf, library):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, None), (7, "a "), (7, "a ")]
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd)
    got = sorted(map(tuple, sc.digest(docs, PATH).collect()), key=repr)
    want = []
    for doc_id, text in docs.collect():
        ids = library.encode(text or "", add_eos=True, add_bos=False)
        want.append(
            (doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(library.decode(ids).encode()).hexdigest())
        )
    assert got == sorted(want, key=repr)


def test_chunks_are_segmented_once_and_forgotten(library, monkeypatch):
    own = sc.Codec(PATH)
    asked = []
    segment = own.model.encode

    class Model:
        def encode(self, chunks, num_threads):
            asked.extend(chunks)
            return segment(chunks, num_threads=num_threads)

    whole = own.model
    own.model = Model()
    first = own.encode(["one two one two", "two one"]).to_pylist()
    assert sorted(asked) == ["one", "two"]
    assert first == [[*library.encode(t), 2] for t in ("one two one two", "two one")]
    own.encode(["one two"])
    assert len(asked) == 2
    monkeypatch.setattr(sc, "REMEMBERED", 0)
    assert own.encode(["three one", "four"]).to_pylist() == [[*library.encode(t), 2] for t in ("three one", "four")]
    assert b" two" not in own.known
    own.model = whole


def test_small_stretches_give_the_same(library, monkeypatch):
    monkeypatch.setattr(sc, "STRETCH", 10)
    own = sc.Codec(PATH)
    assert own.encode(texts(), end=False).to_pylist() == [library.encode(t) for t in texts()]


def test_models_that_cannot_be_cut_take_whole_texts(library):
    own = sc.Codec(PATH)
    assert own.cuts and not sc.crosses("▁▁ab") and sc.crosses("a▁b")
    own.cuts = False
    assert own.encode(texts(), end=False).to_pylist() == [library.encode(t) for t in texts()]


def test_any_ids_decode_as_the_library_does(library):
    rng = random.Random(9)
    lists = [[rng.randrange(32000) for _ in range(rng.randrange(1, 90))] for _ in range(300)]
    lists += [[rng.choice([0, 1, 2, 5, 35, 190, 230, 300, 29871, 259]) for _ in range(rng.randrange(1, 9))] for _ in range(500)]
    lists += [[2], [], [1, 2], [35, 300], [29871], [2, 2], [259, 2]]
    got = sc.codec(PATH).decode(pa.array([*lists, None, [32000], [-1]], pa.list_(pa.int32()))).to_pylist()
    assert got == [library.decode(x) for x in lists] + ["", None, None]
    assert sc.codec(PATH).decode(pa.array(lists, pa.list_(pa.int32())).slice(3, 5)).to_pylist() == [library.decode(x) for x in lists[3:8]]


def test_other_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([("a b", 1, "x"), (None, 2, None)], "text string, ids int, decoded string")
    rows = sc.round_trip(docs, PATH).collect()
    assert [(r["text"], r["decoded"]) for r in rows] == [("a b", "a b"), (None, "")]
    assert rows[1]["ids"] == [2]
    assert sc.digest(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
    assert [r["t"] for r in sc.decode(sc.encode(docs, PATH), PATH, text="t").collect()] == ["a b", ""]


def test_packed_ids_of_a_chunk_are_its_own(library):
    own = sc.Codec(PATH)
    assert np.frombuffer(own._segment([b" the"])[0], dtype="<i4").tolist() == library.encode("the")
