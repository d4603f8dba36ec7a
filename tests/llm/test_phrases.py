"""Phrases against brute force, with good, poor and empty samples."""

import collections
import random
import re
import threading
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from compare import differences

from riskloom.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string"


def und(lang):
    return "und" if lang is None else lang


def brute(docs, limit, support):
    """docs: (text, lang) pairs; the contract, word by word."""
    counts, totals = collections.Counter(), collections.Counter()
    for text, lang in docs:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[und(lang)] += len(words)
            for k in range(1, 5):
                counts.update((und(lang), tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    rows = collections.defaultdict(list)
    long = {key: a for key, a in counts.items() if a >= support and len(key[1]) > 1}
    for (lang, p), a in long.items():
        cuts = [(2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        around = [b for (other, q), b in long.items() if other == lang and len(q) > len(p)
                  and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if not any(100 * b >= 80 * a for b in around):
            phrase = " ".join(p)
            rows[lang].append((-score, -a, phrase.encode(), (phrase, a, counts[lang, p[:k]], counts[lang, p[k:]], totals[lang], score)))
    return sorted((lang, i, *row[3]) for lang, found in rows.items() for i, row in enumerate(sorted(found)[:limit], 1))


def made(seed, n):
    rng = random.Random(seed)
    words = ["Ab", "b", "c", "É", "é", "New", "york", "City", "x\0y", "\x1cq", "漢字", "d-e", "."]
    docs = []
    for _ in range(n):
        parts = [rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", "\n", "\r\n", "\x85 "]) for _ in range(rng.randrange(40))]
        if rng.random() < 0.5:
            parts.insert(0, "new York city hall ")
        docs.append(("".join(parts), rng.choice(["en", "en", "de", None, "und", ""])))
    return docs + [(None, "en"), ("", None), ("   ", "fr"), ("one two", "it")] + [("same old words again and again", "en")] * 40


@pytest.mark.parametrize("sample", [1, 3, 10**9])
@pytest.mark.parametrize("limit", [7, 2000])
def test_any_sample_gives_the_brute_force_result(spark, monkeypatch, sample, limit):
    monkeypatch.setattr(co, "STRETCH", 500)  # goes to the tasks with their function
    docs = made(4, 300)
    table = spark.createDataFrame([(None, text, lang) for text, lang in docs], SCHEMA).repartition(5)
    got = co.mine(table, limit=limit, support=9, sample=sample)
    assert sorted(map(tuple, got.collect())) == brute(docs, limit, 9)


def test_a_full_table_of_bits_only_counts_more(spark):
    docs = made(8, 200)
    table = spark.createDataFrame([(None, text, lang) for text, lang in docs], SCHEMA)
    assert sorted(map(tuple, co.mine(table, support=5, bits=7).collect())) == brute(docs, 2000, 5)


def test_failures_of_the_border_bring_in_longer_phrases(spark):
    texts = spark.createDataFrame([("en", "a b c d. a b c d, x")] * 3, "lang string, text string")
    proposed = spark.createDataFrame(_keys(spark, _hashes("en", ["a", "b"])), "bucket int, low int")
    table = co.with_phrases(co.empty_table(), proposed)
    first = co.count(texts, co.Tables(co.sent(spark, table))).collect()
    assert sum(r["n"] for r in first if r["phrase"] == "") == 27 and {r["phrase"] for r in first} == {"", None}
    a_b = co._joined_hash(*_hashes("en", ["a", "b"])[:, None])
    by_key = dict.fromkeys(_keys(spark, np.append(_hashes("en", ["a", "b", "c", "d"]), a_b)), 6) | {_keys(spark, _hashes("en", ["x"]))[0]: 3}
    assert {(r["bucket"], r["low"]): r["n"] for r in first if r["phrase"] is None} == by_key
    _, passes = co.closed(texts, table, 6)
    rows = [r for found in passes for r in found.collect() if r["phrase"]]
    found = {r["phrase"]: r["n"] for r in rows}
    assert len(passes) == 5 and len(rows) == len(found)
    assert found == dict.fromkeys(["a", "b", "c", "d", "a b", "b c", "c d", "a b c", "b c d", "a b c d"], 6)


def _hashes(lang, words):
    import xxhash

    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], dtype=np.uint64)


def _keys(spark, hashes):
    keys = hashes >> np.uint64(64 - co.key_bits(spark))
    return [(int(k) >> 32, int(np.uint32(k & np.uint64(2**32 - 1)).view(np.int32))) for k in keys]


def test_counts_past_64_bits(spark):
    huge = 4 * 10**18
    rows = [("en", 1, "a", huge), ("en", 1, "b", huge), ("en", 2, "a b", huge - 1), ("en", 2, "b a", huge // 2), ("en", 3, "a b a", huge // 2)]
    got = {r["phrase"]: (r["score"], r["kept"]) for r in co.scored(spark.createDataFrame(rows, "lang string, words int, phrase string, n long")).collect()}
    assert got["a b"] == (2_000_000 * (huge - 1) // (2 * huge), True)
    assert got["b a"] == (500_000, False)


def test_odd_texts_match_sql(spark, tmp_path):
    docs = made(2, 250)
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(i, text, lang) for i, (text, lang) in enumerate(docs)], SCHEMA).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert differences(co.digest(spark.read.parquet(path)), con, co.SQL) == []


def test_empty_tables_and_extra_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert co.digest(none).count() == 0
    docs = [("a b c " * 50, "en")]
    table = spark.createDataFrame([("a b c " * 50, "en", 1, "x", 2)], "text string, lang string, n int, phrase string, words int")
    assert sorted(map(tuple, co.digest(table).collect())) == brute(docs, 2000, 30)


def test_sums_of_text_are_sent_in_bounded_batches():
    rows = co.SENT + 5
    part = pa.table({"bucket": np.zeros(rows, dtype=np.int32), "lang": ["x"] * rows, "phrase": [f"p {i}" for i in range(rows)], "n": np.ones(rows, dtype=np.int64)})
    summed = co._summed([part, part])
    batches = co._with_no_lists(summed)
    assert max(b.num_rows for b in batches) <= co.SENT and sum(b.num_rows for b in batches) == rows
    assert set(summed.column("n").to_pylist()) == {2}


def test_late_passes_go_through_pieces_with_new_phrases_only(monkeypatch):
    bits, text, walked = 44, b"a b c d. e f g h, a b c d; x b c y", []
    empty, new = co.empty_table(12), co.empty_table(12)
    full = np.full_like(empty, 2**64 - 1)
    # words are known to an empty earlier table, so only the pair comes by key
    key = np.concatenate([key for key, _, _ in co.tally(b"b c", "en", co.Tables(full, empty), bits)])
    assert len(key) == 1
    for probe in co.PROBES:
        at = int(co._position(key, probe, len(new))[0])
        new[at >> 6] |= np.uint64(1 << (at & 63))
    words, factorize = co._words(text), co.pd.factorize
    monkeypatch.setattr(co.pd, "factorize", lambda values: walked.append(len(values)) or factorize(values))
    found = list(co.tally(text, "en", co.Tables(full, full, empty, new), bits))
    # three pieces of three pairs each hold b c; the fourth is left alone
    assert len(words[0]) == 16 and walked[0] == 9
    assert [(p.to_pylist(), n.tolist()) for _, n, p in found if p is not None] == [(["b c"], [3])]
    walked.clear()
    assert not list(co.tally(b"e f g h. x y", "en", co.Tables(full, full, empty, new), bits)) and not walked


def test_sums_of_text_take_little_more_than_their_rows():
    rng, rows = np.random.default_rng(5), 120_000
    parts = []
    for lang in ("x", "y"):
        ids = rng.integers(0, rows, rows)
        parts.append(pa.table({"bucket": (ids % 4001).astype(np.int32), "lang": [lang] * rows, "phrase": [f"some words {i}" for i in ids], "n": np.full(rows, 3)}))
    want = collections.Counter()
    for lang, part in zip("xy", parts):
        for b, p in zip(part["bucket"].to_pylist(), part["phrase"].to_pylist()):
            want[b, lang, p] += 3
    pool, held, done = pa.default_memory_pool(), [], threading.Event()

    def watch():
        while not done.is_set():
            held.append(pool.bytes_allocated())
            time.sleep(0.0005)

    before, watcher = pool.bytes_allocated(), threading.Thread(target=watch)
    watcher.start()
    summed = co._summed(parts)
    done.set()
    watcher.join()
    got = {(r["bucket"], r["lang"], r["phrase"]): r["n"] for r in summed.to_pylist()}
    assert got == want and len(summed) == len(want)
    assert max(held) - before < 1.7 * sum(part.nbytes for part in parts)
    assert co._summed([part.slice(0, 0) for part in parts]).num_rows == 0
