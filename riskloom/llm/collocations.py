"""Frequent phrases and their association scores, mined by a sample and its negative border.

A phrase of k words can only be frequent if its first and its last k - 1 words are. So:

1. A sample of the texts is mined level by level at a lowered support; what it finds is proposed.
2. One pass over all texts counts the proposed phrases and their negative border: the phrases that
   are not proposed, but all of whose parts are, as far as they occur. A border phrase that turns out
   frequent is a failure of the sample.
3. The failures are added to the proposal, and a further pass counts the phrases that this brings in
   and that no pass has counted; until a pass finds nothing frequent. From the third pass on, few phrases
   are new, and only the pieces of text that hold one are gone through.

The border is large and nearly all of it is rare, and so is much of a proposal, so a pass counts by
the upper 44 or more bits of a hash (`key_bits`). A collision can only make a count too large, and
what a pass finds frequent is counted as text by the next one, so all counts that come out are
exact. Every phrase is counted over all texts, so counts do not depend on the sample; a poor sample
only costs passes, of which there are at most one more than words in the longest phrase, but for
collisions.

**At scale.** The proposal grows with the corpus, so tasks get it as a bit table of fixed size
(2 ** `BITS` bits, 16 MB): a false hit only has one more phrase counted. Its bits are combined by
Spark; only the table reaches the driver. Tasks count a few megabytes of text at a time as arrays of
word numbers, so no frequent word or phrase makes a hot key: text is summed per task, and hashes are
packed into lists, one for each bucket of hashes and power of two in their counts, which take 4 bytes
a phrase, are dealt out by bucket, and only then unpacked and summed. What each pass finds is stored
in the shared folder. Products are decimals, so no count is too large for them.

Defined results: a null text has no words, a null language is `und`. Repeated rows count as often
as they come. An empty table gives an empty result. Other columns are not read. Equal scores are
ranked by count, then by phrase in UTF-8 byte order, which is unique within a language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.session import stored

LONGEST = 4
SUPPORT = 30
#: One row in so many is in the sample, in which a phrase must stand so often to be proposed.
SAMPLE = 8
SAMPLE_SUPPORT = 2
#: Base-2 logarithm of the bits in a table, and the bits per phrase.
BITS = 27
PROBES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
#: Bytes of text that a task counts at a time; a longer text is counted alone.
STRETCH = 3 << 20
#: Rows of text and keys that a task holds before it sums them.
HELD = 1_000_000
HELD_KEYS = 1_000_000
#: Parts, by bucket, in which a task sums its rows of text.
PARTS = 8
#: Rows of text that a task sends at a time.
SENT = 1 << 16
#: Slots in which each language's best rows are found before they meet.
SLOTS = (64, 8)

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[list(b" \t")] = 1
_CLASS[list(PIECE_ENDS)] = 2

ROWS = "bucket int, lang string, phrase string, n long, lows array<int>"
LOW_BITS = 32
#: Tasks that sum unpacked hashes, as a multiple of the session's shuffle partitions.
FINER = 3


def sum_tasks(spark: SparkSession) -> int:
    """More than other shuffles have: lists are small, but what they unpack to is held as a hash table."""
    return FINER * int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_bits(spark: SparkSession) -> int:
    """Bits of a hash that are used: 32 within a bucket, and buckets enough to fill all tasks evenly."""
    return LOW_BITS + max(12, (16 * sum_tasks(spark)).bit_length())


# ---- the table of proposed phrases


def empty_table(bits: int = BITS) -> np.ndarray:
    return np.zeros(1 << (bits - 6), dtype=np.uint64)


def _position(keys: np.ndarray, probe: np.uint64, slots: int) -> np.ndarray:
    """Number of one of a phrase's bits in a table of `slots` 64-bit words, a power of two."""
    return (keys * probe) >> np.uint64(64 - 5 - slots.bit_length())


def has(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    found = np.zeros(len(keys), dtype=bool)
    left = None
    for probe in PROBES:
        # most keys of a border miss at the first bit
        at = _position(keys if left is None else keys[left], probe, len(table))
        hit = np.flatnonzero((table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1))
        left = hit if left is None else left[hit]
    found[left] = True
    return found


def with_phrases(table: np.ndarray, phrases: DataFrame) -> np.ndarray:
    """The table with the bits of phrases (bucket, low) set as well; bits are combined before they are collected."""

    slots = len(table)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(slots, dtype=np.uint64)
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for probe in PROBES:
                at = _position(keys, probe, slots)
                np.bitwise_or.at(own, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(own[at].view(np.int64))], names=["at", "bits"])

    key = F.shiftleft(F.col("bucket").cast("long"), LOW_BITS).bitwiseOR(F.col("low").cast("long").bitwiseAND((1 << LOW_BITS) - 1))
    rows = phrases.select(key).mapInArrow(bits, "at long, bits long")
    merged = rows.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = table.copy()
    at = merged.column("at").to_numpy()
    table[at] |= merged.column("bits").to_numpy().view(np.uint64)
    return table


@lru_cache(maxsize=4)
def _opened(packed: bytes) -> np.ndarray:
    """The table sent to this worker, opened once."""
    return np.frombuffer(zstandard.decompress(packed), dtype=np.uint64)


def sent(spark: SparkSession, table: np.ndarray) -> Broadcast:
    return spark.sparkContext.broadcast(zstandard.compress(table.tobytes(), 1))


# ---- counting


def _joined_hash(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (first ^ (first >> np.uint64(31))) * PROBES[1] + word


def _words(text: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Number of each word in order, the distinct words, and whether a word's piece goes on after it."""
    kinds = _CLASS[np.frombuffer(text, dtype=np.uint8)]
    inner = kinds == 0
    edge = np.flatnonzero(np.diff(inner, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    letters = np.frombuffer(text, dtype=np.uint8)[inner]
    bounds = np.append(0, np.cumsum(ends - starts)).astype("<i8")
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(letters))
    table = words.dictionary_encode()
    breaks = np.cumsum(kinds == 2, dtype=np.int32)[starts]
    on = np.append(breaks[1:] == breaks[:-1], False)[: len(starts)]
    return table.indices.to_numpy(zero_copy_only=False), table.dictionary, on


class Tables(NamedTuple):
    """What a pass knows: the proposal now, before the last pass and before the one before it, and what
    the last pass found frequent. None where there was no such pass."""

    now: np.ndarray | Broadcast
    before: np.ndarray | Broadcast | None = None
    older: np.ndarray | Broadcast | None = None
    confirmed: np.ndarray | Broadcast | None = None


class _Seen:
    """Which distinct phrases of one length had all their parts in an earlier table, length by length."""

    def __init__(self, table: np.ndarray | None):
        self.table = table

    def words(self, keys: np.ndarray) -> np.ndarray:
        self.tested = np.full(len(keys), self.table is not None)
        self.passed = self.tested & has(self.table, keys) if self.table is not None else self.tested
        return self.tested

    def longer(self, keys: np.ndarray, first: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """`first` and `rest` number the parts without the last and without the first word."""
        self.tested = self.passed[first] & self.passed[rest]
        self.passed = self.tested & has(self.table, keys) if self.table is not None else self.tested
        return self.tested


def _near(codes: np.ndarray, on: np.ndarray, of_word: np.ndarray, unused: np.uint64, table: np.ndarray) -> np.ndarray:
    """Whether each word's piece holds a phrase of the table."""
    hashes = words = of_word[codes]
    hit = has(table, of_word >> unused)[codes]
    fits = np.ones(len(codes), dtype=bool)
    for k in range(2, LONGEST + 1):
        # phrases by the place they begin at, and whether they end in the same piece
        hashes, fits = _joined_hash(hashes[:-1], words[k - 1 :]), fits[:-1] & on[k - 2 : len(on) - 1]
        hit[: len(hashes)] |= fits & has(table, hashes >> unused)
    piece = np.append(0, np.cumsum(~on[:-1], dtype=np.int32))
    near = np.zeros(piece[-1] + 1, dtype=bool)
    near[piece[hit]] = True
    return near[piece]


def tally(text: bytes, lang: str, tables: Tables, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array | None]]:
    """Keys, counts and text of phrases in one stretch all of whose parts the proposal has.

    Phrases that it brings in come by key, those that the last pass brought in and found frequent with
    their text; so each phrase comes once by key and at most once as text. The first pass also gives
    the number of words, as phrase ''.
    """
    codes, words, on = _words(text)
    if not len(codes):
        return
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "replace"))
    of_word = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.to_numpy(zero_copy_only=False)), dtype=np.uint64, count=len(words))
    size, unused = len(words), np.uint64(64 - bits)
    if tables.older is not None and tables.confirmed is not None:
        # what is counted now holds or is a phrase that the last pass found, of which there are few by now
        near = _near(codes, on, of_word, unused, tables.confirmed)
        codes, on = codes[near], on[near]
        if not len(codes):
            return
    hashes, counts = of_word, np.bincount(codes, minlength=size).astype(np.int32)
    keys = hashes >> unused
    before, older = _Seen(tables.before), _Seen(tables.older)
    tested, earlier = before.words(keys), older.words(keys)
    if tables.before is None:
        yield keys[:1], np.array([len(codes)]), pa.array([""], pa.large_string())
    # the number of the phrase that begins at each place, -1 where it isn't proposed
    inside = has(tables.now, keys)
    at = np.where(inside[codes], codes, np.int32(-1))
    some_place = None
    for k in range(1, LONGEST + 1):
        if k > 1:
            both = (at[:-1] >= 0) & (at[1:] >= 0)
            # longer phrases overlap, so they share a piece
            places = np.flatnonzero(both & on[:-1] if k == 2 else both)
            numbers, kinds = pd.factorize(at[places].astype(np.int64) * size + codes[places + k - 1])
            numbers, places = numbers.astype(np.int32), places.astype(np.int32)
            counts = np.bincount(numbers, minlength=len(kinds)).astype(np.int32)
            first, last = (kinds // size).astype(np.int32), (kinds % size).astype(np.int32)
            del both, kinds
            hashes = _joined_hash(hashes[first], of_word[last])
            keys = hashes >> unused
            some_place = np.zeros(len(keys), dtype=np.int32)
            some_place[numbers] = places
            rest = at[some_place + 1]
            tested, earlier = before.longer(keys, first, rest), older.longer(keys, first, rest)
            inside = has(tables.now, keys)
            at.fill(-1)
            at[places] = np.where(inside[numbers], numbers, np.int32(-1))
            del numbers, places, first, last, rest
        if tables.confirmed is not None:
            found = tested & ~earlier & has(tables.confirmed, keys)
            if found.any():
                begins = None if some_place is None else some_place[found]
                parts = [words.take(pa.array(np.flatnonzero(found) if begins is None else codes[begins + j])) for j in range(k)]
                yield keys[found], counts[found], pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
        yield keys[~tested], counts[~tested], None


def _buckets(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(LOW_BITS)).astype(np.int32)


def _spelled(keys: np.ndarray, counts: np.ndarray, lang: str, phrases: pa.Array) -> pa.Table:
    return pa.table(
        {"bucket": _buckets(keys), "lang": pa.repeat(pa.scalar(lang, pa.string()), len(keys)), "phrase": phrases.cast(pa.string()), "n": counts.astype(np.int64)}
    )


def _packed(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Lists of keys per bucket: those whose count holds 1, those whose count holds 2, 4 and so on."""
    keys, counts = (np.concatenate(parts) for parts in zip(*held))
    held.clear()
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
    del order
    keys, counts = keys[starts], np.add.reduceat(counts, starts, dtype=np.int64) if len(starts) else counts
    del starts
    for power in range(int(counts.max(initial=0)).bit_length()):
        own = keys[(counts >> power) & 1 == 1]
        buckets = _buckets(own)
        starts = np.flatnonzero(np.diff(buckets, prepend=-1))
        lows = pa.array((own & np.uint64((1 << LOW_BITS) - 1)).astype(np.uint32).view(np.int32))
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(own)).astype(np.int32)), lows)
        none, n = pa.nulls(len(starts), pa.string()), np.full(len(starts), 1 << power)
        yield pa.RecordBatch.from_arrays([pa.array(buckets[starts]), none, none, pa.array(n), lists], names=["bucket", "lang", "phrase", "n", "lows"])


def _summed(held: list[pa.Table]) -> pa.Table:
    # a part of the buckets at a time, and on one thread: grouping takes several times the memory of its rows
    rows = pa.concat_tables(held)
    part = np.concatenate([b.to_numpy() for b in rows.column("bucket").chunks] or [np.array([], dtype=np.int32)]) % PARTS
    sums = []
    for i in range(PARTS):
        own = rows.filter(pa.array(part == i))
        sums.append(own.group_by(["bucket", "lang", "phrase"], use_threads=False).aggregate([("n", "sum")]))
        del own
    return pa.concat_tables(sums).rename_columns({"n_sum": "n"}).select(["bucket", "lang", "phrase", "n"])


def _with_no_lists(rows: pa.Table) -> list[pa.RecordBatch]:
    return rows.append_column("lows", pa.nulls(len(rows), pa.list_(pa.int32()))).combine_chunks().to_batches(max_chunksize=SENT)


def count(texts: DataFrame, tables: Tables) -> DataFrame:
    """Whole-table counts of the phrases that `tally` counts; texts has lang and text, no nulls.

    bucket, low, n by key; bucket, lang, phrase, n as text. The tables are sent ones.
    """
    bits = key_bits(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = Tables(*[_opened(t.value) if t else None for t in tables])
        held: dict[str, list[bytes]] = {}
        size = 0
        sums: list[pa.Table] = []
        border: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            while held:
                lang, parts = held.popitem()
                # texts are apart like pieces; lower() of bytes changes A-Z alone
                for keys, counts, phrases in tally(b".".join(parts).lower(), lang, opened, bits):
                    if phrases is None:
                        border.append((keys, counts))
                    else:
                        sums.append(_spelled(keys, counts, lang, phrases))
            if sum(len(keys) for keys, _ in border) >= HELD_KEYS:
                yield from _packed(border)
            if sum(map(len, sums)) >= HELD:
                sums[:] = [_summed(sums)]
                if len(sums[0]) >= HELD // 2:
                    yield from _with_no_lists(sums.pop())
            # what a stretch and the sums took goes back to the system, which other tasks share
            pa.default_memory_pool().release_unused()

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                raw = text.as_buffer().to_pybytes()
                held.setdefault(lang.as_py(), []).append(raw)
                size += len(raw)
                if size >= STRETCH:
                    yield from flush()
                    size = 0
        yield from flush()
        if border:
            yield from _packed(border)
        if sums:
            rest = _summed(sums)
            sums.clear()
            yield from _with_no_lists(rest)
            del rest
        # a worker that waits for its next task holds no more than the tables
        pa.default_memory_pool().release_unused()

    # a number of partitions that stays, as adaptive execution knows only the size of the lists
    dealt = texts.select("lang", "text").mapInArrow(run, ROWS).repartition(sum_tasks(texts.sparkSession), "bucket")
    unpacked = dealt.select("bucket", "lang", "phrase", "n", F.explode_outer("lows").alias("low"))
    return unpacked.groupBy("bucket", "low", "lang", "phrase").agg(F.sum("n").alias("n"))


def closed(texts: DataFrame, table: np.ndarray, support: int, spelled: bool = True) -> tuple[np.ndarray, list[DataFrame]]:
    """The table of all phrases with at least `support`, and (lang, phrase, n) of them if `spelled`.

    `table` holds the proposal; with an empty one this mines level by level. Phrase '' has the number
    of words of a language.
    """
    spark = texts.sparkSession
    found, tables = [], Tables(sent(spark, table))
    while True:
        rows = stored(count(texts, tables).filter((F.col("phrase") == "") | (F.col("n") >= support)), "phrases")
        found.append(rows.filter("phrase is not null").select("lang", "phrase", "n"))
        frequent_keys = rows.filter("phrase is null")
        for done in (tables.older, tables.confirmed):
            if done:
                done.destroy()
        if frequent_keys.isEmpty():
            for done in (tables.now, tables.before):
                if done:
                    done.destroy()
            return table, found
        confirmed = with_phrases(np.zeros_like(table), frequent_keys)
        table = table | confirmed
        tables = Tables(sent(spark, table), tables.now, tables.before, sent(spark, confirmed) if spelled else None)


def frequent(docs: DataFrame, support: int = SUPPORT, text: str = "text", lang: str = "lang", sample: int = SAMPLE, bits: int = BITS) -> DataFrame:
    """(lang, words, phrase, n) of all phrases with at least `support`; 0 words stand for a language's total."""
    texts = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    drawn = texts.filter(F.pmod(F.xxhash64("lang", "text", F.monotonically_increasing_id()), F.lit(sample)) == 0)
    proposal, _ = closed(stored(drawn, "sample"), empty_table(bits), SAMPLE_SUPPORT, spelled=False)
    _, found = closed(texts, proposal, support)
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    # a language's number of words may come in parts, by the words whose hash they were dealt by
    total = F.sum("n").alias("n")
    return reduce(DataFrame.unionAll, found).groupBy("lang", "phrase").agg(total).select("lang", words.alias("words"), "phrase", "n")


# ---- scores


def _whole(n: Column) -> Column:
    return n.cast("decimal(20,0)")


def scored(counts: DataFrame) -> DataFrame:
    """Phrases of two words and more with the cut that scores least: lang, phrase, a, l, r, score, kept."""
    phrases = counts.filter("words >= 2")
    part = counts.filter("words between 1 and 3")
    cuts = phrases.select(
        "lang", "phrase", F.col("n").alias("a"),
        F.expr(
            "inline(transform(sequence(1, words - 1), c -> named_struct('cut', c, "
            "'head', substring_index(phrase, ' ', c), 'tail', substring_index(phrase, ' ', c - words))))"
        ),
    )
    halves = cuts.join(part.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"]).join(
        part.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"]
    )
    score = F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * _whole(F.col("a")), _whole(F.col("l")) + _whole(F.col("r")))
    best = (
        halves.groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(score.cast("long").alias("score"), "cut", "l", "r")).alias("best"))
        .select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    )
    inner = phrases.filter("words >= 3").select(
        "lang", F.col("n").alias("longer"),
        F.expr(
            "explode(flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), "
            "s -> array_join(slice(split(phrase, ' '), s, m), ' ')))))"
        ).alias("phrase"),
    )
    longest = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = _whole(F.col("longer")) * 100 >= _whole(F.col("a")) * 80
    return best.join(longest, ["lang", "phrase"], "left").withColumn("kept", ~F.coalesce(covered, F.lit(False))).drop("longer")


def best_per_language(rows: DataFrame, limit: int) -> DataFrame:
    """Each language's first rows with their rank, found in slots first so that none sorts a whole language."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = rows.withColumn("_slot", F.pmod(F.xxhash64("phrase"), F.lit(SLOTS[0])))
    for slots in SLOTS:
        rows = rows.withColumn("_slot", F.pmod("_slot", F.lit(slots)))
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_slot").orderBy(*order))).filter(F.col("rank") <= limit)
    rows = rows.drop("_slot")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= limit)


def mine(docs: DataFrame, limit: int = 2000, support: int = SUPPORT, text: str = "text", lang: str = "lang", sample: int = SAMPLE, bits: int = BITS) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    a counts the phrase, l and r the two parts of the cut that scores least, n all words of the language.
    """
    counts = frequent(docs, support, text, lang, sample, bits)
    ranked = best_per_language(scored(counts).filter("kept"), limit)
    totals = counts.filter("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return mine(docs)


#: The digest stated for DuckDB.
SQL = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
u AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase FROM u, range(1, {LONGEST + 1}) AS z(k)
  WHERE i + k - 1 <= len(ws)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY ALL HAVING count(*) >= {SUPPORT}),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
x AS (SELECT lang, phrase, a, j, array_to_string(ws[1 : j], ' ') AS head, array_to_string(ws[j + 1 :], ' ') AS tail
  FROM c, range(1, {LONGEST}) AS z(j) WHERE j < k),
s AS (SELECT x.lang, x.phrase, x.a, x.j, h.n AS l, e.n AS r,
  CAST((2000000::HUGEINT * x.a) // (h.n::HUGEINT + e.n) AS BIGINT) AS score
  FROM x JOIN f h ON h.lang = x.lang AND h.phrase = x.head JOIN f e ON e.lang = x.lang AND e.phrase = x.tail),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
o AS (SELECT lang, k, a, ws, z.s AS s, y.b AS b FROM c, range(2, {LONGEST}) AS y(b), range(1, {LONGEST}) AS z(s)
  WHERE b < k AND s + b - 1 <= k),
v AS (SELECT lang, array_to_string(ws[s : s + b - 1], ' ') AS phrase, max(a) AS longer FROM o GROUP BY ALL),
q AS (SELECT m.* FROM m LEFT JOIN v USING (lang, phrase) WHERE v.longer IS NULL OR 100::HUGEINT * v.longer < 80::HUGEINT * m.a)
SELECT q.lang, row_number() OVER (PARTITION BY q.lang ORDER BY q.score DESC, q.a DESC, q.phrase) AS rank,
  q.phrase, q.a, q.l, q.r, t.n, q.score
FROM q JOIN t ON t.lang = q.lang
QUALIFY rank <= 2000
"""
