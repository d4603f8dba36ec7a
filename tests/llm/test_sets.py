"""Operators over whole tables: archives, search, mixing, near-duplicates, the pipeline."""

import collections
import gzip
import hashlib
import math
import random

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from compare import differences
from pyspark.sql import functions as F

from riskloom.llm import mixing, near_dedup, quality_classifier, quality_rules, topk_search, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ---- archives


def odd_pages(spark):
    same = "<p>" + "x" * 1200 + "</p>"
    rows = [
        (1, "http://a/b c", same), (2, None, same), (7, "http://é", same), (7, "http://é", same), (None, "u", same),
        (3, "u\r\nWARC-Type: evil", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (8, "u", "ß" * 700),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_odd_pages_match_sql(spark, tmp_path):
    path = f"{tmp_path}/pages.parquet"
    odd_pages(spark).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/*.parquet'")
    assert differences(warc.digest(spark, spark.read.parquet(path)), con, warc.SQL) == []
    assert warc.digest(spark, odd_pages(spark).filter("false")).count() == 0


def test_archives_are_gzip_members_of_records(spark, tmp_path):
    folder = f"file://{tmp_path}/archives"
    listed = warc.write_archives(warc.mark_revisits(odd_pages(spark)), folder, archive_bytes=200).collect()
    assert sum(r["records"] for r in listed) == 10 and len(listed) > 2
    for r in listed:
        assert open(r["path"], "rb").read(2) == b"\x1f\x8b"
        assert gzip.open(r["path"]).read().count(b"WARC/1.1\r\n") == r["records"]
    back = warc.read_archives(spark.createDataFrame(listed), folder).collect()
    html = {(r["page_id"], r["html"] or "") for r in odd_pages(spark).collect()}
    assert all(r["verified"] for r in back)
    assert {(r["page_id"], r["payload"].decode()) for r in back if r["record_type"] == "response"} <= html


def test_damage_is_found():
    content = warc.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    assert warc.parse(content)["verified"]
    assert not warc.parse(content.replace(b"payload\r\n\r\n", b"PAYLOAD\r\n\r\n"))["verified"]
    with pytest.raises(ValueError):
        warc.parse(content[:-5])


# ---- search


def test_search_against_brute_force(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 12)) * np.exp(rng.normal(size=(700, 1)))
    x[100:160] = x[100]  # many ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] * 12), (None, x[0].tolist()), (904, []), (950, [1.0])]
    path = f"{tmp_path}/embeddings.parquet"
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet' WHERE len(embedding) <> 1")
    assert differences(topk_search.digest(spark.read.parquet(path)), con, topk_search.SQL) == []


def test_small_blocks_and_seeds_give_the_same(spark, monkeypatch, sf):
    for name, value in (("SEED", 3), ("CANDIDATE_BLOCK", 37), ("QUERY_BLOCK", 2)):
        monkeypatch.setattr(topk_search, name, value)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert differences(topk_search.digest(spark.read.parquet(f"{sf}/embeddings.parquet")), con, topk_search.SQL) == []


def test_search_sends_no_blocks_to_the_driver(spark, monkeypatch):
    for name, value in (("SEED", 5), ("CANDIDATE_BLOCK", 4), ("QUERY_BLOCK", 2), ("GROUP_BYTES", 1)):
        monkeypatch.setattr(topk_search, name, value)
    x = np.random.default_rng(4).normal(size=(300, 3))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = topk_search.search(rows, F.col("vec_id") % 20 == 0)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    ints = np.floor(256 * x.astype(np.float32).astype(float))
    expected = set()
    for q in range(0, 300, 20):
        score = {c: int(ints[q] @ ints[c]) for c in range(300) if c != q}
        expected |= {(q, r + 1, c, score[c]) for r, c in enumerate(sorted(score, key=lambda c: (-score[c], c))[:5])}
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect()} == expected


def test_longest_come_from_the_first_blocks(spark):
    x = [[float(i % 97), 1.0] for i in range(500)]
    rows = topk_search.prepared(spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<float>"))
    order = rows.repartitionByRange(F.desc("norm2"), F.col("vec_id")).sortWithinPartitions(F.desc("norm2"), "vec_id")
    blocks = topk_search._stored(topk_search._packed(order, 7).repartition("block"), "blocks")
    ids, ints = topk_search.longest(blocks, 2)
    assert ids.tolist() == sorted(range(500), key=lambda i: (-(i % 97), i))
    assert ints.tolist() == [[256.0 * (i % 97), 256.0] for i in ids]


def test_search_of_few_rows(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (50, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk_search.digest(few).collect())) == [(0, 1, 50, 3 * 65536), (50, 1, 0, 3 * 65536)]
    assert topk_search.digest(few.filter("false")).count() == 0


# ---- mixing


def test_targets_are_reshared():
    sizes = [10, 1000, 1000, 10, 0]
    got = mixing.targets(sizes)
    assert got[0] == 20 and got[4] == 0 and sum(got) == pytest.approx(1.5 * sum(sizes))
    assert all(t <= 2 * s + 1e-9 for t, s in zip(got, sizes))


def test_tree_keeps_quotas():
    counts = [5, 1000, 0, 37]
    got = mixing.split(counts, 7, 1)
    assert got.sum(axis=0).tolist() == counts and got.sum(axis=1).max() - got.sum(axis=1).min() <= 1
    huge = mixing.split([3 * 10**9, 10**9, 5], 4, 1)
    assert huge.sum(axis=0).tolist() == [3 * 10**9, 10**9, 5] and huge.min() >= 0
    assert huge.sum(axis=1).max() - huge.sum(axis=1).min() <= 1
    assert (mixing.split([3 * 10**9, 10**9, 5], 4, 1) == huge).all()


@pytest.mark.parametrize("good, bad, n", [(40, 60, 50), (300, 5, 200), (7, 900, 45), (1, 99, 99), (50, 0, 40), (0, 50, 40)])
def test_draws_are_hypergeometric(good, bad, n):
    rng = np.random.default_rng(4)
    got = np.bincount([mixing.hypergeometric(rng, good, bad, n) for _ in range(20_000)], minlength=good + 1)
    ways = [math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n) if n >= k else 0 for k in range(good + 1)]
    assert len(got) == good + 1 and np.abs(got / 20_000 - ways).sum() < 0.06


@pytest.mark.parametrize("good, bad, n", [(10**9, 3 * 10**9, 2 * 10**9), (5 * 10**12, 10**12, 10**12), (10**6, 10**13, 10**12)])
def test_large_draws_have_mean_and_spread(good, bad, n):
    rng = np.random.default_rng(9)
    got = np.array([mixing.hypergeometric(rng, good, bad, n) for _ in range(4000)], dtype=float)
    total = good + bad
    mean, deviation = n * good / total, math.sqrt(n * (good / total) * (bad / total) * ((total - n) / (total - 1)))
    assert abs(got.mean() - mean) < 5 * deviation / math.sqrt(4000)
    assert got.std() == pytest.approx(deviation, rel=0.07)
    assert got.min() >= max(0, n - bad) and got.max() <= min(good, n)


def test_mix_meets_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, "en", None, 0), (10**6 + 1, "a b c", "en", None, 0), (None, "x " * 9, "en", "", 0)], DOCS)
    docs = docs.unionByName(extra)
    rows = mixing.digest(docs).collect()
    assert len(rows) == docs.count()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sums = collections.defaultdict(lambda: [0, 0, 0.0, 0])
    for r in rows:
        s = sums[source[r["doc_id"]]]
        s[0] += r["size"]
        s[1] += r["taken"]
        s[2], s[3] = r["target"], r["source_size"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    names = sorted(sums, key=lambda k: (k is None, k))
    assert mixing.targets([sums[k][0] for k in names]) == pytest.approx([sums[k][2] for k in names])
    assert all(s[0] == s[3] and abs(s[1] - s[2]) <= 1 for s in sums.values())
    again = mixing.digest(docs.repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    shards = collections.Counter(x for r in rows for x in r["shards"])
    assert max(shards.values()) - min(shards.values()) <= 1
    assert mixing.digest(docs.filter("false")).count() == 0


def test_mix_keeps_columns_with_clashing_names(spark):
    rows = [(i, "a word or two " * (i + 1), "s%d" % (i % 2), "x", -i, 0.5, "b") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, shard string, size long, target double, blocks string")
    got = mixing.mixed(docs, shards=3)
    assert got.columns == ["doc_id", "text", "source", "size", "target", "blocks", "shard"]
    found = got.collect()
    assert found and all(r["size"] == -r.doc_id and r.target == 0.5 and r.blocks == "b" and 0 <= r.shard < 3 for r in found)
    plain = mixing.mixed(docs.select("doc_id", "text", "source"), shards=3).collect()
    assert sorted((r.doc_id, r.shard) for r in found) == sorted((r.doc_id, r.shard) for r in plain)


def test_mix_of_repeated_and_empty_rows(spark):
    rows = [(1, "a b c d", "en", "s", 1)] * 5 + [(2, "", "en", "t", 0), (3, None, "en", "t", 0)]
    got = mixing.digest(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == 7 and all(r["taken"] <= 2 * r["size"] for r in got)


# ---- near-duplicates


def brute_force(rows, threshold):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= threshold * len(sets[a] | sets[b]):
                one, other = find(a), find(b)
                root[max(one, other)] = min(one, other)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_documents():
    """A large group of partly changed copies, groups of exact copies, short and empty texts."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(160)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 12])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, "Exact  copy of\tsome text here" if i % 2 else "exact copy of some text HERE") for i in range(20)]
    rows += [(300, ""), (301, None), (302, "  \n"), (303, "one two"), (304, "ONE two"), (305, "one two three four five"), (306, "é É")]
    return rows


@pytest.mark.parametrize("threshold,block", [(85, 512), (80, 16)])
def test_classes_against_brute_force(spark, monkeypatch, threshold, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = near_documents()
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.classes(docs, threshold).collect()}
    assert got == brute_force(rows, threshold)


def test_digest_of_real_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = near_dedup.digest(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_force(
        [(r["doc_id"], r["text"]) for r in docs.collect()], 85
    )
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_odd_rows_of_near_duplicates(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (4, "A B C D E F"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnsRenamed({})
    got = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in near_dedup.digest(docs).collect())
    assert got == sorted([("None", "None", True)] * 2 + [("5", "4", False)] * 2 + [("4", "4", True), ("6", "6", True)])
    assert {r["doc_id"] for r in near_dedup.keep_one(docs).collect()} == {None, 4, 6}
    assert near_dedup.digest(docs.filter("false")).count() == 0


def test_sketches_estimate_and_merge():
    rng = np.random.default_rng(2)
    a, b = (np.unique(rng.integers(0, 1 << 63, 900, dtype=np.uint64)) for _ in range(2))
    b = np.unique(np.concatenate([b[:100], a[:800]]))
    x, y = near_dedup.sketch(a), near_dedup.sketch(b)
    assert (near_dedup.merge(x, y) == near_dedup.sketch(np.union1d(a, b))).all()
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    found = near_dedup.estimate(*(np.array([v]) for v in ((x > y).sum(), (x < y).sum(), len(a), len(b))))[0]
    assert abs(found - j) < 0.1
    for percent in (80, 85, 95):
        r = near_dedup.band_rows(percent)
        assert (1 - (percent / 100) ** r) ** (near_dedup.REGISTERS // r) <= near_dedup.MISS


# ---- pipeline


def test_pipeline_stage_by_stage(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bad = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 0").collect()}
    stages = dict(corpus_pipeline.STAGES)

    ruled = stages["quality_rules"](spark, docs, sf).cache()
    want = {r["doc_id"] for r in quality_rules.digest(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in ruled.collect()} == want and ruled.columns == docs.columns
    assert len(want & bad) <= 0.05 * len(bad)

    judged = stages["quality_classifier"](spark, ruled, sf).cache()
    model = quality_classifier.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = ruled.collect()
    scores = model.score([r["text"] for r in rows])
    assert {r["doc_id"] for r in judged.collect()} == {r["doc_id"] for r, s in zip(rows, scores) if s >= 0.5}

    alone = stages["near_dedup"](spark, judged, sf).cache()
    classes = brute_force([(r["doc_id"], r["text"]) for r in judged.collect()], 80)
    assert {r["doc_id"] for r in alone.collect()} == {i for i, (_, c) in classes.items() if i == c}

    mixed = stages["mixing"](spark, alone, sf).cache()
    due = {
        r["doc_id"]: sum(2 * b["words"] >= r["size"] for b in r["blocks"]) for r in mixing.blocks(alone).collect()
    }
    assert collections.Counter(r["doc_id"] for r in mixed.collect()) == +collections.Counter(due)

    encoded = stages["bpe"](spark, mixed, sf).collect()
    assert len(encoded) == mixed.count() and all(r["decodes"] and len(r["ids"]) == 4 * r["n_tokens"] for r in encoded)


def test_pipeline_of_odd_rows(spark, tmp_path):
    good = "some clean words that follow one another in a sentence " + " ".join(f"word{i} then" for i in range(60))
    rows = [(1, good, "en", None, 3), (1, good, "en", None, 3), (2, None, None, None, None), (3, "", "en", "a", 0), (None, good + " more", "en", "a", 1)]
    sf = str(tmp_path)
    spark.createDataFrame(rows, DOCS).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in got} <= {1, None} and got
