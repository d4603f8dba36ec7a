"""Row-wise operators: pages, languages, quality, rules, tokens, licenses."""

import hashlib
import struct

import numpy as np
import public_tokenizers
import pytest
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskloom.llm import (
    bpe,
    html_extract,
    language_id,
    license_scan,
    quality_classifier,
    quality_rules,
)
from riskloom.llm.queries import ORACLES, QUERIES

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)
EMPTY = "doc_id long, text string, lang string, source string"


def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, extra columns with clashing names."""
    rows = [
        (1, None, None, None, "x", 1.0),
        (2, "", "en", "a", "x", 1.0),
        (None, "some words in a row", "en", "a", "x", 1.0),
        (3, "the same line\nthe same line\n\nother", "en", None, "x", 1.0),
        (3, "the same line\nthe same line\n\nother", "en", None, "x", 1.0),
        (4, "wörd " * 40_000, "de", "b", "x", 1.0),
        (5, "1234 !!! ½ ☃", "en", "b", "x", 1.0),
        (6, "Licensed under the GNU General Public License, version 2.", "en", "b", "x", 1.0),
        (7, "Licensed under the GNU General Public License version 3 only.", "en", "b", "x", 1.0),
    ]
    return spark.createDataFrame(rows, EMPTY + ", labels string, score double")


# ---- SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) == []


@pytest.mark.parametrize("module", [quality_rules, license_scan])
def test_odd_documents_match_sql(spark, tmp_path, module):
    path = f"{tmp_path}/documents.parquet"
    odd_documents(spark).coalesce(1).write.parquet(path)
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert differences(module.digest(spark.read.parquet(path)), con, module.SQL) == []
    assert module.digest(spark.createDataFrame([], EMPTY)).count() == 0


# ---- pages


PARAGRAPH = "A sentence long enough to count as running text, with several more words in it. " * 2
PAGES = {
    "article": (
        "<html><head><title>t</title></head><body><nav><a>Home</a></nav><article><h1>Title &amp; more</h1>"
        "<p>One\n  two<br>three</p><aside>side</aside><ul><li>a</li><li>b</li></ul></article><footer>f</footer></body></html>",
        "Title & more\nOne two three\na\nb",
    ),
    "plain divs": (
        f'<body><div class="menu">Home About</div><div id="content"><h2>Head</h2><p>{PARAGRAPH}</p><p>Short.</p>'
        f'<p>{PARAGRAPH}</p></div><div class="cookie-notice">{PARAGRAPH}</div><div id="comments"><p>{PARAGRAPH}</p></div></body>',
        f"Head\n{PARAGRAPH.strip()}\nShort.\n{PARAGRAPH.strip()}",
    ),
    "script with a tag in it": ('<script>var t="</p>";</script><article><p>x</p></article>', "x"),
    "broken": ("<article><p>a<p><b>b<br><p>c", "a\nb\nc"),
    "header in the article": ("<header>Site</header><main><header><h1>H</h1></header><p>t</p><form>f</form></main>", "H\nt"),
    "comment article": ('<main><p>t</p></main><article class="comment"><p>reply</p></article>', "t"),
    "entities": ("<article><p>&eacute;&#x41;&#66;&nbsp;&lt;</p></article>", "éAB <"),
    "empty": ("", ""),
    "no markup": ("just text", "just text"),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, text = PAGES[name]
    assert html_extract.extract(page) == text


TEXT = PARAGRAPH.strip()
NAMED = {
    "layout with a sidebar": (f'<div class="layout with-sidebar"><p>{TEXT}</p></div>', TEXT),
    "word within a name": (f'<div class="post social-science"><p>{TEXT}</p></div>', TEXT),
    "page in a form": (f'<body><form id="aspnetForm"><p>{TEXT}</p><p>{TEXT}</p></form></body>', f"{TEXT}\n{TEXT}"),
    "compounds in an article": (
        f'<article><p>{TEXT}</p><section id="related-work"><p>Work.</p></section><div class="search-and-rescue">Sea.</div>'
        '<p class="notice-of-meeting">Noon.</p></article>',
        f"{TEXT}\nWork.\nSea.\nNoon.",
    ),
    "parts of an article": (
        f'<article><p>{TEXT}</p><div class="share-buttons">s</div><div class="ad-slot-3">a</div><form>f</form>'
        f'<div class="comments"><p>{TEXT}</p></div></article>',
        TEXT,
    ),
    "line before the article": (f"<p>before</p><article><p>{TEXT}</p></article>", TEXT),
    "long attribute": ('<article><p data-x="' + "a>b<c " * 2000 + '">text</p></article>', "text"),
    "stray quote": ('<article><p title=5">a</p><p>b "q" c</p></article>', 'a\nb "q" c'),
}


@pytest.mark.parametrize("name", NAMED)
def test_names_and_attributes(name):
    page, text = NAMED[name]
    assert html_extract.extract(page) == text


@given(st.lists(st.sampled_from([0, 0, 0, 5, 40, 90, 200]), max_size=30), st.sampled_from([1, 80]))
def test_kept_lines_against_plain_rule(lengths, surge):
    sums = [sum(lengths[i : i + html_extract.WINDOW]) for i in range(len(lengths))]
    kept, on, last_dive = [], False, -1
    for i, total in enumerate(sums):
        if on and total == 0:
            on, last_dive = False, i
        elif not on and total >= surge and i != last_dive:
            on = True
        if on:
            kept.append(i)
    assert html_extract.kept_lines(np.array(lengths, dtype=np.int64), surge).nonzero()[0].tolist() == kept


def test_pages_of_an_empty_table(spark):
    assert html_extract.digest(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_long_page():
    body = "".join(f"<p>{TEXT} {i}</p>" for i in range(20_000))
    assert html_extract.extract(f"<body>{body}</body>").count("\n") == 19_999


def test_lines_between_surge_and_dive():
    lengths = np.array([5, 0, 0, 0, 40, 60, 0, 30, 0, 0, 0, 5, 0, 0])
    assert html_extract.kept_lines(lengths, 80).nonzero()[0].tolist() == [3, 4, 5, 6, 7]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/abp\"'=! -&;#x1\n", max_size=300))
def test_any_markup_ends(page):
    assert isinstance(html_extract.extract(page), str)


def test_pages_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", None, "x"), (2, None, "", "x"), (2, None, "", "x"), (None, "u", "<p>é</p>", "x")],
        "page_id long, url string, html string, text string",
    )
    got = sorted(map(tuple, html_extract.digest(pages).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (2, None, "", 0), (None, "u", "é", 1)], key=str)


# ---- languages


def test_languages_on_held_out_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = language_id.digest(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in found)
    assert right >= 0.95 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_rare_language_is_learned(spark):
    common = [(i, "the thing that was on the other with this and for", "en") for i in range(3000)]
    rare = [(9000 + i, "και το πράγμα ήταν με την άλλη για αυτό", "el") for i in range(2)]
    docs = spark.createDataFrame(common + rare, "doc_id long, text string, lang string")
    model = language_id.fit(docs, rows=20)
    asked = spark.createDataFrame([(1, "ήταν αυτό το άλλη πράγμα"), (2, "this was the other thing")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(asked, model).collect()}
    assert got == {1: ("el", 1.0), 2: ("en", 1.0)}


def test_spans_of_mixed_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language_id.fit(docs)
    en, de = ("the thing that was on the other with this and for " * 4), ("der schein und die einheit ist nicht mit dem " * 4)
    mixed = spark.createDataFrame([(1, en + de + en)], "id long, text string")
    spans = language_id.spans(mixed, model).first()["spans"]
    assert [s["lang"] for s in spans] == ["en", "de", "en"]
    assert spans[0]["start"] == 0 and abs(spans[1]["start"] - len(en)) < 12 and spans[2]["end"] == len(en + de + en) - 1


def test_odd_languages(spark):
    docs = odd_documents(spark)
    got = {(r["doc_id"], r["lang_pred"]) for r in language_id.digest(docs).collect()}
    assert {(1, "und"), (2, "und"), (5, "und")} <= got
    untaught = language_id.predict(docs, language_id.fit(docs.filter("false"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in untaught} == {("und", 0.0)}
    assert language_id.digest(spark.createDataFrame([], EMPTY)).count() == 0


def test_constant_paths_are_the_best():
    rng = np.random.default_rng(0)
    for _ in range(300):
        scores = -np.abs(rng.normal(0, 3, (rng.integers(1, 50), rng.integers(1, 5)))).astype(np.float32)
        best = int(scores.sum(axis=0, dtype=float).argmax())
        if language_id.Labeller._constant(scores, best):
            assert (language_id.viterbi(scores) == best).all()


def test_viterbi_against_all_paths():
    from itertools import product

    rng = np.random.default_rng(1)
    for _ in range(50):
        scores = rng.normal(0, 10, (6, 3))
        worth = lambda p: sum(scores[i, x] for i, x in enumerate(p)) - 12 * sum(a != b for a, b in zip(p, p[1:]))
        assert worth(language_id.viterbi(scores).tolist()) == pytest.approx(max(map(worth, product(range(3), repeat=6))))


# ---- quality


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = quality_classifier.digest(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in found) >= 0.93 * len(found)
    assert sum(r["predicted"] for r in found if r["quality"]) >= 0.97 * sum(r["quality"] for r in found)


def test_odd_quality(spark):
    docs = odd_documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_classifier.digest(docs, none).collect()
    assert len(got) == 9 and {round(r["score"], 6) for r in got} == {0.5}
    one = spark.createDataFrame([(3, 1), (3, 1), (4, None), (None, 0), (4, 7)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, one)
    assert all(r["score"] > 0.9 for r in quality_classifier.score(docs, model).collect())
    assert quality_classifier.digest(spark.createDataFrame([], EMPTY), one).count() == 0


# ---- rules


def test_ledger_policies_and_ablations(spark):
    texts = ["word " * 60, "a b c d e " * 30, " ".join(f"w{i}#" for i in range(80)), "few words", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = quality_rules.apply_policy(quality_rules.ledger(docs)).cache()
    assert {r["doc_id"]: r["kept"] for r in rows.collect()} == dict.fromkeys(range(5), False)
    assert {r["doc_id"] for r in quality_rules.passing(quality_rules.apply_policy(rows, "1"), ["doc_id"]).collect()} == {2}
    effect = {r["rule"]: (r["failed"], r["failed_alone"]) for r in quality_rules.ablations(rows).collect()}
    assert effect["symbols"] == (1, 1) and effect["few_words"] == (2, 2) and effect["repeated_windows"][0] == 2


# ---- tokens


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"aeét ’'\n\t0½日😀_-", "<|endoftext|>", "the", " of", "'ll", "  "]), max_size=60).map("".join))
def test_ids_equal_the_library(text):
    library, own = LIBRARY, bpe.codec(VOCABULARY)
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode(text), dtype="<u4").tolist() == ids
    assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_fragments_are_cut_where_no_token_joins():
    own = bpe.codec(VOCABULARY)
    word = "xqzéÿ日本q\x01".encode()
    parts = own.fragments(word)
    assert b"".join(parts) == word and len(parts) > 1
    assert not any(a[-1:] + b[:1] in token for a, b in zip(parts, parts[1:]) for token in own.bytes_of.values())


def test_token_digest(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").unionByName(odd_documents(spark), allowMissingColumns=True)
    texts = [r["text"] or "" for r in docs.select("text").collect()]
    want = set()
    for text in texts:
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        want.add((len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = bpe.digest(docs, VOCABULARY).collect()
    assert len(got) == len(texts) and {tuple(r)[1:] for r in got} == want
    apart = bpe.decode(bpe.encode(docs.select("doc_id", "text"), VOCABULARY), VOCABULARY)
    assert apart.filter("decoded <> coalesce(text, '')").count() == 0


# ---- licenses


def test_spans_survive_changed_words(spark):
    line = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "all associated documentation files (the Software), to deal in the Software without restriction"
    )
    docs = spark.createDataFrame(
        [(1, f"Some text. {line}."), (2, "Permission is hereby denied."), (3, "CC BY-NC: all rights reserved, all rights reserved")],
        "doc_id long, text string",
    )
    got = {r["doc_id"]: r for r in license_scan.digest(docs).collect()}
    assert got[1]["labels"] == "mit" and 0.6 <= got[1]["score"] < 1 and got[1]["n_base"] == 0
    assert got[2]["labels"] == "" and got[2]["score"] == 0
    assert (got[3]["base_labels"], got[3]["n_base"], got[3]["first_word"], got[3]["last_word"]) == ("cc-by,reserved", 3, 0, 6)


@pytest.mark.parametrize(
    ("line", "labels"),
    [
        ("Licensed under the GNU General Public License, version 2.", "gpl,gpl-2.0"),
        ("Licensed under the GNU General Public License version 3", "gpl,gpl-3.0"),
        ("under the terms of the GNU General Public License v2.0", "gpl,gpl-2.0"),
        (
            "under the terms of the GNU General Public License as published by the Free Software Foundation; "
            "either version 3 of the License, or (at your option) any later version",
            "gpl,gpl-3.0",
        ),
        ("Licensed under the GNU General Public License.", "gpl"),
        ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
        ("Licensed under the Apache License, Version 1.1", ""),
        ("subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2.0"),
        ("subject to the terms of the Mozilla Public License, v. 1.1", ""),
    ],
)
def test_versions_are_told_apart(spark, line, labels):
    docs = spark.createDataFrame([(1, f"Some text. {line} More text.")], "doc_id long, text string")
    assert license_scan.digest(docs).first()["labels"] == labels
