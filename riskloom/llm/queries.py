"""The registered queries of the text operators, and the SQL that checks them."""

from __future__ import annotations

import public_tokenizers

from . import (
    bpe,
    collocations,
    html_extract,
    language_id,
    license_scan,
    mixing,
    near_dedup,
    quality_classifier,
    quality_rules,
    sentencepiece_codec,
    topk_search,
    warc,
    whitening,
)
from .common import Query, read

QUERIES: dict[str, Query] = {
    "op1_html_extract": lambda spark, sf_dir: html_extract.digest(read(spark, sf_dir, "pages")),
    "op2_language_id": lambda spark, sf_dir: language_id.digest(read(spark, sf_dir, "documents")),
    "op3_warc": lambda spark, sf_dir: warc.digest(spark, read(spark, sf_dir, "pages")),
    "op4_topk_search": lambda spark, sf_dir: topk_search.digest(read(spark, sf_dir, "embeddings")),
    "op5_quality_classifier": lambda spark, sf_dir: quality_classifier.digest(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    ),
    "op6_quality_rules": lambda spark, sf_dir: quality_rules.digest(read(spark, sf_dir, "documents")),
    "op7_bpe": lambda spark, sf_dir: bpe.digest(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    ),
    "op8_license_scan": lambda spark, sf_dir: license_scan.digest(read(spark, sf_dir, "documents")),
    "op9_mixing": lambda spark, sf_dir: mixing.digest(read(spark, sf_dir, "documents")),
    "op10_near_dedup": lambda spark, sf_dir: near_dedup.digest(read(spark, sf_dir, "documents")),
    "op11_whitening": lambda spark, sf_dir: whitening.digest(read(spark, sf_dir, "embeddings")),
    "op12_phrases": lambda spark, sf_dir: collocations.digest(read(spark, sf_dir, "documents")),
    "op13_sentencepiece": lambda spark, sf_dir: sentencepiece_codec.digest(
        read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    ),
}

ORACLES: dict[str, str] = {
    "op3_warc": warc.SQL,
    "op4_topk_search": topk_search.SQL,
    "op6_quality_rules": quality_rules.SQL,
    "op8_license_scan": license_scan.SQL,
    "op12_phrases": collocations.SQL,
}
