"""From raw documents to encoded training text, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
DataFrame: rules reject, the classifier rejects, one document of each group of near-duplicates
stays, sources are mixed to their target weights (documents may come twice), and texts are encoded.
All but the last return the columns of `documents`. `run` writes each stage's rows to the folder
named by `spark.checkpoint.dir` and reads them again, so a lost executor costs one stage at most.

Defined results: rows that have no words are rejected by the first stage, and null ids pass all
stages. An empty table gives empty results throughout.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import bpe, mixing, near_dedup, quality_classifier, quality_rules
from riskloom.llm.common import read
from riskloom.session import work_dir

VOCABULARY = "byte_bpe_50k.json"


def _carried(docs: DataFrame) -> DataFrame:
    """The rows beside their text, so that no column of theirs clashes with an operator's."""
    return docs.select(F.struct("*").alias("_row"), F.col("doc_id"), F.col("text"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the latest policy rejects."""
    rows = quality_rules.apply_policy(quality_rules.ledger(_carried(docs)))
    return quality_rules.passing(rows, ["_row.*"])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as good text.

    The model is learned from labelled rows of the whole table: those that the rules rejected are
    what it must know as bad.
    """
    model = quality_classifier.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return quality_classifier.score(_carried(docs), model).filter("predicted = 1").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by a similarity of 0.8 or more."""
    return near_dedup.keep_one(docs, 80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to their sources' targets, in shards shuffled within."""
    return mixing.mixed(_carried(docs).withColumn("source", F.col("_row.source"))).select("_row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, packed ids, and whether they decode to the text."""
    rows = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(VOCABULARY))
    return rows.select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"),
    )


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", quality),
    ("near_dedup", near_duplicates),
    ("mixing", mix),
    ("bpe", encode),
]

#: The classifier's and the mix's draws can't be stated in SQL; tests follow each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
