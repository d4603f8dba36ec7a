"""Column helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

#: ASCII white space, the only separator of words in rules, sizes and shingles.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def space_words(text: Column) -> Column:
    """Words between runs of ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def spread(spark: SparkSession, *columns: Column) -> Column:
    """A slot in which to put a row, so that one key fills as many tasks as the session shuffles to."""
    slots = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")
