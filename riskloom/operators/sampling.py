"""Sampling, splitting, ordering and limits that do not depend on row order or partitioning."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import key_hash, uniform_hash
from ..functions.scalars import SEED
from ..schema import LABEL

# Independent draws need different salts: a split drawn with the salt of a sample would
# put the whole sample on one side.
SAMPLE_SALT, SPLIT_SALT, SHUFFLE_SALT = f"{SEED}:sample", f"{SEED}:split", f"{SEED}:shuffle"


def shuffle_rows(df: DataFrame, keys: list[str], salt: str = SHUFFLE_SALT) -> DataFrame:
    """Rows in a random but repeatable order."""
    return df.orderBy(key_hash(*[F.col(k) for k in keys], salt=salt), *keys)


def first_rows(df: DataFrame, order: list[str | Column], n: int) -> DataFrame:
    """The first n rows of a stated order (a bare limit takes whichever arrive first)."""
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(by), tie).limit(k)


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second)


def sample_fraction(
    df: DataFrame, keys: list[str], fraction: float | Column, salt: str = SAMPLE_SALT
) -> DataFrame:
    """Keep each row with the given probability."""
    return df.filter(uniform_hash(*[F.col(k) for k in keys], salt=salt) < fraction)


def sample_normals(
    df: DataFrame, keys: list[str], fraction: float = 0.01, label: str = LABEL
) -> DataFrame:
    """All frauds and a fixed share of the normal rows, in one scan instead of a union of two."""
    drawn = uniform_hash(*[F.col(k) for k in keys], salt=SAMPLE_SALT) < fraction
    return df.filter((F.col(label) == 1) | ((F.col(label) == 0) & drawn))


def undersample(
    df: DataFrame, keys: list[str], ratio: float = 1.0, label: str = LABEL
) -> DataFrame:
    """All frauds and about `ratio` normal rows per fraud.

    The share to keep is a scalar subquery over the class counts.
    """
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("frauds"), F.count_if(F.col(label) == 0).alias("normals")
    )
    share = counts.select(
        F.least(F.lit(1.0), F.try_divide(F.col("frauds") * float(ratio), F.col("normals")))
    ).scalar()
    return sample_normals(df, keys, share, label)


def split_side(
    keys: list[str], train: float = 0.8, label: str | None = None, fractions: dict[int, float] | None = None
) -> Column:
    """True for training rows. With `fractions` each class gets its own share."""
    drawn = uniform_hash(*[F.col(k) for k in keys], salt=SPLIT_SALT)
    if not fractions:
        return drawn < train
    bound = F.lit(float(train))
    for value, fraction in fractions.items():
        bound = F.when(F.col(label) == value, F.lit(float(fraction))).otherwise(bound)
    return drawn < bound


def train_test_split(
    df: DataFrame, keys: list[str], train: float = 0.8, label: str | None = None,
    fractions: dict[int, float] | None = None,
) -> tuple[DataFrame, DataFrame]:
    side = split_side(keys, train, label, fractions)
    return df.filter(side), df.filter(~side)


def cached(df: DataFrame) -> DataFrame:
    """Keep a reused table in memory, spilling to disk; lost blocks are recomputed. Unpersist when done."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
