"""Scalar expressions over transaction columns."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42  # fixed value: the seed every random step uses


def hour_of_day(seconds: Column) -> Column:
    """Whole hours since the start, modulo a day (cast first: fractions never form groups)."""
    return (seconds / 3600).cast("int") % 24


def positive_rounded(amount: Column) -> Column:
    """Amount to two places, 0 unless positive. The feed calls this `Amount_Log`, though no log is taken."""
    return F.when(amount > 0, F.round(amount, 2)).otherwise(0.0)


def positive_log1p(amount: Column) -> Column:
    """ln(1 + amount), 0 unless positive."""
    return F.when(amount > 0, F.log1p(amount)).otherwise(0.0)


def high_amount(amount: Column, limit: float = 500) -> Column:
    return F.when(amount > limit, 1).otherwise(0)


def class_name(label: Column) -> Column:
    return F.when(label == 1, "Fraud").otherwise("Normal")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 when the whole is 0 or missing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def rate_pct(part: Column, whole: Column, digits: int = 4) -> Column:
    """Share in percent."""
    return F.round(
        F.coalesce(F.try_divide(part.cast("double") * 100, whole.cast("double")), F.lit(0.0)), digits
    )


def vector_element(vector: Column, index: int) -> Column:
    """One element of an ML vector, dense or sparse, without leaving the JVM."""
    return vector_to_array(vector)[index]


def key_hash(*keys: Column, salt: str | int = SEED) -> Column:
    """32-bit hash of business keys as bigint.

    Depends on values only, never on row order or partitioning, so a retried or
    re-planned task draws the same numbers. `salt` separates independent draws.
    """
    text = F.concat_ws(":", *[k.cast("string") for k in keys], F.lit(str(salt)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def uniform_hash(*keys: Column, salt: str | int = SEED) -> Column:
    """Key hash as a number in [0, 1)."""
    return key_hash(*keys, salt=salt) / F.lit(4294967296.0)
