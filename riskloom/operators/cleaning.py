"""Cleaning of transaction tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import high_amount, hour_of_day, positive_rounded, rate_pct
from ..schema import AMOUNT, LABEL, TIME
from .ordered import exact_quantiles

# Fixed value: share of normal amounts that is kept.
OUTLIER_QUANTILE = 0.999


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Keep rows without a null in `subset` (default: any column).

    Stated column by column: such filters reach the scan one by one, and the optimizer's
    constraint set stays linear in the number of columns. `na.drop` is a single predicate over
    all of them, from which that set grows exponentially when the columns are computed.
    """
    return df.filter(reduce(and_, [F.col(f"`{c}`").isNotNull() for c in subset or df.columns]))


def positive_amount(df: DataFrame, amount: str = AMOUNT) -> DataFrame:
    return df.filter(F.col(amount) > 0)


def with_label(df: DataFrame, label: str = LABEL, value: int = 1) -> DataFrame:
    return df.filter(F.col(label) == value)


def valid_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Rows whose features are all present and not NaN: what a vector assembler would accept."""
    usable = [F.col(c).isNotNull() & ~F.isnan(c) for c in features]
    return df.filter(reduce(and_, usable))


def amount_threshold(
    df: DataFrame,
    amount: str = AMOUNT,
    label: str = LABEL,
    q: float = OUTLIER_QUANTILE,
    rel_err: float = 0.0,
) -> DataFrame:
    """One-row table `threshold`: a high quantile of the normal rows' amounts.

    `rel_err=0` is exact. A larger value takes Spark's quantile sketch instead; close to
    the top of the range even 0.01 lets the maximum through.
    """
    normal = with_label(df, label, 0)
    if rel_err > 0:
        accuracy = max(1, round(1 / rel_err))
        return normal.agg(F.percentile_approx(amount, q, accuracy).cast("double").alias("threshold"))
    return exact_quantiles(normal, amount, {"threshold": q})


def within_threshold(
    df: DataFrame,
    threshold: DataFrame,
    amount: str = AMOUNT,
    exempt: Column | None = None,
) -> DataFrame:
    """Keep amounts up to the threshold, and every exempt row.

    The threshold enters as a scalar subquery: computed once, no join, no value on the driver.
    """
    keep = F.col(amount) <= threshold.select("threshold").scalar()
    return df.filter(keep if exempt is None else keep | exempt)


def outlier_filter(
    df: DataFrame,
    amount: str = AMOUNT,
    label: str = LABEL,
    q: float = OUTLIER_QUANTILE,
    rel_err: float = 0.0,
) -> DataFrame:
    """Drop extreme amounts of normal rows; frauds stay whatever their amount."""
    limit = amount_threshold(df, amount, label, q, rel_err)
    return within_threshold(df, limit, amount, exempt=F.col(label) == 1)


def derived_columns(df: DataFrame, time: str = TIME, amount: str = AMOUNT) -> DataFrame:
    return df.withColumns(
        {
            "Hour": hour_of_day(F.col(time)),
            "Amount_Log": positive_rounded(F.col(amount)),
            "Is_High_Amount": high_amount(F.col(amount)),
        }
    )


def clean_transactions(
    df: DataFrame,
    subset: list[str] | None = None,
    time: str = TIME,
    amount: str = AMOUNT,
    label: str = LABEL,
    q: float = OUTLIER_QUANTILE,
    rel_err: float = 0.0,
) -> DataFrame:
    """Drop incomplete rows, then bad amounts, then outliers; add the derived columns."""
    valid = df.transform(drop_nulls, subset).transform(positive_amount, amount)
    return valid.transform(outlier_filter, amount, label, q, rel_err).transform(
        derived_columns, time, amount
    )


def clean_report(
    df: DataFrame,
    subset: list[str] | None = None,
    amount: str = AMOUNT,
    label: str = LABEL,
    q: float = OUTLIER_QUANTILE,
    rel_err: float = 0.0,
) -> DataFrame:
    """Row counts before and after cleaning, in one pass besides the one for the threshold."""
    columns = subset or df.columns
    complete = reduce(and_, [F.col(c).isNotNull() for c in columns])
    valid = complete & (F.col(amount) > 0)
    limit = amount_threshold(df.filter(valid), amount, label, q, rel_err).scalar()
    kept = valid & ((F.col(amount) <= limit) | (F.col(label) == 1))
    counts = df.agg(F.count("*").alias("rows_before"), F.count_if(kept).alias("rows_after"))
    removed = F.col("rows_before") - F.col("rows_after")
    return counts.select(
        "rows_before",
        "rows_after",
        removed.alias("rows_removed"),
        rate_pct(removed, F.col("rows_before"), 2).alias("removed_pct"),
    )
