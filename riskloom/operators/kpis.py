"""Indicators over transaction tables. Each is a single aggregation with map-side partials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    AMOUNT_BUCKETS,
    AMOUNT_CLUSTERS,
    RISK_BANDS,
    Bands,
    bucketize,
    class_name,
    grid_cell,
    hour_of_day,
    rate_pct,
    ratio,
)
from ..schema import AMOUNT, LABEL, TIME
from .cleaning import with_label
from .ordered import exact_quantiles

# Fixed value: components whose class means are reported.
KPI_COMPONENTS = ("V1", "V3", "V4", "V7")
# Fixed value: components compared by class separation.
SEPARATION_COMPONENTS = ("V1", "V2", "V3", "V4", "V7", "V10", "V11", "V12", "V14", "V17")


def _frauds(label: str) -> Column:
    return F.count_if(F.col(label) == 1)


def overall(df: DataFrame, amount: str = AMOUNT, label: str = LABEL) -> DataFrame:
    """One row: counts, fraud rate and amount statistics."""
    a = F.col(amount)
    return df.agg(
        F.count("*").alias("total_transactions"),
        _frauds(label).alias("fraud_count"),
        F.count_if(F.col(label) == 0).alias("normal_count"),
        rate_pct(_frauds(label), F.count("*")).alias("fraud_rate"),
        F.round(F.avg(a), 2).alias("avg_amount"),
        F.round(F.min(a), 2).alias("min_amount"),
        F.round(F.max(a), 2).alias("max_amount"),
        F.round(F.stddev(a), 2).alias("stddev_amount"),
    )


def class_comparison(
    df: DataFrame, amount: str = AMOUNT, label: str = LABEL, approx: bool = False
) -> DataFrame:
    """Per class: count, average, median and maximum amount.

    The median is exact unless `approx`, which saves the second pass over the table.
    """
    a = F.col(amount)
    measures = [
        F.count("*").alias("count"),
        F.round(F.avg(a), 2).alias("avg_amount"),
        F.round(F.max(a), 2).alias("max_amount"),
    ]
    if approx:
        per_class = df.groupBy(label).agg(
            *measures, F.round(F.percentile_approx(amount, 0.5), 2).alias("median_amount")
        )
    else:
        medians = exact_quantiles(df, amount, {"median": 0.5}, by=[label]).select(
            label, F.round("median", 2).alias("median_amount")
        )
        per_class = df.groupBy(label).agg(*measures).join(medians, label, "left")
    return per_class.select(
        label,
        class_name(F.col(label)).alias("class_name"),
        "count",
        "avg_amount",
        "median_amount",
        "max_amount",
    ).orderBy(label)


def hourly(df: DataFrame, hour: str = "Hour", amount: str = AMOUNT, label: str = LABEL) -> DataFrame:
    """Per hour of day: transactions, frauds, summed and average amount."""
    return (
        df.groupBy(hour)
        .agg(
            F.count("*").alias("total_count"),
            _frauds(label).alias("fraud_count"),
            F.round(F.sum(amount), 2).alias("total_amount"),
            F.round(F.avg(amount), 2).alias("avg_amount"),
        )
        .orderBy(hour)
    )


def amount_buckets(
    df: DataFrame, amount: str = AMOUNT, label: str = LABEL, bands: Bands = AMOUNT_BUCKETS
) -> DataFrame:
    """Per amount range: transactions, frauds and fraud rate, ranges in rising order."""
    return (
        df.groupBy(bucketize(F.col(amount), bands, ordinal=True).alias("_rank"))
        .agg(
            F.count("*").alias("count"),
            _frauds(label).alias("fraud_count"),
            rate_pct(_frauds(label), F.count("*")).alias("fraud_rate"),
        )
        .orderBy("_rank")
        .select(
            F.element_at(F.array(*[F.lit(n) for n in bands.labels]), F.col("_rank")).alias("amount_bucket"),
            "count",
            "fraud_count",
            "fraud_rate",
        )
    )


def feature_class_means(
    df: DataFrame, features: tuple[str, ...] = KPI_COMPONENTS, label: str = LABEL
) -> DataFrame:
    """One row: each feature's mean among frauds and among normal rows."""
    kinds = {"fraud": 1, "normal": 0}
    return df.agg(
        *[
            F.round(F.avg(F.when(F.col(label) == k, F.col(f))), 4).alias(f"{f}_{kind}_avg")
            for f in features
            for kind, k in kinds.items()
        ]
    )


def feature_separation(
    df: DataFrame,
    features: tuple[str, ...] = SEPARATION_COMPONENTS,
    label: str = LABEL,
    k: int | None = None,
) -> DataFrame:
    """Features by distance of their class means, widest first; all of them unless `k` is given."""
    means = df.agg(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.coalesce(F.avg(F.when(F.col(label) == 1, F.col(f))), F.lit(0.0)).alias("f"),
                F.coalesce(F.avg(F.when(F.col(label) == 0, F.col(f))), F.lit(0.0)).alias("n"),
            ).alias(f"_{f}")
            for f in features
        ]
    )
    ranked = (
        means.select(F.inline(F.array(*[F.col(f"_{f}") for f in features])))
        .select(
            "feature",
            F.round("f", 4).alias("fraud_avg"),
            F.round("n", 4).alias("normal_avg"),
            F.round(F.abs(F.col("f") - F.col("n")), 4).alias("separation"),
        )
        .orderBy(F.desc("separation"), "feature")
    )
    return ranked if k is None else ranked.limit(k)


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("count")).orderBy(label)


def class_amounts(df: DataFrame, amount: str = AMOUNT, label: str = LABEL) -> DataFrame:
    return (
        df.groupBy(label)
        .agg(
            F.count("*").alias("count"),
            F.round(F.avg(amount), 2).alias("avg_amount"),
            F.round(F.max(amount), 2).alias("max_amount"),
        )
        .orderBy(label)
    )


def class_shares(df: DataFrame, amount: str = AMOUNT, label: str = LABEL) -> DataFrame:
    """Class sizes, their share of all rows, and average amounts."""
    total = df.agg(F.count("*")).scalar()
    return (
        df.groupBy(label)
        .agg(F.count("*").alias("count"), F.round(F.avg(amount), 2).alias("avg_amount"))
        .withColumn("share_pct", rate_pct(F.col("count"), total))
        .withColumn("class_name", class_name(F.col(label)))
        .orderBy(label)
    )


def class_ratio(df: DataFrame, amount: str = AMOUNT, label: str = LABEL) -> DataFrame:
    """Normal rows per fraud, and how much higher the average fraud amount is."""
    mean = {k: F.avg(F.when(F.col(label) == k, F.col(amount))) for k in (0, 1)}
    return df.agg(
        F.round(ratio(F.count_if(F.col(label) == 0), _frauds(label)), 4).alias("normal_per_fraud"),
        F.round(ratio(mean[1], mean[0]), 4).alias("amount_ratio"),
        F.round((ratio(mean[1], mean[0]) - 1) * 100, 2).alias("amount_excess_pct"),
    )


def hourly_counts(df: DataFrame, time: str = TIME, label: str = LABEL) -> DataFrame:
    return (
        df.groupBy(hour_of_day(F.col(time)).alias("hour"))
        .agg(F.count("*").alias("transactions"), _frauds(label).alias("frauds"))
        .orderBy("hour")
    )


def hourly_frauds(df: DataFrame, time: str = TIME, label: str = LABEL) -> DataFrame:
    return (
        with_label(df, label)
        .groupBy(hour_of_day(F.col(time)).alias("hour"))
        .agg(F.count("*").alias("fraud_count"))
        .orderBy("hour")
    )


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, deviation, minimum and maximum of every numeric column, one row per column."""
    columns = columns or [f.name for f in df.schema.fields if f.dataType.typeName() in NUMERIC]
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev(c).alias("stddev"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    return stats.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))


NUMERIC = {"double", "float", "integer", "long", "short", "byte", "decimal"}


def fraud_amount_clusters(
    df: DataFrame,
    amount: str = AMOUNT,
    label: str = LABEL,
    means: tuple[str, ...] = ("V1", "V14", "V17"),
    bands: Bands = AMOUNT_CLUSTERS,
) -> DataFrame:
    """Frauds by size of amount, with average amount and components."""
    return (
        with_label(df, label)
        .groupBy(bucketize(F.col(amount), bands).alias("cluster"))
        .agg(
            F.count("*").alias("count"),
            F.avg(amount).alias("avg_amount"),
            *[F.avg(c).alias(f"avg_{c}") for c in means],
        )
    )


def risk_communities(
    df: DataFrame, by: str = "V14", amount: str = AMOUNT, label: str = LABEL, bands: Bands = RISK_BANDS
) -> DataFrame:
    """Frauds by range of their strongest component."""
    return (
        with_label(df, label)
        .groupBy(bucketize(F.col(by), bands).alias("community"))
        .agg(
            F.count("*").alias("size"),
            F.round(F.avg(amount), 2).alias("avg_amount"),
            F.round(F.avg(by), 4).alias(f"avg_{by}"),
        )
    )


def min_count_groups(df: DataFrame, keys: list[str], at_least: int = 3) -> DataFrame:
    """Groups with at least so many rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).filter(F.col("count") >= at_least)


def fraud_cells(df: DataFrame, amount: str = AMOUNT, label: str = LABEL) -> DataFrame:
    """Frauds with their cell on the component-amount grid (fixed widths: 0.5 and 50)."""
    return with_label(df, label).withColumns(
        {
            "v14_bucket": (F.col("V14") * 2).cast("int"),
            "amount_bucket": grid_cell(F.col(amount), 50),
        }
    )


def dense_fraud_cells(df: DataFrame, at_least: int = 3) -> DataFrame:
    return min_count_groups(fraud_cells(df), ["v14_bucket", "amount_bucket"], at_least)


def batch_metrics(df: DataFrame, amount: str = AMOUNT, label: str = LABEL) -> list[Column]:
    """Aggregates describing one batch of scored transactions."""
    detected = F.count_if(F.col("prediction") == 1)
    return [
        F.count("*").alias("total_transactions"),
        detected.alias("fraud_detected"),
        _frauds(label).alias("actual_fraud"),
        F.coalesce(F.round(F.avg(amount), 2), F.lit(0.0)).alias("avg_amount"),
        F.coalesce(F.round(F.max("fraud_score"), 4), F.lit(0.0)).alias("max_fraud_score"),
        rate_pct(detected, F.count("*")).alias("fraud_rate"),
    ]


def party_profile(df: DataFrame, party: str = "bank", label: str = LABEL) -> DataFrame:
    """Rows and frauds per party, all parties in one pass."""
    return (
        df.groupBy(party)
        .agg(F.count("*").alias("transactions"), _frauds(label).alias("frauds"))
        .orderBy(party)
    )
