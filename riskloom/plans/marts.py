"""Dashboard tables, all computed from transactions and models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hour_of_day, rate_pct
from ..operators.evaluation import confusion_matrix
from ..operators.kpis import amount_buckets, overall
from ..operators.sampling import first_rows, top_k
from ..schema import AMOUNT, LABEL, TIME
from ..sources.transactions import EPOCH
from ..streaming.scoring import alerts_only


def overview(df: DataFrame, evaluation: DataFrame) -> DataFrame:
    """One row: totals of the table beside the quality of a model on its test rows."""
    columns = {
        "model_accuracy": "accuracy", "auc_roc": "auc_roc", "precision": "precision",
        "recall": "recall", "f1_score": "f1_score", "fraud_recall": "fraud_recall",
    }
    return overall(df).select(
        "total_transactions", "fraud_count", "normal_count",
        F.col("fraud_rate").alias("fraud_rate_percent"), "avg_amount",
        *[evaluation.select(c).scalar().alias(name) for name, c in columns.items()],
    )


def hourly(df: DataFrame, time: str = TIME, amount: str = AMOUNT, label: str = LABEL) -> DataFrame:
    """Hour-of-day series; `timestamp` is when that hour last began within the data."""
    frauds = F.count_if(F.col(label) == 1)
    last_start = F.max(F.floor(F.col(time) / 3600) * 3600)
    origin = F.unix_seconds(F.lit(EPOCH).cast("timestamp"))
    return (
        df.groupBy(hour_of_day(F.col(time)).alias("hour"))
        .agg(
            F.date_format(F.timestamp_seconds(origin + last_start), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
            F.count("*").alias("total_transactions"),
            frauds.alias("fraud_detected"),
            rate_pct(frauds, F.count("*")).alias("fraud_rate"),
            F.round(F.avg(amount), 2).alias("avg_amount"),
        )
        .select("timestamp", "hour", "total_transactions", "fraud_detected", "fraud_rate", "avg_amount")
        .orderBy("hour")
    )


def amount_distribution(df: DataFrame) -> DataFrame:
    return amount_buckets(df).withColumnRenamed("amount_bucket", "bucket")


def feature_importance(importance: DataFrame, k: int = 10) -> DataFrame:
    return top_k(importance, "importance", k, "feature").select(
        "feature", F.round("importance", 4).alias("importance")
    )


def confusion_table(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Actual by predicted, two rows."""
    rows = [
        F.struct(
            F.lit(actual).alias("Actual"),
            F.col(normal).alias("Predicted Normal"),
            F.col(fraud).alias("Predicted Fraud"),
        )
        for actual, normal, fraud in (("Normal", "tn", "fp"), ("Fraud", "fn", "tp"))
    ]
    return confusion_matrix(df, label, prediction).select(F.inline(F.array(*rows)))


def recent_alerts(scored: DataFrame, key: str = "event_id", time: str = TIME, amount: str = AMOUNT, n: int = 20) -> DataFrame:
    """The latest alerts, newest first."""
    micros = F.unix_micros(F.lit(EPOCH).cast("timestamp")) + F.round(F.col(time) * 1_000_000).cast("long")
    return first_rows(alerts_only(scored), [F.desc(time), key], n).select(
        F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.concat(F.lit("TXN"), F.col(key).cast("string")).alias("transaction_id"),
        F.round(amount, 2).alias("amount"),
        F.round("fraud_score", 4).alias("fraud_score"),
        "is_alert",
    )
