"""Scoring of transactions, the same expressions for streams and batches."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import FRAUD_RULES, Rule, alert_label, rule_score, threshold_prediction
from ..operators.cleaning import valid_features
from ..operators.models import score
from ..schema import AMOUNT, FEATURES, LABEL, TIME


def apply_rules(
    df: DataFrame, rules: tuple[Rule, ...] = FRAUD_RULES, threshold: float = 0.5
) -> DataFrame:
    value = F.col("fraud_score")
    return df.withColumn("fraud_score", rule_score(rules)).withColumns(
        {"prediction": threshold_prediction(value, threshold), "is_alert": alert_label(value, threshold)}
    )


def alerts_only(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("prediction") == 1)


def scored_output(scored: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns written for each scored transaction."""
    columns = [TIME, AMOUNT, LABEL, "fraud_score", "prediction", "is_alert"]
    arrival = [c for c in ["processing_time"] if c in scored.columns]
    return scored.select(*(keep or []), *columns, *arrival)


def apply_model(df: DataFrame, model: PipelineModel, features: list[str] = FEATURES) -> DataFrame:
    """Score with a saved model. Rows with unusable features are left out beforehand."""
    return score(model, valid_features(df, features))
