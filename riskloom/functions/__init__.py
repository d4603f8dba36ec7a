"""Column expressions shared by batch and streaming plans."""

from .buckets import (
    AMOUNT_BUCKETS,
    AMOUNT_CLUSTERS,
    RISK_BANDS,
    STATUS_BANDS,
    Bands,
    bucketize,
    grid_cell,
    status_band,
)
from .scalars import (
    class_name,
    hour_of_day,
    high_amount,
    key_hash,
    positive_log1p,
    positive_rounded,
    ratio,
    rate_pct,
    uniform_hash,
    vector_element,
)
from .scoring import FRAUD_RULES, Rule, alert_label, rule_score, threshold_prediction

__all__ = [
    "AMOUNT_BUCKETS", "AMOUNT_CLUSTERS", "RISK_BANDS", "STATUS_BANDS", "Bands", "bucketize",
    "grid_cell", "status_band", "class_name", "hour_of_day", "high_amount", "key_hash",
    "positive_log1p", "positive_rounded", "ratio", "rate_pct", "uniform_hash", "vector_element",
    "FRAUD_RULES", "Rule", "alert_label", "rule_score", "threshold_prediction",
]
