"""Additive rule scores for transactions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add, gt, lt

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPARE = {"<": lt, ">": gt}


@dataclass(frozen=True)
class Rule:
    column: str
    op: str
    threshold: float
    weight: float


# Rules in the order their weights are added (a sum of doubles depends on it).
FRAUD_RULES = (
    Rule("V1", "<", -3, 0.7),
    Rule("V3", "<", -4, 0.15),
    Rule("V4", ">", 3, 0.1),
    Rule("Amount", ">", 1000, 0.15),
    Rule("V7", "<", -5, 0.1),
    Rule("V10", "<", -5, 0.1),
)


def rule_score(rules: tuple[Rule, ...] = FRAUD_RULES) -> Column:
    """Sum of the weights of all rules that hold; a null input adds nothing."""
    return reduce(
        add,
        [
            F.when(COMPARE[r.op](F.col(r.column), F.lit(r.threshold)), F.lit(r.weight)).otherwise(0.0)
            for r in rules
        ],
    )


def threshold_prediction(score: Column, threshold: float = 0.5) -> Column:
    return F.when(score > threshold, 1).otherwise(0)


def alert_label(score: Column, threshold: float = 0.5) -> Column:
    return F.when(score > threshold, F.lit("FRAUD_ALERT")).otherwise(F.lit("NORMAL"))
