"""Labelled value ranges: one generic expression and the preset ranges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """`labels[i]` names values below `edges[i]`; the last label takes the rest."""

    edges: tuple[float, ...]
    labels: tuple[str, ...]

    def __post_init__(self):
        if len(self.labels) != len(self.edges) + 1:
            raise ValueError("one more label than edges is needed")
        if list(self.edges) != sorted(set(self.edges)):
            raise ValueError("edges must rise")


# The published bucket edges and labels.
AMOUNT_BUCKETS = Bands((10, 50, 100, 500, 1000), ("0-10", "10-50", "50-100", "100-500", "500-1000", "1000+"))
AMOUNT_CLUSTERS = Bands((10, 100, 500), ("micro", "small", "medium", "large"))
RISK_BANDS = Bands((-10, -5, 0), ("high_risk_1", "high_risk_2", "medium_risk", "low_risk"))

# Dashboard colour steps per metric.
STATUS_BANDS = {
    "fraud_rate": Bands((0.5, 1), ("yellow", "orange", "red")),
    "accuracy": Bands((0.8, 0.9), ("green", "yellow", "red")),
    "precision": Bands((0.7, 0.9), ("red", "yellow", "green")),
    "recall": Bands((0.7, 0.9), ("red", "yellow", "green")),
    "f1_score": Bands((0.7, 0.9), ("red", "yellow", "green")),
    "fraud_score": Bands((0.3, 0.5), ("green", "yellow", "red")),
}


def bucketize(value: Column, bands: Bands, ordinal: bool = False) -> Column:
    """Label (or 1-based position) of the left-closed range holding `value`.

    A null compares to nothing and so gets the last label, as in a CASE chain.
    """
    names = range(1, len(bands.labels) + 1) if ordinal else bands.labels
    *below, rest = [F.lit(name) for name in names]
    chain = F.when(value < F.lit(bands.edges[0]), below[0])
    for edge, name in zip(bands.edges[1:], below[1:]):
        chain = chain.when(value < F.lit(edge), name)
    return chain.otherwise(rest)


def grid_cell(value: Column, width: float) -> Column:
    """Cell number of a value on a grid; cuts toward zero, so the two cells around 0 merge."""
    return (value / F.lit(float(width))).cast("int")


def status_band(metric: Column, value: Column, bands: dict[str, Bands] | None = None) -> Column:
    """Colour of a metric value; null for a metric without steps."""
    bands = STATUS_BANDS if bands is None else bands
    (first, *others) = bands.items()
    chain = F.when(metric == first[0], bucketize(value, first[1]))
    for name, steps in others:
        chain = chain.when(metric == name, bucketize(value, steps))
    return chain
