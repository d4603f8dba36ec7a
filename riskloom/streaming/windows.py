"""Event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_window(
    df: DataFrame,
    event_time: str = "event_time",
    width: str = "1 minute",
    lateness: str = "10 minutes",
    **counts,
) -> DataFrame:
    """Transactions per window of event time, with further aggregates by name.

    On a stream rows later than `lateness` are dropped. In append mode a window is given out once
    the watermark has passed it; `sinks.updates_to_table` gives it as it grows, and so the last
    windows too. On a batch the watermark has no effect.
    """
    return (
        df.withWatermark(event_time, lateness)
        .groupBy(F.window(event_time, width))
        .agg(F.count("*").alias("transactions"), *[c.alias(n) for n, c in counts.items()])
        .select(F.col("window.start").alias("window_start"), "transactions", *counts)
    )


def fraud_per_window(df: DataFrame, event_time: str = "event_time", width: str = "1 minute", lateness: str = "10 minutes") -> DataFrame:
    """Windows with the number of alerts in each."""
    return per_window(df, event_time, width, lateness, alerts=F.count_if(F.col("prediction") == 1))


def partial_windows(
    scored: DataFrame, event_time: str = "event_time", arrival: str = "processing_time", width: str = "1 minute"
) -> DataFrame:
    """What one batch adds to its windows: transactions, alerts, and seconds between event and arrival.

    Such rows add up (see `merged_windows`) in any order, so there is no watermark and no row is late.
    Rows without an event time belong to no window. A table without arrival has no latency.
    """
    sums = {"transactions": F.count("*"), "alerts": F.count_if(F.col("prediction") == 1)}
    if arrival in scored.columns:
        seconds = F.unix_micros(arrival) / 1e6 - F.unix_micros(event_time) / 1e6
        sums |= {"timed": F.count(seconds), "latency_sum": F.sum(seconds), "latency_max": F.max(seconds)}
    counted = scored.groupBy(F.window(event_time, width)).agg(*[c.alias(n) for n, c in sums.items()])
    return counted.select(F.col("window.start").alias("window_start"), *sums)


def merged_windows(parts: DataFrame) -> DataFrame:
    """The windows of all batches from what each batch added."""
    sums = [F.sum(c).alias(c) for c in ("transactions", "alerts")]
    if "latency_sum" in parts.columns:
        mean = F.try_divide(F.sum("latency_sum"), F.sum("timed"))
        sums += [mean.alias("avg_latency"), F.max("latency_max").alias("max_latency")]
    return parts.groupBy("window_start").agg(*sums)


def latency(df: DataFrame, event_time: str = "event_time", arrival: str = "processing_time") -> list:
    """Aggregates of the seconds between event and processing."""
    seconds = F.unix_micros(arrival) / 1e6 - F.unix_micros(event_time) / 1e6
    return [
        F.avg(seconds).alias("avg_latency"),
        F.percentile_approx(seconds, 0.95).alias("p95_latency"),
        F.max(seconds).alias("max_latency"),
    ]
