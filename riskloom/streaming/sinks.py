"""Streaming sinks. Each query keeps its own checkpoint in a folder of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.kpis import batch_metrics
from ..operators.sampling import cached
from ..sources.events import split_events
from .scoring import alerts_only, scored_output
from .windows import merged_windows, partial_windows


def _start(writer: DataStreamWriter, checkpoint: str, until_done: bool, interval: str | None = None) -> StreamingQuery:
    """Process what is there and end, or go on: as fast as possible, or a batch every `interval`."""
    writer = writer.option("checkpointLocation", checkpoint)
    if until_done:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def to_parquet(
    df: DataFrame, path: str, checkpoint: str, until_done: bool = True, interval: str | None = None
) -> StreamingQuery:
    writer = df.writeStream.outputMode("append").format("parquet").option("path", path)
    return _start(writer, checkpoint, until_done, interval)


def alerts_to_csv(scored: DataFrame, path: str, checkpoint: str, until_done: bool = True) -> StreamingQuery:
    writer = alerts_only(scored).writeStream.outputMode("append").format("csv")
    return _start(writer.option("header", True).option("path", path), checkpoint, until_done)


def alerts_to_table(scored: DataFrame, path: str, checkpoint: str, until_done: bool = True) -> StreamingQuery:
    return to_parquet(alerts_only(scored), path, checkpoint, until_done)


def to_console(aggregated: DataFrame, checkpoint: str, path: str, until_done: bool = True) -> StreamingQuery:
    """Print the changed rows of an aggregate per batch, and keep them as `updates_to_table` does.

    Only aggregates are for the console: what is printed passes through the driver.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        print(f"batch {batch_id}")
        batch.sparkSession.read.parquet(f"{path}/batch={batch_id}").show(truncate=False)

    return _start(aggregated.writeStream.outputMode("update").foreachBatch(handle), checkpoint, until_done)


def _metrics_of(batch: DataFrame, batch_id: int) -> DataFrame:
    return batch.agg(*batch_metrics(batch)).select(
        F.lit(batch_id).cast("long").alias("batch_id"), F.current_timestamp().alias("timestamp"), "*"
    )


def write_batch_metrics(path: str) -> Callable[[DataFrame, int], None]:
    """A batch handler storing one record per batch as JSON and as a CSV time series.

    The batch number is part of the path and a repeated batch replaces what it wrote
    before, so a retry leaves no second record.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        record = _metrics_of(batch, batch_id).filter("total_transactions > 0").coalesce(1)
        record = cached(record)
        try:
            record.write.mode("overwrite").json(f"{path}/json/batch={batch_id}")
            record.select(
                "timestamp", "batch_id", "total_transactions", "fraud_detected", "fraud_rate", "avg_amount"
            ).write.mode("overwrite").option("header", True).csv(f"{path}/series/batch={batch_id}")
        finally:
            record.unpersist()

    return handle


METRICS_SCHEMA = (
    "batch_id long, timestamp timestamp, total_transactions long, fraud_detected long, "
    "actual_fraud long, avg_amount double, max_fraud_score double, fraud_rate double"
)


def read_batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(f"{path}/json/batch=*")


def metrics_per_batch(scored: DataFrame, path: str, checkpoint: str, until_done: bool = True) -> StreamingQuery:
    return _start(scored.writeStream.foreachBatch(write_batch_metrics(path)), checkpoint, until_done)


def fan_out(
    scored: DataFrame, path: str, checkpoint: str, until_done: bool = True, interval: str | None = None
) -> StreamingQuery:
    """Metrics, predictions and alerts of each batch from a single read of the source.

    One query serves all outputs, so they always describe the same rows. Rows with an `event_time`
    also give the batch's share of the minutes, for `read_windows`.
    """
    metrics = write_batch_metrics(f"{path}/metrics")

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = cached(batch)
        try:
            metrics(rows, batch_id)
            output = scored_output(rows)
            output.write.mode("overwrite").parquet(f"{path}/predictions/batch={batch_id}")
            alerts_only(output).write.mode("overwrite").option("header", True).csv(f"{path}/alerts/batch={batch_id}")
            if "event_time" in rows.columns:
                _write_windows(rows, path, batch_id)
        finally:
            rows.unpersist()

    return _start(scored.writeStream.foreachBatch(handle), checkpoint, until_done, interval)


def _write_windows(batch: DataFrame, path: str, batch_id: int) -> None:
    partial_windows(batch).write.mode("overwrite").parquet(f"{path}/windows/batch={batch_id}")


def windows_to_table(scored: DataFrame, path: str, checkpoint: str, until_done: bool = True) -> StreamingQuery:
    """What each batch adds to its minutes; a repeated batch replaces what it wrote before."""
    return _start(scored.writeStream.foreachBatch(lambda batch, n: _write_windows(batch, path, n)), checkpoint, until_done)


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """All minutes as they stand: transactions, alerts and latency, whenever their rows came in."""
    return merged_windows(spark.read.parquet(f"{path}/windows/batch=*"))


def accepted_and_rejects(
    events: DataFrame, path: str, checkpoint: str, until_done: bool = True, interval: str | None = None
) -> StreamingQuery:
    """Usable events and rejects of `read_events` as two Parquet tables, from a single read of the source."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = cached(batch)
        try:
            for name, part in zip(("accepted", "rejects"), split_events(rows)):
                part.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        finally:
            rows.unpersist()

    return _start(events.writeStream.foreachBatch(handle), checkpoint, until_done, interval)


def updates_to_table(aggregated: DataFrame, path: str, checkpoint: str, until_done: bool = True) -> StreamingQuery:
    """Every changed row of an aggregate with its batch; `latest` gives the table as it stands.

    Rows come out as they change, not only once the watermark has passed them, so at the end of
    the input nothing is held back. A repeated batch replaces what it wrote before.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _start(aggregated.writeStream.outputMode("update").foreachBatch(handle), checkpoint, until_done)


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last state of each row that `updates_to_table` wrote."""
    table = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    values = [c for c in table.columns if c not in (*keys, "batch")]
    newest = table.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values])


def run_to_end(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for a query to finish its input; after `timeout` seconds stop it. True if it finished."""
    finished = query.awaitTermination(timeout) if timeout else (query.awaitTermination() or True)
    if not finished:
        query.stop()
    return bool(finished)


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()
