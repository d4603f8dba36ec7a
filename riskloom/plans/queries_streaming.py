"""Queries that run as streams over the given tables to the end and read the sinks back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.models import load_model, save_model
from ..session import work_dir
from ..sources.events import read_events
from ..sources.tables import parse_json_events, read_csv, read_table, write_csv
from ..sources.transactions import transaction_stream, transactions
from ..streaming import scoring, sinks, sources, windows
from . import oracle as o
from .catalog import query
from .queries_learning import same_scores, trained

BATCHES = 4
FILES_PER_BATCH = 16
SLIM = ["V1", "V3", "V4", "V7", "V10"]
REPLAY_SCHEMA = (
    "event_id long, user_id long, Time double, V1 double, V3 double, V4 double, V7 double, V10 double, "
    "Amount double, Class int"
)
OUTPUT = "event_id, Time, Amount, Class, fraud_score, prediction, is_alert"


def _per_batch(table) -> int:
    return -(-table.count() // BATCHES)


def csv_feed(spark, sf):
    """The transactions as a stream of CSV files, one for each partition of the table."""
    path = write_csv(transactions(spark, sf, SLIM), work_dir(spark, "feed"))
    return sources.csv_stream(spark, path, REPLAY_SCHEMA, FILES_PER_BATCH)


def scored_stream(spark, sf):
    return scoring.apply_rules(transaction_stream(spark, sf, SLIM))


def _stored(spark, stream):
    """Run a stream into Parquet to its end and read the table."""
    path = work_dir(spark, "stream")
    sinks.run_to_end(sinks.to_parquet(stream, f"{path}/out", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/out")


@query("csv_stream_scan", f"WITH {o.tx(SLIM)} SELECT event_id, user_id, Time, {', '.join(SLIM)}, Amount, Class FROM tx")
def _(spark, sf):
    return _stored(spark, csv_feed(spark, sf)).drop("processing_time")


@query(
    "stream_replay",
    f"WITH {o.tx([])}, n AS (SELECT event_id, row_number() OVER (ORDER BY {o.keyhash('event_id', '42:shuffle')}, event_id) AS p FROM tx) "
    f"SELECT event_id, CAST((p - 1) // CAST(ceil((SELECT count(*) FROM tx) / {BATCHES}.0) AS BIGINT) AS BIGINT) AS batch_id FROM n",
)
def _(spark, sf):
    table = transactions(spark, sf, [])
    return sources.replay_batches(table, ["event_id"], _per_batch(table)).select("event_id", "batch_id")


@query("stream_rule_scoring", f"WITH {o.SCORED} SELECT {OUTPUT} FROM scored")
def _(spark, sf):
    stream = scoring.scored_output(scored_stream(spark, sf), ["event_id"])
    return _stored(spark, stream).drop("processing_time")


@query("stream_parquet_sink", f"WITH {o.SCORED} SELECT prediction, count(*) AS count FROM scored GROUP BY 1")
def _(spark, sf):
    return _stored(spark, scored_stream(spark, sf)).groupBy("prediction").agg(F.count("*").alias("count"))


@query("stream_csv_alert_sink", f"WITH {o.SCORED} SELECT {OUTPUT} FROM scored WHERE prediction = 1")
def _(spark, sf):
    path = work_dir(spark, "alerts")
    output = scoring.scored_output(scored_stream(spark, sf), ["event_id"]).drop("processing_time")
    sinks.run_to_end(sinks.alerts_to_csv(output, f"{path}/out", f"{path}/checkpoint"))
    return read_csv(spark, f"{path}/out", output.schema)


@query("alert_table_sink", f"WITH {o.SCORED} SELECT event_id, fraud_score, is_alert FROM scored WHERE prediction = 1")
def _(spark, sf):
    path = work_dir(spark, "alert-table")
    sinks.run_to_end(sinks.alerts_to_table(scored_stream(spark, sf), f"{path}/out", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/out").select("event_id", "fraud_score", "is_alert")


@query("stream_console_sink", f"WITH {o.tx([])} SELECT count(*) AS rows FROM tx")
def _(spark, sf):
    path = work_dir(spark, "console")
    stream = scored_stream(spark, sf).groupBy("is_alert").agg(F.count("*").alias("rows"))
    sinks.run_to_end(sinks.to_console(stream, f"{path}/checkpoint", f"{path}/shown"))
    return sinks.latest(spark, f"{path}/shown", ["is_alert"]).agg(F.sum("rows").alias("rows"))


@query(
    "foreach_batch_metrics_sink",
    f"WITH {o.SCORED} SELECT count(*) AS total_transactions, count(*) FILTER (WHERE prediction = 1) AS fraud_detected, {o.FRAUDS} AS actual_fraud, "
    f"{o.rnd('avg(Amount)', 2)} AS avg_amount, {o.rnd('max(fraud_score)', 4)} AS max_fraud_score, "
    f"{o.pct('count(*) FILTER (WHERE prediction = 1)', 'count(*)', 2)} AS fraud_rate FROM scored",
)
def _(spark, sf):
    path = work_dir(spark, "batch-metrics")
    sinks.run_to_end(sinks.metrics_per_batch(scored_stream(spark, sf), f"{path}/out", f"{path}/checkpoint"))
    batches = sinks.read_batch_metrics(spark, f"{path}/out")
    total = F.sum("total_transactions")
    return batches.agg(
        *[F.sum(c).alias(c) for c in ("total_transactions", "fraud_detected", "actual_fraud")],
        F.round(F.sum(F.col("avg_amount") * F.col("total_transactions")) / total, 2).alias("avg_amount"),
        F.max("max_fraud_score").alias("max_fraud_score"),
        F.round(F.sum("fraud_detected") * 100 / total, 2).alias("fraud_rate"),
    )


@query(
    "stream_fan_out",
    f"WITH {o.SCORED} SELECT 'predictions' AS output, count(*) AS rows FROM scored UNION ALL "
    "SELECT 'alerts', count(*) FROM scored WHERE prediction = 1 UNION ALL SELECT 'metrics', count(*) FROM scored",
)
def _(spark, sf):
    path = work_dir(spark, "fan-out")
    stream = scored_stream(spark, sf)
    sinks.run_to_end(sinks.fan_out(stream, f"{path}/out", f"{path}/checkpoint"))
    output = scoring.scored_output(stream)
    counts = {
        "predictions": spark.read.parquet(f"{path}/out/predictions/batch=*").agg(F.count("*").alias("rows")),
        "alerts": spark.read.schema(output.schema).option("header", True).csv(f"{path}/out/alerts/batch=*").agg(F.count("*").alias("rows")),
        "metrics": sinks.read_batch_metrics(spark, f"{path}/out/metrics").agg(F.sum("total_transactions").alias("rows")),
    }
    first, *others = [t.select(F.lit(name).alias("output"), "rows") for name, t in counts.items()]
    for t in others:
        first = first.unionByName(t)
    return first


@query("stream_lifecycle", f"WITH {o.tx([])} SELECT true AS finished, count(*) AS rows FROM tx")
def _(spark, sf):
    path = work_dir(spark, "lifecycle")
    started = sinks.to_parquet(scored_stream(spark, sf), f"{path}/out", f"{path}/checkpoint")
    finished = sinks.run_to_end(started)
    return spark.read.parquet(f"{path}/out").agg(F.lit(finished).alias("finished"), F.count("*").alias("rows"))


@query("stream_model_scoring", "SELECT event_id, true AS same FROM events")
def _(spark, sf):
    model = load_model(save_model(trained(spark, sf, "LogisticRegression"), work_dir(spark, "model")))
    scored = scoring.apply_model(transaction_stream(spark, sf), model)
    return same_scores(_stored(spark, scored), scoring.apply_model(transactions(spark, sf), model))


# --- event time, over the event table itself ---

LATENESS = "10 minutes"


def event_stream(spark, sf):
    """The event table as a stream; errors count as alerts."""
    schema = read_table(spark, sf, "events").schema
    return sources.table_stream(spark, sf, "events", schema).select(
        F.col("ts").cast("timestamp").alias("event_time"),
        (F.col("event_type") == "error").cast("int").alias("prediction"),
        "event_id",
        "props",
    )


def _minutes(extra):
    return (
        f"SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS transactions{extra} "
        "FROM events GROUP BY 1"
    )


def _windows(spark, stream):
    """Run a stream of windows to its end and give the last state of each."""
    path = work_dir(spark, "windows")
    sinks.run_to_end(sinks.updates_to_table(stream, f"{path}/out", f"{path}/checkpoint"))
    return _named(sinks.latest(spark, f"{path}/out", ["window_start"]))


def _named(df):
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query("tx_per_minute", _minutes(""))
def _(spark, sf):
    return _windows(spark, windows.per_window(event_stream(spark, sf), lateness=LATENESS))


@query("fraud_over_time", _minutes(", count(*) FILTER (WHERE event_type = 'error') AS alerts"))
def _(spark, sf):
    return _windows(spark, windows.fraud_per_window(event_stream(spark, sf), lateness=LATENESS))


# each event arrives a few seconds after it happened, by its id
ARRIVAL_SECONDS = "event_id % 97"


def arrived_events(spark, sf):
    arrival = F.timestamp_micros(F.unix_micros("event_time") + F.expr(ARRIVAL_SECONDS) * 1_000_000)
    return event_stream(spark, sf).withColumn("processing_time", arrival)


@query(
    "minutes_with_latency",
    "SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS transactions, "
    f"count(*) FILTER (WHERE event_type = 'error') AS alerts, {o.rnd(f'avg(CAST({ARRIVAL_SECONDS} AS DOUBLE))', 6)} AS avg_latency, "
    f"CAST(max({ARRIVAL_SECONDS}) AS DOUBLE) AS max_latency FROM events GROUP BY 1",
)
def _(spark, sf):
    path = work_dir(spark, "minutes")
    sinks.run_to_end(sinks.windows_to_table(arrived_events(spark, sf), f"{path}/out", f"{path}/checkpoint"))
    return _named(sinks.read_windows(spark, f"{path}/out")).withColumn("avg_latency", F.round("avg_latency", 6))


@query(
    "latency_metric",
    f"WITH l AS (SELECT CAST({ARRIVAL_SECONDS} AS DOUBLE) AS s FROM events) SELECT count(*) AS transactions, "
    f"{o.rnd('avg(s)', 6)} AS avg_latency, quantile_disc(s, 0.95) AS p95_latency, max(s) AS max_latency FROM l",
)
def _(spark, sf):
    stored = _stored(spark, arrived_events(spark, sf))
    return stored.agg(F.count("*").alias("transactions"), *windows.latency(stored)).withColumn(
        "avg_latency", F.round("avg_latency", 6)
    )


@query("json_event_stream", "SELECT CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events")
def _(spark, sf):
    from .queries_tables import EVENT_BODY

    parsed = parse_json_events(event_stream(spark, sf), EVENT_BODY, "props")
    return _stored(spark, parsed).filter(F.col("_malformed").isNull()).select("k")


@query(
    "json_events_split",
    "SELECT CASE WHEN event_type = 'error' THEN 'rejects' ELSE 'accepted' END AS output, "
    "CASE WHEN event_type = 'error' THEN 'no JSON object' END AS reason, count(*) AS rows, "
    "CAST(sum(CASE WHEN event_type <> 'error' THEN CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END) AS BIGINT) AS total FROM events GROUP BY 1, 2",
)
def _(spark, sf):
    from .queries_tables import EVENT_BODY

    # bodies of errors arrive without their last character
    cut = F.when(F.col("prediction") == 1, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    events = read_events(event_stream(spark, sf).select(cut.alias("body")), EVENT_BODY, required=["k"])
    path = work_dir(spark, "json-events")
    sinks.run_to_end(sinks.accepted_and_rejects(events, f"{path}/out", f"{path}/checkpoint"))
    accepted, rejects = (spark.read.parquet(f"{path}/out/{name}/batch=*") for name in ("accepted", "rejects"))
    usable = accepted.agg(F.count("*").alias("rows"), F.sum("k").alias("total"))
    unusable = rejects.groupBy(F.col("_reason").alias("reason")).agg(F.count("*").alias("rows"))
    return usable.select(F.lit("accepted").alias("output"), F.lit(None).cast("string").alias("reason"), "rows", "total").unionByName(
        unusable.select(F.lit("rejects").alias("output"), "reason", "rows", F.lit(None).cast("long").alias("total"))
    )
