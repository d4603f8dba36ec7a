"""Whole jobs: read transactions, compute, write tables and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, evaluation, federated, kpis, models, proximity, sampling
from ..schema import AMOUNT, FEATURES, KEYED_TRANSACTION_SCHEMA, LABEL, TIME, feed_schema
from ..session import cut_lineage
from ..sources.events import read_events
from ..sources.tables import csv_columns, register_view, write_csv, write_json, write_parquet
from ..sources.transactions import EPOCH
from ..streaming import scoring, sinks, sources
from ..streaming.windows import merged_windows, partial_windows
from . import marts


def _records(df: DataFrame, order: list[str]) -> DataFrame:
    """A short report as one array column. For reports of known length only."""
    entry = F.struct(*[F.col(c) for c in [*order, *[c for c in df.columns if c not in order]]])
    return df.agg(F.array_sort(F.collect_list(entry)).alias("records"))


def kpi_job(df: DataFrame, out: str, rel_err: float = 0.0) -> str:
    """Clean the feed, store it, and report the indicators computed on the stored table."""
    spark = df.sparkSession
    path = write_parquet(cleaning.clean_transactions(df, rel_err=rel_err), f"{out}/transactions_clean")
    clean = register_view(spark.read.parquet(path))
    hours, buckets = kpis.hourly(clean), kpis.amount_buckets(clean)
    write_csv(hours, f"{out}/hourly_stats")
    write_csv(buckets, f"{out}/amount_buckets")
    total = kpis.overall(clean)
    document = total.select(
        F.struct("*").alias("overall"),
        _records(kpis.class_comparison(clean), [LABEL]).scalar().alias("class_comparison"),
        _records(hours, ["Hour"]).scalar().alias("hourly_distribution"),
        _records(buckets, ["amount_bucket"]).scalar().alias("amount_buckets"),
        kpis.feature_class_means(clean).select(F.struct("*")).scalar().alias("feature_analysis"),
    )
    return write_json(document, f"{out}/sql_metrics")


def ml_job(df: DataFrame, out: str, keys: list[str], ratio: float = 2.0, run_id: str = "run") -> DataFrame:
    """Split, balance the training side, train and compare the classifiers on all held-out rows."""
    spark = df.sparkSession
    training, test = sampling.train_test_split(cleaning.drop_nulls(df, [*FEATURES, LABEL]), keys)
    training, test = cut_lineage(sampling.undersample(training, keys, ratio)), cut_lineage(test)
    classifiers = {
        "RandomForest": (models.random_forest(), models.tree_importance),
        "LogisticRegression": (models.logistic_regression(), models.linear_importance),
        "GradientBoosted": (models.gradient_boosted(), models.tree_importance),
    }
    results = []
    for name, (classifier, importance) in classifiers.items():
        model = models.train(training, classifier)
        models.save_model(model, f"{out}/models/{name}")
        scored = models.score(model, test)
        quality = cut_lineage(evaluation.evaluate(scored, name))
        ranked = importance(spark, model)
        write_json(
            quality.withColumn("timestamp", F.current_timestamp()).withColumn(
                "feature_importance", _records(ranked, ["feature"]).scalar()
            ),
            f"{out}/metrics/{name}",
        )
        report = models.export_predictions(scored, keys)
        write_csv(report, f"{out}/predictions/{name}_csv")
        write_parquet(report, f"{out}/predictions/{name}")
        metrics = evaluation.long_metrics(quality)
        models.log_run(metrics, f"{out}/runs", f"{run_id}-{name}", {p.name: v for p, v in classifier.extractParamMap().items()})
        results.append(metrics)
    return evaluation.compare_models(reduce(DataFrame.unionByName, results), list(classifiers))


def score_job(df: DataFrame, model_path: str, out: str) -> str:
    """Score a batch with a saved model."""
    return write_parquet(scoring.apply_model(df, models.load_model(model_path)), f"{out}/scored")


def evaluate_job(predictions: dict[str, DataFrame], out: str) -> str:
    """Quality of scored tables, by name of their model: measures, curves, the models side by side.

    The document has the best model, all measures and the class sizes of the first table.
    """
    results = []
    for name, scored in predictions.items():
        results.append(cut_lineage(evaluation.evaluate(scored, name)))
        write_csv(evaluation.roc_pr_curve(scored, "fraud_probability"), f"{out}/curves/{name}")
    quality = reduce(DataFrame.unionByName, results)
    metrics = evaluation.long_metrics(quality)
    if len(predictions) > 1:
        write_csv(evaluation.compare_models(metrics, list(predictions)), f"{out}/model_comparison")
    shares = kpis.class_shares(next(iter(predictions.values())))
    document = evaluation.best_model(metrics).select(
        F.struct("*").alias("best"),
        _records(quality, ["model"]).scalar().alias("models"),
        _records(shares, [LABEL]).scalar().alias("class_distribution"),
    )
    return write_json(document, f"{out}/evaluation")


def model_stream_job(
    spark: SparkSession, source: str, model_path: str, out: str, checkpoint: str, interval: str | None = None, timeout: float | None = None
) -> bool:
    """Score the batches of a watched folder with a saved model.

    Without `interval` all present input is processed; with it (as "10 seconds") the stream goes on
    until `timeout` seconds have passed, or for ever.
    """
    stream = sources.csv_stream(spark, source, feed_schema(csv_columns(spark, source)))
    scored = scoring.apply_model(stream, models.load_model(model_path))
    return sinks.run_to_end(sinks.to_parquet(scored, f"{out}/scored", checkpoint, interval is None, interval), timeout)


def _timed(df: DataFrame) -> DataFrame:
    """Transactions with the time of their event; the feed counts seconds from `EPOCH`."""
    origin = F.unix_micros(F.lit(EPOCH).cast("timestamp"))
    return df.withColumn("event_time", F.timestamp_micros(origin + F.round(F.col(TIME) * 1_000_000).cast("long")))


def fit_forest(df: DataFrame, keys: list[str], ratio: float = 2.0) -> tuple[PipelineModel, DataFrame]:
    """A random forest fitted on the balanced training side, and all held-out rows."""
    training, test = sampling.train_test_split(df, keys)
    return models.train(cut_lineage(sampling.undersample(training, keys, ratio)), models.random_forest()), test


def graph_job(df: DataFrame, out: str, key: str) -> str:
    """Fraud groups and the graph of frauds near in time, as one document."""
    frauds = cut_lineage(cleaning.with_label(df))
    document = proximity.time_graph_summary(frauds, key, TIME).select(
        F.struct("*").alias("network"),
        _records(kpis.risk_communities(frauds), ["community"]).scalar().alias("communities"),
        _records(kpis.fraud_amount_clusters(frauds), ["cluster"]).scalar().alias("clusters"),
        _records(kpis.hourly_frauds(frauds), ["hour"]).scalar().alias("hourly_distribution"),
        _records(kpis.feature_separation(df, k=5), ["feature"]).scalar().alias("feature_separation"),
        kpis.dense_fraud_cells(frauds).agg(F.count("*")).scalar().alias("dense_cells"),
    )
    return write_json(document, f"{out}/graph_metrics")


def federated_job(
    df: DataFrame, out: str, key: str, epsilon: float | None = None, noise_seed: str | None = None
) -> DataFrame:
    """Train over the parties and write the history of rounds."""
    parties = federated.assign_party(df, key)
    scaled = cut_lineage(federated.scale_by_party(parties, keys=[key]))
    history = cut_lineage(federated.round_history(federated.train_federated(scaled, epsilon=epsilon, noise_seed=noise_seed), scaled))
    write_json(history, f"{out}/federated_history")
    return history


def streaming_job(
    spark: SparkSession, source: str, out: str, checkpoint: str, timeout: float | None = None, interval: str | None = None
) -> bool:
    """Score the batches of a watched folder; True when all present input was processed.

    With `interval` (as "10 seconds") it keeps watching, until `timeout` seconds have passed or for ever.
    """
    schema = feed_schema(csv_columns(spark, source))
    scored = _timed(scoring.apply_rules(sources.csv_stream(spark, source, schema)))
    return sinks.run_to_end(sinks.fan_out(scored, out, checkpoint, interval is None, interval), timeout)


def events_job(
    spark: SparkSession, source: str, out: str, checkpoint: str, timeout: float | None = None, interval: str | None = None
) -> bool:
    """Transactions from a watched folder of JSON bodies, one a line, as the tables accepted and rejects.

    Key, time and amount must be there; other fields may be missing. Empty lines are no bodies.
    Without `interval` all present input is processed.
    """
    lines = spark.readStream.text(source).filter(F.trim("value") != "")
    events = read_events(lines, KEYED_TRANSACTION_SCHEMA, "value", ["event_id", TIME, AMOUNT])
    return sinks.run_to_end(sinks.accepted_and_rejects(events, out, checkpoint, interval is None, interval), timeout)


def dashboard_job(df: DataFrame, quality: DataFrame, importance: DataFrame, predictions: DataFrame, out: str) -> str:
    """All dashboard tables as CSV, the overview as JSON too."""
    scored = scoring.apply_rules(df)
    totals = marts.overview(df, quality)
    write_json(totals, f"{out}/overview_metrics")
    write_csv(marts.hourly(df), f"{out}/hourly_transactions")
    write_csv(marts.amount_distribution(df), f"{out}/amount_distribution")
    write_csv(marts.feature_importance(importance), f"{out}/feature_importance")
    write_csv(marts.confusion_table(predictions), f"{out}/confusion_matrix")
    write_csv(marts.recent_alerts(scored), f"{out}/recent_alerts")
    write_csv(merged_windows(partial_windows(_timed(scored))).orderBy("window_start"), f"{out}/fraud_over_time")
    return out
