import datetime as dt

import pytest

from riskloom.__main__ import main
from riskloom.operators import evaluation, kpis, models, sampling
from riskloom.plans import jobs
from riskloom.schema import KEYED_TRANSACTION_SCHEMA
from riskloom.sources import tables
from riskloom.sources.transactions import raw_transactions, transactions
from riskloom.streaming import scoring, sinks, sources, windows

KEYS = ["event_id"]


@pytest.fixture
def feed(spark, sf, tmp_path):
    return sources.write_replay(transactions(spark, sf), str(tmp_path / "feed"), KEYS, 250)


def test_replay_cuts_equal_batches(spark, sf):
    batches = sources.replay_batches(transactions(spark, sf, []), KEYS, 300)
    assert [r["count"] for r in batches.groupBy("batch_id").count().orderBy("batch_id").collect()] == [300, 300, 300, 100]


def test_stream_equals_batch(spark, sf, feed, tmp_path):
    assert jobs.streaming_job(spark, feed, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    batch = scoring.apply_rules(transactions(spark, sf))
    columns = ["Time", "Amount", "Class", "fraud_score", "prediction", "is_alert"]
    stored = spark.read.parquet(str(tmp_path / "out/predictions/batch=*")).select(columns)
    assert sorted(stored.collect()) == sorted(batch.select(columns).collect())
    metrics = sinks.read_batch_metrics(spark, str(tmp_path / "out/metrics")).collect()
    assert [r.total_transactions for r in sorted(metrics)] == [250] * 4
    assert sum(r.fraud_detected for r in metrics) == batch.filter("prediction = 1").count()
    assert sum(r.actual_fraud for r in metrics) == batch.filter("Class = 1").count()


def test_second_run_adds_nothing(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for _ in range(2):
        assert jobs.streaming_job(spark, feed, out, checkpoint)
    assert spark.read.parquet(f"{out}/predictions/batch=*").count() == 1000


def test_repeated_batch_replaces_its_record(spark, sf, tmp_path):
    handle = sinks.write_batch_metrics(str(tmp_path / "m"))
    rows = scoring.apply_rules(transactions(spark, sf))
    handle(rows, 3)
    handle(rows, 3)
    assert sinks.read_batch_metrics(spark, str(tmp_path / "m")).count() == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "m/series/batch=*")).count() == 1


def test_empty_batch_leaves_no_record(spark, sf, tmp_path):
    handle = sinks.write_batch_metrics(str(tmp_path / "m"))
    handle(scoring.apply_rules(transactions(spark, sf)).filter("1 = 0"), 0)
    assert sinks.read_batch_metrics(spark, str(tmp_path / "m")).count() == 0


def test_windows_drop_late_rows_and_keep_open_ones(spark, tmp_path):
    def at(minute, second=0):
        return dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=minute, seconds=second)

    def write(name, minutes):
        rows = [(at(m, s), p) for m, s, p in minutes]
        spark.createDataFrame(rows, "event_time timestamp, prediction int").coalesce(1).write.json(f"{tmp_path}/{name}")

    def run():
        stream = spark.readStream.schema("event_time timestamp, prediction int").json(f"{tmp_path}/in*")
        counted = windows.fraud_per_window(stream, lateness="10 minutes")
        sinks.run_to_end(sinks.to_parquet(counted, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))

    write("in1", [(0, 1, 0), (0, 59, 1), (1, 0, 0), (30, 0, 0)])
    run()
    write("in2", [(1, 30, 1), (50, 0, 0)])  # minute 1 is long closed: its second row comes too late
    run()
    got = {r.window_start: (r.transactions, r.alerts) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {at(0): (2, 1), at(1): (1, 0), at(30): (1, 0)}


def test_unusable_rows_do_not_stop_model_scoring(spark, sf):
    table = transactions(spark, sf)
    train, _ = sampling.train_test_split(sampling.undersample(table, KEYS, 2.0), KEYS)
    model = models.train(train, models.logistic_regression())
    broken = raw_transactions(spark, sf)
    usable = broken.filter("V1 is not null and Amount is not null").count()
    assert scoring.apply_model(broken, model).count() == usable < broken.count()


def test_timeout_stops_a_query(spark, feed, tmp_path):
    scored = scoring.apply_rules(sources.csv_stream(spark, feed))
    query = sinks.to_parquet(scored, str(tmp_path / "o"), str(tmp_path / "c"), until_done=False)
    assert sinks.run_to_end(query, timeout=1) is False
    assert not query.isActive
    sinks.stop_all(spark)


def test_kpi_job_writes_its_reports(spark, sf, tmp_path):
    path = jobs.kpi_job(raw_transactions(spark, sf), str(tmp_path))
    document = spark.read.json(path).first()
    clean = spark.read.parquet(str(tmp_path / "transactions_clean"))
    assert document.overall.total_transactions == clean.count()
    assert len(document.hourly_distribution) == 24 and len(document.class_comparison) == 2
    hours = spark.read.option("header", True).csv(str(tmp_path / "hourly_stats"))
    assert hours.count() == 24


def test_ml_graph_and_dashboard_jobs(spark, sf, tmp_path):
    table = transactions(spark, sf)
    compared = jobs.ml_job(table, str(tmp_path / "ml"), KEYS).collect()
    assert {r.metric for r in compared} == set(evaluation.MEASURES)
    assert spark.read.json(str(tmp_path / "ml/metrics/RandomForest")).first().model == "RandomForest"
    assert spark.read.parquet(str(tmp_path / "ml/runs")).select("run_id").distinct().count() == 3
    network = spark.read.json(jobs.graph_job(table, str(tmp_path / "graph"), "event_id")).first()
    assert network.network.vertices == table.filter("Class = 1").count()
    model = models.load_model(str(tmp_path / "ml/models/RandomForest"))
    scored = models.score(model, table)
    jobs.dashboard_job(
        table, evaluation.evaluate(scored, "RandomForest"), models.tree_importance(spark, model), scored, str(tmp_path / "dash")
    )
    names = ["hourly_transactions", "amount_distribution", "feature_importance", "confusion_matrix", "recent_alerts"]
    counts = {n: spark.read.option("header", True).csv(str(tmp_path / "dash" / n)).count() for n in names}
    assert counts["hourly_transactions"] == 24 and counts["confusion_matrix"] == 2 and counts["feature_importance"] == 10


def test_shell_runs_jobs_on_a_keyless_csv(spark, sf, tmp_path):
    feed = transactions(spark, sf).drop("event_id", "user_id")
    path = tables.write_csv(feed, str(tmp_path / "feed"))
    for job in ("kpi", "dashboard"):
        main([job, "--input", path, "--output", str(tmp_path / job)])
    assert spark.read.json(str(tmp_path / "kpi/sql_metrics")).count() == 1
    assert spark.read.json(str(tmp_path / "dashboard/overview_metrics")).first().total_transactions == 1000
    main(["replay", "--input", path, "--output", str(tmp_path / "batches"), "--rows-per-batch", "400"])
    main(["stream", "--input", str(tmp_path / "batches"), "--output", str(tmp_path / "scored")])
    scored = spark.read.parquet(str(tmp_path / "scored/predictions/batch=*"))
    expected = scoring.apply_rules(transactions(spark, sf)).select("Time", "Amount", "Class", "fraud_score")
    assert sorted(scored.select(expected.columns).collect()) == sorted(expected.collect())


def test_shuffled_columns_stop_the_stream(spark, tmp_path):
    path = tables.write_csv(spark.createDataFrame([(1, 2.0)], "Class int, Time double"), str(tmp_path / "feed"))
    stream = sources.csv_stream(spark, path, "Time double, Class int")
    with pytest.raises(Exception):
        sinks.run_to_end(sinks.to_parquet(stream, str(tmp_path / "o"), str(tmp_path / "c")))


def test_federated_job_with_noise(spark, sf, tmp_path):
    history = jobs.federated_job(transactions(spark, sf), str(tmp_path), "event_id", epsilon=100.0, noise_seed="s")
    assert history.count() == 15
    assert spark.read.json(str(tmp_path / "federated_history")).count() == 15


def test_batch_metrics_of_nothing(spark):
    empty = spark.createDataFrame([], KEYED_TRANSACTION_SCHEMA)
    scored = scoring.apply_rules(empty)
    row = scored.agg(*kpis.batch_metrics(scored)).first()
    assert (row.total_transactions, row.avg_amount, row.fraud_rate) == (0, 0.0, 0.0)


def test_tables_of_several_files_stream_whole(spark, sf, tmp_path):
    folder = str(tmp_path / "several")
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(f"{folder}/events.parquet")
    from riskloom.plans import catalog

    catalog.load()
    for name in ("tx_per_minute", "fraud_over_time", "latency_metric", "json_event_stream"):
        several, one = (sorted(map(tuple, catalog.QUERIES[name](spark, where).collect()), key=str) for where in (folder, sf))
        assert several == one and one
    minutes = catalog.QUERIES["tx_per_minute"](spark, folder)
    assert minutes.agg({"transactions": "sum"}).first()[0] == events.count()


def test_saved_models_score_batches_and_streams(spark, sf, tmp_path):
    table = transactions(spark, sf)
    model, held_out = jobs.fit_forest(table, KEYS)
    path = models.save_model(model, str(tmp_path / "model"))
    jobs.score_job(held_out, path, str(tmp_path / "batch"))
    source = str(tmp_path / "feed")
    held_out.write.option("header", True).csv(source)
    assert jobs.model_stream_job(spark, source, path, str(tmp_path / "stream"), str(tmp_path / "check"))
    # with an interval it goes on until it is stopped
    assert not jobs.model_stream_job(spark, source, path, str(tmp_path / "live"), str(tmp_path / "check2"), "1 second", 20)
    want = {r.event_id: r.prediction for r in spark.read.parquet(str(tmp_path / "batch/scored")).collect()}
    for out in ("stream", "live"):
        assert {r.event_id: r.prediction for r in spark.read.parquet(str(tmp_path / f"{out}/scored")).collect()} == want
