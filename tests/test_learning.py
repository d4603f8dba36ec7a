import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.operators import evaluation, federated, models, sampling
from riskloom.schema import FEATURES
from riskloom.sources.transactions import transactions

KEYS = ["event_id"]


@pytest.fixture(scope="module")
def sides(spark):
    table = transactions(spark, "/root/testdata/sf0.01")
    return sampling.train_test_split(sampling.undersample(table, KEYS, 2.0), KEYS)


@pytest.fixture(scope="module")
def regression(sides):
    return models.train(sides[0], models.logistic_regression())


def test_forest_separates_and_repeats(sides):
    train, test = sides
    fit = lambda: models.train(train, models.random_forest(numTrees=20))
    first, second = fit(), fit()
    scored = models.score(first, test)
    assert evaluation.auc_roc(scored, "fraud_probability").first().auc_roc > 0.75
    assert list(first.stages[-1].featureImportances.toArray()) == list(second.stages[-1].featureImportances.toArray())


def test_regression_and_importance(spark, sides, regression):
    quality = evaluation.evaluate(models.score(regression, sides[1]), "lr").first()
    assert quality.auc_roc > 0.75
    assert quality.tp + quality.fp + quality.tn + quality.fn == sides[1].count()
    table = models.linear_importance(spark, regression).collect()
    assert len(table) == len(FEATURES) and all(r.importance >= 0 for r in table)


def test_saved_model_scores_alike(sides, regression, tmp_path):
    again = models.load_model(models.save_model(regression, str(tmp_path / "model")))
    rows = lambda m: sorted(models.score(m, sides[1]).select("event_id", "fraud_probability").collect())
    assert rows(regression) == rows(again)


def test_exact_areas_agree_with_spark(spark):
    rng = np.random.default_rng(1)
    rows = [(int(y), float(np.round(s, 2))) for y, s in zip(rng.random(400) < 0.2, rng.normal(size=400))]
    df = spark.createDataFrame([(y, s + y) for y, s in rows], "Class int, score double")
    areas = evaluation.exact_areas(evaluation.score_counts(df, "score")).first()
    raw = df.withColumn("rawPrediction", array_to_vector(F.array(-F.col("score"), F.col("score"))))
    assert areas.auc_roc == pytest.approx(evaluation.binned_area(raw), abs=1e-9)
    assert areas.auc_pr == pytest.approx(evaluation.binned_area(raw, "areaUnderPR"), abs=1e-9)


def test_measures_of_one_sided_predictions(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (0, 0)], "Class int, prediction int")
    row = evaluation.fraud_metrics(evaluation.weighted_metrics(evaluation.confusion_matrix(df))).first()
    assert (row.fraud_precision, row.fraud_recall, row.fraud_f1) == (0, 0, 0)
    assert row.accuracy == pytest.approx(0.3333)


def test_comparison_names_winners_and_ties(spark):
    rows = [("a", "auc_roc", 0.9), ("b", "auc_roc", 0.8), ("a", "recall", 0.5), ("b", "recall", 0.5), ("a", "f1", 0.1), ("b", "f1", 0.2)]
    df = spark.createDataFrame(rows, "model string, metric string, value double")
    assert {r.metric: r.winner for r in evaluation.compare_models(df, ["a", "b"]).collect()} == {"auc_roc": "a", "recall": "=", "f1": "b"}
    assert evaluation.best_model(df).first().best_model == "a"


# --- parties ---

@pytest.fixture(scope="module")
def party_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 3))
    y = (rng.random(900) < 1 / (1 + np.exp(-(x @ [1.5, -1.0, 0.0] - 0.5)))).astype(int)
    party = [federated.PARTIES[i % 3] if i % 2 else federated.PARTIES[0] for i in range(900)]
    rows = [(i, party[i], int(y[i]), *map(float, x[i])) for i in range(900)]
    return spark.createDataFrame(rows, "event_id long, bank string, Class int, a double, b double, c double").repartition(4)


def minimum(x, y, reg, mix):
    """Elastic-net logistic regression by many plain proximal gradient steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(20000):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (p - y) / len(y)
        gradient[:-1] += reg * (1 - mix) * w[:-1]
        w = w - gradient
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - reg * mix, 0)
    return w


def test_local_models_reach_the_minimum(party_rows):
    features = ["a", "b", "c"]
    start = {p: np.zeros(4) for p in federated.PARTIES}
    got, samples = federated.local_steps(party_rows, start, features, steps=6)
    data = party_rows.toPandas()
    for name, rows in data.groupby("bank"):
        assert samples[name] == len(rows)
        expected = minimum(rows[features].to_numpy(), rows.Class.to_numpy(), federated.REG, federated.ELASTIC_NET)
        assert got[name] == pytest.approx(expected, abs=1e-4)


def test_rounds_start_from_the_shared_model(spark, party_rows):
    scaled = party_rows.withColumn("is_train", F.col("event_id") % 5 != 0)
    run = federated.train_federated(scaled, ["a", "b", "c"], rounds=3, steps=1)
    history = federated.round_history(run, scaled).collect()
    assert [(r.round, r.name) for r in history] == [(n, p) for n in (1, 2, 3) for p in federated.PARTIES]
    assert all(r.merged_model_auc > 0.75 for r in history)
    means = {r.round: r.global_auc for r in history}
    for n in means:
        rows = [r for r in history if r.round == n]
        assert means[n] == pytest.approx(sum(r.auc * r.samples for r in rows) / sum(r.samples for r in rows), abs=1e-5)
    # one step per round from a fresh start would repeat the same models
    first, last = run.merged[0][3], run.merged[-1][3]
    assert first != last


def test_average_of_equal_models_is_that_model(spark):
    df = spark.createDataFrame([(1, "x", 10, [1.0, -2.0], 0.5), (1, "y", 990, [1.0, -2.0], 0.5)], federated.WEIGHTS_SCHEMA)
    merged = federated.fedavg(df).first()
    assert merged.weights == [1.0, -2.0] and merged.intercept == 0.5 and merged.samples == 1000


def test_average_counts_samples(spark):
    df = spark.createDataFrame([(1, "x", 1, [4.0], 0.0), (1, "y", 3, [0.0], 4.0)], federated.WEIGHTS_SCHEMA)
    assert federated.fedavg(df).first().weights == [1.0]
    assert federated.fedavg(df, ["round"]).first().intercept == 3.0


def test_noise_is_repeatable_and_clipped(spark):
    df = spark.createDataFrame([(1, "x", 1, [30.0, -40.0], 30.0)], federated.WEIGHTS_SCHEMA)
    row = federated.clip_update(df, 1.0).first()
    assert row.weights == pytest.approx([0.3, -0.4]) and row.intercept == pytest.approx(0.3)
    noised = lambda seed, epsilon=1.0: (lambda r: [*r.weights, r.intercept])(federated.add_noise(df, epsilon, seed).first())
    assert noised("s", 1e9) == pytest.approx([0.3, -0.4, 0.3], abs=1e-6)
    assert noised("s") == noised("s")
    assert all(a != b for a, b in zip(noised("s"), noised("t")))
    # four times the budget of two rounds is four times less noise
    quiet, loud = ([x - y for x, y in zip(noised("s", e), [0.3, -0.4, 0.3])] for e in (4.0, 1.0))
    assert [4 * x for x in quiet] == pytest.approx(loud, abs=1e-6)


def test_noise_needs_a_seed_and_parties_must_be_listed(party_rows):
    scaled = party_rows.withColumn("is_train", F.col("event_id") % 5 != 0)
    with pytest.raises(ValueError, match="noise_seed"):
        federated.train_federated(scaled, ["a", "b", "c"], epsilon=1.0)
    with pytest.raises(ValueError, match="Banque_C"):
        federated.train_federated(scaled, ["a", "b", "c"], parties=("Banque_A", "Banque_B"))


def test_scaling_keeps_all_rows(spark):
    rows = [(i, "North" if i % 2 else None, float(i), None if i == 4 else 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "event_id long, bank string, a double, b double")
    scaled = {r.event_id: r for r in federated.scale_by_party(df, ["a", "b"]).collect()}
    assert len(scaled) == 60 and scaled[4].b is None and scaled[5].b == 0 and scaled[7].a is not None


def test_scaling_uses_training_rows_of_the_own_party(party_rows):
    scaled = federated.scale_by_party(party_rows, ["a", "b"]).filter("is_train")
    for r in scaled.groupBy("bank").agg(F.avg("a").alias("m"), F.stddev("b").alias("s")).collect():
        assert r.m == pytest.approx(0, abs=1e-9) and r.s == pytest.approx(1)


def test_rows_of_one_party_stay_in_many_tasks(spark):
    rows = spark.range(4000).select(F.col("id").alias("event_id"), F.concat(F.lit("A"), F.col("id") % 2).alias("bank"), F.col("id").cast("double").alias("V1"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    scaled = federated.scale_by_party(rows.repartition(8), ["V1"])
    held = [r["count"] for r in scaled.groupBy(F.spark_partition_id()).count().collect()]
    for k, v in before.items():
        spark.conf.set(k, v)
    assert sum(held) == 4000 and max(held) < 0.4 * sum(held)
