"""Queries for feature preparation, classifiers and training across parties."""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import key_hash
from ..operators import evaluation, federated, kpis, models, sampling
from ..schema import FEATURES, LABEL
from ..session import cut_lineage, work_dir
from ..sources.transactions import transactions
from . import marts
from . import oracle as o
from .catalog import query
from .queries_tables import scored_transactions

KEYS = ["event_id"]


@cache
def _samples(application: str, spark, sf):
    """Balanced training rows and all held-out rows, drawn once per application and stored."""
    training, test = sampling.train_test_split(transactions(spark, sf), KEYS)
    return cut_lineage(sampling.undersample(training, KEYS, 2.0)), cut_lineage(test)


@cache
def _model(application: str, spark, sf, kind: str):
    classifier = {
        "RandomForest": models.random_forest, "LogisticRegression": models.logistic_regression,
        "GradientBoosted": models.gradient_boosted,
    }[kind]()
    return models.train(samples(spark, sf)[0], classifier)


def samples(spark, sf):
    return _samples(spark.sparkContext.applicationId, spark, sf)


def trained(spark, sf, kind):
    return _model(spark.sparkContext.applicationId, spark, sf, kind)


def predictions(spark, sf, kind):
    return models.score(trained(spark, sf, kind), samples(spark, sf)[1])


# --- features ---

@query("assemble_features", f"WITH {o.tx()} SELECT event_id, " + ", ".join(f"{c} AS {c}" for c in FEATURES) + " FROM tx")
def _(spark, sf):
    table = models.assembler(output="features").transform(transactions(spark, sf))
    return models.feature_columns(table).select("event_id", *FEATURES)


def _scaled_sql(source, keep="event_id"):
    return f"SELECT {keep}, " + ", ".join(
        o.rnd(f"(({c}) - avg({c}) OVER ()) / stddev_samp({c}) OVER ()", 5) + f" AS {c}" for c in FEATURES
    ) + f" FROM {source}"


def _rounded(df, digits=5):
    return df.withColumns({c: F.round(c, digits) for c in FEATURES})


@query("standard_scale", f"WITH {o.tx()} {_scaled_sql('tx')}")
def _(spark, sf):
    vectors = models.assembler().transform(transactions(spark, sf))
    scaled = models.scaler().fit(vectors).transform(vectors)
    return _rounded(models.feature_columns(scaled).select("event_id", *FEATURES))


@query("feature_pipeline", f"WITH {o.tx()} {_scaled_sql('tx', 'event_id, Class')}")
def _(spark, sf):
    table = transactions(spark, sf)
    scaled = models.feature_pipeline().fit(table).transform(table)
    return _rounded(models.feature_columns(scaled).select("event_id", LABEL, *FEATURES))


# --- classifiers (checked by rows here, by quality in the tests) ---

@query("train_random_forest")
def _(spark, sf):
    return predictions(spark, sf, "RandomForest").select("event_id", LABEL, "prediction", "fraud_probability")


@query("train_logistic_regression")
def _(spark, sf):
    return predictions(spark, sf, "LogisticRegression").select("event_id", LABEL, "prediction", "fraud_probability")


@query("train_gbt")
def _(spark, sf):
    return predictions(spark, sf, "GradientBoosted").select("event_id", LABEL, "prediction", "fraud_probability")


@query("score_batch")
def _(spark, sf):
    scored = models.score(trained(spark, sf, "LogisticRegression"), transactions(spark, sf))
    return scored.select("event_id", "prediction", "fraud_probability")


@query("tree_feature_importance")
def _(spark, sf):
    return models.tree_importance(spark, trained(spark, sf, "RandomForest"))


@query("linear_importance")
def _(spark, sf):
    return models.linear_importance(spark, trained(spark, sf, "LogisticRegression"))


@query("export_predictions")
def _(spark, sf):
    return models.export_predictions(predictions(spark, sf, "RandomForest"), KEYS)


def _qualities(spark, sf):
    kinds = ["RandomForest", "LogisticRegression", "GradientBoosted"]
    rows = [evaluation.long_metrics(evaluation.evaluate(predictions(spark, sf, k), k)) for k in kinds]
    return reduce(DataFrame.unionByName, rows), kinds


@query("model_comparison")
def _(spark, sf):
    return evaluation.compare_models(*_qualities(spark, sf))


@query("best_model")
def _(spark, sf):
    return evaluation.best_model(_qualities(spark, sf)[0])


@query("evaluate_random_forest")
def _(spark, sf):
    return evaluation.evaluate(predictions(spark, sf, "RandomForest"), "RandomForest")


@query("roc_pr_curve_model")
def _(spark, sf):
    return evaluation.roc_pr_curve(predictions(spark, sf, "RandomForest"), "fraud_probability", digits=4)


# rows that the split puts on the test side
_TEST_ROWS = f"{o.tx([])}, test AS (SELECT * FROM tx WHERE {o.uniform('event_id', sampling.SPLIT_SALT)} >= 0.8)"


def same_scores(one, other):
    """Per row, whether two tables of scores agree."""
    columns = ["event_id", "prediction", "fraud_probability"]
    pairs = one.select(*columns).join(
        other.select("event_id", *[F.col(c).alias(f"other_{c}") for c in columns[1:]]), "event_id", "full"
    )
    agree = [F.col(c).eqNullSafe(F.col(f"other_{c}")) for c in columns[1:]]
    return pairs.select("event_id", (agree[0] & agree[1]).alias("same"))


@query("model_save_load", f"WITH {_TEST_ROWS} SELECT event_id, true AS same FROM test")
def _(spark, sf):
    path = models.save_model(trained(spark, sf, "LogisticRegression"), work_dir(spark, "model"))
    reloaded = models.score(models.load_model(path), samples(spark, sf)[1])
    return same_scores(reloaded, predictions(spark, sf, "LogisticRegression"))


@query(
    "run_metrics_log",
    f"WITH {o.SCORED}, cells AS (SELECT {o.CELLS} FROM scored), m AS (SELECT {o.WEIGHTED_MEASURES} FROM cells) "
    "SELECT 'rules' AS run_id, 'param' AS kind, 'threshold' AS name, '0.5' AS value "
    "UNION ALL SELECT 'rules', 'metric', unnest(['accuracy', 'precision', 'recall', 'f1_score']), "
    "unnest([CAST(accuracy AS VARCHAR), CAST(precision AS VARCHAR), CAST(recall AS VARCHAR), CAST(f1_score AS VARCHAR)]) FROM m",
)
def _(spark, sf):
    quality = evaluation.weighted_metrics(evaluation.confusion_matrix(scored_transactions(spark, sf)))
    metrics = quality.unpivot([], ["accuracy", "precision", "recall", "f1_score"], "metric", "value")
    path = models.log_run(metrics, work_dir(spark, "runs"), "rules", {"threshold": 0.5})
    return spark.read.parquet(path)


@query("mart_overview")
def _(spark, sf):
    quality = evaluation.evaluate(predictions(spark, sf, "RandomForest"), "RandomForest")
    return marts.overview(transactions(spark, sf, []), quality)


@query("mart_feature_importance")
def _(spark, sf):
    return marts.feature_importance(models.tree_importance(spark, trained(spark, sf, "RandomForest")))


# --- training across parties ---

_BANK = "CASE event_id % 3 WHEN 0 THEN 'Banque_A' WHEN 1 THEN 'Banque_B' ELSE 'Banque_C' END AS bank"


@query("assign_bank", f"WITH {o.tx([])} SELECT event_id, {_BANK} FROM tx")
def _(spark, sf):
    return federated.assign_party(transactions(spark, sf, []), "event_id").select("event_id", "bank")


@query(
    "bank_profile",
    f"WITH {o.tx([])}, b AS (SELECT *, {_BANK} FROM tx) SELECT bank, count(*) AS transactions, {o.FRAUDS} AS frauds FROM b GROUP BY bank",
)
def _(spark, sf):
    return kpis.party_profile(federated.assign_party(transactions(spark, sf, []), "event_id"))


def _own_scale(c):
    w = "OVER (PARTITION BY bank)"
    x = f"avg({c}) FILTER (WHERE is_train) {w}"
    s = f"stddev_samp({c}) FILTER (WHERE is_train) {w}"
    return f"{o.rnd(f'coalesce(({c} - {x}) / nullif({s}, 0), 0)', 5)} AS {c}"


@query(
    "per_bank_scale_split",
    f"WITH {o.tx()}, b AS (SELECT *, {_BANK}, {o.uniform('event_id', sampling.SPLIT_SALT)} < 0.8 AS is_train FROM tx) "
    f"SELECT event_id, bank, is_train, {', '.join(_own_scale(c) for c in FEATURES)} FROM b",
)
def _(spark, sf):
    parties = federated.assign_party(transactions(spark, sf), "event_id")
    return _rounded(federated.scale_by_party(parties).select("event_id", "bank", "is_train", *FEATURES))


@cache
def _scaled(application: str, spark, sf):
    return cut_lineage(federated.scale_by_party(federated.assign_party(transactions(spark, sf), "event_id")))


@cache
def _run(application: str, spark, sf):
    return federated.train_federated(scaled(spark, sf))


def scaled(spark, sf):
    return _scaled(spark.sparkContext.applicationId, spark, sf)


def run(spark, sf):
    return _run(spark.sparkContext.applicationId, spark, sf)


@query("local_train")
def _(spark, sf):
    return run(spark, sf).local_models(spark)


@query("broadcast_global_model")
def _(spark, sf):
    return run(spark, sf).global_models(spark)


@query("round_history")
def _(spark, sf):
    return federated.round_history(run(spark, sf), scaled(spark, sf))


_BY_BANK = f"{o.SCORED}, b AS (SELECT *, {_BANK} FROM scored)"
_LOCAL = (
    f"{_BY_BANK}, cells AS (SELECT bank, {o.CELLS} FROM b GROUP BY bank), {o.areas('b', 'fraud_score', 'bank')}, "
    f"local AS (SELECT bank, {o.rnd('auc_roc', 6)} AS auc, {o.rnd(o.div('tp + tn', 'tp + tn + fp + fn'), 6)} AS accuracy, "
    f"{o.rnd(o.div('tp', 'tp + fp'), 6)} AS precision, {o.rnd(o.div('tp', 'tp + fn'), 6)} AS recall, tp + tn + fp + fn AS samples "
    "FROM cells JOIN area USING (bank))"
)


def _by_bank(spark, sf):
    return federated.assign_party(scored_transactions(spark, sf), "event_id")


@query("local_evaluate", f"WITH {_LOCAL} SELECT bank, auc, accuracy, precision, recall FROM local")
def _(spark, sf):
    return federated.evaluate_by_party(_by_bank(spark, sf), "fraud_score")


@query(
    "weighted_global_metric",
    f"WITH {_LOCAL} SELECT {o.rnd('sum(auc * samples) / sum(samples)', 5)} AS global_auc FROM local",
)
def _(spark, sf):
    rows = _by_bank(spark, sf)
    local = federated.evaluate_by_party(rows, "fraud_score").join(
        kpis.party_profile(rows).select("bank", F.col("transactions").alias("samples")), "bank"
    )
    return federated.weighted_metric(local).select(F.round("global_auc", 5).alias("global_auc"))


# A linear model SQL can state: each party's weights are the distances of its class means.
_CENTROID = ["V1", "V3", "V4", "V14"]


def centroid_models(spark, sf):
    rows = federated.assign_party(transactions(spark, sf, _CENTROID), "event_id")
    gap = [F.avg(F.when(F.col(LABEL) == 1, F.col(c))) - F.avg(F.when(F.col(LABEL) == 0, F.col(c))) for c in _CENTROID]
    return rows.groupBy("bank").agg(
        F.count("*").alias("samples"), F.array(*gap).alias("weights"), F.avg(LABEL).alias("intercept")
    )


_LOCAL_MODELS = (
    f"{o.tx(_CENTROID)}, b AS (SELECT *, {_BANK} FROM tx), local AS (SELECT bank, count(*) AS samples, "
    + ", ".join(f"avg({c}) FILTER (WHERE Class = 1) - avg({c}) FILTER (WHERE Class = 0) AS w{i}" for i, c in enumerate(_CENTROID))
    + ", avg(Class) AS intercept FROM b GROUP BY bank)"
)


def _weight_columns(models_table):
    return [F.round(F.col("weights")[i], 6).alias(f"w{i}") for i in range(len(_CENTROID))]


@query(
    "fedavg",
    f"WITH {_LOCAL_MODELS} SELECT CAST(sum(samples) AS BIGINT) AS samples, "
    + ", ".join(f"{o.rnd(f'sum(w{i} * samples) / sum(samples)', 6)} AS w{i}" for i in range(len(_CENTROID)))
    + f", {o.rnd('sum(intercept * samples) / sum(samples)', 6)} AS intercept FROM local",
)
def _(spark, sf):
    merged = federated.fedavg(centroid_models(spark, sf))
    return merged.select("samples", *_weight_columns(merged), F.round("intercept", 6).alias("intercept"))


NOISE_SEED = "fixed here so that SQL can draw the same"


def _noise_sql(i):
    """Weight i, or the intercept behind the weights, clipped and noised."""
    value, name = (f"w{i}", f"w{i}") if i < len(_CENTROID) else ("intercept", "intercept")
    u = f"({o.uniform(f'''bank || ':{i}' ''', NOISE_SEED)} * (1 - 2e-9) + 1e-9 - 5e-1)"
    size = " + ".join([f"abs(w{j})" for j in range(len(_CENTROID))] + ["abs(intercept)"])
    return f"{o.rnd(f'{value} * least(1e0, 1e0 / ({size})) - 2e0 * sign({u}) * ln(1 - 2 * abs({u}))', 6)} AS {name}"


@query("dp_noise", f"WITH {_LOCAL_MODELS} SELECT bank, samples, {', '.join(_noise_sql(i) for i in range(len(_CENTROID) + 1))} FROM local")
def _(spark, sf):
    noisy = federated.add_noise(centroid_models(spark, sf), epsilon=1.0, seed=NOISE_SEED, limit=1.0)
    return noisy.select("bank", "samples", *_weight_columns(noisy), F.round("intercept", 6).alias("intercept"))
