"""Feature preparation and classifiers on Spark ML."""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vector_element
from ..functions.scalars import SEED
from ..schema import AMOUNT, FEATURES, LABEL, TIME
from .sampling import cached, first_rows


def assembler(features: list[str] = FEATURES, output: str = "features_raw", skip_invalid: bool = False) -> VectorAssembler:
    return VectorAssembler(
        inputCols=features, outputCol=output, handleInvalid="skip" if skip_invalid else "error"
    )


def scaler(with_mean: bool = True) -> StandardScaler:
    return StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=with_mean)


def feature_pipeline(features: list[str] = FEATURES, with_mean: bool = True) -> Pipeline:
    return Pipeline(stages=[assembler(features), scaler(with_mean)])


def feature_columns(df: DataFrame, features: list[str] = FEATURES, vector: str = "features") -> DataFrame:
    """The feature vector back as plain columns in place of the inputs."""
    others = [c for c in df.columns if c not in (*features, vector, "features_raw")]
    values = vector_to_array(vector)
    return df.select(*others, *[values[i].alias(c) for i, c in enumerate(features)])


# The classifiers' parameters.
def random_forest(label: str = LABEL, **overrides) -> RandomForestClassifier:
    params = dict(numTrees=100, maxDepth=10, minInstancesPerNode=5, featureSubsetStrategy="sqrt", seed=SEED)
    return RandomForestClassifier(labelCol=label, featuresCol="features", **(params | overrides))


def logistic_regression(label: str = LABEL, **overrides) -> LogisticRegression:
    params = dict(maxIter=100, regParam=0.01, elasticNetParam=0.8)
    return LogisticRegression(labelCol=label, featuresCol="features", **(params | overrides))


def gradient_boosted(label: str = LABEL, **overrides) -> GBTClassifier:
    params = dict(maxIter=20, maxDepth=5, seed=SEED)
    return GBTClassifier(labelCol=label, featuresCol="features", **(params | overrides))


def train(df: DataFrame, classifier: Estimator, features: list[str] = FEATURES) -> PipelineModel:
    """Fit scaling and classifier on training rows only, so nothing leaks from the test side.

    The rows are kept while the fit makes its passes over them.
    """
    kept = cached(df.select(*features, classifier.getLabelCol()))
    try:
        return Pipeline(stages=[assembler(features), scaler(), classifier]).fit(kept)
    finally:
        kept.unpersist()


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Batch or stream with `prediction` and `fraud_probability`; works row by row."""
    scored = model.transform(df)
    return scored.select(
        *df.columns, "prediction", vector_element(F.col("probability"), 1).alias("fraud_probability")
    )


def export_predictions(scored: DataFrame, order: list[str], n: int | None = None) -> DataFrame:
    """The report of scored transactions; with `n`, its first rows in a stated order."""
    rows = scored if n is None else first_rows(scored, order, n)
    return rows.select(TIME, AMOUNT, LABEL, "prediction", "fraud_probability")


def _importance_table(spark: SparkSession, features: list[str], values) -> DataFrame:
    rows = [(name, float(value)) for name, value in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def tree_importance(spark: SparkSession, model: PipelineModel, features: list[str] = FEATURES) -> DataFrame:
    return _importance_table(spark, features, model.stages[-1].featureImportances.toArray())


def linear_importance(spark: SparkSession, model: PipelineModel, features: list[str] = FEATURES) -> DataFrame:
    """Features by absolute coefficient."""
    return _importance_table(spark, features, abs(model.stages[-1].coefficients.toArray()))


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def log_run(metrics: DataFrame, path: str, run_id: str, params: dict[str, object] | None = None) -> str:
    """Append a run's parameters and (metric, value) rows to a table of runs."""
    spark = metrics.sparkSession
    rows = metrics.select(
        F.lit(run_id).alias("run_id"), F.lit("metric").alias("kind"),
        F.col("metric").alias("name"), F.col("value").cast("string").alias("value"),
    )
    if params:
        stated = [(run_id, "param", k, str(v)) for k, v in params.items()]
        rows = rows.unionByName(
            spark.createDataFrame(stated, "run_id string, kind string, name string, value string")
        )
    rows.write.mode("append").parquet(path)
    return path
