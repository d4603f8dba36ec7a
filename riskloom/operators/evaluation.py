"""Model quality from scored rows, by aggregation only."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio
from ..schema import LABEL
from ..session import cut_lineage
from .ordered import running


def confusion_counts(label: str = LABEL, prediction: str = "prediction", weight: Column | None = None) -> list[Column]:
    """The four cells as aggregates; `weight` counts each row that many times."""

    def cell(actual: int, predicted: int, name: str) -> Column:
        hit = (F.col(label) == actual) & (F.col(prediction) == predicted)
        if weight is None:
            return F.count_if(hit).alias(name)
        return F.coalesce(F.sum(F.when(hit, weight)), F.lit(0)).cast("long").alias(name)

    return [cell(1, 1, "tp"), cell(0, 1, "fp"), cell(0, 0, "tn"), cell(1, 0, "fn")]


def confusion_matrix(
    df: DataFrame, label: str = LABEL, prediction: str = "prediction", by: list[str] | None = None
) -> DataFrame:
    return df.groupBy(*(by or [])).agg(*confusion_counts(label, prediction))


def accuracy(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("int")).alias("accuracy"))


def fraud_metrics(confusion: DataFrame) -> DataFrame:
    """Precision, recall and F1 of the fraud class; 0 where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return confusion.withColumns(
        {
            "fraud_precision": F.round(ratio(tp, tp + fp), 4),
            "fraud_recall": F.round(ratio(tp, tp + fn), 4),
            "fraud_f1": F.round(ratio(2 * tp, 2 * tp + fp + fn), 4),
        }
    )


def weighted_metrics(confusion: DataFrame) -> DataFrame:
    """Accuracy, and both classes' precision, recall and F1 weighted by class size."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    frauds, normals, total = tp + fn, tn + fp, tp + fp + tn + fn

    def weighted(of_fraud: Column, of_normal: Column) -> Column:
        return F.round(ratio(frauds * of_fraud + normals * of_normal, total), 4)

    return confusion.withColumns(
        {
            "accuracy": F.round(ratio(tp + tn, total), 4),
            "precision": weighted(ratio(tp, tp + fp), ratio(tn, tn + fn)),
            "recall": weighted(ratio(tp, frauds), ratio(tn, normals)),
            "f1_score": weighted(ratio(2 * tp, 2 * tp + fp + fn), ratio(2 * tn, 2 * tn + fn + fp)),
        }
    )


def score_counts(
    df: DataFrame,
    score: str,
    label: str = LABEL,
    digits: int | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Frauds and normal rows per score. Rounding to `digits` bounds the number of scores."""
    value = F.col(score).cast("double")
    return df.groupBy(*(by or []), (F.round(value, digits) if digits else value).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def _above(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Adds how many frauds and normal rows precede each score, highest score first."""
    return running(
        counts,
        [*[F.col(c) for c in by or []], F.desc("score")],
        sums={"pos_above": F.col("pos"), "neg_above": F.col("neg")},
        before=True,
    )


def roc_pr_curve(
    df: DataFrame, score: str, label: str = LABEL, digits: int | None = 4
) -> DataFrame:
    """One point per score: rows flagged at or above it, and the rates that follow."""
    counts = score_counts(df, score, label, digits)
    totals = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    p, n = totals.select("p").scalar(), totals.select("n").scalar()
    tp, fp = F.col("pos_above") + F.col("pos"), F.col("neg_above") + F.col("neg")
    return _above(counts).select(
        F.col("score").alias("threshold"),
        tp.alias("tp"),
        fp.alias("fp"),
        F.round(ratio(tp, p), 6).alias("tpr"),
        F.round(ratio(fp, n), 6).alias("fpr"),
        F.round(ratio(tp, tp + fp), 6).alias("precision"),
        F.round(ratio(tp, p), 6).alias("recall"),
    )


def exact_areas(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Area under the ROC curve (per group), and under the PR curve when not grouped.

    Takes `score_counts`; tied scores share a sloped segment. The PR curve starts at
    recall 0 with the precision of its first point.
    """
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    pos_above, neg_above = F.col("pos_above").cast("double"), F.col("neg_above").cast("double")
    # frauds counted before the group's own first score are taken off again
    roc = F.try_divide(
        F.sum(neg * (pos_above + pos / 2)) - F.min(pos_above) * F.sum(neg), F.sum(pos) * F.sum(neg)
    )
    areas = [F.coalesce(roc, F.lit(0.0)).alias("auc_roc")]
    if not by:
        here = (pos_above + pos) / (pos_above + pos + neg_above + neg)
        before = F.coalesce(F.try_divide(pos_above, pos_above + neg_above), here)
        pr = F.try_divide(F.sum(pos * (here + before) / 2), F.sum(pos))
        areas.append(F.coalesce(pr, F.lit(0.0)).alias("auc_pr"))
    return _above(counts, by).groupBy(*(by or [])).agg(*areas)


def auc_roc(df: DataFrame, score: str, label: str = LABEL, by: list[str] | None = None) -> DataFrame:
    return exact_areas(score_counts(df, score, label, by=by), by).select(*(by or []), "auc_roc")


def auc_pr(df: DataFrame, score: str, label: str = LABEL) -> DataFrame:
    return exact_areas(score_counts(df, score, label)).select("auc_pr")


def binned_area(df: DataFrame, metric: str = "areaUnderROC", raw: str = "rawPrediction", label: str = LABEL) -> float:
    """Spark's own evaluator, which reduces the curve to about a thousand points."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=raw, metricName=metric
    ).evaluate(df)


def evaluate(
    df: DataFrame, model: str, score: str = "fraud_probability", label: str = LABEL,
    prediction: str = "prediction",
) -> DataFrame:
    """One row with every quality measure of a scored table.

    The table, and the model behind it, is read once: all measures follow from counts per
    score, prediction and label.
    """
    tally = cut_lineage(
        df.groupBy(
            F.col(score).cast("double").alias("score"),
            F.col(prediction).alias("prediction"),
            F.col(label).alias("label"),
        ).agg(F.count("*").alias("rows"))
    )
    counts = tally.groupBy("score").agg(
        F.coalesce(F.sum(F.when(F.col("label") == 1, F.col("rows"))), F.lit(0)).alias("pos"),
        F.coalesce(F.sum(F.when(F.col("label") == 0, F.col("rows"))), F.lit(0)).alias("neg"),
    )
    areas = exact_areas(counts)
    cells = tally.agg(*confusion_counts("label", "prediction", F.col("rows")))
    return (
        cells.transform(weighted_metrics)
        .transform(fraud_metrics)
        .select(
            F.lit(model).alias("model"),
            F.round(areas.select("auc_roc").scalar(), 4).alias("auc_roc"),
            F.round(areas.select("auc_pr").scalar(), 4).alias("auc_pr"),
            *MEASURES[2:],
            "tp", "fp", "tn", "fn",
        )
    )


MEASURES = [
    "auc_roc", "auc_pr", "accuracy", "precision", "recall", "f1_score",
    "fraud_precision", "fraud_recall", "fraud_f1",
]


def long_metrics(evaluation: DataFrame) -> DataFrame:
    """(model, metric, value) rows of `evaluate` results."""
    return evaluation.unpivot(["model"], MEASURES, "metric", "value")


def compare_models(metrics: DataFrame, models: list[str]) -> DataFrame:
    """Metric by model, with the better model of each metric ("=" when level)."""
    wide = metrics.groupBy("metric").pivot("model", models).agg(F.first("value"))
    best = F.greatest(*[F.col(m) for m in models])
    leaders = F.filter(
        F.array(*[F.when(F.col(m) == best, F.lit(m)) for m in models]), lambda m: m.isNotNull()
    )
    return wide.withColumn("winner", F.when(F.size(leaders) == 1, leaders[0]).otherwise("="))


def best_model(metrics: DataFrame, metric: str = "auc_roc") -> DataFrame:
    return metrics.filter(F.col("metric") == metric).agg(
        F.max_by("model", "value").alias("best_model"), F.max("value").alias(metric)
    )
