"""Training across parties whose rows are never pooled: only sums leave a party's rows.

Every step handles all parties in one Spark job. Row-level work (gradient and curvature of
the logistic loss) happens in the tasks; what reaches the driver is one small vector per
party, its size set by the number of features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ratio, uniform_hash
from ..schema import FEATURES, LABEL
from ..session import cut_lineage
from .evaluation import confusion_counts, exact_areas
from .sampling import cached, split_side

# Parties and training parameters.
PARTIES = ("Banque_A", "Banque_B", "Banque_C")
ROUNDS, REG, ELASTIC_NET = 5, 0.01, 0.8

WEIGHTS_SCHEMA = "round int, bank string, samples long, weights array<double>, intercept double"


def assign_party(df: DataFrame, key: str, parties: tuple[str, ...] = PARTIES, name: str = "bank") -> DataFrame:
    """A party for every row, from its business key."""
    names = F.array(*[F.lit(p) for p in parties])
    return df.withColumn(name, F.element_at(names, (F.pmod(F.col(key), F.lit(len(parties))) + 1).cast("int")))


def party_statistics(df: DataFrame, features: list[str] = FEATURES, party: str = "bank") -> DataFrame:
    """Mean and deviation of each feature per party, as one struct per feature."""
    return df.groupBy(party).agg(
        *[F.struct(F.avg(c).alias("mean"), F.stddev(c).alias("std")).alias(f"_{c}") for c in features]
    )


def scale_by_party(
    df: DataFrame,
    features: list[str] = FEATURES,
    party: str = "bank",
    keys: list[str] | None = None,
    train: float = 0.8,
) -> DataFrame:
    """Mark each row `is_train` and scale its features by its own party's training rows.

    All rows stay. A feature without spread becomes 0; one that is null, or of a party without
    training rows, stays null.
    """
    marked = df.withColumn("is_train", split_side(keys or ["event_id"], train))
    stats = party_statistics(marked.filter("is_train"), features, party)
    # one row per party, sent to all tasks: joined by party, all rows of a party would meet in one task
    per_party = F.broadcast(stats.withColumnRenamed(party, "_party"))
    scaled = {}
    for c in features:
        away = F.col(c) - F.col(f"_{c}.mean")
        flat = F.coalesce(F.col(f"_{c}.std"), F.lit(0.0)) == 0
        scaled[c] = F.when(flat, away * 0.0).otherwise(F.try_divide(away, F.col(f"_{c}.std")))
    return marked.join(per_party, F.col(party).eqNullSafe(F.col("_party")), "left").select(
        *[scaled[c].alias(c) if c in scaled else F.col(c) for c in marked.columns]
    )


def _curvature_terms(batches: Iterator[pd.DataFrame], features, party, label, models) -> Iterator[pd.DataFrame]:
    """Per party in this partition: rows, gradient and upper triangle of the Hessian, summed."""
    size = len(features) + 1
    upper = np.triu_indices(size)
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for name, rows in batch.groupby(party, sort=False):
            x = np.column_stack([rows[features].to_numpy(float), np.ones(len(rows))])
            p = 1.0 / (1.0 + np.exp(-np.clip(x @ models[name], -500, 500)))
            gradient = x.T @ (p - rows[label].to_numpy(float))
            hessian = (x * (p * (1 - p))[:, None]).T @ x
            sums = np.concatenate([[len(rows)], gradient, hessian[upper]])
            totals[name] = totals[name] + sums if name in totals else sums
    if totals:
        yield pd.DataFrame({party: list(totals), "sums": [list(v) for v in totals.values()]})


def _newton_step(start, gradient, hessian, reg: float, elastic_net: float, sweeps: int = 200):
    """Minimise the quadratic model of the loss plus elastic net by coordinate descent."""
    l1, l2 = reg * elastic_net, reg * (1 - elastic_net)
    w = start.copy()
    slope = gradient.copy()  # of the quadratic model at w
    last = len(w) - 1  # the intercept is not penalised
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(w)):
            curve = hessian[j, j] + (0.0 if j == last else l2) + 1e-9
            target = w[j] - (slope[j] + (0.0 if j == last else l2 * w[j])) / curve
            if j != last:
                target = np.sign(target) * max(abs(target) - l1 / curve, 0.0)
            step = target - w[j]
            if step:
                w[j] = target
                slope += hessian[:, j] * step
                moved = max(moved, abs(step))
        if moved < 1e-9:
            break
    return w


def local_steps(
    df: DataFrame,
    models: dict[str, np.ndarray],
    features: list[str] = FEATURES,
    party: str = "bank",
    label: str = LABEL,
    reg: float = REG,
    elastic_net: float = ELASTIC_NET,
    steps: int = 2,
) -> tuple[dict[str, np.ndarray], dict[str, int]]:
    """Improve every party's own model on its own rows; returns models and row counts.

    A Newton step uses the curvature as well as the slope, so that few passes over the
    rows are needed where gradient steps would take tens.
    """
    models, samples = dict(models), {}
    size = len(features) + 1
    upper = np.triu_indices(size)
    rows = df.select(party, label, *features)
    for _ in range(steps):
        current = dict(models)
        sums = (
            rows.mapInPandas(
                lambda it, m=current: _curvature_terms(it, features, party, label, m),
                f"{party} string, sums array<double>",
            )
            .select(party, F.posexplode("sums").alias("i", "v"))
            .groupBy(party, "i")
            .agg(F.sum("v").alias("v"))
        )
        # parties x features^2 / 2 numbers, whatever the number of rows
        by_party: dict[str, np.ndarray] = {}
        for name, i, v in sums.collect():
            by_party.setdefault(name, np.zeros(1 + size + len(upper[0])))[i] = v
        for name, values in by_party.items():
            n = values[0]
            hessian = np.zeros((size, size))
            hessian[upper] = values[1 + size :] / n
            hessian = hessian + hessian.T - np.diag(np.diag(hessian))
            samples[name] = int(n)
            models[name] = _newton_step(models[name], values[1 : 1 + size] / n, hessian, reg, elastic_net)
    return models, samples


def fedavg(models: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Average of the parties' models, each counted by its number of samples."""
    by = by or []
    n = F.col("samples").cast("double")
    positions = models.select(*by, "samples", F.posexplode("weights").alias("i", "w"))
    averaged = positions.groupBy(*by, "i").agg((F.sum(F.col("w") * n) / F.sum(n)).alias("w"))
    weights = averaged.groupBy(*by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "w"))), lambda t: t["w"]).alias("weights")
    )
    rest = models.groupBy(*by).agg(
        (F.sum(F.col("intercept") * n) / F.sum(n)).alias("intercept"), F.sum("samples").alias("samples")
    )
    if by:
        return weights.join(rest, by)
    return rest.select("samples", weights.scalar().alias("weights"), "intercept")


def weighted_metric(metrics: DataFrame, value: str = "auc", by: list[str] | None = None) -> DataFrame:
    """Mean of the parties' own metrics, each counted by its number of samples."""
    n = F.col("samples").cast("double")
    return metrics.groupBy(*(by or [])).agg(ratio(F.sum(F.col(value) * n), F.sum(n)).alias(f"global_{value}"))


def clip_update(models: DataFrame, limit: float = 1.0) -> DataFrame:
    """Scale a party's weights and intercept down to at most `limit` in the sum of their sizes."""
    size = F.aggregate("weights", F.abs("intercept"), lambda total, w: total + F.abs(w))
    factor = F.least(F.lit(1.0), F.coalesce(F.try_divide(F.lit(float(limit)), size), F.lit(1.0)))
    return models.withColumn("_factor", factor).withColumns(
        {"weights": F.transform("weights", lambda w: w * F.col("_factor")), "intercept": F.col("intercept") * F.col("_factor")}
    ).drop("_factor")


def add_noise(models: DataFrame, epsilon: float, seed: str, limit: float = 1.0, party: str = "bank") -> DataFrame:
    """Clip each party's update and add Laplace noise of scale 2 * limit / epsilon to all of it.

    Two updates within the clip differ by 2 * limit at most in the sum of sizes, so one report
    costs `epsilon`. The noise is drawn from a hash of seed, party and position, so a retried task
    repeats it; whoever knows the seed can take the noise off, so it must stay secret and be used
    for one report only.
    """
    clipped = clip_update(models, limit)
    scale = 2 * float(limit) / float(epsilon)

    def noisy(w: Column, i: Column) -> Column:
        # kept off the ends, where the logarithm has no value
        u = (uniform_hash(F.col(party), i, salt=seed) * (1 - 2e-9)) + 1e-9 - 0.5
        return w - F.lit(scale) * F.signum(u) * F.log(1 - 2 * F.abs(u))

    return clipped.withColumns(
        {"weights": F.transform("weights", noisy), "intercept": noisy(F.col("intercept"), F.size("weights"))}
    )


def margin(features: list[str], weights: Column, intercept: Column) -> Column:
    """Linear score of a row under a model held in an array column."""
    total = intercept
    for i, c in enumerate(features):
        total = total + F.col(c) * weights[i]
    return total


def evaluate_by_party(
    df: DataFrame, score: str = "score", prediction: str = "prediction",
    label: str = LABEL, party: str = "bank", by: list[str] | None = None,
) -> DataFrame:
    """AUC, accuracy, precision and recall per party (and per further keys), from one tally."""
    keys = [*(by or []), party]
    tally = cut_lineage(
        df.groupBy(*keys, F.col(score).alias("score"), F.col(prediction).alias("prediction")).agg(
            F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
        )
    )
    both = tally.select(
        *keys, "prediction",
        F.inline(F.array(
            F.struct(F.lit(1).alias("label"), F.col("pos").alias("n")),
            F.struct(F.lit(0).alias("label"), F.col("neg").alias("n")),
        )),
    )
    counts = tally.groupBy(*keys, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    cells = both.groupBy(*keys).agg(*confusion_counts("label", "prediction", F.col("n")))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return cells.join(exact_areas(counts, keys), keys).select(
        *keys,
        F.round("auc_roc", 6).alias("auc"),
        F.round(ratio(tp + tn, tp + tn + fp + fn), 6).alias("accuracy"),
        F.round(ratio(tp, tp + fp), 6).alias("precision"),
        F.round(ratio(tp, tp + fn), 6).alias("recall"),
    )


@dataclass
class FederatedRun:
    """Local models of every round, and the averaged model each round ended with."""

    features: list[str]
    local: list[tuple] = field(default_factory=list)
    merged: list[tuple] = field(default_factory=list)

    def local_models(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.local, WEIGHTS_SCHEMA)

    def global_models(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.merged, WEIGHTS_SCHEMA)


def train_federated(
    scaled: DataFrame,
    features: list[str] = FEATURES,
    party: str = "bank",
    label: str = LABEL,
    parties: tuple[str, ...] = PARTIES,
    rounds: int = ROUNDS,
    steps: int = 2,
    epsilon: float | None = None,
    clip: float = 1.0,
    noise_seed: str | None = None,
) -> FederatedRun:
    """Rounds of local training and averaging; each round starts from the averaged model.

    `scaled` comes from `scale_by_party`. With `epsilon` the change each party reports is
    clipped and noised before averaging; `epsilon` covers all rounds together, and `noise_seed`
    must be given and kept secret. Rows of a party that is not listed are an error.
    """
    if epsilon is not None and noise_seed is None:
        raise ValueError("noise needs a secret noise_seed")
    spark = scaled.sparkSession
    listed = F.coalesce(F.col(party).isin(list(parties)), F.lit(False))
    others = [r[0] for r in scaled.filter(~listed).select(party).distinct().limit(5).collect()]
    if others:
        raise ValueError(f"rows of parties that are not listed: {others}")
    rows = cached(scaled.filter("is_train").select(party, label, *features))
    run = FederatedRun(features)
    shared = np.zeros(len(features) + 1)
    try:
        for number in range(1, rounds + 1):
            models, samples = local_steps(
                rows, {p: shared for p in parties}, features, party, label, steps=steps
            )
            reported = [(number, p, n, models[p][:-1].tolist(), float(models[p][-1])) for p, n in sorted(samples.items())]
            run.local += reported
            changes = spark.createDataFrame(
                [(r, p, n, (np.array(w) - shared[:-1]).tolist(), b - float(shared[-1])) for r, p, n, w, b in reported],
                WEIGHTS_SCHEMA,
            ).withColumnRenamed("bank", party)
            if epsilon is not None:
                changes = add_noise(changes, epsilon / rounds, f"{noise_seed}:{number}", clip, party)
            merged = fedavg(changes).first()
            shared = shared + np.append(merged["weights"], merged["intercept"])
            run.merged.append((number, "global", int(merged["samples"]), shared[:-1].tolist(), float(shared[-1])))
    finally:
        rows.unpersist()
    return run


def round_history(run: FederatedRun, scaled: DataFrame, party: str = "bank", label: str = LABEL) -> DataFrame:
    """Per round and party: samples and local test metrics, the sample-weighted mean AUC, and
    the AUC the averaged model really reaches on all parties' test rows.

    All rounds are scored in one pass over the test rows.
    """
    spark = scaled.sparkSession
    # rounds x parties rows of weights: fixed by the arguments of the run
    local = F.broadcast(run.local_models(spark).withColumnRenamed("bank", party))
    test = scaled.filter(~F.col("is_train")).select(party, label, *run.features)
    scored = test.join(local.select("round", party, "weights", "intercept"), party).select(
        "round", party, label, margin(run.features, F.col("weights"), F.col("intercept")).alias("score")
    ).withColumn("prediction", F.when(F.col("score") > 0, 1).otherwise(0))
    own = evaluate_by_party(scored, party=party, label=label, by=["round"])
    merged = run.global_models(spark)
    pooled = test.select(
        label,
        F.inline(F.array(*[
            F.struct(
                F.lit(number).alias("round"),
                margin(run.features, F.array(*[F.lit(w) for w in weights]), F.lit(intercept)).alias("score"),
            )
            for number, _, _, weights, intercept in run.merged
        ])),
    )
    merged_auc = exact_areas(
        pooled.groupBy("round", "score").agg(
            F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
        ),
        ["round"],
    ).select("round", F.round("auc_roc", 6).alias("merged_model_auc"))
    history = own.join(local.select("round", party, "samples"), ["round", party])
    return (
        history.join(weighted_metric(history, "auc", ["round"]), "round")
        .join(merged_auc, "round")
        .select("round", F.col(party).alias("name"), "samples", "auc", "accuracy", "precision", "recall",
                F.round("global_auc", 6).alias("global_auc"), "merged_model_auc")
        .orderBy("round", "name")
    )
