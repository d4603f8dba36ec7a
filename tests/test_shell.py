"""Scoring and evaluation from the shell."""

import pytest

from riskloom.__main__ import main
from riskloom.operators import models
from riskloom.plans import jobs
from riskloom.schema import FEATURES, LABEL, TIME
from riskloom.sources import tables
from riskloom.sources.transactions import transactions

KEYS = ["event_id"]


@pytest.fixture(scope="module")
def fitted(spark, sf, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shell"))
    model, held_out = jobs.fit_forest(transactions(spark, sf).dropna(subset=[*FEATURES, LABEL]), KEYS)
    models.save_model(model, f"{folder}/model")
    tables.write_parquet(held_out, f"{folder}/held_out")
    tables.write_csv(held_out.select(*dict.fromkeys([TIME, *FEATURES, LABEL])), f"{folder}/feed")
    return folder


def test_score_and_evaluate(spark, fitted, tmp_path):
    out = str(tmp_path)
    main(["score", "--input", f"{fitted}/held_out", "--format", "parquet", "--model", f"{fitted}/model", "--output", out])
    scored = spark.read.parquet(f"{out}/scored")
    rows = {(r.label, r.prediction): r["count"] for r in scored.groupBy(scored[LABEL].alias("label"), "prediction").count().collect()}
    main(["evaluate", "--input", out, "--models", "scored", "--output", f"{out}/report"])
    document = spark.read.json(f"{out}/report/evaluation").first()
    (quality,) = document.models
    assert (quality.tp, quality.fp, quality.tn, quality.fn) == tuple(rows.get(k, 0) for k in ((1, 1), (0, 1), (0, 0), (1, 0)))
    assert document.best.best_model == "scored" and document.best.auc_roc == quality.auc_roc
    assert sum(c["count"] for c in document.class_distribution) == scored.count() == spark.read.parquet(f"{fitted}/held_out").count()
    curve = spark.read.csv(f"{out}/report/curves/scored", header=True, inferSchema=True)
    last = curve.orderBy("threshold").first()
    assert (last.tpr, last.fpr) == (1, 1)
    tables.write_parquet(scored.withColumn("prediction", 1 - scored["prediction"]), f"{out}/turned")
    main(["evaluate", "--input", out, "--models", "scored", "turned", "--output", f"{out}/both"])
    compared = {r.metric: r for r in spark.read.csv(f"{out}/both/model_comparison", header=True, inferSchema=True).collect()}
    assert len(compared) == 9 and compared["auc_roc"].winner == "=" and compared["accuracy"].winner == "scored"
    assert compared["accuracy"].turned == pytest.approx(1 - compared["accuracy"].scored, abs=1e-3)


def test_score_stream(spark, fitted, tmp_path):
    main(["score-stream", "--input", f"{fitted}/feed", "--model", f"{fitted}/model", "--output", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "c")])
    assert spark.read.parquet(str(tmp_path / "out" / "scored")).count() == spark.read.parquet(f"{fitted}/held_out").count()


def test_missing_arguments():
    for job in ("score", "score-stream", "evaluate"):
        with pytest.raises(SystemExit):
            main([job, "--input", "a", "--output", "b"])
