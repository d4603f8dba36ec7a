"""Run a job from the shell: python -m riskloom JOB --input PATH --output PATH."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from .operators import cleaning, evaluation, models
from .plans import jobs
from .schema import FEATURES, LABEL, TIME, feed_schema
from .session import cut_lineage, get_session, work_dir
from .sources import tables
from .streaming import sources

KEY = "event_id"
JOBS = ["kpi", "ml", "score", "evaluate", "graph", "federated", "stream", "score-stream", "events", "replay", "dashboard"]


def read_transactions(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A Parquet table, or CSV with the columns of a transaction feed; rows without a key get one."""
    if kind == "parquet":
        df = spark.read.parquet(path)
    else:
        df = tables.read_csv(spark, path, feed_schema(tables.csv_columns(spark, path)))
    return df if KEY in df.columns else cut_lineage(tables.with_key(df, TIME))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="riskloom", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--master", help="Spark master; left to spark-submit when absent")
    parser.add_argument("--checkpoint", help="folder for the stream's progress; a fresh one when absent")
    parser.add_argument("--timeout", type=float, help="seconds after which the stream job stops")
    parser.add_argument("--rows-per-batch", type=int, default=50)
    parser.add_argument("--rel-err", type=float, default=0.0, help="error allowed for the outlier threshold")
    parser.add_argument("--epsilon", type=float, help="privacy budget of all rounds of the federated job")
    parser.add_argument("--noise-seed", help="secret seed of the federated job's noise; needed with --epsilon")
    parser.add_argument("--interval", help='keep the stream running with a batch every so often, as "10 seconds"')
    parser.add_argument("--model", help="saved model of the jobs score and score-stream")
    parser.add_argument("--models", nargs="+", help="Parquet tables of predictions below --input that the evaluate job compares")
    args = parser.parse_args(argv)
    if args.job in ("score", "score-stream") and not args.model:
        parser.error("--model is needed")
    if args.job == "evaluate" and not args.models:
        parser.error("--models is needed")
    spark = get_session(f"riskloom-{args.job}", args.master)

    if args.job in ("stream", "score-stream", "events"):
        checkpoint = args.checkpoint or work_dir(spark, "stream-checkpoint")
        if args.job == "stream":
            jobs.streaming_job(spark, args.input, args.output, checkpoint, args.timeout, args.interval)
        elif args.job == "events":
            jobs.events_job(spark, args.input, args.output, checkpoint, args.timeout, args.interval)
        else:
            jobs.model_stream_job(spark, args.input, args.model, args.output, checkpoint, args.interval, args.timeout)
        return
    if args.job == "evaluate":
        jobs.evaluate_job({name: spark.read.parquet(f"{args.input}/{name}") for name in args.models}, args.output)
        return
    df = read_transactions(spark, args.input, args.format)
    if args.job == "kpi":
        jobs.kpi_job(df, args.output, args.rel_err)
    elif args.job == "ml":
        jobs.ml_job(df, args.output, [KEY]).show()
    elif args.job == "score":
        jobs.score_job(df, args.model, args.output)
    elif args.job == "graph":
        jobs.graph_job(df, args.output, KEY)
    elif args.job == "federated":
        jobs.federated_job(df, args.output, KEY, args.epsilon, args.noise_seed).show()
    elif args.job == "replay":
        sources.write_replay(df, args.output, [KEY], args.rows_per_batch)
    else:
        usable = cleaning.drop_nulls(df, [*FEATURES, LABEL])
        model, test = jobs.fit_forest(usable, [KEY])
        predictions = models.score(model, test)
        jobs.dashboard_job(
            df, evaluation.evaluate(predictions, "RandomForest"), models.tree_importance(spark, model), predictions, args.output
        )


if __name__ == "__main__":
    main()
