"""Queries for indicators, evaluation and dashboard tables that need no trained model."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import AMOUNT_CLUSTERS, RISK_BANDS, Bands, bucketize, hour_of_day, rate_pct
from ..operators import cleaning, evaluation, kpis
from ..schema import FEATURES, decimals_to_double
from ..sources.tables import read_table
from ..sources.transactions import EPOCH, raw_transactions, transactions
from ..streaming.scoring import apply_rules
from . import marts
from . import oracle as o
from .catalog import query
from .queries_tables import scored_transactions


def cleaned(spark, sf):
    return cleaning.clean_transactions(raw_transactions(spark, sf))


_MONEY = (
    f"{o.rnd('avg(Amount)', 2)} AS avg_amount, {o.rnd('min(Amount)', 2)} AS min_amount, "
    f"{o.rnd('max(Amount)', 2)} AS max_amount, {o.rnd('stddev_samp(Amount)', 2)} AS stddev_amount"
)
_OVERALL = (
    f"count(*) AS total_transactions, {o.FRAUDS} AS fraud_count, {o.NORMALS} AS normal_count, "
    f"{o.pct(o.FRAUDS, 'count(*)')} AS fraud_rate, {_MONEY}"
)


@query("kpi_overall", f"WITH {o.CLEANING} SELECT {_OVERALL} FROM clean")
def _(spark, sf):
    return kpis.overall(cleaned(spark, sf))


@query(
    "kpi_class_comparison",
    f"WITH {o.CLEANING} SELECT Class, CASE WHEN Class = 1 THEN 'Fraud' ELSE 'Normal' END AS class_name, count(*) AS count, "
    f"{o.rnd('avg(Amount)', 2)} AS avg_amount, {o.rnd('quantile_cont(Amount, 0.5)', 2)} AS median_amount, "
    f"{o.rnd('max(Amount)', 2)} AS max_amount FROM clean GROUP BY Class",
)
def _(spark, sf):
    return kpis.class_comparison(cleaned(spark, sf))


@query(
    "kpi_hourly",
    f"WITH {o.CLEANING} SELECT Hour, count(*) AS total_count, {o.FRAUDS} AS fraud_count, "
    f"{o.rnd('sum(Amount)', 2)} AS total_amount, {o.rnd('avg(Amount)', 2)} AS avg_amount FROM clean GROUP BY Hour",
)
def _(spark, sf):
    return kpis.hourly(cleaned(spark, sf))


_BUCKETS = f"count(*) AS count, {o.FRAUDS} AS fraud_count, {o.pct(o.FRAUDS, 'count(*)')} AS fraud_rate"


@query("kpi_amount_buckets", f"WITH {o.CLEANING} SELECT {o.BUCKET} AS amount_bucket, {_BUCKETS} FROM clean GROUP BY 1")
def _(spark, sf):
    return kpis.amount_buckets(cleaned(spark, sf))


def _class_means(features):
    return ", ".join(
        f"{o.rnd(f'avg(CASE WHEN Class = {k} THEN {f} END)', 4)} AS {f}_{kind}_avg"
        for f in features
        for kind, k in (("fraud", 1), ("normal", 0))
    )


@query("kpi_feature_class_means", f"WITH {o.CLEANING} SELECT {_class_means(kpis.KPI_COMPONENTS)} FROM clean")
def _(spark, sf):
    return kpis.feature_class_means(cleaned(spark, sf))


# the same indicators on another table: returned lines of an order stand for frauds
_LINES = "lines AS (SELECT l_extendedprice AS Amount, CAST(l_returnflag = 'R' AS INTEGER) AS Class, l_linestatus FROM lineitem)"


def line_items(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("price"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
    )


@query("kpi_overall_lineitem", f"WITH {_LINES} SELECT {_OVERALL} FROM lines")
def _(spark, sf):
    return kpis.overall(line_items(spark, sf), "price", "returned")


@query(
    "kpi_class_comparison_lineitem",
    f"WITH {_LINES} SELECT Class AS returned, CASE WHEN Class = 1 THEN 'Fraud' ELSE 'Normal' END AS class_name, count(*) AS count, "
    f"{o.rnd('avg(Amount)', 2)} AS avg_amount, {o.rnd('quantile_cont(Amount, 0.5)', 2)} AS median_amount, "
    f"{o.rnd('max(Amount)', 2)} AS max_amount FROM lines GROUP BY Class",
)
def _(spark, sf):
    return kpis.class_comparison(line_items(spark, sf), "price", "returned")


_PRICE_BANDS = Bands((1000, 10000, 50000, 90000), ("<1k", "1k-10k", "10k-50k", "50k-90k", "90k+"))


@query(
    "kpi_amount_buckets_lineitem",
    f"WITH {_LINES} SELECT {o.case_bands('Amount', _PRICE_BANDS)} AS amount_bucket, {_BUCKETS} FROM lines GROUP BY 1",
)
def _(spark, sf):
    return kpis.amount_buckets(line_items(spark, sf), "price", "returned", _PRICE_BANDS)


@query("class_counts", f"WITH {o.tx([])} SELECT Class, count(*) AS count FROM tx GROUP BY Class")
def _(spark, sf):
    return kpis.class_counts(transactions(spark, sf, []))


@query(
    "hourly_counts_raw",
    f"WITH {o.tx([])} SELECT {o.HOUR} AS hour, count(*) AS transactions, {o.FRAUDS} AS frauds FROM tx GROUP BY 1",
)
def _(spark, sf):
    return kpis.hourly_counts(transactions(spark, sf, []))


@query(
    "class_amount_summary",
    f"WITH {o.tx([])} SELECT Class, count(*) AS count, {o.rnd('avg(Amount)', 2)} AS avg_amount, "
    f"{o.rnd('max(Amount)', 2)} AS max_amount FROM tx GROUP BY Class",
)
def _(spark, sf):
    return kpis.class_amounts(transactions(spark, sf, []))


_DESCRIBED = ["event_id", "user_id", "Time", *FEATURES, "Class"]


@query(
    "describe_table",
    f"WITH {o.tx()} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, {o.rnd(f'avg({c})', 4)} AS mean, {o.rnd(f'stddev_samp({c})', 4)} AS stddev, "
        f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM tx"
        for c in _DESCRIBED
    ),
)
def _(spark, sf):
    stats = kpis.describe(transactions(spark, sf))
    return stats.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query(
    "fraud_amount_clusters",
    f"WITH {o.tx(['V1', 'V14', 'V17'])} SELECT {o.case_bands('Amount', AMOUNT_CLUSTERS)} AS cluster, count(*) AS count, "
    + ", ".join(f"{o.rnd(f'avg({c})', 6)} AS avg_{c.replace('Amount', 'amount')}" for c in ("Amount", "V1", "V14", "V17"))
    + " FROM tx WHERE Class = 1 GROUP BY 1",
)
def _(spark, sf):
    clusters = kpis.fraud_amount_clusters(transactions(spark, sf, ["V1", "V14", "V17"]))
    return clusters.withColumns({c: F.round(c, 6) for c in clusters.columns if c.startswith("avg_")})


@query(
    "hourly_fraud",
    f"WITH {o.tx([])} SELECT {o.HOUR} AS hour, count(*) AS fraud_count FROM tx WHERE Class = 1 GROUP BY 1",
)
def _(spark, sf):
    return kpis.hourly_frauds(transactions(spark, sf, []))


@query(
    "risk_communities",
    f"WITH {o.tx(['V14'])} SELECT {o.case_bands('V14', RISK_BANDS)} AS community, count(*) AS size, "
    f"{o.rnd('avg(Amount)', 2)} AS avg_amount, {o.rnd('avg(V14)', 4)} AS avg_V14 FROM tx WHERE Class = 1 GROUP BY 1",
)
def _(spark, sf):
    return kpis.risk_communities(transactions(spark, sf, ["V14"]))


@query(
    "dense_fraud_cells",
    f"WITH {o.tx(['V14'])} SELECT CAST(trunc(V14 * 2) AS INTEGER) AS v14_bucket, CAST(trunc(Amount / 50) AS INTEGER) AS amount_bucket, "
    "count(*) AS count FROM tx WHERE Class = 1 GROUP BY 1, 2 HAVING count(*) >= 3",
)
def _(spark, sf):
    return kpis.dense_fraud_cells(transactions(spark, sf, ["V14"]))


_BATCH_METRICS = (
    "count(*) AS total_transactions, count(*) FILTER (WHERE prediction = 1) AS fraud_detected, "
    f"{o.FRAUDS} AS actual_fraud, {o.rnd('avg(Amount)', 2)} AS avg_amount, {o.rnd('max(fraud_score)', 4)} AS max_fraud_score, "
    f"{o.pct('count(*) FILTER (WHERE prediction = 1)', 'count(*)')} AS fraud_rate"
)


@query("batch_metrics", f"WITH {o.SCORED} SELECT {_BATCH_METRICS} FROM scored")
def _(spark, sf):
    scored = scored_transactions(spark, sf)
    return scored.agg(*kpis.batch_metrics(scored))


@query(
    "class_ratio",
    f"WITH {o.tx([])}, s AS (SELECT {o.FRAUDS} AS f, {o.NORMALS} AS n, avg(Amount) FILTER (Class = 1) AS af, avg(Amount) FILTER (Class = 0) AS an FROM tx) "
    f"SELECT {o.rnd(o.div('n', 'f'), 4)} AS normal_per_fraud, {o.rnd('af / an', 4)} AS amount_ratio, {o.rnd('(af / an - 1) * 100', 2)} AS amount_excess_pct FROM s",
)
def _(spark, sf):
    return kpis.class_ratio(transactions(spark, sf, []))


_SEPARATION = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, avg({f}) FILTER (Class = 1) AS f, avg({f}) FILTER (Class = 0) AS n FROM tx"
    for f in kpis.SEPARATION_COMPONENTS
)


@query(
    "feature_separation",
    f"WITH {o.tx(list(kpis.SEPARATION_COMPONENTS))}, s AS ({_SEPARATION}) SELECT feature, {o.rnd('f', 4)} AS fraud_avg, "
    f"{o.rnd('n', 4)} AS normal_avg, {o.rnd('abs(f - n)', 4)} AS separation FROM s",
)
def _(spark, sf):
    return kpis.feature_separation(transactions(spark, sf, list(kpis.SEPARATION_COMPONENTS)))


# --- evaluation of the rules as a classifier ---

@query("confusion_matrix", f"WITH {o.SCORED} SELECT {o.CELLS} FROM scored")
def _(spark, sf):
    return evaluation.confusion_matrix(scored_transactions(spark, sf))


@query("accuracy", f"WITH {o.SCORED} SELECT {o.rnd('avg(CAST(Class = prediction AS INTEGER))', 6)} AS accuracy FROM scored")
def _(spark, sf):
    return evaluation.accuracy(scored_transactions(spark, sf)).select(F.round("accuracy", 6).alias("accuracy"))


@query(
    "weighted_precision_recall_f1",
    f"WITH {o.SCORED}, cells AS (SELECT {o.CELLS} FROM scored) SELECT tp, fp, tn, fn, {o.WEIGHTED_MEASURES} FROM cells",
)
def _(spark, sf):
    return evaluation.weighted_metrics(evaluation.confusion_matrix(scored_transactions(spark, sf)))


@query(
    "fraud_precision_recall_f1",
    f"WITH {o.SCORED}, cells AS (SELECT {o.CELLS} FROM scored) SELECT tp, fp, tn, fn, {o.FRAUD_MEASURES} FROM cells",
)
def _(spark, sf):
    return evaluation.fraud_metrics(evaluation.confusion_matrix(scored_transactions(spark, sf)))


# -V14 is a continuous score: as many thresholds as rows
@query("auc_roc", f"WITH {o.tx(['V14'])}, {o.areas('tx', '-V14')} SELECT {o.rnd('auc_roc', 8)} AS auc_roc FROM area")
def _(spark, sf):
    rows = transactions(spark, sf, ["V14"]).withColumn("score", -F.col("V14"))
    return evaluation.auc_roc(rows, "score").select(F.round("auc_roc", 8).alias("auc_roc"))


@query("auc_pr", f"WITH {o.tx(['V14'])}, {o.areas('tx', '-V14')} SELECT {o.rnd('auc_pr', 8)} AS auc_pr FROM area")
def _(spark, sf):
    rows = transactions(spark, sf, ["V14"]).withColumn("score", -F.col("V14"))
    return evaluation.auc_pr(rows, "score").select(F.round("auc_pr", 8).alias("auc_pr"))


@query(
    "evaluate_model",
    f"WITH {o.SCORED}, cells AS (SELECT {o.CELLS} FROM scored), {o.areas('scored', 'fraud_score')} "
    f"SELECT 'rules' AS model, {o.rnd('auc_roc', 4)} AS auc_roc, {o.rnd('auc_pr', 4)} AS auc_pr, {o.WEIGHTED_MEASURES}, "
    f"{o.FRAUD_MEASURES}, tp, fp, tn, fn FROM cells, area",
)
def _(spark, sf):
    return evaluation.evaluate(scored_transactions(spark, sf), "rules", "fraud_score")


def _curve(source, score):
    return (
        f"sc AS (SELECT {score} AS threshold, {o.FRAUDS} AS pos, {o.NORMALS} AS neg FROM {source} GROUP BY 1), "
        "cum AS (SELECT threshold, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n "
        "FROM sc WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)) "
        f"SELECT threshold, tp, fp, {o.rnd(o.div('tp', 'p'), 6)} AS tpr, {o.rnd(o.div('fp', 'n'), 6)} AS fpr, "
        f"{o.rnd(o.div('tp', 'tp + fp'), 6)} AS precision, {o.rnd(o.div('tp', 'p'), 6)} AS recall FROM cum"
    )


@query("roc_pr_curve", f"WITH {o.tx(['V14'])}, {_curve('tx', o.rnd('-V14', 4))}")
def _(spark, sf):
    rows = transactions(spark, sf, ["V14"]).withColumn("score", -F.col("V14"))
    return evaluation.roc_pr_curve(rows, "score", digits=4)


@query(
    "class_distribution",
    f"WITH {o.tx([])} SELECT Class, count(*) AS count, {o.rnd('avg(Amount)', 2)} AS avg_amount, "
    f"{o.pct('count(*)', '(SELECT count(*) FROM tx)')} AS share_pct, CASE WHEN Class = 1 THEN 'Fraud' ELSE 'Normal' END AS class_name FROM tx GROUP BY Class",
)
def _(spark, sf):
    return kpis.class_shares(transactions(spark, sf, []))


@query(
    "model_comparison_rules",
    f"WITH {o.SCORED}, strict AS (SELECT Class, CAST(fraud_score > 0.8 AS INTEGER) AS prediction FROM scored), "
    f"a AS (SELECT {o.CELLS} FROM scored), b AS (SELECT {o.CELLS} FROM strict), "
    f"am AS (SELECT {o.WEIGHTED_MEASURES}, {o.FRAUD_MEASURES} FROM a), bm AS (SELECT {o.WEIGHTED_MEASURES}, {o.FRAUD_MEASURES} FROM b), "
    f"{o.areas('scored', 'fraud_score')}, "
    + "m AS ("
    + " UNION ALL ".join(
        [f"SELECT '{m}' AS metric, am.{m} AS rules, bm.{m} AS strict FROM am, bm" for m in evaluation.MEASURES[2:]]
        + [f"SELECT '{m}', {o.rnd(m, 4)}, {o.rnd(m, 4)} FROM area" for m in ("auc_roc", "auc_pr")]
    )
    + ") SELECT metric, rules, strict, CASE WHEN rules > strict THEN 'rules' WHEN strict > rules THEN 'strict' ELSE '=' END AS winner FROM m",
)
def _(spark, sf):
    table = transactions(spark, sf, o.RULE_COMPONENTS)
    rules = evaluation.evaluate(apply_rules(table), "rules", "fraud_score")
    strict = evaluation.evaluate(apply_rules(table, threshold=0.8), "strict", "fraud_score")
    rows = evaluation.long_metrics(rules).unionByName(evaluation.long_metrics(strict))
    return evaluation.compare_models(rows, ["rules", "strict"])


# --- dashboard tables ---

@query(
    "mart_hourly",
    f"WITH {o.tx([])} SELECT strftime(TIMESTAMP '{EPOCH}' + to_seconds(CAST(max(floor(Time / 3600)) * 3600 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS timestamp, "
    f"{o.HOUR} AS hour, count(*) AS total_transactions, {o.FRAUDS} AS fraud_detected, {o.pct(o.FRAUDS, 'count(*)')} AS fraud_rate, "
    f"{o.rnd('avg(Amount)', 2)} AS avg_amount FROM tx GROUP BY hour",
)
def _(spark, sf):
    return marts.hourly(transactions(spark, sf, []))


@query("mart_amount_distribution", f"WITH {o.tx([])} SELECT {o.BUCKET} AS bucket, {_BUCKETS} FROM tx GROUP BY 1")
def _(spark, sf):
    return marts.amount_distribution(transactions(spark, sf, []))


@query(
    "mart_confusion_matrix",
    f"WITH {o.SCORED} SELECT CASE WHEN Class = 1 THEN 'Fraud' ELSE 'Normal' END AS Actual, "
    "count(*) FILTER (WHERE prediction = 0) AS \"Predicted Normal\", count(*) FILTER (WHERE prediction = 1) AS \"Predicted Fraud\" FROM scored GROUP BY Class",
)
def _(spark, sf):
    return marts.confusion_table(scored_transactions(spark, sf))


@query(
    "mart_recent_alerts",
    f"WITH {o.SCORED} SELECT strftime(TIMESTAMP '{EPOCH}' + to_microseconds(CAST(round(Time * 1000000) AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS timestamp, "
    f"'TXN' || event_id AS transaction_id, {o.rnd('Amount', 2)} AS amount, {o.rnd('fraud_score', 4)} AS fraud_score, is_alert "
    "FROM scored WHERE prediction = 1 ORDER BY Time DESC, event_id LIMIT 20",
)
def _(spark, sf):
    return marts.recent_alerts(scored_transactions(spark, sf))
