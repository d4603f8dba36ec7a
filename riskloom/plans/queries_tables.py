"""Queries for sources, sinks, cleaning, scalar expressions, ordering and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    AMOUNT_BUCKETS, AMOUNT_CLUSTERS, RISK_BANDS, alert_label, bucketize, class_name, high_amount,
    hour_of_day, key_hash, positive_log1p, positive_rounded, rate_pct, rule_score, status_band,
    threshold_prediction, uniform_hash, vector_element,
)
from ..operators import cleaning, evaluation, kpis, models, sampling
from ..schema import COMPONENTS, FEATURES, KEYED_TRANSACTION_SCHEMA, decimals_to_double
from ..session import cut_lineage, work_dir
from ..sources import tables
from ..sources.transactions import raw_transactions, transactions
from ..streaming.scoring import alerts_only, apply_rules
from . import oracle as o
from .catalog import query

TX_COLUMNS = ", ".join(["event_id", "user_id", "Time", *FEATURES, "Class"])
SLIM = "event_id, user_id, Time, Amount, Class"


def scored_transactions(spark, sf):
    return apply_rules(transactions(spark, sf, o.RULE_COMPONENTS))


# --- sources ---

@query("csv_scan_typed", f"WITH {o.tx()} SELECT {TX_COLUMNS} FROM tx")
def _(spark, sf):
    path = tables.write_csv(transactions(spark, sf), work_dir(spark, "csv"))
    return tables.read_csv(spark, path, KEYED_TRANSACTION_SCHEMA)


@query("csv_scan_inferred", f"WITH {o.tx([])} SELECT CAST(event_id AS INTEGER) AS event_id, CAST(user_id AS INTEGER) AS user_id, Time, Amount, Class FROM tx")
def _(spark, sf):
    path = tables.write_csv(transactions(spark, sf, []), work_dir(spark, "csv"))
    return tables.read_csv(spark, path)


EVENT_BODY = T.StructType([T.StructField("k", T.LongType())])


@query("json_event_parse", "SELECT CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events")
def _(spark, sf):
    parsed = tables.parse_json_events(tables.read_table(spark, sf, "events"), EVENT_BODY, "props")
    return tables.accepted(parsed)


@query("json_event_rejects", "SELECT event_type AS _malformed FROM events")
def _(spark, sf):
    # plain text in place of JSON: every row must come out as rejected, none may be lost
    parsed = tables.parse_json_events(tables.read_table(spark, sf, "events"), EVENT_BODY, "event_type")
    return tables.rejected(parsed)


@query(
    "rows_to_table",
    f"WITH {o.tx([])} SELECT {o.HOUR} AS hour, count(*) AS transactions, {o.FRAUDS} AS frauds FROM tx GROUP BY 1",
)
def _(spark, sf):
    rows = [r.asDict() for r in kpis.hourly_counts(transactions(spark, sf, [])).collect()]  # 24 at most
    return tables.rows_to_table(spark, rows, "hour int, transactions long, frauds long")


@query("temp_view", f"WITH {o.tx([])} SELECT Class, count(*) AS count FROM tx GROUP BY Class")
def _(spark, sf):
    tables.register_view(transactions(spark, sf, []), "transactions")
    return spark.sql("SELECT Class, count(*) AS count FROM transactions GROUP BY Class")


# --- sinks, read back ---

@query("parquet_sink", f"WITH {o.CLEANING} SELECT {TX_COLUMNS}, Hour, Amount_Log, Is_High_Amount FROM clean")
def _(spark, sf):
    clean = cleaning.clean_transactions(raw_transactions(spark, sf))
    return spark.read.parquet(tables.write_parquet(clean, work_dir(spark, "clean")))


@query(
    "csv_sink",
    f"WITH {o.tx([])} SELECT {o.BUCKET} AS amount_bucket, count(*) AS count, {o.FRAUDS} AS fraud_count, "
    f"{o.pct(o.FRAUDS, 'count(*)')} AS fraud_rate FROM tx GROUP BY 1",
)
def _(spark, sf):
    report = kpis.amount_buckets(transactions(spark, sf, []))
    path = tables.write_csv(report, work_dir(spark, "buckets"))
    return tables.read_csv(spark, path, report.schema)


@query(
    "json_metrics_sink",
    f"WITH {o.tx([])} SELECT count(*) AS total_transactions, {o.FRAUDS} AS fraud_count, "
    f"{o.pct(o.FRAUDS, 'count(*)')} AS fraud_rate FROM tx",
)
def _(spark, sf):
    total = kpis.overall(transactions(spark, sf, [])).select(F.struct("*").alias("overall"))
    path = tables.write_json(total, work_dir(spark, "metrics"))
    return spark.read.schema(decimals_to_double(total).schema).json(path).select(
        "overall.total_transactions", "overall.fraud_count", "overall.fraud_rate"
    )


@query(
    "decimal_to_double",
    f"WITH {o.tx([])} SELECT Class, CAST(sum(CAST(Amount AS DECIMAL(18, 2))) AS DOUBLE) AS total, "
    "CAST(max(CAST(Amount AS DECIMAL(18, 2))) AS DOUBLE) AS highest FROM tx GROUP BY Class",
)
def _(spark, sf):
    exact = F.col("Amount").cast("decimal(18,2)")
    nested = transactions(spark, sf, []).groupBy("Class").agg(
        F.struct(F.sum(exact).alias("total"), F.array(F.max(exact)).alias("top")).alias("money")
    )
    return decimals_to_double(nested).select(
        "Class", F.col("money.total").alias("total"), F.col("money.top")[0].alias("highest")
    )


# --- cleaning ---

@query("drop_nulls", f"WITH {o.CLEANING} SELECT {TX_COLUMNS} FROM complete")
def _(spark, sf):
    return cleaning.drop_nulls(raw_transactions(spark, sf))


@query("positive_amount", f"WITH {o.tx([], raw=True)} SELECT {SLIM} FROM tx WHERE Amount > 0")
def _(spark, sf):
    return cleaning.positive_amount(raw_transactions(spark, sf, []))


@query(
    "quantile_outlier_filter",
    f"WITH {o.tx([])}, bound AS (SELECT quantile_cont(Amount, 0.999) AS threshold FROM tx WHERE Class = 0) "
    f"SELECT {SLIM} FROM tx WHERE Amount <= (SELECT threshold FROM bound) OR Class = 1",
)
def _(spark, sf):
    return cleaning.outlier_filter(transactions(spark, sf, []))


@query(
    "outlier_threshold",
    f"WITH {o.tx([])} SELECT {o.rnd('quantile_cont(Amount, 0.999)', 6)} AS threshold FROM tx WHERE Class = 0",
)
def _(spark, sf):
    return cleaning.amount_threshold(transactions(spark, sf, [])).select(F.round("threshold", 6).alias("threshold"))


@query("class_filter", f"WITH {o.tx([])} SELECT {SLIM} FROM tx WHERE Class = 1")
def _(spark, sf):
    return cleaning.with_label(transactions(spark, sf, []))


@query("alert_filter", f"WITH {o.SCORED} SELECT event_id, fraud_score, prediction, is_alert FROM scored WHERE prediction = 1")
def _(spark, sf):
    return alerts_only(scored_transactions(spark, sf)).select("event_id", "fraud_score", "prediction", "is_alert")


@query(
    "having_min_count",
    f"WITH {o.tx([])} SELECT user_id, count(*) AS count FROM tx GROUP BY user_id HAVING count(*) >= 3",
)
def _(spark, sf):
    return kpis.min_count_groups(transactions(spark, sf, []), ["user_id"], 3)


_V1_USABLE = "V1 IS NOT NULL AND Amount IS NOT NULL"


@query("skip_invalid_features", f"WITH {o.tx(raw=True)} SELECT {TX_COLUMNS} FROM tx WHERE {_V1_USABLE}")
def _(spark, sf):
    vectors = models.assembler(skip_invalid=True).transform(raw_transactions(spark, sf))
    return vectors.drop("features_raw")


@query("valid_features", f"WITH {o.tx(raw=True)} SELECT {TX_COLUMNS} FROM tx WHERE {_V1_USABLE}")
def _(spark, sf):
    return cleaning.valid_features(raw_transactions(spark, sf), FEATURES)


@query(
    "clean_report",
    f"WITH {o.CLEANING}, c AS (SELECT (SELECT count(*) FROM tx) AS rows_before, (SELECT count(*) FROM clean) AS rows_after) "
    "SELECT rows_before, rows_after, rows_before - rows_after AS rows_removed, "
    f"{o.pct('rows_before - rows_after', 'rows_before', 2)} AS removed_pct FROM c",
)
def _(spark, sf):
    return cleaning.clean_report(raw_transactions(spark, sf))


@query("clean_transactions", f"WITH {o.CLEANING} SELECT {TX_COLUMNS}, Hour, Amount_Log, Is_High_Amount FROM clean")
def _(spark, sf):
    return cleaning.clean_transactions(raw_transactions(spark, sf))


# --- scalar expressions ---

def _scalar(name, sql, column, components=()):
    components = list(components)

    @query(name, f"WITH {o.tx(components)} SELECT event_id, {sql} AS {name} FROM tx")
    def _(spark, sf):
        return transactions(spark, sf, components).select("event_id", column().alias(name))


_scalar("hour_of_day", o.HOUR, lambda: hour_of_day(F.col("Time")))
_scalar("amount_rounded", f"CASE WHEN Amount > 0 THEN {o.rnd('Amount', 2)} ELSE 0e0 END", lambda: positive_rounded(F.col("Amount")))
_scalar("amount_log1p", o.rnd("CASE WHEN Amount > 0 THEN ln(1 + Amount) ELSE 0e0 END", 6), lambda: F.round(positive_log1p(F.col("Amount")), 6))
_scalar("high_amount_flag", "CAST(Amount > 500 AS INTEGER)", lambda: high_amount(F.col("Amount")))
_scalar("amount_bucket6", o.BUCKET, lambda: bucketize(F.col("Amount"), AMOUNT_BUCKETS))
_scalar("amount_cluster4", o.case_bands("Amount", AMOUNT_CLUSTERS), lambda: bucketize(F.col("Amount"), AMOUNT_CLUSTERS))
_scalar("risk_community", o.case_bands("V14", RISK_BANDS), lambda: bucketize(F.col("V14"), RISK_BANDS), ["V14"])
_scalar("rule_score", o.SCORE, rule_score, o.RULE_COMPONENTS)
_scalar("threshold_prediction", f"CAST({o.SCORE} > 0.5 AS INTEGER)", lambda: threshold_prediction(rule_score()), o.RULE_COMPONENTS)
_scalar("alert_label", f"CASE WHEN {o.SCORE} > 0.5 THEN 'FRAUD_ALERT' ELSE 'NORMAL' END", lambda: alert_label(rule_score()), o.RULE_COMPONENTS)
_scalar("class_name", "CASE WHEN Class = 1 THEN 'Fraud' ELSE 'Normal' END", lambda: class_name(F.col("Class")))
_scalar("key_hash", o.keyhash("event_id", "42"), lambda: key_hash(F.col("event_id")))


@query(
    "grid_bucket",
    f"WITH {o.tx(['V14'])} SELECT event_id, CAST(trunc(V14 * 2) AS INTEGER) AS v14_bucket, "
    "CAST(trunc(Amount / 50) AS INTEGER) AS amount_bucket FROM tx WHERE Class = 1",
)
def _(spark, sf):
    return kpis.fraud_cells(transactions(spark, sf, ["V14"])).select("event_id", "v14_bucket", "amount_bucket")


@query("processing_time", "SELECT event_id, true AS stamped FROM events")
def _(spark, sf):
    stamped = transactions(spark, sf, []).withColumn("processing_time", F.current_timestamp())
    return stamped.select("event_id", F.col("processing_time").isNotNull().alias("stamped"))


@query("row_id", f"WITH {o.tx([])} SELECT event_id, row_number() OVER (ORDER BY Time, event_id) AS row_id FROM tx")
def _(spark, sf):
    from ..operators.ordered import number_rows

    return number_rows(transactions(spark, sf, []), ["Time", "event_id"], "row_id").select("event_id", "row_id")


@query(
    "fraud_rate_pct",
    f"WITH {o.tx([])} SELECT user_id, {o.pct(o.FRAUDS, 'count(*)')} AS fraud_rate FROM tx GROUP BY user_id",
)
def _(spark, sf):
    return transactions(spark, sf, []).groupBy("user_id").agg(
        rate_pct(F.count_if(F.col("Class") == 1), F.count("*")).alias("fraud_rate")
    )


@query("vector_element", f"WITH {o.tx(['V1', 'V14'])} SELECT event_id, V14 AS element FROM tx")
def _(spark, sf):
    vectors = models.assembler(["V1", "V14"], "v").transform(transactions(spark, sf, ["V1", "V14"]))
    return vectors.select("event_id", vector_element(F.col("v"), 1).alias("element"))


@query("rename_drop_select", f"WITH {o.tx([])} SELECT event_id AS transaction_id, Amount AS amount FROM tx")
def _(spark, sf):
    return (
        transactions(spark, sf, [])
        .withColumnsRenamed({"event_id": "transaction_id", "Amount": "amount"})
        .drop("user_id")
        .select("transaction_id", "amount")
    )


@query(
    "status_band",
    f"WITH {o.SCORED}, cells AS (SELECT {o.CELLS} FROM scored), w AS (SELECT {o.WEIGHTED_MEASURES} FROM cells), "
    f"rate AS (SELECT {o.pct(o.FRAUDS, 'count(*)')} AS fraud_rate, "
    f"{o.rnd('max(fraud_score)', 4)} AS fraud_score FROM scored), "
    "m AS (SELECT unnest(['accuracy', 'precision', 'recall', 'f1_score', 'fraud_rate', 'fraud_score']) AS metric, "
    "unnest([accuracy, precision, recall, f1_score, fraud_rate, fraud_score]) AS value FROM w, rate) "
    f"SELECT metric, value, {o.status_case()} AS band FROM m",
)
def _(spark, sf):
    scored = scored_transactions(spark, sf)
    row = scored.agg(
        *evaluation.confusion_counts(),
        rate_pct(F.count_if(F.col("Class") == 1), F.count("*")).alias("fraud_rate"),
        F.round(F.max("fraud_score"), 4).alias("fraud_score"),
    ).transform(evaluation.weighted_metrics)
    names = ["accuracy", "precision", "recall", "f1_score", "fraud_rate", "fraud_score"]
    return row.select(*names).unpivot([], names, "metric", "value").withColumn(
        "band", status_band(F.col("metric"), F.col("value"))
    )


# --- order, limit, sampling, union ---

@query("order_by", f"WITH {o.tx([])} SELECT {SLIM} FROM tx")
def _(spark, sf):
    return transactions(spark, sf, []).orderBy("Amount", "event_id")


@query(
    "order_by_custom_rank",
    f"WITH {o.tx([])} SELECT {o.BUCKET} AS amount_bucket, {o.case_bands('Amount', AMOUNT_BUCKETS, True)} AS rank, "
    "count(*) AS count FROM tx GROUP BY 1, 2",
)
def _(spark, sf):
    rank = bucketize(F.col("Amount"), AMOUNT_BUCKETS, ordinal=True)
    label = bucketize(F.col("Amount"), AMOUNT_BUCKETS)
    return (
        transactions(spark, sf, [])
        .groupBy(label.alias("amount_bucket"), rank.alias("rank"))
        .agg(F.count("*").alias("count"))
        .orderBy("rank")
    )


@query("limit_n", f"WITH {o.tx([])} SELECT {SLIM} FROM tx WHERE Class = 0 ORDER BY event_id LIMIT 1000")
def _(spark, sf):
    return sampling.first_rows(cleaning.with_label(transactions(spark, sf, []), value=0), ["event_id"], 1000)


@query("top_k", f"WITH {o.tx([])} SELECT {SLIM} FROM tx ORDER BY Amount DESC, event_id LIMIT 10")
def _(spark, sf):
    return sampling.top_k(transactions(spark, sf, []), "Amount", 10, "event_id")


@query("shuffle_rows", f"WITH {o.tx([])} SELECT {SLIM} FROM tx")
def _(spark, sf):
    return sampling.shuffle_rows(transactions(spark, sf, []), ["event_id"])


@query(
    "shuffle_positions",
    f"WITH {o.tx([])} SELECT event_id, row_number() OVER (ORDER BY {o.keyhash('event_id', sampling.SHUFFLE_SALT)}, event_id) AS position FROM tx",
)
def _(spark, sf):
    from ..operators.ordered import number_rows

    drawn = transactions(spark, sf, []).select(
        "event_id", key_hash(F.col("event_id"), salt=sampling.SHUFFLE_SALT).alias("draw")
    )
    return number_rows(drawn, ["draw", "event_id"], "position").select("event_id", "position")


_SAMPLED = o.uniform("event_id", sampling.SAMPLE_SALT)
_SPLIT = o.uniform("event_id", sampling.SPLIT_SALT)


@query(
    "union_all",
    f"WITH {o.tx([])} SELECT {SLIM} FROM tx WHERE Class = 1 UNION ALL SELECT {SLIM} FROM tx WHERE Class = 0 AND {_SAMPLED} < 0.01",
)
def _(spark, sf):
    table = transactions(spark, sf, [])
    normals = sampling.sample_fraction(cleaning.with_label(table, value=0), ["event_id"], 0.01)
    return sampling.union_all(cleaning.with_label(table), normals)


@query(
    "undersample_majority",
    f"WITH {o.tx([])}, share AS (SELECT least(1, {o.FRAUDS} * 2e0 / {o.NORMALS}) AS f FROM tx) "
    f"SELECT {SLIM} FROM tx WHERE Class = 1 OR (Class = 0 AND {_SAMPLED} < (SELECT f FROM share))",
)
def _(spark, sf):
    return sampling.undersample(transactions(spark, sf, []), ["event_id"], 2.0)


@query("fixed_fraction_sample", f"WITH {o.tx([])} SELECT {SLIM} FROM tx WHERE Class = 1 OR {_SAMPLED} < 0.01")
def _(spark, sf):
    return sampling.sample_normals(transactions(spark, sf, []), ["event_id"], 0.01)


@query("train_test_split", f"WITH {o.tx([])} SELECT {SLIM}, {_SPLIT} < 0.8 AS is_train FROM tx")
def _(spark, sf):
    return transactions(spark, sf, []).withColumn("is_train", sampling.split_side(["event_id"], 0.8))


@query(
    "train_test_split_by_class",
    f"WITH {o.tx([])} SELECT Class, {_SPLIT} < CASE WHEN Class = 1 THEN 0.5 ELSE 0.8 END AS is_train, count(*) AS count FROM tx GROUP BY ALL",
)
def _(spark, sf):
    train, test = sampling.train_test_split(
        transactions(spark, sf, []), ["event_id"], label="Class", fractions={0: 0.8, 1: 0.5}
    )
    both = sampling.union_all(train.withColumn("is_train", F.lit(True)), test.withColumn("is_train", F.lit(False)))
    return both.groupBy("Class", "is_train").agg(F.count("*").alias("count"))


@query("cache", f"WITH {o.tx([])} SELECT Class, count(*) AS count FROM tx GROUP BY Class")
def _(spark, sf):
    kept = sampling.cached(transactions(spark, sf, []))
    try:
        return cut_lineage(kpis.class_counts(kept))
    finally:
        kept.unpersist()
