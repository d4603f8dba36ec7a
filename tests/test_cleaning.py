import pytest
from pyspark.sql import functions as F

from riskloom.functions import (
    AMOUNT_BUCKETS, Bands, alert_label, bucketize, hour_of_day, positive_log1p, positive_rounded, rate_pct,
    rule_score, threshold_prediction,
)
from riskloom.operators import cleaning, kpis
from riskloom.sources import tables
from riskloom.schema import TRANSACTION_SCHEMA, decimals_to_double

SCHEMA = "event_id long, Time double, V1 double, Amount double, Class int"


@pytest.fixture
def dirty(spark):
    rows = [(i, float(i), 0.5, float(i + 1), 0) for i in range(2000)]
    rows += [(3000, 1.0, None, 5.0, 0), (3001, 1.0, 0.1, None, 0), (3002, 1.0, 0.1, 0.0, 1), (3003, 1.0, 0.1, -4.0, 0)]
    rows += [(3004, 1.0, 0.1, 1e6, 1), (3005, 1.0, 0.1, 1e6, 0)]
    return spark.createDataFrame(rows, SCHEMA)


def test_cleaning_drops_bad_rows_and_keeps_large_frauds(dirty):
    kept = {r.event_id for r in cleaning.clean_transactions(dirty).select("event_id").collect()}
    assert not kept & {3000, 3001, 3002, 3003, 3005}
    assert 3004 in kept
    # 2001 normal amounts: rank 0.999 * 2000 = 1998 falls on the amount 1999
    assert 1998 in kept and 1999 not in kept


def test_loose_sketch_lets_the_maximum_through(dirty):
    kept = {r.event_id for r in cleaning.clean_transactions(dirty, rel_err=0.01).select("event_id").collect()}
    assert 3005 in kept


def test_report_agrees_with_cleaning(dirty):
    report = cleaning.clean_report(dirty).first()
    assert report.rows_before == dirty.count()
    assert report.rows_after == cleaning.clean_transactions(dirty).count()
    assert report.rows_removed == report.rows_before - report.rows_after


def test_wide_computed_tables_stay_plannable(spark):
    wide = spark.range(10).select("id", *[(F.rand(1) * 0 + F.col("id") * i).alias(f"c{i}") for i in range(1, 40)])
    assert cleaning.drop_nulls(wide).count() == 10


def test_valid_features_rejects_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 1.0), (None, 1.0)], "a double, b double")
    assert cleaning.valid_features(df, ["a", "b"]).count() == 1


def column(spark, value, dtype, expression):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expression(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "seconds,hour", [(0.0, 0), (3599.9, 0), (3600.0, 1), (86399.0, 23), (86400.0, 0), (90000.0, 1)]
)
def test_hours_are_whole(spark, seconds, hour):
    assert column(spark, seconds, "double", hour_of_day) == hour


@pytest.mark.parametrize("amount,label", [(0.0, "0-10"), (9.99, "0-10"), (10.0, "10-50"), (999.99, "500-1000"), (1000.0, "1000+")])
def test_ranges_hold_their_lower_edge(spark, amount, label):
    assert column(spark, amount, "double", lambda x: bucketize(x, AMOUNT_BUCKETS)) == label


def test_bands_are_checked():
    with pytest.raises(ValueError):
        Bands((1, 2), ("a", "b"))
    with pytest.raises(ValueError):
        Bands((2, 1), ("a", "b", "c"))


def test_amount_log_rounds_and_log1p_takes_the_logarithm(spark):
    assert column(spark, 12.345, "double", positive_rounded) == 12.35
    assert column(spark, -1.0, "double", positive_rounded) == 0.0
    assert column(spark, 0.0, "double", positive_log1p) == 0.0


def test_rate_of_nothing_is_zero(spark):
    assert column(spark, 3, "int", lambda x: rate_pct(x, F.lit(0))) == 0.0


RULES = "V1 double, V3 double, V4 double, Amount double, V7 double, V10 double"


@pytest.mark.parametrize(
    "row,score,alert",
    [
        ((0.0, -5.0, 4.0, 2000.0, -6.0, -6.0), 0.6, 1),  # all rules but the first
        ((0.0, -5.0, 4.0, 2000.0, -6.0, 0.0), 0.5, 0),  # exactly at the threshold
        ((-3.5, 0.0, 0.0, 1.0, 0.0, 0.0), 0.7, 1),
        ((-3.0, -4.0, 3.0, 1000.0, -5.0, -5.0), 0.0, 0),  # thresholds themselves do not count
        ((None, None, 4.0, None, None, None), 0.1, 0),
    ],
)
def test_rule_scores(spark, row, score, alert):
    got = spark.createDataFrame([row], RULES).select(
        rule_score().alias("s"), threshold_prediction(rule_score()).alias("p"), alert_label(rule_score()).alias("a")
    ).first()
    assert got.s == pytest.approx(score)
    assert got.p == alert and got.a == ("FRAUD_ALERT" if alert else "NORMAL")


def test_buckets_add_up_and_stay_in_order(dirty):
    valid = dirty.filter("Amount is not null")
    rows = kpis.amount_buckets(valid).collect()
    assert sum(r["count"] for r in rows) == valid.count()
    names = [r.amount_bucket for r in rows]
    assert names == [n for n in AMOUNT_BUCKETS.labels if n in names]


def test_decimals_become_doubles_at_any_depth(spark):
    df = spark.sql("SELECT 1.5BD AS a, array(named_struct('b', 2.25BD)) AS c, map('k', 3.5BD) AS m")
    flat = decimals_to_double(df)
    assert "decimal" not in flat.schema.simpleString()
    row = flat.first()
    assert (row.a, row.c[0].b, row.m["k"]) == (1.5, 2.25, 3.5)


def test_csv_headers_are_checked(spark, tmp_path):
    path = tables.write_csv(spark.createDataFrame([(1.0, 2.0)], "Amount double, Time double"), str(tmp_path / "t"))
    with pytest.raises(Exception):
        tables.read_csv(spark, path, TRANSACTION_SCHEMA).collect()


def test_json_rows_are_all_accounted_for(spark):
    df = spark.createDataFrame([('{"k": 1}',), ("{oops",), ('{"k": 3}',)], "body string")
    parsed = tables.parse_json_events(df, spark.createDataFrame([], "k long").schema)
    assert sorted(r.k for r in tables.accepted(parsed).collect()) == [1, 3]
    assert [r._malformed for r in tables.rejected(parsed).collect()] == ["{oops"]


def test_binary_bodies_parse(spark):
    df = spark.createDataFrame([(bytearray(b'{"k": 7}'),)], "body binary")
    assert tables.accepted(tables.parse_json_events(df, spark.createDataFrame([], "k long").schema)).first().k == 7


def test_keys_do_not_depend_on_layout(spark):
    rows = [(float(i % 7), float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "Time double, Amount double")
    keyed = lambda d: sorted((r.Amount, r.event_id) for r in tables.with_key(d, "Time").collect())
    assert keyed(df) == keyed(df.repartition(6, "Amount"))
    assert sorted(k for _, k in keyed(df)) == list(range(1, 51))
