import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ordered, sampling


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one value, another third one group."""
    rng = random.Random(3)
    rows = [(i, 7 if i % 3 == 0 else rng.randrange(40), rng.choice([0, 0, 1, 2]), rng.randrange(9)) for i in range(900)]
    return spark.createDataFrame(rows, "id long, v int, g int, w int").repartition(5).cache()


@pytest.mark.parametrize("before", [False, True])
def test_running_sums_and_maxima(skewed, before):
    got = ordered.running(
        skewed, ["v", "id"], {"total": F.col("w")}, {"last": F.struct("v", "id")}, before=before
    ).collect()
    rows = sorted(((r.v, r.id, r.w) for r in skewed.collect()))
    total, last, expected = 0, None, {}
    for v, i, w in rows:
        if before:
            expected[i] = (total, last)
        total, last = total + w, (v, i)
        if not before:
            expected[i] = (total, last)
    assert len(got) == len(rows)
    assert {r.id: (r.total, tuple(r.last) if r.last else None) for r in got} == expected


def test_row_numbers_are_a_permutation(skewed):
    numbers = [r.n for r in ordered.number_rows(skewed, [F.desc("v"), "id"], "n").orderBy(F.desc("v"), "id").collect()]
    assert numbers == list(range(1, 901))


def test_quantiles_equal_numpy(skewed):
    probs = {"q0": 0.0, "q25": 0.25, "median": 0.5, "q999": 0.999, "q1": 1.0}
    by_group = {r.g: r for r in ordered.exact_quantiles(skewed, "v", probs, ["g"]).collect()}
    values = {}
    for r in skewed.collect():
        values.setdefault(r.g, []).append(r.v)
    for g, vs in values.items():
        for name, p in probs.items():
            assert by_group[g][name] == pytest.approx(np.quantile(vs, p)), (g, name)
    overall = ordered.exact_quantiles(skewed, "v", probs).first()
    assert overall.median == pytest.approx(np.median([v for vs in values.values() for v in vs]))


def test_quantiles_of_a_million_values_in_one_bracket(spark):
    n = 1_000_000
    near = spark.range(n).select(F.when(F.col("id") % 1000 == 0, F.col("id") * 1e6).otherwise(5 + F.pmod(F.col("id") * 7919, F.lit(n)) * 1e-9).alias("v"))
    values = np.sort([i * 1e6 if i % 1000 == 0 else 5 + (i * 7919 % n) * 1e-9 for i in range(n)])
    probs = {"a": 0.1, "median": 0.5, "b": 0.99, "top": 0.9995}
    row = ordered.exact_quantiles(near, "v", probs).first()
    for name, p in probs.items():
        at = (n - 1) * p
        low, high = values[int(np.floor(at))], values[int(np.ceil(at))]
        assert row[name] == low + (high - low) * (at - np.floor(at))


def test_quantiles_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("a", -inf), ("a", 1.0), ("a", 2.0), ("a", inf), ("b", 1e308), ("b", -1e308), ("b", 3.0), (None, 4.0), (None, None), ("c", None), ("n", nan), ("n", 1.0), ("n", 2.0)]
    got = {r.g: (r.low, r.median) for r in ordered.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), "v", {"low": 0.0, "median": 0.5}, ["g"]).collect()}
    assert got == {"a": (-inf, 1.5), "b": (-1e308, 3.0), None: (4.0, 4.0), "n": (1.0, 2.0)}


def test_quantiles_order_nothing(spark):
    plan = ordered.exact_quantiles(spark.range(100).selectExpr("id * 1.5D AS v"), "v", {"q": 0.3})._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_quantile_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert ordered.exact_quantiles(empty, "v", {"q": 0.5}).first().q is None


def test_samples_do_not_depend_on_partitioning(skewed):
    pick = lambda df: {r.id for r in sampling.sample_fraction(df, ["id"], 0.3).collect()}
    assert pick(skewed) == pick(skewed.coalesce(1)) == pick(skewed.repartition(11))
    assert 200 < len(pick(skewed)) < 340


def test_split_is_independent_of_the_sample(skewed):
    drawn = sampling.sample_fraction(skewed, ["id"], 0.3)
    train, test = sampling.train_test_split(drawn, ["id"])
    assert train.count() + test.count() == drawn.count()
    assert 0.7 < train.count() / drawn.count() < 0.9


def test_undersampling_keeps_all_frauds(skewed):
    df = skewed.select("id", (F.col("g") == 2).cast("int").alias("Class"))
    balanced = sampling.undersample(df, ["id"], 1.0)
    frauds = df.filter("Class = 1").count()
    assert balanced.filter("Class = 1").count() == frauds
    assert 0.7 < balanced.filter("Class = 0").count() / frauds < 1.3


def test_undersampling_without_frauds_or_normals(spark):
    one_sided = spark.createDataFrame([(1, 1), (2, 1)], "id long, Class int")
    assert sampling.undersample(one_sided, ["id"], 1.0).count() == 2


def test_shuffle_repeats(skewed):
    order = lambda df: [r.id for r in sampling.shuffle_rows(df, ["id"]).collect()]
    assert order(skewed) == order(skewed.repartition(3)) != sorted(order(skewed))
