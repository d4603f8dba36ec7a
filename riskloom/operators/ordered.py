"""Running totals and exact quantiles over a global order, without a single-task window.

Rows are laid out by range, so that each partition holds a contiguous stretch of the order. A
window then runs inside each partition only, and the few per-partition totals (one row per
partition) carry the sums forward. Equal values do not pile up: the range bounds are drawn over
all order columns, so a tie on the first is split by the next. How many ranges a table gets is
left to adaptive execution. Quantiles need no order at all: brackets are counted into bins.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, stored

# Accuracy of the sketch that brackets a quantile first, and bins that a bracket is counted into.
SKETCH_ACCURACY = 10_000
BINS = 1_024


def running(
    df: DataFrame,
    order: list[str | Column],
    sums: dict[str, Column] | None = None,
    maxes: dict[str, Column] | None = None,
    before: bool = False,
) -> DataFrame:
    """Add cumulative sums and maxima over the whole table in the given order.

    `before=True` leaves the row itself out (the first row gets sum 0 and max null).
    `order` must be unique per row. The table is stored once, in its order.
    """
    sums, maxes = sums or {}, maxes or {}
    stop = -1 if before else Window.currentRow
    slot, part = "_slot", "_part"
    measures = {**sums, **maxes}
    inner = {name: f"_{name}_in" for name in measures}
    carry = {name: f"_{name}_carry" for name in measures}

    laid_out = cut_lineage(
        df.withColumns({inner[n]: c for n, c in measures.items()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        # documented layout: partition number in the upper bits, row number in the lower 33
        .withColumn(slot, F.monotonically_increasing_id())
        .withColumn(part, F.shiftright(slot, 33))
    )
    totals = laid_out.groupBy(part).agg(
        *[F.sum(inner[n]).alias(inner[n]) for n in sums],
        *[F.max(inner[n]).alias(inner[n]) for n in maxes],
    )
    # one row per partition: small however large the table is
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        part,
        *[F.sum(inner[n]).over(earlier).alias(carry[n]) for n in sums],
        *[F.max(inner[n]).over(earlier).alias(carry[n]) for n in maxes],
    )
    stretch = (
        Window.partitionBy(part)
        .orderBy(slot)
        .rowsBetween(Window.unboundedPreceding, stop)
    )
    within = laid_out.withColumns(
        {n: F.sum(inner[n]).over(stretch) for n in sums}
        | {n: F.max(inner[n]).over(stretch) for n in maxes}
    )
    joined = within.join(F.broadcast(carried), part)
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in measures],
        *[_plus(F.col(n), F.col(carry[n])).alias(n) for n in sums],
        *[F.greatest(F.col(n), F.col(carry[n])).alias(n) for n in maxes],
    )


def _plus(value: Column, carried: Column) -> Column:
    return F.coalesce(value, F.lit(0)) + F.coalesce(carried, F.lit(0))


def number_rows(df: DataFrame, order: list[str | Column], name: str = "row_number") -> DataFrame:
    """1-based position of each row in a global order."""
    return running(df, order, sums={name: F.lit(1).cast("long")})


_BIN = "struct<bin:int,n:bigint,low:double,high:double>"


def _bin_of_rank(bins: str, rank: str) -> Column:
    """The first of the ordered bins that reaches past a 0-based rank."""
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast(_BIN).alias("hit"))

    def add(so_far, b):
        seen = so_far["seen"] + b["n"]
        hit = F.when(so_far["hit"].isNull() & (seen > F.col(rank)), b).otherwise(so_far["hit"])
        return F.struct(seen.alias("seen"), hit.alias("hit"))

    return F.aggregate(bins, start, add, lambda done: done["hit"])


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: list[str] | None = None
) -> DataFrame:
    """Interpolated quantiles of a numeric column, one row per group (or one in all).

    A small sketch brackets each wanted rank. Then all values are counted into the bracket's bins,
    below and above it; the bin that holds the rank is the next bracket, until the rank's neighbours
    are the ends of bins. Whatever the sketch says, the result is exact; a bad bracket costs a pass.
    Nothing is ordered but a group's bins, of which there are `BINS` and two. The column is stored
    on its own first, so that passes read nothing else. Nulls are left out, NaN is the largest value.
    """
    by = by or []
    keys = by or ["_all"]
    narrow = [F.col(c) for c in by] or [F.lit(0).alias("_all")]
    known = stored(df.filter(F.col(value).isNotNull()).select(*narrow, F.col(value).cast("double").alias("_v")), "values")
    step = 2 / SKETCH_ACCURACY
    names = list(probs)
    points = [min(max(probs[name] + shift, 0.0), 1.0) for name in names for shift in (-step, step)]
    sketch = known.groupBy(*keys).agg(
        F.count("*").alias("_size"), F.percentile_approx("_v", points, SKETCH_ACCURACY).alias("_points")
    )
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("_name"), F.lit(float(probs[name])).alias("_p"), F.get("_points", F.lit(2 * i)).alias("_low"), F.get("_points", F.lit(2 * i + 1)).alias("_high"))
            for i, name in enumerate(names)
        ]
    )
    exact = (F.col("_size") - 1) * F.col("_p")
    open_ = sketch.select(*keys, "_size", F.inline(wanted)).select(
        *keys, "_name", "_low", "_high",
        F.floor(exact).alias("_lower"), F.ceil(exact).alias("_upper"), (exact - F.floor(exact)).alias("_part"),
    )
    v, low, high = F.col("_v"), F.col("_low"), F.col("_high")
    # halves, so that no difference overflows; what is no number goes between the ends
    place = F.nanvl((v / 2 - low / 2) / (high / 2 - low / 2), F.lit(0.5)) * BINS
    at = (
        F.when(v < low, -1)
        .when(v > high, BINS)
        .when(v == low, 0)
        .when(v == high, BINS - 1)
        .otherwise(F.least(F.greatest(F.floor(place), F.lit(0)), F.lit(BINS - 1)))
        .cast("int")
    )
    rank = ["_name", "_lower", "_upper", "_part"]
    settled = []
    while True:
        named = open_.select(*[F.col(c).alias(f"_of_{c}") for c in keys], *rank, "_low", "_high")
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys])
        # without groups, a row per wanted quantile
        held = known.join(named if by else F.broadcast(named), same)
        counted = held.groupBy(*keys, *rank, at.alias("bin")).agg(
            F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")
        )
        lists = counted.groupBy(*keys, *rank).agg(F.array_sort(F.collect_list(F.struct("bin", "n", "low", "high"))).alias("_bins"))
        found = stored(lists.select(*keys, *rank, _bin_of_rank("_bins", "_lower").alias("_a"), _bin_of_rank("_bins", "_upper").alias("_b")), "bins")
        apart = (F.col("_a.bin") != F.col("_b.bin")) | (F.col("_a.low") == F.col("_a.high"))
        settled.append(found.filter(apart).select(*keys, "_name", "_part", F.col("_a.high").alias("_from"), F.col("_b.low").alias("_to")))
        open_ = found.filter(~apart).select(*keys, *rank, F.col("_a.low").alias("_low"), F.col("_a.high").alias("_high"))
        if open_.isEmpty():
            break
    between = F.col("_from") + (F.col("_to") - F.col("_from")) * F.col("_part")
    result = F.when(F.col("_from") == F.col("_to"), F.col("_from")).otherwise(between)
    rows = reduce(DataFrame.unionAll, settled)
    return rows.groupBy(*by).agg(*[F.max(F.when(F.col("_name") == name, result)).alias(name) for name in names])
