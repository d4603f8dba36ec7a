"""Graphs whose edges follow from nearness, measured without listing the edges.

Transactions near in time (or in the same grid cell) form dense groups: a burst of n
transactions has n*n/2 edges. All measures here come from sorted counts instead, so the
work stays about linear in the number of transactions, whatever the density.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio
from .ordered import running
from .spread import KeyTable

# Fixed value: transactions less than this many seconds apart are linked.
LINK_SECONDS = 3600
TICKS_PER_SECOND = 1_000_000


def _ticks(time: Column) -> Column:
    """Time as whole microseconds, so that differences are exact."""
    return F.round(time * TICKS_PER_SECOND).cast("long")


# Counts of pairs and triples are whole decimals: exact, whatever the size and order of summing.
_WHOLE = "decimal(38,0)"


def _whole(n: Column) -> Column:
    return n.cast("decimal(19,0)")


def _part(n: Column, by: Column) -> Column:
    """n, which `by` divides, over `by`."""
    return ((n - n % by) / by).cast("long")


def _pairs(n: Column) -> Column:
    """n (n - 1) / 2, the even factor halved first."""
    n = n.cast("long")
    even = n % 2 == 0
    return (_whole(F.when(even, F.shiftright(n, 1)).otherwise(n)) * _whole(F.when(even, n - 1).otherwise(F.shiftright(n - 1, 1)))).cast(_WHOLE)


def _triples(n: Column) -> Column:
    """n (n - 1) (n - 2) / 6, with the factors divided first that 2 and 3 divide."""
    n = n.cast("long")
    twos = [F.when(n % 2 == 0, 2).otherwise(1), F.when(n % 2 == 0, 1).otherwise(2), F.lit(1)]
    threes = [F.when(n % 3 == r, 3).otherwise(1) for r in range(3)]
    product = None
    for step, (two, three) in enumerate(zip(twos, threes)):
        factor = _whole(_part(n - step, two * three))
        product = factor if product is None else (product * factor).cast(_WHOLE)
    return product


def time_groups(df: DataFrame, key: str, time: str, seconds: float = LINK_SECONDS) -> DataFrame:
    """One row per distinct time with what its transactions see around them.

    same: transactions at this very time; left/right: linked earlier/later ones;
    upto: all transactions until this time; reach: all before the end of its window.
    """
    width = round(seconds * TICKS_PER_SECOND)
    groups = df.groupBy(_ticks(F.col(time)).alias("tick")).agg(
        F.count("*").alias("same"), F.min(key).alias("first_key")
    )
    # window ends are looked up by sorting them in among the times: an end at exactly
    # another time comes before it on the right and after it on the left (strict nearness)
    end, point, start = 0, 1, 2
    marks = F.array(
        *[
            F.struct(
                (F.col("tick") + shift).alias("at"), F.lit(kind).alias("kind"), rows.alias("rows")
            )
            for shift, kind, rows in (
                (width, end, F.lit(0).cast("long")),
                (0, point, F.col("same")),
                (-width, start, F.lit(0).cast("long")),
            )
        ]
    )
    swept = running(
        groups.select("tick", "same", "first_key", F.inline(marks)),
        ["at", "kind"],
        sums={"n": F.col("rows")},
    )
    seen = {kind: F.max(F.when(F.col("kind") == kind, F.col("n"))) for kind in (end, point, start)}
    return swept.groupBy("tick").agg(
        F.max("same").alias("same"),
        F.max("first_key").alias("first_key"),
        seen[point].alias("upto"),
        seen[end].alias("reach"),
        (seen[point] - F.max("same") - seen[start]).alias("left"),
        (seen[end] - seen[point]).alias("right"),
    )


def _on_vertices(df: DataFrame, key: str, time: str, groups: DataFrame, *columns: str) -> DataFrame:
    """Each transaction with the columns of its time; those of a crowded time are dealt over tasks."""
    at = df.select(key, _ticks(F.col(time)).alias("tick"))
    return KeyTable(groups, ["tick"], "same").join(at, key, *columns).drop("tick")


def time_neighbours(df: DataFrame, key: str, time: str, seconds: float = LINK_SECONDS) -> DataFrame:
    """Edges by vertex: how many transactions each one is linked to, earlier, later and in all.

    Those neighbours are exactly the transactions inside the window, so the table states
    the whole edge set in one row per vertex.
    """
    groups = time_groups(df, key, time, seconds).withColumn(
        "degree", F.col("same") - 1 + F.col("left") + F.col("right")
    )
    return _on_vertices(df, key, time, groups, "left", "right", "degree")


def time_graph_summary(df: DataFrame, key: str, time: str, seconds: float = LINK_SECONDS) -> DataFrame:
    """Vertices, edges, triangles and density of the graph of transactions near in time."""
    same, right = F.col("same"), F.col("right")
    edges = _pairs(same) + _whole(same) * _whole(right)
    # each triangle is counted at its earliest time, with 3, 2 or 1 corners there; the later
    # corners lie in one window and so are linked to each other
    triangles = _triples(same) + (_pairs(same) * _whole(right)).cast(_WHOLE) + (_whole(same) * _pairs(right)).cast(_WHOLE)
    sums = time_groups(df, key, time, seconds).agg(
        F.coalesce(F.sum("same"), F.lit(0)).alias("vertices"),
        F.coalesce(F.sum(edges.cast(_WHOLE)), F.lit(0)).cast(_WHOLE).alias("edges"),
        F.coalesce(F.sum(triangles.cast(_WHOLE)), F.lit(0)).cast(_WHOLE).alias("triangles"),
    )
    return sums.withColumn("density", F.round(density(F.col("vertices"), F.col("edges")), 6))


def time_clustering(df: DataFrame, key: str, time: str, seconds: float = LINK_SECONDS) -> DataFrame:
    """Per vertex: degree, triangles through it, and the share of its neighbours that are linked."""
    width = round(seconds * TICKS_PER_SECOND)
    groups = time_groups(df, key, time, seconds)
    marks = F.array(
        F.struct(F.col("tick").alias("at"), F.lit(0).alias("kind"), (_whole(F.col("same")) * _whole(F.col("reach"))).cast(_WHOLE).alias("v")),
        F.struct((F.col("tick") - width).alias("at"), F.lit(1).alias("kind"), F.lit(0).cast(_WHOLE).alias("v")),
    )
    columns = ["tick", "same", "upto", "reach", "left", "right"]
    swept = running(
        groups.select(*columns, F.inline(marks)), ["at", "kind"], sums={"sum_reach": F.col("v")}
    )
    at_start = F.max(F.when(F.col("kind") == 1, F.col("sum_reach")))
    # the running sum includes the point's own share
    at_point = F.max(F.when(F.col("kind") == 0, F.col("sum_reach") - F.col("v")))
    others, left, right = F.col("same") - 1, F.col("left"), F.col("right")
    across = F.col("reach_of_left") - _whole(left) * _whole(F.col("upto"))
    near = _whole(others) * (_whole(left) + _whole(right))
    triangles = (_pairs(left) + _pairs(others) + _pairs(right) + near.cast(_WHOLE) + across.cast(_WHOLE)).cast(_WHOLE)
    per_time = (
        swept.groupBy("tick")
        .agg(
            *[F.max(c).alias(c) for c in columns[1:]],
            (at_point - at_start).alias("reach_of_left"),
        )
        .select(
            "tick",
            "same",
            (others + left + right).alias("degree"),
            triangles.alias("triangles"),
        )
        .withColumn("clustering", ratio(F.col("triangles").cast("double"), _pairs(F.col("degree")).cast("double")))
    )
    return _on_vertices(df, key, time, per_time, "degree", "triangles", "clustering")


def time_components(df: DataFrame, key: str, time: str, seconds: float = LINK_SECONDS) -> DataFrame:
    """Connected components of the graph of transactions near in time.

    A component is a run of times without a gap as wide as the window, so one ordered pass
    finds all of them. It is named after its earliest transaction.
    """
    groups = time_groups(df, key, time, seconds)
    opens = F.when(F.col("left") == 0, F.struct(F.col("tick"), F.col("first_key")))
    labelled = running(groups.select("tick", "same", "left", "first_key"), ["tick"], maxes={"opened": opens})
    named = labelled.select("tick", "same", F.col("opened.first_key").alias("component"))
    return _on_vertices(df, key, time, named, "component")


def consecutive_links(
    df: DataFrame, key: str, time: str, seconds: float = LINK_SECONDS, carry: list[str] | None = None
) -> DataFrame:
    """Each transaction linked to the one before it, when that is near enough in time.

    At most one edge per transaction; the components are those of the full graph. Columns
    in `carry` come along from both ends as src_* and dst_*.
    """
    carry = carry or []
    rows = df.select(_ticks(F.col(time)).alias("tick"), key, *carry)
    entry = F.struct("tick", key, *carry)
    linked = running(rows, ["tick", key], maxes={"previous": entry}, before=True)
    near = F.col("tick") - F.col("previous.tick") < round(seconds * TICKS_PER_SECOND)
    return linked.filter(near).select(
        F.col(f"previous.{key}").alias("src"),
        F.col(key).alias("dst"),
        *[F.col(f"previous.{c}").alias(f"src_{c}") for c in carry],
        *[F.col(c).alias(f"dst_{c}") for c in carry],
    )


def cell_links(df: DataFrame, key: str, cell: list[str]) -> DataFrame:
    """Transactions of one cell linked to the cell's first: a star in place of all pairs.

    Also gives the degree each vertex has in the full graph, where the cell is a clique. A crowded
    cell's transactions are dealt over tasks; null values are cells too.
    """
    cells = df.groupBy(*cell).agg(F.min(key).alias("hub"), F.count("*").alias("members"))
    return KeyTable(cells, cell, "members").join(df.select(key, *cell), key, "hub", "members").select(
        F.col(key).alias("src"), F.col("hub").alias("dst"), (F.col("members") - 1).alias("degree")
    )


def cell_graph_summary(df: DataFrame, cell: list[str]) -> DataFrame:
    """Vertices, edges, triangles, density and mean clustering of the same-cell graph."""
    n = F.col("n")
    sums = df.groupBy(*cell).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("vertices"),
        F.coalesce(F.sum(_pairs(n)), F.lit(0)).cast(_WHOLE).alias("edges"),
        F.coalesce(F.sum(_triples(n)), F.lit(0)).cast(_WHOLE).alias("triangles"),
        F.coalesce(F.sum(F.when(n >= 3, n)), F.lit(0)).alias("clustered"),
    )
    return sums.select(
        "vertices", "edges", "triangles",
        F.round(density(F.col("vertices"), F.col("edges")), 6).alias("density"),
        F.round(ratio(F.col("clustered"), F.col("vertices")), 6).alias("avg_clustering"),
    )


def density(vertices: Column, edges: Column) -> Column:
    """Edges over possible edges of an undirected simple graph."""
    return ratio(edges.cast("double"), _pairs(vertices).cast("double"))
