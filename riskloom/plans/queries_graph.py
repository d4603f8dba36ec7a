"""Queries for graph measures.

Two kinds of graph: frauds near in time or in one grid cell, whose edges follow from the
values and are never listed; and explicit edge tables, from accounts that act one after the
other, and from the parties of order lines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning, graph, kpis, proximity
from ..schema import TIME
from ..sources.tables import read_table
from ..sources.transactions import transactions
from . import oracle as o
from .catalog import query

KEY = "event_id"


def frauds(spark, sf):
    return cleaning.with_label(transactions(spark, sf, []))


def account_links(spark, sf):
    """Accounts of frauds that follow each other within the link time: enough for components only."""
    links = proximity.consecutive_links(frauds(spark, sf), KEY, TIME, carry=["user_id"])
    return links.select(F.col("src_user_id").alias("src"), F.col("dst_user_id").alias("dst"))


_LINKS = o.FRAUD_TIMES + (
    ", ordered AS (SELECT event_id, user_id, tick, lag(event_id) OVER w AS prev_id, lag(user_id) OVER w AS prev_user, "
    "lag(tick) OVER w AS prev_tick FROM frauds WINDOW w AS (ORDER BY tick, event_id))"
    ", links AS MATERIALIZED (SELECT prev_id, event_id, prev_user AS src, user_id AS dst FROM ordered WHERE tick - prev_tick < 3600000000)"
    ", simple AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM links WHERE src <> dst)"
    ", sym AS MATERIALIZED (SELECT a AS src, b AS dst FROM simple UNION ALL SELECT b, a FROM simple)"
)


def purchase_edges(spark, sf):
    """Customer, supplier and part of each order line, linked to each other.

    Ids of the three kinds are kept apart by their remainder modulo 3.
    """
    lines = read_table(spark, sf, "lineitem")
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customer, supplier, part = F.col("o_custkey") * 3, F.col("l_suppkey") * 3 + 1, F.col("l_partkey") * 3 + 2
    sides = [(customer, supplier), (supplier, part), (part, customer)]
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.inline(F.array(*[F.struct(a.alias("src"), b.alias("dst")) for a, b in sides]))
    )


_LINES = (
    "lines AS MATERIALIZED (SELECT o_custkey * 3 AS c, l_suppkey * 3 + 1 AS s, l_partkey * 3 + 2 AS p FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey)"
)
#: CTEs `links` (both ways, a row per line), `simple` and `sym` (each pair once, and both ways) of all lines.
_PARTIES = _LINES + (
    ", sides AS (SELECT c AS src, s AS dst FROM lines UNION ALL SELECT s, p FROM lines UNION ALL SELECT p, c FROM lines)"
    ", links AS MATERIALIZED (SELECT src, dst FROM sides UNION ALL SELECT dst, src FROM sides)"
    ", simple AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM sides)"
    ", sym AS MATERIALIZED (SELECT a AS src, b AS dst FROM simple UNION ALL SELECT b, a FROM simple)"
)
_PURCHASES = _LINES + (
    ", cs AS MATERIALIZED (SELECT DISTINCT c, s FROM lines), sp AS MATERIALIZED (SELECT DISTINCT s, p FROM lines)"
    ", pc AS MATERIALIZED (SELECT DISTINCT p, c FROM lines)"
    ", tri AS MATERIALIZED (SELECT cs.c, cs.s, pc.p FROM cs JOIN pc ON cs.c = pc.c JOIN sp ON sp.s = cs.s AND sp.p = pc.p)"
)


# --- edges that follow from the values ---

def _long(df, *counts):
    """Exact decimal counts as long, which the given tables stay within."""
    return df.withColumns({c: F.col(c).cast("long") for c in counts})


@query(
    "similarity_edges",
    f"WITH {o.FRAUD_TIMES} SELECT f.event_id, count(*) FILTER (WHERE g.tick < f.tick) AS \"left\", "
    "count(*) FILTER (WHERE g.tick > f.tick) AS \"right\", count(g.tick) AS degree "
    "FROM frauds f LEFT JOIN pairs p ON p.src = f.event_id LEFT JOIN frauds g ON g.event_id = p.dst GROUP BY f.event_id",
)
def _(spark, sf):
    return proximity.time_neighbours(frauds(spark, sf), KEY, TIME)


@query("consecutive_links", f"WITH {_LINKS} SELECT prev_id AS src, event_id AS dst FROM links")
def _(spark, sf):
    return proximity.consecutive_links(frauds(spark, sf), KEY, TIME)


_CELLS = (
    f"WITH {o.tx(['V14'])}, f AS (SELECT event_id, CAST(trunc(V14 * 2) AS INTEGER) AS a, CAST(trunc(Amount / 50) AS INTEGER) AS b "
    "FROM tx WHERE Class = 1)"
)


@query(
    "bucket_edges",
    f"{_CELLS} SELECT event_id AS src, min(event_id) OVER (PARTITION BY a, b) AS dst, count(*) OVER (PARTITION BY a, b) - 1 AS degree FROM f",
)
def _(spark, sf):
    cells = kpis.fraud_cells(transactions(spark, sf, ["V14"]))
    return proximity.cell_links(cells, KEY, ["v14_bucket", "amount_bucket"])


@query(
    "bucket_graph_summary",
    f"{_CELLS}, p AS (SELECT x.event_id AS u, y.event_id AS v FROM f x JOIN f y ON x.a = y.a AND x.b = y.b AND x.event_id < y.event_id)"
    ", t AS (SELECT count(*) AS n FROM p JOIN p q ON p.v = q.u JOIN p r ON r.u = p.u AND r.v = q.v)"
    ", c AS (SELECT count(*) AS n FROM (SELECT count(*) OVER (PARTITION BY a, b) AS m FROM f) WHERE m >= 3)"
    ", k AS (SELECT (SELECT count(*) FROM f) AS vertices, (SELECT count(*) FROM p) AS edges)"
    f" SELECT vertices, edges, t.n AS triangles, {o.rnd(o.div('edges', 'vertices * (vertices - 1) / 2e0'), 6)} AS density, "
    f"{o.rnd(o.div('c.n', 'vertices'), 6)} AS avg_clustering FROM k, t, c",
)
def _(spark, sf):
    cells = kpis.fraud_cells(transactions(spark, sf, ["V14"]))
    return _long(proximity.cell_graph_summary(cells, ["v14_bucket", "amount_bucket"]), "edges", "triangles")


@query(
    "connected_components",
    f"WITH RECURSIVE {o.FRAUD_TIMES}, {o.component_labels('pairs')} "
    "SELECT event_id, coalesce(component, event_id) AS component FROM frauds LEFT JOIN labels ON id = event_id",
)
def _(spark, sf):
    return proximity.time_components(frauds(spark, sf), KEY, TIME)


@query(
    "triangle_count",
    f"WITH {o.FRAUD_TIMES}, up AS (SELECT * FROM pairs WHERE src < dst)"
    ", t AS (SELECT count(*) AS n FROM up a JOIN up b ON a.dst = b.src JOIN up c ON c.src = a.src AND c.dst = b.dst)"
    ", k AS (SELECT (SELECT count(*) FROM frauds) AS vertices, (SELECT count(*) FROM up) AS edges)"
    f" SELECT vertices, edges, t.n AS triangles, {o.rnd(o.div('edges', 'vertices * (vertices - 1) / 2e0'), 6)} AS density FROM k, t",
)
def _(spark, sf):
    return _long(proximity.time_graph_summary(frauds(spark, sf), KEY, TIME), "edges", "triangles")


_TIME_TRIANGLES = (
    f"WITH {o.FRAUD_TIMES}, t AS (SELECT a.src AS id, count(*) / 2 AS n FROM pairs a JOIN pairs b ON a.src = b.src AND a.dst <> b.dst "
    "JOIN pairs c ON c.src = a.dst AND c.dst = b.dst GROUP BY 1), d AS (SELECT src AS id, count(*) AS n FROM pairs GROUP BY 1)"
    ", v AS (SELECT event_id, coalesce(d.n, 0) AS degree, CAST(coalesce(t.n, 0) AS BIGINT) AS triangles "
    "FROM frauds LEFT JOIN d ON d.id = event_id LEFT JOIN t ON t.id = event_id)"
)
_COEFFICIENT = o.div("2 * triangles", "degree * (degree - 1)")


@query(
    "clustering_coefficient",
    f"{_TIME_TRIANGLES} SELECT event_id, degree, triangles, {o.rnd(_COEFFICIENT, 6)} AS clustering FROM v",
)
def _(spark, sf):
    table = proximity.time_clustering(frauds(spark, sf), KEY, TIME)
    return _long(table, "triangles").withColumn("clustering", F.round("clustering", 6))


@query("average_clustering", f"{_TIME_TRIANGLES} SELECT {o.rnd(f'avg({_COEFFICIENT})', 6)} AS avg_clustering FROM v")
def _(spark, sf):
    table = proximity.time_clustering(frauds(spark, sf), KEY, TIME)
    return table.agg(F.round(F.avg("clustering"), 6).alias("avg_clustering"))


# --- explicit edge tables ---

@query("connected_components_accounts", f"WITH RECURSIVE {_LINKS}, {o.component_labels('sym')} SELECT id, component FROM labels")
def _(spark, sf):
    return graph.connected_components(account_links(spark, sf))


@query(
    "network_density",
    f"WITH {_PARTIES}, k AS (SELECT (SELECT count(DISTINCT src) FROM sym) AS vertices, (SELECT count(*) FROM simple) AS edges) "
    f"SELECT vertices, edges, {o.rnd(o.div('edges', 'vertices * (vertices - 1) / 2e0'), 6)} AS density FROM k",
)
def _(spark, sf):
    return graph.network_density(purchase_edges(spark, sf))


def _pagerank_sql(rounds: int, damping: float = 0.85) -> str:
    ctes = [
        "v AS MATERIALIZED (SELECT src AS id FROM links UNION SELECT dst FROM links)",
        "n AS (SELECT count(*) AS n FROM v)",
        "outs AS MATERIALIZED (SELECT src, count(*) AS d FROM links GROUP BY src)",
        "r0 AS MATERIALIZED (SELECT id, 1e0 / n AS rank FROM v, n)",
    ]
    for i in range(1, rounds + 1):
        p = f"r{i - 1}"
        ctes += [
            f"l{i} AS (SELECT coalesce(sum(rank), 0) AS lost FROM {p} WHERE id NOT IN (SELECT src FROM outs))",
            f"i{i} AS (SELECT dst AS id, sum(rank / d) AS got FROM links JOIN outs USING (src) JOIN {p} ON {p}.id = src GROUP BY dst)",
            f"r{i} AS MATERIALIZED (SELECT v.id, {1 - damping} / CAST(n AS DOUBLE) + {damping} * (coalesce(got, 0) + lost / n) AS rank "
            f"FROM v LEFT JOIN i{i} ON i{i}.id = v.id, n, l{i})",
        ]
    return ", ".join(ctes)


@query("pagerank", f"WITH {_PARTIES}, {_pagerank_sql(10)} SELECT id, {o.rnd('rank', 8)} AS rank FROM r10")
def _(spark, sf):
    # the parties of a line have no order, so rank passes both ways
    ranks = graph.pagerank(graph.both_ways(purchase_edges(spark, sf)), rounds=10)
    return ranks.select("id", F.round("rank", 8).alias("rank"))


def _propagation_sql(rounds: int) -> str:
    ctes = ["p0 AS MATERIALIZED (SELECT DISTINCT src AS id, src AS community FROM sym)"]
    for i in range(1, rounds + 1):
        ctes.append(
            f"p{i} AS MATERIALIZED (SELECT id, community FROM (SELECT dst AS id, community, "
            f"row_number() OVER (PARTITION BY dst ORDER BY count(*) DESC, community) AS k FROM sym JOIN p{i - 1} ON p{i - 1}.id = src "
            "GROUP BY dst, community) WHERE k = 1)"
        )
    return ", ".join(ctes)


@query("community_detection", f"WITH {_PARTIES}, {_propagation_sql(5)} SELECT id, community FROM p5")
def _(spark, sf):
    return graph.label_propagation(purchase_edges(spark, sf), rounds=5)


@query("triangle_count_purchases", f"WITH {_PURCHASES} SELECT count(*) AS triangles FROM tri")
def _(spark, sf):
    return graph.triangle_count(purchase_edges(spark, sf))


@query(
    "clustering_coefficient_purchases",
    f"WITH {_PURCHASES}, e AS (SELECT c AS a, s AS b FROM cs UNION ALL SELECT s, p FROM sp UNION ALL SELECT p, c FROM pc)"
    ", d AS (SELECT id, count(*) AS degree FROM (SELECT a AS id FROM e UNION ALL SELECT b FROM e) GROUP BY id)"
    ", t AS (SELECT id, count(*) AS n FROM (SELECT c AS id FROM tri UNION ALL SELECT s FROM tri UNION ALL SELECT p FROM tri) GROUP BY id)"
    ", x AS (SELECT d.id, degree, coalesce(n, 0) AS triangles FROM d LEFT JOIN t ON t.id = d.id)"
    f" SELECT id, degree, triangles, {o.rnd(_COEFFICIENT, 6)} AS clustering FROM x",
)
def _(spark, sf):
    table = graph.clustering_coefficients(purchase_edges(spark, sf))
    return table.withColumn("clustering", F.round("clustering", 6))
