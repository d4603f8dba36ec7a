import collections
import random
import re
import time
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom import session
from riskloom.operators import graph, lists, packed, proximity
from riskloom.operators.spread import KeyTable
from riskloom.plans import catalog, queries_graph  # noqa: F401


def brute_force(times: dict[int, float], seconds: float):
    near = {v: set() for v in times}
    for a, b in combinations(times, 2):
        if abs(round(times[a] * 1e6) - round(times[b] * 1e6)) < round(seconds * 1e6):
            near[a].add(b)
            near[b].add(a)
    return near


def components(near):
    label, seen = {}, set()
    for v in sorted(near):
        if v in seen:
            continue
        stack, members = [v], set()
        while stack:
            x = stack.pop()
            if x not in members:
                members.add(x)
                stack += near[x]
        seen |= members
        for m in members:
            label[m] = members
    return label


def triangles_at(near, v):
    return sum(1 for a, b in combinations(near[v], 2) if b in near[a])


@pytest.fixture(scope="module", params=["spread", "burst", "grid"])
def points(request):
    rng = random.Random(11)
    if request.param == "spread":
        return {i: rng.uniform(0, 2000) for i in range(60)}
    if request.param == "burst":  # a third at one instant, more of them packed together
        return {i: 500.0 if i % 3 == 0 else rng.uniform(0, 1500) for i in range(60)}
    return {i: float(rng.randrange(0, 400, 20)) for i in range(60)}  # gaps exactly as wide as the window


WIDTH = 20.0


def test_time_graph_equals_all_pairs(spark, points):
    df = spark.createDataFrame(list(points.items()), "id long, t double")
    near = brute_force(points, WIDTH)
    rows = {r.id: r for r in proximity.time_clustering(df, "id", "t", WIDTH).collect()}
    neighbours = {r.id: r for r in proximity.time_neighbours(df, "id", "t", WIDTH).collect()}
    assert rows.keys() == neighbours.keys() == points.keys()
    for v in points:
        assert rows[v].degree == neighbours[v].degree == len(near[v])
        assert rows[v].triangles == triangles_at(near, v)
        assert neighbours[v].left == sum(points[u] < points[v] for u in near[v])
    total = proximity.time_graph_summary(df, "id", "t", WIDTH).first()
    assert total.vertices == 60
    assert total.edges == sum(map(len, near.values())) / 2
    assert total.triangles == sum(triangles_at(near, v) for v in near) / 3


def test_time_components_equal_search(spark, points):
    df = spark.createDataFrame(list(points.items()), "id long, t double")
    expected = components(brute_force(points, WIDTH))
    got = {r.id: r.component for r in proximity.time_components(df, "id", "t", WIDTH).collect()}
    for v in points:
        assert {u for u in got if got[u] == got[v]} == expected[v]
        assert got[v] == min(expected[v], key=lambda u: (round(points[u] * 1e6), u))


def test_consecutive_links_keep_components(spark, points):
    df = spark.createDataFrame(list(points.items()), "id long, t double")
    links = proximity.consecutive_links(df, "id", "t", WIDTH).collect()
    assert len(links) <= len(points)
    near = {v: set() for v in points}
    for r in links:
        near[r.src].add(r.dst)
        near[r.dst].add(r.src)
    assert components(near) == components(brute_force(points, WIDTH))


@pytest.fixture(scope="module")
def edges():
    """A hub that a third of all edges touch, a long chain, a clique, loops and repeats."""
    rng = random.Random(5)
    hub = [(0, i) for i in range(1, 40)]
    chain = [(100 + i, 101 + i) for i in range(30)]
    clique = list(combinations(range(200, 206), 2))
    some = [(rng.randrange(1, 40), rng.randrange(1, 40)) for _ in range(40)]
    return hub + chain + clique + some + [(7, 7), (0, 1), (1, 0)]


def adjacency(edges):
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    return near


def test_components_of_edges(spark, edges):
    got = {r.id: r.component for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {v: min(c) for v, c in components(adjacency(edges)).items()}
    again = spark.createDataFrame([(k, v) for k, v in got.items()], "src long, dst long")
    assert {r.id: r.component for r in graph.connected_components(again).collect()} == {k: v for k, v in got.items()}


def test_triangles_and_clustering_of_edges(spark, edges):
    near = adjacency(edges)
    got = {r.id: r for r in graph.clustering_coefficients(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got.keys() == near.keys()
    for v in near:
        t, d = triangles_at(near, v), len(near[v])
        assert (got[v].triangles, got[v].degree) == (t, d)
        assert got[v].clustering == pytest.approx(2 * t / (d * (d - 1)) if d > 1 else 0)
    total = graph.triangle_count(spark.createDataFrame(edges, "src long, dst long")).first().triangles
    assert total == sum(triangles_at(near, v) for v in near) / 3


def test_pagerank_sums_to_one_and_agrees(spark, edges):
    got = {r.id: r.rank for r in graph.pagerank(spark.createDataFrame(edges, "src long, dst long"), rounds=7).collect()}
    ids = {v for e in edges for v in e}
    rank = {v: 1 / len(ids) for v in ids}
    out = {v: [b for a, b in edges if a == v] for v in ids}
    for _ in range(7):
        lost = sum(rank[v] for v in ids if not out[v])
        new = {v: 0.15 / len(ids) + 0.85 * lost / len(ids) for v in ids}
        for v in ids:
            for b in out[v]:
                new[b] += 0.85 * rank[v] / len(out[v])
        rank = new
    assert sum(got.values()) == pytest.approx(1)
    assert got == pytest.approx(rank)


def test_pagerank_without_sinks(spark):
    ring = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src long, dst long")
    assert [r.rank for r in graph.pagerank(ring, rounds=6).collect()] == pytest.approx([1 / 3] * 3)


def test_labels_split_two_cliques(spark):
    edges = list(combinations(range(5), 2)) + list(combinations(range(10, 15), 2)) + [(4, 10)]
    got = {r.id: r.community for r in graph.label_propagation(spark.createDataFrame(edges, "src long, dst long"), 6).collect()}
    assert len({got[i] for i in range(4)}) == 1
    assert len({got[i] for i in range(11, 15)}) == 1
    assert got[0] != got[12]


def test_cells_are_cliques(spark):
    df = spark.createDataFrame([(i, i % 2 if i < 6 else 9) for i in range(8)], "id long, cell int")
    total = proximity.cell_graph_summary(df, ["cell"]).first()
    assert (total.vertices, total.edges, total.triangles) == (8, 3 + 3 + 1, 2)
    assert total.avg_clustering == pytest.approx(6 / 8)
    assert {(r.src, r.dst, r.degree) for r in proximity.cell_links(df, "id", ["cell"]).collect()} >= {(0, 0, 2), (7, 6, 1)}


def test_counts_beyond_long_are_exact(spark):
    n = 4_000_003
    burst = spark.range(n).select("id", F.lit(7.0).alias("t"))
    row = proximity.time_graph_summary(burst, "id", "t", WIDTH).first()
    assert (row.edges, row.triangles) == (n * (n - 1) // 2, n * (n - 1) * (n - 2) // 6)


@pytest.fixture(scope="module")
def purchases(spark, tmp_path_factory):
    """Tables of lines with all return flags, and the edges that their parties should have."""
    path = str(tmp_path_factory.mktemp("purchases"))
    rng = random.Random(3)
    orders = [(k, rng.randrange(4)) for k in range(12)]
    lines = [(k, rng.randrange(4), rng.randrange(3), flag) for k, _ in orders for flag in "NAR"]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_returnflag string").write.parquet(
        f"{path}/lineitem.parquet"
    )
    edges = []
    for k, part, supplier, _ in lines:
        c, s, p = dict(orders)[k] * 3, supplier * 3 + 1, part * 3 + 2
        edges += [(c, s), (s, p), (p, c)]
    return path, edges


def test_purchase_triangles_hold_all_lines(spark, purchases):
    path, edges = purchases
    near = adjacency(edges)
    count = catalog.QUERIES["triangle_count_purchases"](spark, path).first().triangles
    assert count == sum(triangles_at(near, v) for v in near) / 3
    got = {r.id: (r.degree, r.triangles) for r in catalog.QUERIES["clustering_coefficient_purchases"](spark, path).collect()}
    assert got == {v: (len(near[v]), triangles_at(near, v)) for v in near}


def test_density_ranks_and_communities_hold_all_purchases(spark, purchases):
    path, edges = purchases
    near = adjacency(edges)
    n, pairs = len(near), sum(map(len, near.values())) // 2
    row = catalog.QUERIES["network_density"](spark, path).first()
    assert (row.vertices, row.edges, row.density) == (n, pairs, round(pairs / (n * (n - 1) / 2), 6))

    both = edges + [(b, a) for a, b in edges]
    rank, out = {v: 1 / n for v in near}, {v: [b for a, b in both if a == v] for v in near}
    for _ in range(10):
        new = {v: 0.15 / n for v in near}
        for v in near:
            for b in out[v]:
                new[b] += 0.85 * rank[v] / len(out[v])
        rank = new
    got = {r.id: r["rank"] for r in catalog.QUERIES["pagerank"](spark, path).collect()}
    assert got == pytest.approx(rank, abs=1e-7)

    label = {v: v for v in near}
    for _ in range(5):
        votes = {v: [label[u] for u in near[v]] for v in near}
        label = {v: min(set(x), key=lambda c: (-x.count(c), c)) for v, x in votes.items()}
    assert {r.id: r.community for r in catalog.QUERIES["community_detection"](spark, path).collect()} == label


def hub_graph():
    """Vertex 0 has half of all edges, some parallel; vertices from 5000 on have no outgoing ones."""
    rng = random.Random(6)
    edges = [(0, i) for i in range(1, 3000)] + [(0, 7)] * 5
    return edges + [(rng.randrange(1, 3000), rng.choice([0, rng.randrange(3000), rng.randrange(5000, 5050)])) for _ in edges]


def test_hub_edges_are_spread_over_tasks(spark):
    cut = graph.VertexCut(spark.createDataFrame(hub_graph(), "src long, dst long"))
    total = cut.edges.count()
    slots = [r["count"] for r in cut.edges.groupBy("src", "slot").count().collect()]
    assert max(slots) < total / 50
    assert cut.hubs.collect()[0]["id"] == 0 and cut.hubs.count() == 1
    held = [r["count"] for r in cut.edges.filter("src = 0").groupBy(F.spark_partition_id()).count().collect()]
    assert len(held) == 4 and max(held) < 0.4 * sum(held)
    sent = spark.createDataFrame([(0, 2.0), (5, 1.0)], "id long, rank double")
    delivered = cut.deliver(sent)
    assert delivered.filter("src = 0").count() == len(set(hub_graph()) & {(0, i) for i in range(6000)})
    assert {r.src for r in delivered.select("src").distinct().collect()} <= {0, 5}


def test_ranks_with_a_hub_and_sinks_equal_plain_rounds(spark):
    edges = hub_graph()
    out = {}
    for a, b in edges:
        out.setdefault(a, []).append(b)
    everyone = {v for e in edges for v in e}
    rank = dict.fromkeys(everyone, 1 / len(everyone))
    for _ in range(6):
        lost = sum(rank[v] for v in everyone if v not in out)
        new = dict.fromkeys(everyone, (0.15 + 0.85 * lost) / len(everyone))
        for a, ends in out.items():
            for b in ends:
                new[b] += 0.85 * rank[a] / len(ends)
        rank = new
    table = spark.createDataFrame(edges, "src long, dst long")
    got = {r.id: r["rank"] for r in graph.pagerank(table, rounds=6).collect()}
    assert got == pytest.approx(rank, rel=1e-9)
    weighted = table.groupBy("src", "dst").agg(F.count("*").cast("double").alias("w"))
    assert {r.id: r["rank"] for r in graph.pagerank(weighted, rounds=6, weight="w").collect()} == pytest.approx(rank, rel=1e-9)
    near = {r.id: r["rank"] for r in graph.pagerank(table, rounds=6, tolerance=1e-4).collect()}
    assert near == pytest.approx(rank, abs=1e-2 / len(everyone))


def test_recounting_touched_vertices_equals_recounting_all(spark):
    edges = hub_graph()[:4500] + [(i, i + 1) for i in range(6000, 6040)]
    table = spark.createDataFrame(edges, "src long, dst long")
    near = adjacency(edges)
    label = {v: v for v in near}
    for _ in range(6):
        votes = {v: [label[u] for u in near[v]] for v in near}
        label = {v: min(set(x), key=lambda c: (-x.count(c), c)) for v, x in votes.items()}
    for frontier in (-1.0, 1.0):
        assert {r.id: r.community for r in graph.label_propagation(table, 6, frontier).collect()} == label


def test_graphs_without_edges(spark):
    none = spark.createDataFrame([], "src long, dst long")
    assert graph.pagerank(none).count() == 0 and graph.label_propagation(none).count() == 0


@pytest.fixture
def plain_joins(spark):
    """Joins that shuffle both sides and stay as planned, so that tasks can be told apart."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def spread_over_tasks(df):
    held = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return len(held) == 4 and max(held) < 0.4 * sum(held)


def test_one_crowded_time_or_cell_fills_all_tasks(spark, plain_joins):
    burst = spark.range(4000).select("id", F.lit(7.0).alias("t"), F.lit(None).cast("int").alias("cell"))
    near = proximity.time_neighbours(burst, "id", "t", WIDTH)
    assert spread_over_tasks(near) and near.select("degree").distinct().collect() == [(3999,)]
    links = proximity.cell_links(burst, "id", ["cell"])
    assert spread_over_tasks(links) and links.select("dst", "degree").distinct().collect() == [(0, 3999)]
    named = proximity.time_components(burst, "id", "t", WIDTH)
    assert spread_over_tasks(named) and named.select("component").distinct().collect() == [(0,)]


def test_rows_of_a_hot_key_are_dealt_and_others_stay(spark, plain_joins):
    rows = spark.range(6000).select("id", F.when(F.col("id") < 3000, 1).when(F.col("id") < 3010, None).otherwise(F.col("id")).alias("k"))
    known = KeyTable(rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top")), ["k"], "n")
    assert known.hot.count() == 1
    slots = {r["_slot"]: r["count"] for r in known.dealt(rows.filter("k = 1"), "id").groupBy("_slot").count().collect()}
    assert max(slots.values()) < 100 and len(slots) > 50
    got = known.join(rows, "id", "n", "top")
    assert got.count() == 6000 and spread_over_tasks(got)
    expected = {1: (3000, 2999), None: (10, 3009)} | {i: (1, i) for i in range(3010, 6000)}
    assert {r.k: (r.n, r.top) for r in got.select("k", "n", "top").distinct().collect()} == expected


def test_triangles_through_a_hub(spark):
    rng = random.Random(8)
    edges = [(0, i) for i in range(1, 1500)] + [(rng.randrange(1, 1500), rng.randrange(1, 1500)) for _ in range(1500)]
    near = adjacency(edges)
    got = {r.id: r.triangles for r in graph.triangles(spark.createDataFrame(edges, "src long, dst long")).collect()}
    expected = {v: triangles_at(near, v) for v in near if v}
    assert {v: t for v, t in got.items() if v} == {v: t for v, t in expected.items() if t}
    assert got[0] == sum(1 for a, b in {(min(e), max(e)) for e in edges} if a and a != b)


def test_triangles_of_no_edges(spark):
    assert graph.triangle_count(spark.createDataFrame([], "src long, dst long")).first().triangles == 0


def test_lists_of_lower_ends_do_not_go_along_with_edges(spark, plain_joins):
    edges = spark.createDataFrame(list(combinations(range(12), 2)), "src long, dst long")
    for table in (graph.triangles(edges), graph.clustering_coefficients(edges)):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        # an exploded list that stays in the row has no number among the columns left out
        assert re.findall(r"Generate explode\(\w+#\d+\), \[\d+\]", plan) == re.findall(r"Generate explode\(\w+#\d+\), \[\d*\]", plan) != []
        assert {r.triangles for r in table.collect()} == {55}


def test_shuffle_files_go_once_a_table_is_stored(spark):
    rows = session.stored(spark.range(2000).repartition(7, "id"), "rows")
    status = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    before = status.diskBlockManager().getAllFiles().size()
    session.stored(rows.groupBy((F.col("id") % 50).alias("k")).agg(F.collect_list("id").alias("ids")), "again")
    assert spark.conf.get(session._SHUFFLES_GO) == "false"
    for _ in range(50):
        if status.diskBlockManager().getAllFiles().size() <= before:
            break
        time.sleep(0.1)
    assert status.diskBlockManager().getAllFiles().size() <= before


def test_lists_go_along_edges_in_bytes_and_in_turns(spark, monkeypatch):
    assert "steps" in graph.triangles(spark.createDataFrame([(1, 2), (2, 3), (1, 3)], "src long, dst long"))._jdf.queryExecution().toString()
    rng = random.Random(12)
    far = [rng.randrange(-(2**62), 2**62) for _ in range(20)] + list(range(40)) + [10**6 + 7 * i for i in range(20)] + [2**63 - 1, -(2**63)]
    edges = [tuple(rng.sample(far, 2)) for _ in range(1200)] + [(5, 5)]
    near = adjacency(edges)
    table = spark.createDataFrame(edges, "src long, dst long")
    for told in (1, 1000):
        monkeypatch.setattr(graph, "TOLD", told)
        got = {r.id: r.triangles for r in graph.triangles(table).collect()}
        assert got == {v: t for v in near if (t := triangles_at(near, v))}


def test_packed_lists_are_unpacked_alike(spark):
    rows = [(1, [5]), (2, [-(2**63), 2**63 - 1]), (3, []), (4, [0, 255, 510]), (5, [0, 256]), (6, [3, 70000, 70001]), (7, [1, 2**40])]
    table = spark.createDataFrame(rows, "k long, v array<long>").coalesce(1)
    got = lists.packed(table, "k", "v", "id").toArrow().combine_chunks()
    first, n, steps = (got.column(c).combine_chunks() for c in ("first", "n", "steps"))
    flat, at, found = lists.unpacked(first.to_numpy(), n.to_numpy(), steps).tolist(), 0, {}
    for k, size in zip(got.column("id").to_pylist(), n.to_pylist()):
        found[k], at = flat[at : at + size], at + size
    assert found == {k: v for k, v in rows if v}
    assert {k: len(x) for k, x in zip(got.column("id").to_pylist(), steps.to_pylist())} == {1: 0, 2: 8, 4: 2, 5: 2, 6: 8, 7: 8}


def test_packed_edges_stay_and_hubs_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(packed, "PART", 500)
    cut = packed.PackedGraph(spark.createDataFrame(hub_graph(), "src long, dst long"))
    rows = cut.edges.collect()
    assert cut.hubs.tolist() == [0] and cut.parts == -(-len(hub_graph()) // 500) == len(rows)
    held = [len(r["take"]) // 4 for r in rows]
    assert sum(held) == len(hub_graph()) and max(held) < 0.2 * sum(held)
    state = cut.first_state()
    size, sinks, _, moved, sends = cut.totals(state)
    ids = {v for e in hub_graph() for v in e}
    assert (size, sinks, moved, sends.tolist()) == (len(ids), len(ids - {a for a, _ in hub_graph()}), 0, [0.0])
    sent = cut.next_state(cut.next_state(state, sends, 1.0, -1.0, 1.0, send=False), np.array([1.0]), 0.0, 0.0, 1.0)
    got = {r.id: r["rank"] for r in packed.PackedGraph.ranks(sent).collect()}
    out = collections.Counter(a for a, _ in hub_graph())
    expected = dict.fromkeys(ids, 1.0)
    for a, b in hub_graph():
        expected[b] += 1.0 / out[a] if a else 1.0
    assert got == pytest.approx(expected)


def test_ends_without_id_receive_and_do_not_send(spark):
    edges = [(1, 2), (2, 1), (1, None), (None, 2), (2, 3), (2**63 - 1, 0), (0, -(2**63))]
    table = spark.createDataFrame(edges, "src long, dst long")
    rank = dict.fromkeys({v for e in edges for v in e}, 1 / 7)
    out = collections.Counter(a for a, _ in edges)
    for _ in range(4):
        lost = sum(rank[v] for v in rank if not out[v])
        new = dict.fromkeys(rank, (0.15 + 0.85 * lost) / 7)
        for a, b in edges:
            if a is not None:
                new[b] += 0.85 * rank[a] / out[a]
        rank = new
    got = graph.pagerank(table, rounds=4)
    assert got.schema["id"].dataType.simpleString() == "bigint"
    assert {r.id: r["rank"] for r in got.collect()} == pytest.approx(rank)
