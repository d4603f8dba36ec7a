"""Graph measures on an explicit edge table (`src`, `dst`)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratio
from ..session import cut_lineage, shuffles_go, stored, work_dir
from . import lists
from .packed import PackedGraph
from .proximity import density
from .spread import KeyTable

#: Entries of lists that go along edges in one turn, per edge.
TOLD = 8


def undirected(edges: DataFrame) -> DataFrame:
    """Each linked pair once, smaller id first, without loops."""
    return (
        edges.filter(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .distinct()
    )


def both_ways(edges: DataFrame) -> DataFrame:
    """Every edge in both directions, by one pass over the table."""
    ends = F.array(
        F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
    )
    return edges.select(F.inline(ends))


def vertices_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    return both_ways(undirected(edges)).groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree"))


def with_least(rows: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Each row with the least `value` of its key, however many rows a key has.

    Rows are dealt to slots within their key; the least of each slot meets by key, and goes back
    only to the slots that are there, so a hub fills as many tasks as the session shuffles to.
    """
    slots = max(64, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumn("_slot", F.pmod(F.xxhash64(value), F.lit(slots)).cast("int"))
    least = (
        dealt.groupBy(key, "_slot")
        .agg(F.min(value).alias(out))
        .groupBy(key)
        .agg(F.min(out).alias(out), F.collect_list("_slot").alias("_slots"))
        .select(key, out, F.explode("_slots").alias("_slot"))
    )
    return dealt.join(least, [key, "_slot"]).drop("_slot")


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(id, component): component is the smallest id that can be reached.

    Alternates two star operations: every vertex hands its larger, then its smaller
    neighbours the smallest id it knows. The edge table shrinks to one star per component
    within a number of rounds logarithmic in the size, not the diameter. Each round is
    materialized, and stops the loop when it changed nothing. `max_rounds` only guards against
    a loop that would not end.
    """
    stars = cut_lineage(undirected(edges))
    everyone = vertices_of(stars)
    mark = _fingerprint(stars)
    for _ in range(max_rounds):
        wider = (
            with_least(both_ways(stars), "src", "dst", "low")
            .filter(F.col("dst") > F.col("src"))
            .select(F.col("dst").alias("src"), F.least("low", "src").alias("dst"))
            .distinct()
        )
        # from here every edge points from a larger to a smaller id
        stars = cut_lineage(
            with_least(wider, "src", "dst", "low")
            .select(F.when(F.col("dst") == F.col("low"), F.col("src")).otherwise(F.col("dst")).alias("src"), F.col("low").alias("dst"))
            .distinct()
        )
        previous, mark = mark, _fingerprint(stars)
        if mark == previous:
            break
    else:
        raise RuntimeError(f"components still changing after {max_rounds} rounds")
    return everyone.join(
        stars.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("root")), "id", "left"
    ).select("id", F.coalesce("root", "id").alias("component"))


def _fingerprint(edges: DataFrame) -> tuple:
    ends = F.struct(F.least("src", "dst"), F.greatest("src", "dst"))
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64(ends).cast("decimal(20,0)"))).first())


def triangles(edges: DataFrame) -> DataFrame:
    """(id, triangles) for vertices in at least one triangle.

    Edges point from lower to higher degree. No vertex then has more than sqrt(2 * edges)
    successors, hubs included, so successor lists stay small; each edge intersects two. What edges
    learn of a hub, its degree or its list, goes to slots that the hub's edges are dealt to. Lists
    go from upper to lower ends, so that only edges whose upper end has successors move one, packed as
    bytes (`lists`). Where they come to more than `TOLD` entries an edge, lower ends take turns, so
    that only the lists of one turn are on the disks at a time. Ids are whole numbers.
    """
    pairs = stored(undirected(edges), "pairs")
    return _triangles(pairs, _degree_table(pairs))


def _degree_table(pairs: DataFrame) -> KeyTable:
    """Degrees from edges that `undirected` gave."""
    return KeyTable(both_ways(pairs).groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree")), ["id"], "degree")


def _triangles(pairs: DataFrame, known: KeyTable) -> DataFrame:
    ends = pairs
    for end, other in (("src", "dst"), ("dst", "src")):
        ends = known.join(ends.withColumn("id", F.col(end)), other, "degree").drop("id").withColumnRenamed("degree", f"{end}_degree")
    rises = F.struct("src_degree", "src") < F.struct("dst_degree", "dst")
    upward = ends.select(
        F.when(rises, F.col("src")).otherwise(F.col("dst")).alias("src"),
        F.when(rises, F.col("dst")).otherwise(F.col("src")).alias("dst"),
    )
    following = stored(upward.groupBy("src").agg(F.sort_array(F.collect_list("dst")).alias("src_next")), "following")
    # how many edges end in a vertex is how often its list is asked for there
    entering = following.select(F.explode("src_next").alias("id")).groupBy("id").agg(F.count("*").alias("entering"))
    upper = KeyTable(lists.packed(following, "src", "src_next", "id").join(entering, "id"), ["id"], "entering")
    wide = following.filter(F.size("src_next") > 1)
    told, edges = upper.table.agg(F.sum(F.col("entering") * F.col("n")), F.sum("entering")).first()
    passes = -(-(told or 0) // (TOLD * max(1, edges or 0)))
    found = [_closed(wide, upper, i, passes) for i in range(max(1, passes))]
    if passes > 1:
        found = [stored(df, "corners") for df in found]
    return reduce(DataFrame.unionAll, found).groupBy("id").agg(F.sum("n").alias("triangles"))


def _closed(wide: DataFrame, upper: KeyTable, turn: int, passes: int) -> DataFrame:
    """(id, n): triangles at their corners, of one of `passes` shares of the lowest corners."""
    if passes > 1:
        wide = wide.filter(F.pmod(F.xxhash64(F.lit("pass"), "src"), F.lit(passes)) == turn)
    asking = wide.select("src", F.explode("src_next").alias("id"))
    told = upper.join(asking, "src", "first", "n", "steps").withColumnRenamed("id", "dst")
    own = lists.packed(wide, "src", "src_next", "src").select("src", *[F.col(c).alias(f"own_{c}") for c in ("first", "n", "steps")])
    # the lists told are many, and need no order; a lower end has one list, of bounded length
    both = told.join(own.hint("shuffle_hash"), "src")
    return lists.corners(both).groupBy("id").agg(F.sum("n").alias("n"))


def triangle_count(edges: DataFrame) -> DataFrame:
    return triangles(edges).agg(
        F.coalesce((F.sum("triangles") / 3).cast("long"), F.lit(0)).alias("triangles")
    )


def clustering_coefficients(edges: DataFrame) -> DataFrame:
    """Per vertex: linked pairs of neighbours over all pairs of neighbours."""
    pairs = stored(undirected(edges), "pairs")
    known = _degree_table(pairs)
    return (
        known.table.join(_triangles(pairs, known), "id", "left")
        .select(
            "id",
            "degree",
            F.coalesce("triangles", F.lit(0)).alias("triangles"),
        )
        .withColumn(
            "clustering",
            ratio(F.col("triangles") * 2, F.col("degree") * (F.col("degree") - 1)),
        )
    )


def network_density(edges: DataFrame) -> DataFrame:
    pairs = cut_lineage(undirected(edges))
    return pairs.agg(F.count("*").alias("edges")).select(
        vertices_of(pairs).agg(F.count("*")).scalar().alias("vertices"), "edges"
    ).withColumn("density", F.round(density(F.col("vertices"), F.col("edges")), 6))


class VertexCut:
    """Directed edges (src, dst, share) stored by source, parallel ones as one, hubs cut into slots.

    A source with more than its share of the edges is a hub: its edges are dealt to slots by their
    other end, so that no task holds more than about a share. Shares are so large that there can't be
    more hubs than `4 * slots`; their table is small whatever the graph. Edges are stored bucketed by
    (src, slot), so `deliver` moves only what is sent, never the edges.

    `share` is an edge's part of its source's edges, counted by the column `weight` if given. `edges`
    is read twice.
    """

    def __init__(self, edges: DataFrame, weight: str | None = None):
        spark = edges.sparkSession
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        slots = max(64, tasks)
        n = F.col(weight) if weight else F.lit(1)
        edges = edges.select("src", "dst", n.alias("n"))
        self.sources = stored(edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("edges"), F.sum("n").alias("out")), "sources")
        share = max(1, -(-(self.sources.agg(F.sum("edges")).first()[0] or 0) // (4 * slots)))
        parts = F.ceil(F.col("edges") / share).cast("int").alias("parts")
        self.hubs = cut_lineage(self.sources.filter(F.col("edges") > share).select("id", parts))
        self.has_hubs = not self.hubs.isEmpty()
        # adaptive execution may broadcast the sources or split a hub's edges
        known = edges.join(self.sources.select(F.col("id").alias("src"), parts, "out"), "src")
        slot = F.pmod(F.xxhash64("dst"), "parts").cast("int").alias("slot")
        name = "edges_" + uuid.uuid4().hex
        with shuffles_go(spark):
            (
                known.select("src", slot, "dst", (F.col("n") / F.col("out")).alias("share"))
                .repartition(tasks, "src", "slot")
                .groupBy("src", "slot", "dst")
                .agg(F.sum("share").alias("share"))
                .write.bucketBy(tasks, "src", "slot")
                .option("path", work_dir(spark, name))
                .format("parquet")
                .saveAsTable(name)
            )
        self.edges = spark.read.table(name)

    def deliver(self, sent: DataFrame) -> DataFrame:
        """Each edge with what its source, `id`, sends; a source that sends nothing drops out.

        Where what is sent is stored and small enough, Spark sends it to all tasks instead.
        """
        if self.has_hubs:
            parts = sent.join(F.broadcast(self.hubs), "id", "left")
            last = F.coalesce("parts", F.lit(1)) - 1
            copies = parts.withColumn("slot", F.explode(F.sequence(F.lit(0), last))).drop("parts")
        else:
            copies = sent.withColumn("slot", F.lit(0))
        copies = copies.withColumnRenamed("id", "src")
        return self.edges.join(copies, ["src", "slot"])


def pagerank(
    edges: DataFrame, rounds: int = 10, damping: float = 0.85, tolerance: float = 0.0, weight: str | None = None
) -> DataFrame:
    """(id, rank) after a fixed number of rounds over directed edges; ranks sum to 1.

    Parallel edges count, by the column `weight` if given. Rank of vertices without outgoing edges is
    spread over all.

    Rounds pass on changes only: what a vertex's rank has changed by is sent along its edges, and a
    vertex whose change is no larger than `tolerance` (of the mean rank) sends nothing. With 0 the
    ranks are those of plain rounds. Changes of all rounds add up to the rank. Edges and ranks are packed
    (`PackedGraph`): what a part of the graph sends to another in a round is one row.
    """
    links = PackedGraph(edges, weight)
    state = links.first_state()
    size, sinks, _, _, sends = links.totals(state)
    kind = edges.schema["src"].dataType
    if not size:
        return PackedGraph.ranks(state).withColumn("id", F.col("id").cast(kind))
    least = tolerance / size
    # all vertices start at the mean rank, as a change
    state = links.next_state(state, sends, 1.0 / size, -1.0, damping, send=False)
    for done in range(1, rounds + 1):
        _, _, lost, moved, sends = links.totals(state)
        if not moved:
            break
        # what all vertices change by alike: lost rank, and in the first round the step to the base rank
        alike = damping * lost / size if sinks else 0.0
        if done == 1:
            alike += (1 - damping) / size - 1.0 / size
        state = links.next_state(state, sends, alike, least, damping)
    return PackedGraph.ranks(state).withColumn("id", F.col("id").cast(kind))


def label_propagation(edges: DataFrame, rounds: int = 5, frontier: float = 0.25) -> DataFrame:
    """(id, community): each round every vertex takes its neighbours' commonest label, the
    smallest one on a tie.

    Votes are recounted only at vertices that have a neighbour whose label changed in the round
    before; the others would vote as they did. Where more than the share `frontier` of the vertices
    changed, nearly all have such a neighbour, and looking for them costs more than it saves: then
    all are recounted, with the same result. Votes meet by vertex and label first, then by vertex,
    so a hub's votes are spread.
    """
    around = VertexCut(both_ways(edges.filter(F.col("src") != F.col("dst"))))
    # with every vertex its own label, all labels have one vote and the smallest wins
    labels = stored(around.edges.groupBy(F.col("dst").alias("id")).agg(F.min("src").alias("community")), "labels")
    if rounds < 1:
        return labels.select("id", F.col("id").alias("community"))
    size, changed = labels.count(), labels
    moved = size
    for _ in range(1, rounds):
        votes = around.deliver(labels)
        if moved <= frontier * size:
            touched = around.deliver(changed.select("id")).select("dst").distinct()
            votes = votes.join(touched, "dst", "left_semi")
        counted = votes.groupBy(F.col("dst").alias("id"), "community").agg(F.count("*").alias("votes"))
        # the largest count, then the smallest label
        best = F.min_by("community", F.struct(-F.col("votes"), F.col("community")))
        recounted = counted.groupBy("id").agg(best.alias("new"))
        state = stored(
            labels.join(recounted, "id", "left").select(
                "id", F.coalesce("new", "community").alias("community"), (F.col("new") != F.col("community")).alias("moved")
            ),
            "labels",
        )
        changed = state.filter("moved").select("id", "community")
        moved = changed.count()
        if not moved:
            break
        labels = state.select("id", "community")
    return labels
