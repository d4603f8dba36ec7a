"""Edges and vertices of a graph packed as arrays, for rounds that pass numbers along edges.

Vertices are dealt to parts by the hash of their id, edges to the part of their source; the edges of
hubs, whose values all parts get, are dealt by their other end as well. A part's edges are sorted by
the part and id of their target, so that what it sends to a part is one array of ids and one of sums.
A round moves those sums; edges stay where they are, bucketed by part, and of the vertices only their
packed state is written. Vertices without an id, which receive but never send, are part -1.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffles_go, stored, work_dir

#: Edges that a part holds, about.
PART = 1 << 20
#: Edges of a row.
CHUNK = 1 << 20

_SENT = "part long, ids binary, sums binary"
_STATE = "part long, ids binary, out binary, rank binary, change binary, sends binary, lost double, moved long, size long, sinks long, hub_ids binary, hub_sends binary"


def _array(value: pa.Scalar, kind=np.float64) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind) if value.is_valid else np.zeros(0, kind)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.table([pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


class PackedGraph:
    """Directed edges (src, dst), parallel ones counted by the column `weight` if given. Ids are whole numbers."""

    def __init__(self, edges: DataFrame, weight: str | None = None):
        spark = edges.sparkSession
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        slots = max(64, tasks)
        ends = [F.col(c).cast("long").alias(c) for c in ("src", "dst")]
        edges = edges.select(*ends, *([F.col(weight).cast("double").alias("n")] if weight else []))
        sources = stored(edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("edges"), (F.sum("n") if weight else F.count("*").cast("double")).alias("out")), "sources")
        total = sources.agg(F.sum("edges")).first()[0] or 0
        self.parts = max(tasks, -(-total // PART))
        share = max(1, -(-total // (4 * slots)))
        hubs = sources.filter((F.col("edges") > share) & F.col("id").isNotNull()).select("id", F.ceil(F.col("edges") / share).cast("int").alias("slots"))
        self.hubs = np.sort(np.array([r["id"] for r in hubs.collect()], np.int64))
        placed = edges.filter(F.col("src").isNotNull())
        part = self.part_of(F.col("src"))
        if len(self.hubs):
            placed = placed.join(F.broadcast(hubs.withColumnRenamed("id", "src")), "src", "left")
            slot = F.pmod(F.xxhash64("dst"), F.col("slots"))
            part = F.when(F.col("slots").isNull(), part).otherwise(F.pmod(F.xxhash64("src", slot), F.lit(self.parts)))
        to = self.part_of(F.col("dst")).cast("int").alias("to")
        placed = placed.select(part.cast("int").alias("part"), "src", F.coalesce("dst", F.lit(0)).alias("dst"), to, *(["n"] if weight else []))
        name = "packed_" + uuid.uuid4().hex
        with shuffles_go(spark):
            (
                placed.groupBy("part").applyInArrow(_packed_edges, "part long, srcs binary, take binary, weights binary, starts binary, ids binary, parts binary, ends binary")
                .write.bucketBy(self.parts, "part").option("path", work_dir(spark, name)).format("parquet").saveAsTable(name)
            )
        self.edges = spark.read.table(name)
        self.sources = sources.select(self.part_of(F.col("id")).alias("part"), F.coalesce("id", F.lit(0)).alias("id"), "out")

    def part_of(self, vertex: Column) -> Column:
        return F.when(vertex.isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(vertex), F.lit(self.parts))).cast("long")

    def first_state(self) -> DataFrame:
        """A row for each part, of vertices that have neither rank nor change yet."""
        hubs = self.hubs
        reached = self.edges.select("ids", "parts", "ends").mapInArrow(_targets, "part long, ids binary")

        def begin(key, sources: pa.Table, reached: pa.Table) -> pa.Table:
            froms = sources.column("id").to_numpy()
            ids = np.unique(np.concatenate([froms, *(_array(x, np.int64) for x in reached.column("ids"))]))
            out = np.full(len(ids), np.nan)  # a sink
            out[np.searchsorted(ids, froms)] = sources.column("out").to_numpy()
            return _table([_state(key[0].as_py(), ids, out, np.zeros(len(ids)), np.zeros(len(ids)), 0.0, hubs)], _STATE)

        return stored(self.sources.groupBy("part").cogroup(reached.groupBy("part")).applyInArrow(begin, _STATE), "ranks")

    def next_state(self, state: DataFrame, hub_sends: np.ndarray, alike: float, least: float, damping: float, send: bool = True) -> DataFrame:
        """Each vertex changes by what it is sent and by `alike`; changes up to `least` are left out."""
        hubs = self.hubs

        def pass_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                of = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
                for i in range(batch.num_rows):
                    srcs, take, starts, ids, parts, ends = (
                        _array(of[c][i], k) for c, k in (("srcs", np.int64), ("take", np.int32), ("starts", np.int64), ("ids", np.int64), ("parts", np.int64), ("ends", np.int64))
                    )
                    value = _looked_up(srcs, _array(of["own_ids"][i], np.int64), _array(of["sends"][i]))
                    if len(hubs):
                        at = np.minimum(np.searchsorted(hubs, srcs), len(hubs) - 1)
                        value = np.where(hubs[at] == srcs, hub_sends[at], value)
                    along, weights = value[take], _array(of["weights"][i])
                    sums = np.add.reduceat(along * weights if len(weights) else along, starts)
                    rows = [
                        (int(p), ids[a:b].tobytes(), sums[a:b].tobytes()) for p, a, b in zip(parts, np.concatenate([[0], ends]), ends) if sums[a:b].any()
                    ]
                    yield from _table(rows, _SENT).to_batches()

        def receive(key, own: pa.Table, sent: pa.Table) -> pa.Table:
            if not own.num_rows:
                return _table([], _STATE)
            ids, out, rank = (_array(own.column(c)[0], k) for c, k in (("ids", np.int64), ("out", np.float64), ("rank", np.float64)))
            change = np.full(len(ids), alike)
            for a, b in zip(sent.column("ids"), sent.column("sums")):
                change[np.searchsorted(ids, _array(a, np.int64))] += _array(b)
            change[np.abs(change) <= least] = 0.0
            return _table([_state(key[0].as_py(), ids, out, rank, change, damping, hubs)], _STATE)

        own = state.select("part", F.col("ids").alias("own_ids"), "sends")
        # a part that has only edges of hubs may have no vertex
        sent = self.edges.join(own.hint("shuffle_hash"), "part", "left").mapInArrow(pass_on, _SENT) if send else state.select("part", "ids", F.col("rank").alias("sums")).limit(0)
        return stored(
            state.select("part", "ids", "out", "rank").groupBy("part").cogroup(sent.groupBy("part")).applyInArrow(receive, _STATE), "ranks"
        )

    def totals(self, state: DataFrame) -> tuple[int, int, float, int, np.ndarray]:
        """Vertices, sinks, change at sinks, vertices that changed, and what hubs send."""
        rows = state.select("size", "sinks", "lost", "moved", "hub_ids", "hub_sends").collect()
        sends = np.zeros(len(self.hubs))
        for r in rows:
            sends[np.searchsorted(self.hubs, np.frombuffer(r["hub_ids"], np.int64))] = np.frombuffer(r["hub_sends"])
        return *(sum(r[c] for r in rows) for c in ("size", "sinks", "lost", "moved")), sends

    @staticmethod
    def ranks(state: DataFrame) -> DataFrame:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, rank = _array(batch.column(1)[i], np.int64), _array(batch.column(2)[i])
                    none = np.full(len(ids), batch.column(0)[i].as_py() < 0)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, mask=none), pa.array(rank)], names=["id", "rank"])

        return state.select("part", "ids", "rank").mapInArrow(rows, "id long, rank double")


def _looked_up(wanted: np.ndarray, ids: np.ndarray, values: np.ndarray) -> np.ndarray:
    """0 for what is not there."""
    if not len(ids):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
    return np.where(ids[at] == wanted, values[at], 0.0)


def _state(part: int, ids: np.ndarray, out: np.ndarray, rank: np.ndarray, change: np.ndarray, damping: float, hubs: np.ndarray) -> tuple:
    sink = np.isnan(out)
    sends = np.zeros(len(ids))
    np.divide(change * damping, out, out=sends, where=~sink & (out != 0))
    mine = np.flatnonzero(np.isin(ids, hubs)) if part >= 0 else np.zeros(0, int)
    return (
        part, ids.tobytes(), out.tobytes(), (rank + change).tobytes(), change.tobytes(), sends.tobytes(), float(change[sink].sum()),
        int(np.count_nonzero(change)), len(ids), int(sink.sum()), ids[mine].tobytes(), sends[mine].tobytes(),
    )


def _packed_edges(table: pa.Table) -> pa.Table:
    schema = "part long, srcs binary, take binary, weights binary, starts binary, ids binary, parts binary, ends binary"
    part, src, dst, to = (table.column(i).to_numpy() for i in range(4))
    n = table.column(4).to_numpy() if table.num_columns > 4 else None
    order = np.argsort(dst)
    # 16 bits are sorted by counting
    narrow = to[order].astype(np.int16 if to.max() < 1 << 15 else np.int64)
    order = order[np.argsort(narrow, kind="stable")]
    rows = []
    for at in range(0, len(order), CHUNK):
        some = order[at : at + CHUNK]
        srcs, take = np.unique(src[some], return_inverse=True)
        b, d, w = to[some], dst[some], np.ones(1) if n is None else n[some]
        first = np.concatenate([[True], (b[1:] != b[:-1]) | (d[1:] != d[:-1])])
        starts = np.flatnonzero(first)
        parts, ends = np.unique(b[starts], return_counts=True)
        rows.append((
            int(part[0]), srcs.tobytes(), take.astype(np.int32).tobytes(), b"" if (w == 1).all() else w.tobytes(), starts.tobytes(),
            d[starts].tobytes(), parts.astype(np.int64).tobytes(), np.cumsum(ends).tobytes(),
        ))
    return _table(rows, schema)


def _targets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, parts, ends = (_array(batch.column(c)[i], np.int64) for c in range(3))
            rows = [(int(p), ids[a:b].tobytes()) for p, a, b in zip(parts, np.concatenate([[0], ends]), ends)]
            yield from _table(rows, "part long, ids binary").to_batches()
