"""Exact top-k search by inner product.

Vectors are ordered by descending length and packed into blocks. All are rotated by the singular
vectors of the candidates (from their sum of products, dimensions x dimensions numbers), so that
the first components hold most of a product. For a block of queries and a block of candidates:

* no product exceeds query length x longest candidate, so a pair of blocks that cannot reach what
  its queries already have is never formed;
* products over the first components plus the product of the residual lengths (Cauchy-Schwarz)
  bound the rest; what stays below the query's k-th best is dropped, the components are widened,
  and only what survives all of them is computed exactly, on the unrotated integers.

What queries already have comes from a first pass against the `SEED` longest candidates, whose
table has that fixed size and is broadcast; they are the first rows of the first candidate blocks, and
only these reach the driver. Stored candidate blocks, dealt by number, pass along groups of query
blocks of at most about `GROUP_BYTES`: each pair of a stored part and a group is a task, nothing is
copied, shuffled by pairs or broadcast, and the join keeps the pairs that length allows. Per pair a
query gives at most k rows; the best k of each query are ranked at the end.

Components become floor(scale * x). Defined results: vectors that are null, empty, of another
length than the most common one, or hold null or non-finite components take no part, as do rows
without id. A candidate with the query's id is the query's own row. Repeated candidates count each;
repeated queries get their rows each. Scores are exact while products stay below 2 ** 53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_dir

#: Longest candidates of the first pass; rows of a block of candidates and of queries.
SEED = 4096
CANDIDATE_BLOCK = 2048
QUERY_BLOCK = 512
#: Query blocks that a task holds in memory.
GROUP_BYTES = 32 << 20
#: Components after which bounds are tested.
STEPS = (8, 16, 32)
#: What rounding may add to a bound, relative to the product of the lengths.
SLACK = 1e-9


def prepared(vectors: DataFrame, scale: float = 256.0, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v (integers as doubles), norm2 of the vectors that take part, written once."""
    x = F.col(vector)
    good = x.isNotNull() & (F.size(x) > 0) & F.col(vec_id).isNotNull() & F.forall(
        x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))
    )
    rows = vectors.filter(good).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("double")).alias("v"),
    )
    rows = rows.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda total, c: total + c * c))
    stored = _stored(rows, "topk-vectors")
    common = stored.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return stored.filter(F.size("v") == (common["n"] if common else 0))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def rotation(rows: DataFrame) -> np.ndarray:
    """Right singular vectors of the rows, from one sum of products."""

    def products(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for part in parts:
            for at in range(0, len(part), 4096):
                x = np.vstack(part["v"].iloc[at : at + 4096].to_numpy())
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "row": list(total)})

    summed = (
        rows.select("v").mapInPandas(products, "i int, row array<double>")
        .select("i", F.posexplode("row").alias("j", "x"))
        .groupBy("i", "j")
        .agg(F.sum("x").alias("x"))
        .collect()
    )
    size = int(max((r["i"] for r in summed), default=-1)) + 1
    gram = np.zeros((size, size))
    for r in summed:
        gram[r["i"], r["j"]] = r["x"]
    return np.linalg.eigh(gram)[1][:, ::-1] if size else gram


def _packed(rows: DataFrame, block: int, turned: np.ndarray | None = None) -> DataFrame:
    """Blocks of rows in the order they come: ids, lengths and integers as bytes.

    Blocks of queries, which give `turned`, have rotated components and floors too, and in `need` the
    least length a candidate must have for some query of the block.
    """
    with_floor = turned is not None
    schema = "block long, longest double, ids binary, norms binary, ints binary, size int"
    if with_floor:
        schema += ", turned binary, floor binary, need double"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held, count = [], 0

        def out(part: pa.Table):
            nonlocal number
            ids = part.column("vec_id").to_numpy()
            x = np.vstack(part.column("v").to_pylist())
            norms = np.sqrt(part.column("norm2").to_numpy())
            values = [
                [number], [float(norms.max())], [ids.tobytes()], [norms.tobytes()], [x.tobytes()], [len(ids)],
            ]
            kinds = [pa.int64(), pa.float64(), *[pa.binary()] * 3, pa.int32()]
            if with_floor:
                floor, need = (part.column(c).to_numpy() for c in ("floor", "need"))
                values += [[(x @ turned).tobytes()], [floor.tobytes()], [float(need.min())]]
                kinds += [pa.binary(), pa.binary(), pa.float64()]
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in schema.split(", ")]
            )

        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            while count >= block:
                whole = pa.Table.from_batches(held)
                yield out(whole.slice(0, block))
                rest = whole.slice(block)
                held, count = rest.to_batches(), rest.num_rows
        if count:
            yield out(pa.Table.from_batches(held))

    return rows.select("vec_id", "v", "norm2", *(["floor", "need"] if with_floor else [])).mapInArrow(pack, schema)


def best(q, q_turned, q_norms, q_ids, c, c_turned, c_norms, c_ids, k: int, floor: np.ndarray):
    """Per query the k best candidates that reach `floor`: (query index, candidate index, score)."""
    n, dims = q.shape
    alive_q, alive_c = np.nonzero(q_norms[:, None] * c_norms[None, :] * (1 + SLACK) >= floor[:, None])
    partial = np.zeros(len(alive_q))
    done = 0
    dense = len(alive_q) > 0.5 * n * len(c)
    for step in [s for s in STEPS if s < dims]:
        if not len(alive_q):
            break
        if dense:
            partial = (q_turned[:, :step] @ c_turned[:, :step].T)[alive_q, alive_c]
        else:
            partial += np.einsum("ij,ij->i", q_turned[alive_q, done:step], c_turned[alive_c, done:step])
        done = step
        rest_q = np.sqrt(np.maximum(np.einsum("ij,ij->i", q_turned[:, step:], q_turned[:, step:]), 0))
        rest_c = np.sqrt(np.maximum(np.einsum("ij,ij->i", c_turned[:, step:], c_turned[:, step:]), 0))
        bound = partial + rest_q[alive_q] * rest_c[alive_c] + SLACK * q_norms[alive_q] * c_norms[alive_c] + 0.5
        on = bound >= floor[alive_q]
        alive_q, alive_c, partial = alive_q[on], alive_c[on], partial[on]
        dense = len(alive_q) > 0.5 * n * len(c)
    if len(alive_q) > 0.1 * n * len(c):
        score = (q @ c.T)[alive_q, alive_c]
    else:
        score = np.empty(len(alive_q))
        for at in range(0, len(alive_q), 65536):
            s = slice(at, at + 65536)
            score[s] = np.einsum("ij,ij->i", q[alive_q[s]], c[alive_c[s]])
    on = (score >= floor[alive_q]) & (q_ids[alive_q] != c_ids[alive_c])
    alive_q, alive_c, score = alive_q[on], alive_c[on], score[on]
    order = np.lexsort((c_ids[alive_c], -score, alive_q))
    alive_q, alive_c, score = alive_q[order], alive_c[order], score[order]
    first = np.searchsorted(alive_q, alive_q, side="left")
    top = np.arange(len(alive_q)) - first < k
    return alive_q[top], alive_c[top], score[top]


def longest(c_blocks: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and integers of the `SEED` longest candidates. Blocks are numbered by length, and a block has a row at least."""
    last, total = -1, 0
    for r in c_blocks.select("block", "size").orderBy("block").limit(SEED).collect():
        last, total = r["block"], total + r["size"]
        if total >= SEED:
            break
    found = c_blocks.filter(F.col("block") <= last).select("block", "ids", "ints").collect()
    found.sort(key=lambda r: r["block"])
    ids = np.frombuffer(b"".join(r["ids"] for r in found), dtype=np.int64)
    return ids[:SEED], np.frombuffer(b"".join(r["ints"] for r in found)).reshape(len(ids), dims)[:SEED]


def _matrix(value: pa.Scalar, rows: int) -> np.ndarray:
    return np.frombuffer(value.as_buffer()).reshape(rows, -1)


def search(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query; `is_query` is over vec_id."""
    spark = vectors.sparkSession
    rows = prepared(vectors, scale, vec_id, vector)
    turned = rotation(rows)
    queries = rows.filter(is_query)
    c_blocks = _stored(
        _packed(
            rows.repartitionByRange(F.desc("norm2"), F.col("vec_id")).sortWithinPartitions(F.desc("norm2"), "vec_id"),
            CANDIDATE_BLOCK,
        ).repartition("block"),
        "topk-candidates",
    )

    # first pass: what every query has among the longest candidates
    seeds = spark.sparkContext.broadcast(longest(c_blocks, len(turned)))

    def first(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, x = seeds.value
        for whole in parts:
            for at in range(0, len(whole), QUERY_BLOCK):
                part = whole.iloc[at : at + QUERY_BLOCK].copy()
                scores = np.vstack(part["v"].to_numpy()) @ x.T
                scores[part["vec_id"].to_numpy()[:, None] == ids[None, :]] = -np.inf
                part["floor"] = (
                    np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(part), -np.inf)
                )
                yield part

    seeded = queries.mapInPandas(first, "vec_id long, v array<double>, norm2 double, floor double")
    # queries that ask for similar lengths share a block
    need = F.when(F.col("norm2") > 0, F.col("floor") / F.sqrt("norm2")).otherwise(F.lit(float("-inf")))
    q_blocks = _stored(
        _packed(
            seeded.withColumn("need", need).repartitionByRange(F.col("need"), F.col("vec_id")).sortWithinPartitions("need"),
            QUERY_BLOCK, turned,
        ),
        "topk-queries",
    )
    q_side = q_blocks.select(
        F.col("block").alias("q_block"),
        *[F.col(c).alias(f"q_{c}") for c in ("ids", "norms", "ints", "turned", "size", "floor")],
        F.col("need").alias("q_need"),
    )
    # a task holds its group of query blocks whole; few parts of candidates meet more groups; the hint keeps Spark from sending a side to all by the size of its files
    held = max(1, GROUP_BYTES // (QUERY_BLOCK * 16 * max(1, len(turned))))
    blocks, parts = q_blocks.count(), max(1, c_blocks.rdd.getNumPartitions())
    lanes = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    groups = max(1, -(-blocks // held), min(blocks, -(-lanes // parts)))
    q_side = q_side.repartition(groups, "q_block")
    met = c_blocks.join(q_side.hint("shuffle_replicate_nl"), F.col("longest") * (1 + SLACK) >= F.col("q_need"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = rotated = None
        for batch in batches:
            of = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                n, m = of["q_size"][i].as_py(), of["size"][i].as_py()
                q_ids, c_ids = (np.frombuffer(of[x][i].as_buffer(), dtype=np.int64) for x in ("q_ids", "ids"))
                block, ints = of["block"][i].as_py(), _matrix(of["ints"][i], m)
                if block != held:  # it meets the queries of a group one after the other
                    held, rotated = block, ints @ turned
                x, y, score = best(
                    _matrix(of["q_ints"][i], n), _matrix(of["q_turned"][i], n),
                    np.frombuffer(of["q_norms"][i].as_buffer()), q_ids,
                    ints, rotated,
                    np.frombuffer(of["norms"][i].as_buffer()), c_ids, k, np.frombuffer(of["q_floor"][i].as_buffer()),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(x), of["q_block"][i].as_py()), pa.int64()), pa.array(x, pa.int32()),
                        pa.array(q_ids[x], pa.int64()), pa.array(c_ids[y], pa.int64()), pa.array(score.astype(np.int64)),
                    ],
                    names=["q_block", "q_row", "query_id", "vec_id", "score"],
                )

    columns = [f"q_{c}" for c in ("block", "ids", "norms", "ints", "turned", "size", "floor")]
    found = met.select(*columns, "block", "ids", "norms", "ints", "size").mapInArrow(
        compare, "q_block long, q_row int, query_id long, vec_id long, score long"
    )
    own = Window.partitionBy("q_block", "q_row", "query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def digest(vectors: DataFrame) -> DataFrame:
    """The contract's columns."""
    return search(vectors, F.col("vec_id") % 50 == 0)


#: The digest stated for DuckDB.
SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
