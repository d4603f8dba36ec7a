"""Whitening of embeddings along their principal components, found by the Jacobi-Davidson method.

Each entry c becomes the whole number x = floor(1024 c) + 100000, so counts and sums are exact. The
covariance of x is never formed: all that is asked of the data is its product with a narrow block of
vectors, C^T (C W) / n with C the centred rows, a map over the stored rows and a sum per dimension.
Blocks of vectors share a product, so a step costs one job however many components are sought.

* Rayleigh-Ritz in the subspace at hand gives approximate eigenvectors and their residuals.
* Leading pairs whose residual has come down to rounding (`TOLERANCE`) are locked.
* For the others the correction equation, projected off the locked and the approximate
  eigenvectors, is solved by a few steps of MINRES, all columns side by side. The corrections extend
  the subspace; a full subspace is restarted from its best vectors.
* A last Rayleigh-Ritz with a fresh product over the locked vectors gives values and vectors.

**At scale.** Rows are stored once in the shared folder as packed whole numbers; each product reads
them, and d x block sums per task meet by dimension. The driver holds d x subspace numbers.

Defined results: a row takes no part if its vector is null, empty, or holds an entry that is null,
not finite or 2**42 or more in size (no long holds it once scaled), or if its length is not the
commonest (the longest of equally common ones). Repeated rows count and come out as often as they
are there; null ids stay. Components without variance are left out, so equal vectors, a single
one or an empty table give no rows. `deviation` is null where no long holds it; `deviation_exact`
has it up to 38 digits. Other columns of the table are not carried over by `digest`; `transform`
keeps them and replaces those with its columns' names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, LongType, StructField

from riskloom.session import work_dir

from .arrow import add_columns

SCALE = 1024
SHIFT = 100_000
LIMIT = 2.0**42
COMPONENTS = 8
#: Vectors sought beyond the wanted ones, so that near values don't hold the wanted ones up.
GUARD = 4
#: Steps of MINRES for a correction, and blocks of vectors in a subspace.
INNER = 5
BLOCKS = 6
#: Residual over the largest value, per square root of the dimension, that counts as rounding.
TOLERANCE = 8 * np.finfo(float).eps
#: Values below this share of the largest are no variance.
NOTHING = 1e-12
ROUNDS = 200
#: Stored rows in a packed block.
PACK = 4096

Product = Callable[[np.ndarray], np.ndarray]


# ---- the method, for any symmetric product


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal base of what `new` adds to the orthonormal columns in `against`."""
    base = np.column_stack(against) if against else np.zeros((len(new), 0))
    size = np.linalg.norm(new, axis=0)
    new = new[:, size > 0] / size[size > 0]
    for _ in range(2):
        new = new - base @ (base.T @ new)
        left, size, _ = np.linalg.svd(new, full_matrices=False)
        new = left[:, size > 1e-8]
    return new[:, : len(base) - base.shape[1]]


def minres(product: Product, right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of product(x) = right, a column each, from 0."""
    safe = lambda x: np.where(x == 0, 1.0, x)
    beta = np.linalg.norm(right, axis=0)
    v, v_old = right / safe(beta), np.zeros_like(right)
    x, w, w_old = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    left, cos, cos_old = beta.copy(), np.ones_like(beta), np.ones_like(beta)
    sin, sin_old = np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        new = product(v) - beta * v_old
        alpha = (v * new).sum(axis=0)
        new -= alpha * v
        beta_new = np.linalg.norm(new, axis=0)
        delta = cos * alpha - cos_old * sin * beta
        on, above, top = np.hypot(delta, beta_new), sin * alpha + cos_old * cos * beta, sin_old * beta
        cos_old, cos, sin_old, sin = cos, delta / safe(on), sin, beta_new / safe(on)
        w, w_old = (v - top * w_old - above * w) / safe(on), w
        x += cos * left * w
        left = -sin * left
        v, v_old, beta = new / safe(beta_new), v, beta_new
    return x


def jacobi_davidson(product: Product, d: int, wanted: int, guard: int = GUARD, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest values of a symmetric positive semidefinite product, their vectors and residuals."""
    wanted = min(wanted, d)
    block = min(d, wanted + guard)
    most = min(d, BLOCKS * block)
    locked = np.zeros((d, 0))
    base = _orthonormal(np.random.default_rng(seed).normal(size=(d, block)))
    image = product(base)
    largest = 0.0
    for _ in range(ROUNDS):
        small = base.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        base, image = base @ turn, image @ turn
        largest = max(largest, values[0])
        residual = image - base * values
        residual -= locked @ (locked.T @ residual)
        enough = np.linalg.norm(residual, axis=0) <= TOLERANCE * np.sqrt(d) * largest
        done = len(enough) if enough.all() else int(np.argmin(enough))
        # nothing is left outside: the subspace's pairs are as good as rounding lets them be
        whole = locked.shape[1] + base.shape[1] >= d
        done = min(len(enough) if whole else done, block - locked.shape[1])
        locked = np.column_stack([locked, base[:, :done]])
        if locked.shape[1] >= wanted:
            break
        base, image, values, residual = base[:, done:], image[:, done:], values[done:], residual[:, done:]
        seek = min(block - locked.shape[1], base.shape[1])
        if base.shape[1] + seek > most - locked.shape[1]:
            keep = max(seek, (most - locked.shape[1]) // 2)
            base, image, values = base[:, :keep], image[:, :keep], values[:keep]
        near = np.column_stack([locked, base[:, :seek]])
        off = lambda x: x - near @ (near.T @ x)
        shift = values[:seek]
        corrections = minres(lambda x: off(product(x) - shift * x), -off(residual[:, :seek]), INNER)
        new = _orthonormal(corrections, locked, base)
        if not new.shape[1]:
            new = _orthonormal(np.random.default_rng(seed).normal(size=(d, seek)), locked, base)
        base, image = np.column_stack([base, new]), np.column_stack([image, product(new)])
    else:
        raise RuntimeError(f"residuals still above rounding after {ROUNDS} rounds")
    vectors = _orthonormal(locked)
    image = product(vectors)
    small = vectors.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)[:wanted]
    vectors, image = vectors @ turn[:, order], image @ turn[:, order]
    return values[order], vectors, np.linalg.norm(image - vectors * values[order], axis=0)


# ---- the data's side


@dataclass(frozen=True)
class Whitening:
    n: int
    #: Exact sums of x per dimension.
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    #: Norms of what the product leaves of the vectors, over the largest value.
    residuals: np.ndarray
    identity_error: float


def _centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean of x - SHIFT as nearest whole numbers and what is left."""
    whole = [(2 * (s - SHIFT * n) + n) // (2 * n) for s in sums]
    left = [(s - (SHIFT + w) * n) / n for s, w in zip(sums, whole)]
    return np.array(whole, dtype=np.int64), np.array(left)


def _scaled(vectors: pa.Array) -> np.ndarray:
    """floor(1024 c) of every vector, a row each."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * SCALE).astype(np.int64).reshape(len(vectors), -1)


def usable(df: DataFrame, column: str) -> DataFrame:
    """Rows whose vector has only entries that can be scaled, and the commonest length."""
    fits = lambda c: c.isNotNull() & (F.abs(F.coalesce(c, F.lit(0)).cast("double")) < LIMIT)
    whole = df.filter(F.col(column).isNotNull() & (F.size(column) > 0) & F.forall(column, fits))
    common = whole.groupBy(F.size(column).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return whole.filter(F.size(column) == (common["size"] if common else 0))


def _stored(rows: DataFrame, column: str) -> DataFrame:
    """The scaled vectors packed into blocks, in the shared folder."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), PACK):
                x = _scaled(batch.column(0).slice(at, PACK))
                if np.abs(x).max() < 2**31:
                    x = x.astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["rows", "block"])

    path = work_dir(rows.sparkSession, "whitening")
    rows.select(column).mapInArrow(pack, "rows int, block binary").write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for rows, block in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = block.as_buffer()
            yield np.frombuffer(raw, dtype="<i4" if len(raw) == 4 * rows * d else "<i8").reshape(rows, d)


def _sums(blocks: DataFrame, d: int, width: int, of_block: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum over all blocks of a d x width table each, summed per task, then by row of the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _blocks(batches, d):
            own = of_block(x)
            total = own if total is None else total + own
        if total is not None:
            lists = pa.ListArray.from_arrays(np.arange(len(total) + 1, dtype=np.int32) * width, pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), lists], names=["i", "p"])

    to = "decimal(38,0)" if kind == "long" else kind
    parts = blocks.mapInArrow(run, f"i int, p array<{kind}>")
    rows = parts.groupBy("i").agg(*[F.sum(F.get("p", F.lit(j)).cast(to)).alias(f"s{j}") for j in range(width)]).collect()
    return np.array([list(r)[1:] for r in sorted(rows)])


def fit(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable rows; None if nothing varies."""
    rows = usable(df, column)
    first = rows.select(F.size(column).alias("size")).first()
    if first is None:
        return None
    d = first["size"]
    blocks = _stored(rows, column)
    n = blocks.agg(F.sum("rows")).first()[0]
    shifted = _sums(blocks, d, 1, lambda x: x.sum(axis=0, dtype=np.int64)[:, None], "long")
    sums = [int(s) + SHIFT * n for s in shifted[:, 0]]
    whole, left = _centre(n, sums)

    def product(vectors: np.ndarray) -> np.ndarray:
        def of_block(x: np.ndarray) -> np.ndarray:
            c = (x - whole) - left
            return c.T @ (c @ vectors)

        return _sums(blocks, d, vectors.shape[1], of_block) / n

    values, vectors, residuals = jacobi_davidson(product, d, components)
    varied = values > max(values[0], 0) * NOTHING
    if not varied.any():
        return None
    values, vectors = values[varied], vectors[:, varied]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    k = len(values)
    scaled = vectors / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        """Products of whitened components, their sums, and the sum of squares of the centred rows."""
        c = (x - whole) - left
        w = c @ scaled
        return np.vstack([w.T @ w, w.sum(axis=0), np.full(k, (c * c).sum())])

    total = _sums(blocks, d, k, moments) / n
    covariance = total[:k] - np.outer(total[k], total[k])
    error = float(np.abs(covariance - np.eye(k)).max())
    return Whitening(n, sums, vectors, values, float(total[k + 1, 0]), residuals[varied] / values[0], error)


def _squares(z: np.ndarray) -> list[int]:
    """The exact sum of squares of each row of whole numbers, in limbs of 20 bits."""
    limbs = []
    for _ in range(3):
        limbs.append(z & 0xFFFFF)
        z = z >> 20
    limbs.append(z)
    powers = [sum((limbs[i] * limbs[p - i]).sum(axis=1) for i in range(max(0, p - 3), min(p, 3) + 1)) for p in range(7)]
    return [sum(int(v) << (20 * p) for p, v in enumerate(row)) for row in zip(*powers)]


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """The exact sum over dimensions of (n x - S) ** 2 of each row, x without SHIFT."""
    shifted = [s - SHIFT * n for s in sums]
    reach = max(max(abs(n * int(v) - s) for v in (lo, hi)) for lo, hi, s in zip(x.min(axis=0), x.max(axis=0), shifted)) if len(x) else 0
    if reach < 2**62 and max(map(abs, shifted)) < 2**62 and n * int(np.abs(x).max(initial=0)) < 2**62:
        z = x * n - np.array(shifted, dtype=np.int64)
        return (z * z).sum(axis=1).tolist() if reach**2 * x.shape[1] < 2**63 else _squares(z)
    return [sum((n * v - s) ** 2 for v, s in zip(row, shifted)) for row in x.tolist()]


def transform(df: DataFrame, model: Whitening, column: str = "embedding") -> DataFrame:
    """The rows of `df` that are usable and as long as the model's, with deviation, deviation_exact and
    `whitened`, a list of the row's components."""
    whole, left = _centre(model.n, model.sums)
    scaled = model.vectors / np.sqrt(model.values)
    n, sums, d = model.n, model.sums, len(model.sums)

    def make():
        def work(batch):
            vectors = batch.column(column)
            x = _scaled(vectors) if len(vectors) else np.zeros((0, d), dtype=np.int64)
            exact = _deviations(x, n, sums)
            w = ((x - whole) - left) @ scaled
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1], pa.array(w.ravel()))
            return [
                pa.array([v if v < 2**63 else None for v in exact], pa.int64()),
                pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0)),
                lists,
            ]

        return work

    columns = [StructField("deviation", LongType()), StructField("deviation_exact", DecimalType(38, 0)), StructField("whitened", ArrayType(DoubleType()))]
    fits = lambda c: c.isNotNull() & (F.abs(F.coalesce(c, F.lit(0)).cast("double")) < LIMIT)
    return add_columns(df.filter((F.size(column) == d) & F.forall(column, fits)), columns, make)


def digest(vectors: DataFrame) -> DataFrame:
    """The contract's columns: a row per vector and component."""
    rows = vectors.select("vec_id", "embedding")
    model = fit(rows)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    listed = transform(rows, model).select(
        "vec_id", F.posexplode("whitened").alias("_at", "whitened"), "deviation", "deviation_exact"
    )
    return listed.select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("_at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
        "deviation_exact",
    )
