"""Sorted lists of whole numbers packed as bytes, and their intersections, over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that are unpacked at a time.
STEP = 4096
WIDTHS = (1, 2, 4, 8)


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def packed(df: DataFrame, key: str, values: str, name: str) -> DataFrame:
    """(`name`, first, n, steps) for each row with a sorted list `values` that is not empty.

    `steps` holds the differences of neighbours, each as wide as the list's largest needs.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(1)
            counts = found.value_lengths().to_numpy().astype(np.int64)
            flat, starts = found.flatten().to_numpy(), _starts(counts)
            # differences wrap as unsigned numbers, and so do their sums
            steps = np.diff(flat, prepend=flat[:1]).view(np.uint64)
            steps[starts[:-1]] = 0
            most = np.maximum.reduceat(steps, starts[:-1]) if len(flat) else steps
            width = np.array(WIDTHS)[np.searchsorted([1 << 8, 1 << 16, 1 << 32], most, side="right")]
            for w in WIDTHS:
                rows = np.flatnonzero(width == w)
                if not len(rows):
                    continue
                inner = np.repeat(width == w, counts)
                inner[starts[:-1]] = False
                ends = _starts((counts[rows] - 1) * w).astype(np.int32)
                data = steps[inner].astype(f"<u{w}").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)), pa.array(flat[starts[rows]], pa.int64()), pa.array(counts[rows], pa.int32()),
                        pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(data)]),
                    ],
                    names=[name, "first", "n", "steps"],
                )

    rows = df.filter(F.size(values) > 0).select(F.col(key).cast("long").alias(name), F.col(values).cast("array<long>").alias("list"))
    return rows.mapInArrow(pack, f"{name} long, first long, n int, steps binary")


def unpacked(first: np.ndarray, n: np.ndarray, steps: pa.BinaryArray) -> np.ndarray:
    """The lists, one after the other."""
    n = n.astype(np.int64)
    starts = _starts(n)
    out = np.zeros(starts[-1], np.uint64)
    ends = np.frombuffer(steps.buffers()[1], np.int32, len(steps) + 1, steps.offset * 4).astype(np.int64)
    size = np.diff(ends)
    data = np.frombuffer(steps.buffers()[2] or b"", np.uint8)
    width = np.where(n > 1, size // np.maximum(n - 1, 1), 0)
    for w in WIDTHS:
        mine = width == w
        if mine.any():
            inner = np.repeat(mine, n)
            inner[starts[:-1]] = False
            taken = np.repeat(mine, size)
            out[inner] = data[ends[0] : ends[-1]][taken].view(f"<u{w}")
    out[starts[:-1]] = first.view(np.uint64)
    total = np.cumsum(out)
    before = np.where(starts[:-1] > 0, total[starts[:-1] - 1], np.uint64(0))
    return (total - np.repeat(before, n)).view(np.int64)


def _common(own: np.ndarray, own_n: np.ndarray, told: np.ndarray, told_n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and values that both lists of a row hold."""
    rows, own_rows = np.repeat(np.arange(len(told_n)), told_n), np.repeat(np.arange(len(own_n)), own_n)
    least = min(int(own.min()), int(told.min()))
    span = max(int(own.max()), int(told.max())) - least + 1
    if span * (len(own_n) + 1) < 1 << 62:
        own_key, key = own_rows * span + (own - least), rows * span + (told - least)
    else:
        code = np.unique(np.concatenate([own, told]))
        own_key, key = (r * len(code) + np.searchsorted(code, x) for r, x in ((own_rows, own), (rows, told)))
    at = np.minimum(np.searchsorted(own_key, key), len(own_key) - 1)
    same = own_key[at] == key
    return rows[same], told[same]


def corners(df: DataFrame) -> DataFrame:
    """(id, n): for rows of `src`, `dst` and their packed lists, how often a vertex is in a triangle, summed by piece."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                batch = whole.slice(at, STEP)
                src, dst, first, n, steps, own_first, own_n, own_steps = batch.columns
                first, n, own_first, own_n = (x.to_numpy() for x in (first, n, own_first, own_n))
                rows, third = _common(unpacked(own_first, own_n, own_steps), own_n, unpacked(first, n, steps), n)
                ids, count = np.unique(np.concatenate([src.to_numpy()[rows], dst.to_numpy()[rows], third]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(count, pa.int64())], names=["id", "n"])

    columns = ["src", "dst", "first", "n", "steps", "own_first", "own_n", "own_steps"]
    return df.select(*columns).mapInArrow(meet, "id long, n long")
