"""Row-wise Python over Arrow batches, with bounded memory and any extra columns passed through."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

#: Rows whose results are held at a time.
STEP = 256

Make = Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]]


def add_columns(df: DataFrame, columns: list[StructField], make: Make) -> DataFrame:
    """`df` with more columns, made by the function that `make` returns once per task.

    The function gets a batch of at most `STEP` rows with all columns of `df` and returns one Arrow
    array per new column. A column of `df` with a new column's name is replaced.
    """
    names = [f.name for f in columns]
    kept = [f for f in df.schema.fields if f.name not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            work = work or make()
            for at in range(0, batch.num_rows, STEP):
                piece = batch.slice(at, STEP)
                made = work(piece)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(f.name) for f in kept] + made, names=[f.name for f in kept] + names
                )

    return df.mapInArrow(run, StructType(kept + columns))
