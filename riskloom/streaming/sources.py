"""Streams of transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import key_hash
from ..operators.ordered import number_rows
from ..operators.sampling import SHUFFLE_SALT
from ..schema import KEYED_TRANSACTION_SCHEMA


def csv_stream(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType = KEYED_TRANSACTION_SCHEMA,
    files_per_batch: int = 1,
) -> DataFrame:
    """A watched folder of CSV files with header; `processing_time` marks arrival."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return (
        spark.readStream.schema(fields)
        .option("header", True)
        # columns in another order than the schema's are an error, not a silent shift
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
        # folders named key=value would add a column
        .select(*fields.fieldNames())
        .withColumn("processing_time", F.current_timestamp())
    )


def replay_batches(df: DataFrame, keys: list[str], rows_per_batch: int) -> DataFrame:
    """Number the rows' batches: shuffled by key hash, then cut into runs of equal length."""
    drawn = df.withColumn("_draw", key_hash(*[F.col(k) for k in keys], salt=SHUFFLE_SALT))
    return (
        number_rows(drawn, ["_draw", *keys], "_position")
        .withColumn("batch_id", F.floor((F.col("_position") - 1) / rows_per_batch).cast("long"))
        .drop("_draw", "_position")
    )


def write_replay(df: DataFrame, path: str, keys: list[str], rows_per_batch: int) -> str:
    """Lay a table out as a folder of batches for `csv_stream` to pick up, one file or more each."""
    batches = replay_batches(df, keys, rows_per_batch)
    (
        batches.repartition("batch_id")
        .write.mode("overwrite")
        .partitionBy("batch_id")
        .option("header", True)
        .csv(path)
    )
    return path


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType) -> DataFrame:
    """One of the given tables as a stream of its files, be it one file or a folder of many.

    The path is a pattern that only this table matches: a plain path would have to be a folder.
    """
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")
