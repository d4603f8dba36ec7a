"""File tables: CSV, Parquet, JSON in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import number_rows
from ..schema import decimals_to_double


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without a schema Spark reads the file once more to infer types."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    # enforceSchema=False checks the header, so columns in another order fail instead of shifting
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names as the header states them; no rows are read."""
    return spark.read.option("header", True).csv(path).columns


def with_key(df: DataFrame, time: str, name: str = "event_id") -> DataFrame:
    """Number rows that come without a key, by time and content; not by their place in the files."""
    mixed = df.withColumn("_mix", F.xxhash64(*df.columns))
    return number_rows(mixed, [time, "_mix"], name).drop("_mix")


def register_view(df: DataFrame, name: str = "transactions") -> DataFrame:
    """Name a table for SQL; returns it to keep chains going."""
    df.createOrReplaceTempView(name)
    return df


def rows_to_table(spark: SparkSession, rows: list[dict], schema: str | T.StructType) -> DataFrame:
    """Small lists of metric records as a table; the schema is explicit."""
    return spark.createDataFrame(rows, schema)


def parse_json_events(df: DataFrame, schema: T.StructType, body: str | Column = "body") -> DataFrame:
    """Payload text or bytes to typed columns, plus `_malformed` with the text that would not parse.

    Works on streams and batches alike. Use `accepted`/`rejected` to split the result.
    """
    text = (F.col(body) if isinstance(body, str) else body).cast("string")
    with_corrupt = T.StructType([*schema.fields, T.StructField("_malformed", T.StringType())])
    parsed = F.from_json(
        text, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    )
    return df.select(parsed.alias("data")).select("data.*")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("_malformed").isNull()).drop("_malformed")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("_malformed").isNotNull()).select("_malformed")


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with header, written by the executors. Sort small reports first; they stay in order."""
    decimals_to_double(df).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """One JSON document per row; nested metric records keep their shape, decimals become numbers."""
    decimals_to_double(df).write.mode("overwrite").json(path)
    return path


def as_json(df: DataFrame, name: str = "document") -> DataFrame:
    """The rows as JSON text in one column."""
    flat = decimals_to_double(df)
    return flat.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in flat.columns])).alias(name))
