"""Transactions derived from the event and embedding tables.

Events give time, account and amount; the embedding an event points at gives the
28 anonymous components. The rule of the mapping is fixed, so any engine that
reads the same tables derives the same transactions.

The full table is derived once per application and kept as Parquet in the shared folder,
as a feed would be. Queries then scan just the columns they use, and their filters reach
the files; otherwise each would repeat the join and the arithmetic for 28 columns.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import AMOUNT, COMPONENTS, LABEL, TIME
from ..session import work_dir
from .tables import read_table, write_parquet

# Moduli and factors of the mapping.
LABEL_MODULUS, LABEL_BELOW, LABEL_SQUARE, LABEL_LINEAR = 997, 20, 31, 7919
NOISE_MODULUS, NOISE_KEY, NOISE_INDEX = 1009, 7919, 104729
EPOCH = "2024-01-01 00:00:00"

MARK = "mark"


def _is_fraud(key: Column) -> Column:
    # reduced before squaring: the key itself squared would overflow on large tables
    m = key % LABEL_MODULUS
    return (m * m * LABEL_SQUARE + m * LABEL_LINEAR) % LABEL_MODULUS < LABEL_BELOW


def _component(i: int) -> str:
    """Component i as SQL text (one call per column, where operators would take a dozen)."""
    noise = f"CAST((noise + {i * NOISE_INDEX}) % {NOISE_MODULUS} AS DOUBLE) / {NOISE_MODULUS}D"
    return f"shift + spread * (CAST(embedding[{i - 1}] AS DOUBLE) * 8D + {noise} - 0.5D) AS V{i}"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(read_table(spark, sf_dir, "events"))


def shaped(events: DataFrame) -> DataFrame:
    """Events, a table or a stream, with the transaction columns that need no embedding."""
    seconds = (
        F.unix_micros(F.col("ts").cast("timestamp"))
        - F.unix_micros(F.lit(EPOCH).cast("timestamp"))
    ) / F.lit(1e6)
    fraud = F.col("fraud")
    return (
        # a step of its own, so that the label is worked out once per row
        events.withColumn("fraud", _is_fraud(F.col("event_id")))
        .select(
            "event_id",
            "user_id",
            "fraud",
            seconds.alias(TIME),
            F.when(fraud, F.col("value") * 4.0).otherwise(F.col("value")).alias(AMOUNT),
            fraud.cast("int").alias(LABEL),
            F.get_json_object("props", "$.k").cast("int").alias(MARK),
        )
    )


def derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns, computed from the given tables. Each event has at most one embedding."""
    embeddings = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    size = embeddings.agg(F.count("*")).scalar()
    return with_components(_events(spark, sf_dir), embeddings, size, COMPONENTS)


def with_components(rows: DataFrame, embeddings: DataFrame, size: int | Column, components: list[str]) -> DataFrame:
    """Rows of `shaped` with components from the embeddings, of which there are `size`."""
    joined = rows.withColumn("vec_id", F.col("event_id") % size).join(embeddings, "vec_id", "left")
    # frauds: three times as spread and lower by two
    return joined.selectExpr(
        "*",
        f"event_id % {NOISE_MODULUS} * {NOISE_KEY} AS noise",
        "IF(fraud, -2D, 0D) AS shift",
        "IF(fraud, 3D, 1D) AS spread",
    ).selectExpr(
        "event_id", "user_id", TIME, *[_component(int(c[1:])) for c in components], AMOUNT, LABEL, MARK
    )


def transaction_stream(spark: SparkSession, sf_dir: str, components: list[str] | None = None) -> DataFrame:
    """The transactions as a stream of the event files, joined to the embeddings as they stand."""
    from ..streaming.sources import table_stream

    components = COMPONENTS if components is None else components
    embeddings = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    events = table_stream(spark, sf_dir, "events", read_table(spark, sf_dir, "events").schema)
    # a stream takes no subquery; the count comes from the files' footers
    rows = with_components(shaped(events), embeddings, embeddings.count(), components)
    return rows.select("event_id", "user_id", TIME, *components, AMOUNT, LABEL).withColumn(
        "processing_time", F.current_timestamp()
    )


@cache
def _stored(application: str, spark: SparkSession, sf_dir: str) -> str:
    # sorted, so that the files are the same whatever order a shuffle delivered the rows in;
    # ids rise with time, which also narrows the value ranges per file
    rows = derive(spark, sf_dir).sortWithinPartitions("event_id")
    return write_parquet(rows, work_dir(spark, "transactions"))


def _table(spark: SparkSession, sf_dir: str, components: list[str]) -> DataFrame:
    if not components:
        return _events(spark, sf_dir)
    return spark.read.parquet(_stored(spark.sparkContext.applicationId, spark, sf_dir))


def transactions(
    spark: SparkSession, sf_dir: str, components: list[str] | None = None
) -> DataFrame:
    """Transactions with `components` (default: all 28). Without any, only events are read."""
    components = COMPONENTS if components is None else components
    table = _table(spark, sf_dir, components)
    return table.select("event_id", "user_id", TIME, *components, AMOUNT, LABEL)


def raw_transactions(
    spark: SparkSession, sf_dir: str, components: list[str] | None = None
) -> DataFrame:
    """The feed before cleaning: events whose payload says so lack a value or carry a bad amount.

    Payload mark: 0 no V1, 1 no amount, 2 refund (negative amount), 3 zero amount.
    """
    components = COMPONENTS if components is None else components
    mark, amount = F.col(MARK), F.col(AMOUNT)
    changed = {
        AMOUNT: F.when(mark == 1, F.lit(None)).when(mark == 2, -amount).when(mark == 3, 0.0).otherwise(amount)
    }
    if "V1" in components:
        changed["V1"] = F.when(mark != 0, F.col("V1"))
    return (
        _table(spark, sf_dir, components)
        .withColumns(changed)
        .select("event_id", "user_id", TIME, *components, AMOUNT, LABEL)
    )
