"""Schemas of the transaction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The column names of a transaction feed.
TIME, AMOUNT, LABEL = "Time", "Amount", "Class"
COMPONENTS = [f"V{i}" for i in range(1, 29)]
FEATURES = [*COMPONENTS, AMOUNT]

TRANSACTION_SCHEMA = T.StructType(
    [T.StructField(TIME, T.DoubleType())]
    + [T.StructField(name, T.DoubleType()) for name in FEATURES]
    + [T.StructField(LABEL, T.IntegerType())]
)

KEYED_TRANSACTION_SCHEMA = T.StructType(
    [T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType())]
    + TRANSACTION_SCHEMA.fields
)


def feed_schema(columns: list[str]) -> T.StructType:
    """The types of a feed that has just these of the known columns, in this order."""
    known = {f.name: f for f in KEYED_TRANSACTION_SCHEMA.fields}
    return T.StructType([known[c] for c in columns if c in known])


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast every decimal in the schema to double, inside structs and arrays as well."""

    def convert(dtype: T.DataType) -> T.DataType:
        if isinstance(dtype, T.DecimalType):
            return T.DoubleType()
        if isinstance(dtype, T.ArrayType):
            return T.ArrayType(convert(dtype.elementType), dtype.containsNull)
        if isinstance(dtype, T.MapType):
            return T.MapType(dtype.keyType, convert(dtype.valueType), dtype.valueContainsNull)
        if isinstance(dtype, T.StructType):
            return T.StructType(
                [T.StructField(f.name, convert(f.dataType), f.nullable) for f in dtype.fields]
            )
        return dtype

    targets = ((field, convert(field.dataType)) for field in df.schema.fields)
    return df.select(
        *[
            F.col(f"`{field.name}`")
            if target == field.dataType
            else F.col(f"`{field.name}`").cast(target).alias(field.name)
            for field, target in targets
        ]
    )
