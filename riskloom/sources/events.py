"""Transactions as JSON bodies whose fields drift: read by field, with the unreadable ones kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _checked(event: Column, field: T.StructField, required: bool) -> tuple[Column, Column]:
    """A field's value, and what is wrong with it (null if nothing)."""
    path, kind = f"$['{field.name}']", field.dataType.simpleString()
    value = F.try_variant_get(event, path, kind)
    read = value.isNotNull()
    if isinstance(field.dataType, T.IntegralType):
        # a number with a fraction is no whole number, rather than one cut off
        read = read & F.coalesce(F.try_variant_get(event, path, "decimal(38,9)") == value, F.lit(False))
    given = F.try_variant_get(event, path, "string").isNotNull()
    wrong = F.when(given & ~read, F.lit(f"{field.name}: no {kind}"))
    if required:
        wrong = wrong.when(~given, F.lit(f"{field.name}: missing"))
    return value, wrong


def read_events(df: DataFrame, schema: T.StructType, body: str = "body", required: list[str] | None = None) -> DataFrame:
    """The fields of `schema` in each body, with `_body` and `_reason`; streams and batches alike.

    Bodies may have further fields, lack fields that are not `required` (null then, as for JSON null),
    and state numbers as text. `_reason` lists what can't be used: no JSON object, a required field
    that is missing or null, a value that is not of its field's type. It is null for usable bodies.
    `split_events` parts the two.
    """
    event = F.col("_event")
    fields = [(f, *_checked(event, f, f.name in (required or []))) for f in schema.fields]
    wrong = F.array_join(F.array_compact(F.array(*[w for _, _, w in fields])), "; ")
    no_object = F.coalesce(~F.startswith(F.schema_of_variant(event), F.lit("OBJECT")), F.lit(True))
    reason = F.when(no_object, F.lit("no JSON object")).otherwise(F.nullif(wrong, F.lit("")))
    text = F.col(body).cast("string")
    parsed = df.select(text.alias("_body"), F.try_parse_json(text).alias("_event"))
    return parsed.select(*[v.alias(f.name) for f, v, _ in fields], "_body", reason.alias("_reason"))


def split_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable events without the extra columns, and the others as body and reason."""
    usable = F.col("_reason").isNull()
    return events.filter(usable).drop("_body", "_reason"), events.filter(~usable).select("_body", "_reason")
