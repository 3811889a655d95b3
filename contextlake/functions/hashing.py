"""Stable hashes and canonical JSON text used for event identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, StringType, StructType

from .text import col, strip


def sha_prefix(value: str | Column, length: int) -> Column:
    return F.substring(F.sha2(col(value), 256), 1, length)


def stable_hash(value: str | Column, length: int = 16) -> Column:
    """Prefix of SHA-256 over the stripped text; '' for null or blank."""
    text = strip(F.coalesce(col(value).cast("string"), F.lit("")))
    return F.when(text == "", F.lit("")).otherwise(sha_prefix(text, length))


def canonical_json(value: Column, dtype: DataType) -> Column:
    """JSON text with sorted keys, ', ' and ': ' separators and explicit nulls.

    Built from expressions at plan time by walking the type, so it stays in
    codegen. Map entries are sorted at run time.
    """
    if isinstance(dtype, StructType):
        fields = sorted(dtype.fields, key=lambda f: f.name)
        parts = [
            F.concat(F.lit(f'"{f.name}": '), canonical_json(value[f.name], f.dataType))
            for f in fields
        ]
        body = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    elif isinstance(dtype, ArrayType):
        items = F.transform(value, lambda x: canonical_json(x, dtype.elementType))
        body = F.concat(F.lit("["), F.concat_ws(", ", items), F.lit("]"))
    elif isinstance(dtype, MapType):
        entries = F.transform(
            F.array_sort(F.map_entries(value)),
            lambda e: F.concat(
                _quoted(e["key"].cast("string")),
                F.lit(": "),
                canonical_json(e["value"], dtype.valueType),
            ),
        )
        body = F.concat(F.lit("{"), F.concat_ws(", ", entries), F.lit("}"))
    elif isinstance(dtype, StringType):
        body = _quoted(value)
    elif isinstance(dtype, BooleanType):
        body = F.when(value, "true").otherwise("false")
    elif dtype.simpleString() in ("date", "timestamp", "timestamp_ntz"):
        body = _quoted(value.cast("string"))
    else:
        body = value.cast("string")
    return F.when(value.isNull(), F.lit("null")).otherwise(body)


def _quoted(value: Column) -> Column:
    as_array = F.to_json(F.array(value))
    return F.substring(as_array, F.lit(2), F.length(as_array) - 2)


def event_key(
    source_name: Column, event_type: Column, event_time: Column, payload_text: Column
) -> Column:
    """Default idempotency key: source, type, time and canonical payload."""
    return F.concat_ws(":", source_name, event_type, event_time, payload_text)


def event_id(key: Column) -> Column:
    return sha_prefix(key, 32)
