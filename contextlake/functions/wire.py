"""Registry wire format: magic byte 0, 4-byte big-endian schema id, payload."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from .json_tools import is_json_object
from .text import col

HEADER_BYTES = 5


def schema_id(value: str | Column) -> Column:
    """Registry id, null for null or short values; ids over INT range give null."""
    v = col(value)
    number = F.conv(F.hex(F.substring(v, 2, 4)), 16, 10)
    return F.when(F.length(v) >= HEADER_BYTES, number.try_cast("int"))


def payload_size(value: str | Column, clamp: bool = False) -> Column:
    """Bytes after the header. Short values go negative unless clamped to 0."""
    size = F.length(col(value)) - HEADER_BYTES
    return F.coalesce(F.greatest(size, F.lit(0)), F.lit(0)) if clamp else size


def hex_preview(value: str | Column, size: int = 20) -> Column:
    return F.hex(F.substring(col(value), 1, size))


def is_wire_value(value: str | Column) -> Column:
    v = col(value)
    framed = (F.length(v) >= HEADER_BYTES) & (F.hex(F.substring(v, 1, 1)) == "00")
    return F.coalesce(framed, F.lit(False))


def body(value: str | Column) -> Column:
    v = col(value)
    return F.substring(v, F.lit(HEADER_BYTES + 1), F.length(v))


def decode_json_payload(value: str | Column, on_error: str = "null") -> Column:
    """JSON records carried in the wire format.

    ``on_error="null"`` drops undecodable values to null; ``"json"`` keeps an
    ``{"error": ..., "schema_id": ...}`` object instead.
    """
    v = col(value)
    text = F.try_validate_utf8(body(v).try_cast("string"))
    parsed = F.when(is_json_object(text), text)
    good = F.when(is_wire_value(v), parsed)
    return good if on_error == "null" else F.coalesce(good, _error_json(v))


def decode_avro_payload(
    value: str | Column, schemas: Mapping[int, str], on_error: str = "null"
) -> Column:
    """Avro records by registry id, decoded in the JVM.

    ``schemas`` maps registry id to Avro schema JSON; fetch it once on the
    driver. Decimals become text and bytes hex, as in the JSON branch. An
    undecodable record comes back from the permissive reader as a record of
    nulls; where the schema has a field that may not be null, that is a decode
    error and not an object. Needs the spark-avro package on the classpath, and
    has not been run without it; the parts around ``from_avro`` are tested.
    """
    from pyspark.sql.avro.functions import from_avro

    v = col(value)
    decoded = F.lit(None).cast("string")
    for key, avro_schema in schemas.items():
        record = from_avro(body(v), avro_schema, {"mode": "PERMISSIVE"})
        decoded = F.when(schema_id(v) == key, record_json(record, json.loads(avro_schema))).otherwise(decoded)
    good = F.when(is_wire_value(v), decoded)
    return good if on_error == "null" else F.coalesce(good, _error_json(v))


def record_json(record: Column, schema: dict) -> Column:
    """JSON text of a decoded record; null for a record that lacks a required field."""
    dtype = avro_type(schema)
    text = F.to_json(jsonable(record, dtype))
    if not isinstance(dtype, StructType):
        return text
    required = [record[f.name].isNotNull() for f in dtype.fields if not f.nullable]
    return F.when(reduce(and_, required), text) if required else text


# ---- fixed values: Avro's plain types and the logical types that change them ----
_AVRO_PLAIN = {
    "null": NullType(), "boolean": BooleanType(), "int": IntegerType(), "long": LongType(), "float": FloatType(),
    "double": DoubleType(), "bytes": BinaryType(), "string": StringType(), "enum": StringType(), "fixed": BinaryType(),
}
_AVRO_LOGICAL = {
    "date": DateType(), "timestamp-millis": TimestampType(), "timestamp-micros": TimestampType(),
    "local-timestamp-millis": TimestampNTZType(), "local-timestamp-micros": TimestampNTZType(),
}


def avro_type(schema: dict | list | str) -> DataType:
    """Spark type of a decoded Avro schema; named types may be used again inside it."""
    return _avro(schema, {})


def _avro(schema: dict | list | str, named: dict[str, DataType]) -> DataType:
    if isinstance(schema, str):
        return named[schema] if schema in named else _AVRO_PLAIN[schema]
    if isinstance(schema, list):
        members = [_avro(s, named) for s in schema if s != "null"]
        if len(members) == 1:
            return members[0]
        if all(isinstance(m, (IntegerType, LongType)) for m in members):
            return LongType()
        if all(isinstance(m, (FloatType, DoubleType)) for m in members):
            return DoubleType()
        return StructType([StructField(f"member{i}", m) for i, m in enumerate(members)])
    kind = schema["type"]
    if kind == "record":
        fields = [
            StructField(f["name"], _avro(f["type"], named), isinstance(f["type"], list) and "null" in f["type"])
            for f in schema["fields"]
        ]
        dtype: DataType = StructType(fields)
    elif kind == "array":
        dtype = ArrayType(_avro(schema["items"], named))
    elif kind == "map":
        dtype = MapType(StringType(), _avro(schema["values"], named))
    elif schema.get("logicalType") == "decimal":
        dtype = DecimalType(schema["precision"], schema.get("scale", 0))
    elif schema.get("logicalType") in _AVRO_LOGICAL:
        dtype = _AVRO_LOGICAL[schema["logicalType"]]
    else:
        dtype = _avro(kind, named)
    if "name" in schema:
        named[schema["name"]] = dtype
    return dtype


def _error_json(v: Column) -> Column:
    short = F.length(v).isNull() | (F.length(v) < HEADER_BYTES)
    reason = (
        F.when(short, "invalid or missing value")
        .when(
            F.hex(F.substring(v, 1, 1)) != "00",
            F.concat(
                F.lit("invalid magic byte: "), F.conv(F.hex(F.substring(v, 1, 1)), 16, 10)
            ),
        )
        .otherwise("payload decode error")
    )
    return F.to_json(F.struct(reason.alias("error"), schema_id(v).alias("schema_id")))


def jsonable(value: Column, dtype: DataType) -> Column:
    """Rewrite a decoded record so JSON shows decimals as text and bytes as hex."""
    if isinstance(dtype, StructType):
        return F.when(
            value.isNotNull(),
            F.struct(*[jsonable(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]),
        )
    if isinstance(dtype, ArrayType):
        return F.transform(value, lambda x: jsonable(x, dtype.elementType))
    if isinstance(dtype, MapType):
        return F.transform_values(value, lambda _k, x: jsonable(x, dtype.valueType))
    if isinstance(dtype, DecimalType):
        return value.cast("string")
    if isinstance(dtype, BinaryType):
        return F.lower(F.hex(value))
    return value
