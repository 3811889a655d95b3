"""Query registration and the common output form of compared results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DateType,
    DecimalType,
    FloatType,
    IntegerType,
    MapType,
    ShortType,
    StringType,
    StructType,
    TimestampType,
)

from .adapters import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Columns in engine-neutral types: text dates, BIGINT, DOUBLE, zone-less timestamps."""
    columns = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, DateType):
            c = c.cast("string")
        elif isinstance(t, TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(t, (DecimalType, FloatType)):
            c = c.cast("double")
        elif isinstance(t, (ByteType, ShortType, IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, ArrayType) and isinstance(t.elementType, StringType):
            c = F.concat_ws("|", c)
        elif isinstance(t, (ArrayType, MapType, StructType)):
            c = F.to_json(c)
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(
    name: str, sql: str | None = None, views: tuple[str, ...] = (), text: tuple[str, ...] = ()
) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its oracle over the named adapter views.

    ``text`` names integer or boolean columns with nulls. Both sides give them
    as text, because the two engines hand such columns out in different types.
    """

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = plain(fn(spark, sf_dir))
            return df.withColumns({c: F.col(c).cast("string") for c in text}) if text else df

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            oracle = with_views(sql.strip(), views)
            if text:
                casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in text)
                oracle = f"SELECT * REPLACE ({casts}) FROM ({oracle})"
            ORACLES[name] = oracle
        return fn

    return register


def half_up(expr: str, digits: int) -> str:
    """SQL rounding that sends ties away from zero despite binary noise."""
    return f"round({expr} + CASE WHEN {expr} >= 0 THEN 1e-9 ELSE -1e-9 END, {digits})"
