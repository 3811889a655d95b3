"""Tables by name or path, and views over several catalogs in one query."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a parquet folder when the name looks like a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of an operational store; needs the store's driver on the classpath.

    Pass ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions`` for
    large tables so that the read is split over executors.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def register_tables(spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Expose frames from any source under one namespace for ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
