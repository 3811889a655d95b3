"""Numbered folders of a stream's batches in shared storage."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def complete(spark: SparkSession, parent: str, name: str) -> list[int]:
    """Numbers of the folders ``<parent>/<name>=<number>`` that were written to their end."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(parent)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [re.fullmatch(rf"{name}=(\d+)", s.getPath().getName()) for s in fs.listStatus(path) if s.isDirectory()]
    numbers = sorted(int(m[1]) for m in found if m)
    return [n for n in numbers if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{parent}/{name}={n}/_SUCCESS"))]


def remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
