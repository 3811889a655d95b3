"""Batch sinks. Merges are expressed as joins, so they work on any table format."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.times import month_of
from ..operators.latest import keep_latest


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: StructType | str,
    partition_by: Sequence[str] = ("event_source",),
    properties: Mapping[str, str] | None = None,
    using: str = "parquet",
    location: str | None = None,
    name_parts: int = 3,
) -> None:
    """Create the namespace and table when missing. The name must be fully qualified."""
    parts = table.split(".")
    if len(parts) != name_parts:
        raise ValueError(f"table name needs {name_parts} parts, got {table!r}")
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    quoted = ", ".join(f"`{c}`" for c in partition_by)
    options = ", ".join(f"'{k}'='{v}'" for k, v in (properties or {}).items())
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {'.'.join(parts[:-1])}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING {using}"
        + (f" PARTITIONED BY ({quoted})" if quoted else "")
        + (f" LOCATION '{location}'" if location else "")
        + (f" TBLPROPERTIES ({options})" if options else "")
    )


def counted_writer(
    df: DataFrame, partition_by: Sequence[str] = ()
) -> tuple[DataFrameWriter, Observation]:
    """Writer of ``df`` and the observation that will hold its row count.

    The count sits above the rebalancing: below it, adaptive execution drops
    the counting step together with an empty stage.
    """
    seen = Observation()
    spread = df.hint("rebalance", *partition_by) if partition_by else df
    return spread.observe(seen, F.count(F.lit(1)).alias("rows")).write, seen


def append_table(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> int:
    """Append to a table or folder and return the rows written.

    The count is observed during the write; the input is evaluated once.
    Partitioned folders get files of an even size: ``REBALANCE`` gathers small
    partition values and splits one that holds most of the rows.
    """
    writer, seen = counted_writer(df, partition_by)
    writer = writer.mode("append")
    if "/" in target:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
    else:
        writer.insertInto(target)
    return seen.get["rows"]


def write_monthly(df: DataFrame, path: str, ts: str, sort_by: Sequence[str], codec: str = "zstd") -> None:
    """Append partitioned by month and sorted inside files, so min/max statistics prune.

    ``REBALANCE`` lets AQE split a month that holds most of the rows instead of
    writing it from one task.
    """
    staged = df.withColumn("month", month_of(ts)).hint("rebalance", "month")
    (
        staged.sortWithinPartitions("month", *sort_by)
        .write.mode("append")
        .option("compression", codec)
        .partitionBy("month")
        .parquet(path)
    )


# ---- fixed values: envelope fields stored as JSON objects ----
OBJECT_FIELDS = ("provenance", "payload_summary", "payload")


def landing_objects(events: DataFrame) -> DataFrame:
    """Envelopes whose JSON text fields are real objects, as a landing line holds them."""
    return events.withColumns({c: F.try_parse_json(c) for c in OBJECT_FIELDS})


#: Lines of a compressed landing file at most: it is read by one task.
LINES_PER_FILE = 200_000


def landing_writer(lines: DataFrame, compression: str | None = "gzip") -> DataFrameWriter:
    """Writer of JSON lines; compressed ones are cut into files that one task reads in seconds."""
    writer = lines.write.mode("append")
    if compression is None:
        return writer
    return writer.option("compression", compression).option("maxRecordsPerFile", LINES_PER_FILE)


def write_landing(
    events: DataFrame, root: str, dt: str | Column | None = None, compression: str | None = None, gathered: bool = False
) -> None:
    """Append envelopes as JSON lines under ``landing_source=<source>/dt=<date>``.

    The partition columns move into the path; a record keeps its own source name. With
    ``compression`` (``gzip``) the files end in ``.json.gz`` and take about a tenth of the space;
    readers need no option for them, and plain files may lie beside them. Rows are dealt out by source
    and date; ``gathered`` rows, of which a task holds few sources already, are written where they are.
    """
    day = F.current_date() if dt is None else (F.lit(dt) if isinstance(dt, str) else dt)
    staged = landing_objects(events).withColumns(
        {"landing_source": F.col("source_name"), "dt": day.cast("string")}
    )
    spread = staged if gathered else staged.hint("rebalance", "landing_source", "dt")
    landing_writer(spread, compression).partitionBy("landing_source", "dt").json(root)


def landing_manifest(landing: DataFrame, path_col: str = "landing_file") -> DataFrame:
    """(path, rows) of every landing file read."""
    return landing.groupBy(F.col(path_col).alias("path")).agg(F.count(F.lit(1)).alias("rows"))


def without_keys(df: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key ``held`` lacks; a null key equals a null key."""
    other = held.select(*[F.col(k).alias(f"_held_{i}") for i, k in enumerate(keys)])
    same = [df[k].eqNullSafe(other[f"_held_{i}"]) for i, k in enumerate(keys)]
    return df.join(other, reduce(and_, same), "left_anti")


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """Target with every source key replaced by its newest source row; null keys match null keys."""
    newest = keep_latest(source, keys, version)
    kept = without_keys(target, newest, keys)
    return kept.select(*target.columns).unionByName(newest.select(*target.columns))


def insert_new(
    target: DataFrame, source: DataFrame, keys: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """Source rows whose key the target does not hold, one per key; null keys match null keys."""
    return without_keys(keep_latest(source, keys, version), target, keys).select(*source.columns)


def update_where(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """``UPDATE … SET … WHERE``: every assignment reads the old row."""
    hit = F.coalesce(condition, F.lit(False))
    types = dict(df.dtypes)
    return df.select(
        *[
            F.when(hit, assignments[c].cast(types[c])).otherwise(F.col(c)).alias(c)
            if c in assignments
            else F.col(c)
            for c in df.columns
        ]
    )


def partition_key(c: str) -> Column:
    """A partition value as text that is never null: empty for null, else marked."""
    text = F.col(c).cast("string")
    return F.when(text.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), text))


def touched_partitions(incoming: DataFrame, columns: Sequence[str], path: str) -> DataFrame:
    """Keys of the distinct partitions of ``incoming``, null included, written to ``path``.

    As a table of their own their size is known, so a few values are broadcast
    and prune the other side's files; many are joined by shuffle.
    """
    keys = incoming.select(*[partition_key(c).alias(f"touched_{c}") for c in columns]).distinct()
    keys.write.parquet(path)
    return incoming.sparkSession.read.schema(keys.schema).parquet(path)


def prune_to(existing: DataFrame, touched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` in the ``touched`` partitions; a null value is a partition like any other.

    One semi join for any number of values. Its keys are never null and made of
    partition columns only, so dynamic pruning keeps other partitions unread.
    """
    # Always true; the optimizer prunes by a side only if that side has a comparison.
    some = touched.filter(F.length(f"touched_{columns[0]}") >= 0)
    same = [partition_key(c) == F.col(f"touched_{c}") for c in columns]
    return existing.join(some, reduce(and_, same), "left_semi")


def merge_into_partitions(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], version: Sequence[str],
    partition_by: str, staging: str,
) -> None:
    """Upsert into a partitioned folder, rewriting only partitions the source touches.

    Keys must not move between partitions; rows without a partition value are a
    partition too. The merged partitions are staged in ``staging`` (the target
    is also an input) and written back with dynamic partition overwrite, so
    untouched partitions keep their files.
    """
    target = spark.read.parquet(path)
    touched = touched_partitions(source, [partition_by], f"{staging}-touched")
    affected = prune_to(target, touched, [partition_by])
    upsert(affected, source, keys, version).write.mode("overwrite").partitionBy(partition_by).parquet(staging)
    (
        spark.read.schema(target.schema)
        .parquet(staging)
        .hint("rebalance", partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .parquet(path)
    )


def append_digest_runs(df: DataFrame, target: str, limit: int = 1000) -> int:
    """Digest run log; long summaries are stored cut, as the log column demands."""
    return append_table(df.withColumn("summary", F.substring("summary", 1, limit)), target)


def compact(spark: SparkSession, source: str, target: str, partition_by: Sequence[str] = (), target_mb: int = 256) -> None:
    """Rewrite a folder of many small files into a new folder of larger ones.

    ``REBALANCE`` into as many parts as the source's bytes fill: a large
    partition value is split over several files, small ones share a task.
    Session settings stay as they are.
    """
    total = file_stats(spark, source).select((F.col("files") * F.col("mean_bytes")).alias("bytes")).first()["bytes"]
    parts = max(1, math.ceil((total or 0) / (target_mb << 20)))
    df = spark.read.parquet(source).hint("rebalance", parts, *partition_by)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Count and size spread of the data files of a folder (content is not read)."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length")
    )
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.avg("length").alias("mean_bytes"),
        F.stddev("length").alias("stddev_bytes"),
        F.min("length").alias("min_bytes"),
        F.max("length").alias("max_bytes"),
    )
