"""A persistent table of the event ids each layer holds, bucketed by id."""

from __future__ import annotations

import hashlib
import math
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids of a bucket after compaction (some 100 MB of files), and files of a bucket before it.
IDS_PER_BUCKET, FILES_PER_BUCKET = 2_000_000, 8
SCHEMA = "event_id string, layer string"
#: Kept beside the ids of a load until the index has them: where its rows went.
PENDING_SCHEMA = "event_id string, layer string, source_name string, event_day string"


class IdIndex:
    """Which event ids are in which layer, whatever their day or source.

    The files are Spark buckets by ``event_id``, so a batch is shuffled to them and they
    are not shuffled: what a load reads is the ids, never the layers. ``path`` holds
    ``ids/g<generation>-b<buckets>`` folders, of which the last complete one counts, and
    ``pending/<load>`` folders, the ids of loads that have not been entered yet. The
    session's catalog has one external table for the current generation.

    One load at a time may work on an index.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16) -> None:
        self.spark, self.path, self.first_buckets = spark, path.rstrip("/"), buckets

    # --- files

    def _fs(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _children(self, name: str) -> list[str]:
        """Names of the complete folders under ``name``."""
        hadoop, fs = self._fs(f"{self.path}/{name}")
        if not fs.exists(hadoop):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(hadoop) if s.isDirectory()]
        return sorted(n for n in names if fs.exists(self._fs(f"{self.path}/{name}/{n}/_SUCCESS")[0]))

    def _delete(self, name: str) -> None:
        hadoop, fs = self._fs(f"{self.path}/{name}")
        fs.delete(hadoop, True)

    # --- generations

    def generation(self) -> tuple[int, int] | None:
        """Number and buckets of the current generation; None before the first."""
        found = [re.fullmatch(r"g(\d+)-b(\d+)", n) for n in self._children("ids")]
        return max(((int(m[1]), int(m[2])) for m in found if m), default=None)

    @property
    def exists(self) -> bool:
        return self.generation() is not None

    def _table_name(self, generation: int, buckets: int) -> str:
        digest = hashlib.sha256(self.path.encode()).hexdigest()[:20]
        return f"event_ids_{digest}_g{generation}_b{buckets}"

    def _table(self, generation: int, buckets: int) -> str:
        name = self._table_name(generation, buckets)
        folder = f"{self.path}/ids/g{generation:06d}-b{buckets}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({SCHEMA}) USING parquet "
            f"CLUSTERED BY (event_id) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
        return name

    def _bucketed(self, ids: DataFrame, buckets: int) -> DataFrame:
        """Each bucket in one task, so that a load adds one file to it."""
        return ids.select("event_id", "layer").repartition(buckets, "event_id")

    def _write(self, ids: DataFrame, generation: int, buckets: int) -> None:
        name = self._table(generation, buckets)
        self._bucketed(ids, buckets).write.insertInto(name)

    def create(self, held: DataFrame | None = None) -> None:
        """The first generation, of the ids that ``held`` (event_id, layer) has."""
        none = self.spark.createDataFrame([], SCHEMA)
        self._write(none if held is None else held.distinct(), 1, self.first_buckets)

    # --- reading and adding

    def held(self) -> DataFrame:
        """``event_id`` and the layers that hold it, ``layers``; nothing is shuffled for it."""
        table = self.spark.table(self._table(*self.generation()))
        return table.groupBy("event_id").agg(F.collect_set("layer").alias("layers"))

    def with_held_layers(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` with ``held_layers``, an empty list where no layer has the id."""
        _, buckets = self.generation()
        held = self.held().select(F.col("event_id").alias("_held_id"), F.col("layers").alias("held_layers"))
        joined = batch.repartition(buckets, "event_id").join(held, F.col("event_id") == F.col("_held_id"), "left")
        return joined.drop("_held_id").withColumn("held_layers", F.coalesce("held_layers", F.array().cast("array<string>")))

    def begin(self, fresh: DataFrame) -> str:
        """Write down what a load is about to insert (PENDING_SCHEMA); returns its name."""
        load = uuid.uuid4().hex
        fresh.write.parquet(f"{self.path}/pending/{load}")
        return load

    def pending(self) -> dict[str, DataFrame]:
        """Loads that began and were not finished."""
        return {n: self.spark.read.schema(PENDING_SCHEMA).parquet(f"{self.path}/pending/{n}") for n in self._children("pending")}

    def finish(self, load: str, entered: DataFrame) -> None:
        """Enter the ids of a load. Ids that were entered before do no harm, so this can be repeated."""
        generation, buckets = self.generation()
        self._write(entered.distinct(), generation, buckets)
        self._delete(f"pending/{load}")

    def compact(self, files_per_bucket: int = FILES_PER_BUCKET, ids_per_bucket: int = IDS_PER_BUCKET) -> bool:
        """Rewrite the index once buckets have many files; true if it was rewritten.

        The new generation counts from the moment it is complete. The bucket number
        follows the ids, so a bucket stays one task's work however many ids there are.
        """
        generation, buckets = self.generation()
        hadoop, fs = self._fs(f"{self.path}/ids/g{generation:06d}-b{buckets}")
        files = sum(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(hadoop))
        if files <= buckets * files_per_bucket:
            return False
        old = self._table(generation, buckets)
        ids = self.spark.table(old).distinct()
        wanted = max(self.first_buckets, math.ceil(ids.count() / ids_per_bucket))
        self._write(ids, generation + 1, wanted)
        self.spark.sql(f"DROP TABLE IF EXISTS {old}")
        self._delete(f"ids/g{generation:06d}-b{buckets}")
        return True
