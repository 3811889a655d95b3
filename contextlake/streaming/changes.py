"""The current rows of a table, kept from its change stream."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import latest_by
from . import folders

#: Batches after which they are merged into the base.
COMPACT_EVERY = 16


class ChangeState:
    """Newest image of every key, deleted ones included, as a base and the batches since.

    A batch adds a folder with its newest change per key, so it costs what it holds and not
    what the table holds; every ``compact_every`` batches they are merged into a new base.
    Folders are numbered by batch: a batch that is run again after a restart writes the
    same folder, and one that its base already has is not read. Deletes stay as rows
    with their log position, so that a change from before them cannot bring a key back.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], order_by: Sequence[str] = ("lsn",),
        compact_every: int = COMPACT_EVERY,
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.order_by, self.compact_every = tuple(keys), tuple(order_by), compact_every

    def _newest(self, images: DataFrame) -> DataFrame:
        # At one log position a delete counts; equal changes are interchangeable.
        order = [*[F.col(c).desc_nulls_last() for c in self.order_by], (F.col("op") == "d").desc(), F.to_json("row").desc()]
        return latest_by(images, [f"key_{k}" for k in self.keys], order)

    def images(self, changes: DataFrame) -> DataFrame:
        """Changes as ``key_…``, the order columns, ``op`` and ``row``; unreadable ones are left out."""
        row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
        staged = changes.filter(F.col("op").isNotNull()).select("op", *self.order_by, row.alias("row"))
        keyed = staged.select("*", *[F.col(f"row.{k}").alias(f"key_{k}") for k in self.keys])
        return keyed.filter(reduce(lambda a, b: a & b, [F.col(f"key_{k}").isNotNull() for k in self.keys]))

    def _base(self) -> int:
        """The last batch that the base holds; -1 without a base."""
        return max(folders.complete(self.spark, f"{self.path}/base", "upto"), default=-1)

    def _since(self, base: int) -> list[int]:
        return [n for n in folders.complete(self.spark, f"{self.path}/batches", "batch") if n > base]

    def stored(self) -> DataFrame | None:
        """Base and later batches, not yet reduced to one row per key."""
        base = self._base()
        paths = [f"{self.path}/base/upto={base}"] if base >= 0 else []
        paths += [f"{self.path}/batches/batch={n}" for n in self._since(base)]
        return self.spark.read.parquet(*paths) if paths else None

    def add(self, changes: DataFrame, batch: int) -> None:
        """Take in a batch; may be called again with the same one."""
        self._newest(self.images(changes)).write.mode("overwrite").parquet(f"{self.path}/batches/batch={batch}")
        base = self._base()
        since = self._since(base)
        if len(since) >= self.compact_every:
            last = since[-1]
            self._newest(self.stored()).write.mode("overwrite").parquet(f"{self.path}/base/upto={last}")
            # The new base counts from here on; what it holds may go.
            for n in since:
                folders.remove(self.spark, f"{self.path}/batches/batch={n}")
            if base >= 0:
                folders.remove(self.spark, f"{self.path}/base/upto={base}")

    def current(self) -> DataFrame:
        """Rows of the table as the last batch left it."""
        stored = self.stored()
        if stored is None:
            raise ValueError(f"no batch has been written to {self.path}")
        return self._newest(stored).filter("op <> 'd'").select("row.*")


def keep_state(changes: DataFrame, state: ChangeState, checkpoint: str) -> None:
    """Bring the state up to what the change stream has now; a restart goes on at the checkpoint."""
    query = (
        changes.writeStream.foreachBatch(lambda batch, n: state.add(batch, n))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
