"""Minute counts of a stream that keep the rows they come too late for."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import folders


class MinuteCounts:
    """Rows and sums per minute of event time, with a table of late rows beside them.

    Every batch has the watermark that the batches before it left: their newest event less
    ``delay``. A row whose minute had ended by then is late and goes to ``late`` as it is; the
    others are summed per minute and added. A batch writes folders under its own number,
    the mark last, so one that runs again after a restart replaces what it wrote.
    """

    def __init__(self, spark: SparkSession, path: str, ts: str, amount: str, delay: timedelta = timedelta(minutes=1)) -> None:
        self.spark, self.path, self.ts, self.amount = spark, path.rstrip("/"), ts, amount
        self.delay = F.lit(delay)

    def _marks(self) -> list[int]:
        return folders.complete(self.spark, f"{self.path}/marks", "batch")

    def _mark(self, batch: int | None) -> DataFrame:
        """One row: the newest event time up to a batch, null before the first."""
        if batch is None:
            return self.spark.range(1).select(F.lit(None).cast("timestamp").alias("newest"))
        return self.spark.read.schema("newest timestamp").parquet(f"{self.path}/marks/batch={batch}")

    def add(self, rows: DataFrame, batch: int) -> None:
        """Take in a batch; may be called again with the same one."""
        before = max((n for n in self._marks() if n < batch), default=None)
        newest = self._mark(before).first()["newest"]
        minute = F.date_trunc("minute", self.ts)
        ended = minute + F.expr("INTERVAL 1 MINUTE") <= F.lit(newest).cast("timestamp") - self.delay
        split = rows.select("*", minute.alias("_minute"), F.coalesce(ended, F.lit(False)).alias("_late"))
        late = split.filter("_late").drop("_minute", "_late")
        late.write.mode("overwrite").parquet(f"{self.path}/late/batch={batch}")
        sums = split.filter("NOT _late AND _minute IS NOT NULL").groupBy(F.col("_minute").alias("minute")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(self.amount).alias("total")
        )
        sums.write.mode("overwrite").parquet(f"{self.path}/sums/batch={batch}")
        mark = rows.agg(F.greatest(F.max(self.ts), F.lit(newest).cast("timestamp")).alias("newest"))
        mark.write.mode("overwrite").parquet(f"{self.path}/marks/batch={batch}")

    def _read(self, name: str) -> DataFrame | None:
        paths = [f"{self.path}/{name}/batch={n}" for n in self._marks()]
        return self.spark.read.parquet(*paths) if paths else None

    def closed(self) -> DataFrame | None:
        """``minute``, ``rows``, ``total`` of the minutes that the watermark has passed."""
        sums = self._read("sums")
        if sums is None:
            return None
        mark = self._mark(self._marks()[-1]).first()["newest"]
        ended = F.col("minute") + F.expr("INTERVAL 1 MINUTE") <= F.lit(mark).cast("timestamp") - self.delay
        return sums.groupBy("minute").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total")).filter(ended)

    def late(self) -> DataFrame | None:
        """Every late row once, as it came."""
        return self._read("late")


def keep_minutes(stream: DataFrame, counts: MinuteCounts, checkpoint: str) -> None:
    """Bring the counts up to what the stream has now; a restart goes on at the checkpoint."""

    def add(batch: DataFrame, n: int) -> None:
        held = batch.persist()
        try:
            counts.add(held, n)
        finally:
            held.unpersist()

    query = (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
