"""Bounded and micro-batch streams, typed streams, live rollups, progress rows."""

from __future__ import annotations

import json
import logging
import threading
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StructType

from ..session import work_dir

LOG = logging.getLogger(__name__)


def write_bounded(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append everything available now and stop; a rerun continues at the checkpoint."""
    writer = (
        df.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    query = (writer.partitionBy(*partition_by) if partition_by else writer).start()
    query.awaitTermination()
    return query


def write_continuous(
    df: DataFrame, path: str, checkpoint: str, every: str = "5 seconds", fmt: str = "parquet"
) -> StreamingQuery:
    """Append in micro-batches until stopped."""
    return (
        df.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(processingTime=every)
        .start()
    )


def typed_stream(
    bus: DataFrame, topic: str, schema: StructType, mapping: Mapping[str, Column], payload: str = "json_payload"
) -> DataFrame:
    """Typed rows of one topic: parse the payload once, then rename and cast.

    ``mapping`` gives output name → expression over the parsed fields.
    """
    rows = bus.filter(F.col("event_source") == topic).select(F.from_json(payload, schema).alias("_r"))
    parsed = rows.select("_r.*")
    return parsed.select(*[c.alias(name) for name, c in mapping.items()])


def money(c: str) -> Column:
    """Amount with two decimals, rounded half up."""
    return F.col(c).cast("decimal(12,2)")


def event_ms(c: str = "ts") -> Column:
    return F.timestamp_millis(c)


def order_mapping() -> dict[str, Column]:
    keep = ("order_id", "user_id", "product_id")
    return {
        "event_time": event_ms(),
        **{c: F.col(c) for c in keep},
        "amount": money("amount"),
        "currency": F.col("currency"),
        "ingested_at": F.current_timestamp(),
    }


def payment_mapping() -> dict[str, Column]:
    return {
        "event_time": event_ms(),
        "payment_id": F.col("payment_id"),
        "order_id": F.col("order_id"),
        "payment_method": F.col("method"),
        "payment_status": F.col("status"),
        "ingested_at": F.current_timestamp(),
    }


def inventory_mapping() -> dict[str, Column]:
    keep = (
        "change_id", "warehouse_id", "product_id", "change_type", "quantity_delta", "previous_qty",
        "new_qty", "reason", "order_id", "supplier_id",
    )
    return {
        "event_time": event_ms(),
        **{c: F.col(c) for c in keep},
        "cost_per_unit": money("cost_per_unit"),
        "ingested_at": F.current_timestamp(),
    }


def dedupe_positions(df: DataFrame, ts: str = "event_time", within: str = "1 minute") -> DataFrame:
    """Drop repeats of a bus position that arrive within the watermark."""
    return df.withWatermark(ts, within).dropDuplicatesWithinWatermark(
        ["event_source", "partition", "offset"]
    )


def live_minutes(df: DataFrame, ts: str, amount: str, customer: str, delay: str = "1 minute") -> DataFrame:
    """Per-minute orders and sales on a stream; distinct customers are approximate.

    A minute is emitted once the watermark has passed its end.
    """
    windowed = df.withWatermark(ts, delay).groupBy(F.window(ts, "1 minute"))
    return windowed.agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(amount).alias("gross_sales"),
        F.approx_count_distinct(customer).alias("active_customers"),
    ).select(F.col("window.start").alias("minute"), "orders", "gross_sales", "active_customers")


def checkpoint_exists(spark: SparkSession, checkpoint: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(checkpoint)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def warn_if_replay_ignored(spark: SparkSession, checkpoint: str, starting: str) -> bool:
    """Warn (and return True) when 'earliest' is asked for but a checkpoint decides."""
    if starting != "earliest":
        return False
    try:
        exists = checkpoint_exists(spark, checkpoint)
    except Exception as error:  # the check must never stop an ingest
        LOG.info("cannot look at checkpoint %s (%s)", checkpoint, error)
        return False
    if exists:
        LOG.warning(
            "earliest was requested but the stream resumes from %s; use a new checkpoint to replay",
            checkpoint,
        )
    return exists


class ProgressLog(StreamingQueryListener):
    """Writes the progress numbers of every batch to a table, one small row each.

    Rows go to ``path`` in blocks of ``block``, so a long run neither fills the
    driver nor loses batches. Use :meth:`watching` around a run, or add the
    listener to ``spark.streams`` and read :meth:`table`.
    """

    SCHEMA = "query string, batch_id bigint, input_rows bigint, rows_per_second double"

    def __init__(self, session: SparkSession, path: str | None = None, block: int = 500) -> None:
        self.session = session
        self.path = path or work_dir(session, "progress")
        self.block = block
        self.rows: list[tuple[str, int, int, float]] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        LOG.info("stream started: %s", event.name)

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        row = (
            progress.get("name") or str(progress.get("id")),
            int(progress.get("batchId", -1)),
            int(progress.get("numInputRows", 0)),
            float(progress.get("inputRowsPerSecond") or 0.0),
        )
        with self._lock:
            self.rows.append(row)
            full = len(self.rows) >= self.block
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        LOG.info("stream ended: %s", event.exception or "ok")

    def flush(self) -> None:
        """Append the rows held so far to the table."""
        with self._lock:
            rows, self.rows = self.rows, []
        if rows:
            self.session.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def table(self) -> DataFrame:
        """Every row so far."""
        self.flush()
        self.session.createDataFrame([], self.SCHEMA).write.mode("append").parquet(self.path)
        return self.session.read.schema(self.SCHEMA).parquet(self.path)

    @contextmanager
    def watching(self) -> Iterator[ProgressLog]:
        """Listen while a block runs; at its end every event of its queries has come in."""
        self.session.streams.addListener(self)
        try:
            yield self
        finally:
            self.session.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
            self.session.streams.removeListener(self)


def stop_all(spark: SparkSession) -> int:
    """Stop every active query; returns how many were stopped."""
    active = spark.streams.active
    for query in active:
        query.stop()
    return len(active)
