"""Streaming behaviour: restarts, duplicates, live rollups and progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from contextlake.operators import rollups
from contextlake.plans import medallion
from contextlake.schemas import BUS
from contextlake.session import work_dir
from contextlake.sources import bus as bus_source
from contextlake.streaming import changes, jobs, late

from .adapters import table
from .projection_queries import bus
from .registry import query
from .sink_queries import BRONZE_SUMMARY, bronze_summary
from .source_queries import stored, typed_bus


@query("r01_watermarked_bronze", BRONZE_SUMMARY)
def _(spark, sf):
    """A watermark without a stateful operator changes nothing."""
    stream = bus_source.read_file_stream(spark, stored(bus(spark, sf), "r01-bus"), BUS).withWatermark("timestamp", "1 minute")
    sink = work_dir(spark, "r01-bronze")
    jobs.write_bounded(medallion.to_bronze(stream), sink, work_dir(spark, "r01-checkpoint"))
    return bronze_summary(spark.read.parquet(sink))


@query("r02_resume_from_checkpoint", "SELECT event_type AS event_source, count(*) AS events FROM events GROUP BY event_type")
def _(spark, sf):
    """Two halves arrive between two bounded runs of one checkpoint."""
    source, sink, checkpoint = (work_dir(spark, f"r02-{n}") for n in ("bus", "sink", "checkpoint"))
    records = bus(spark, sf)
    for half in (F.col("offset") % 2 == 0, F.col("offset") % 2 == 1):
        records.filter(half).write.mode("append").parquet(source)
        stream = bus_source.read_file_stream(spark, source, BUS)
        jobs.write_bounded(medallion.to_bronze(stream), sink, checkpoint)
    return spark.read.parquet(sink).groupBy("event_source").agg(rollups.rows("events"))


@query("r03_replay_warning", "SELECT true AS warned_after, false AS warned_before, false AS warned_latest, count(*) AS events FROM events")
def _(spark, sf):
    source, sink, checkpoint = stored(bus(spark, sf), "r03-bus"), work_dir(spark, "r03"), work_dir(spark, "r03-checkpoint")
    before = jobs.warn_if_replay_ignored(spark, checkpoint, "earliest")
    jobs.write_bounded(medallion.to_bronze(bus_source.read_file_stream(spark, source, BUS)), sink, checkpoint)
    after = jobs.warn_if_replay_ignored(spark, checkpoint, "earliest")
    newest = jobs.warn_if_replay_ignored(spark, checkpoint, "latest")
    return spark.read.parquet(sink).agg(
        F.lit(after).alias("warned_after"), F.lit(before).alias("warned_before"), F.lit(newest).alias("warned_latest"),
        rollups.rows("events"),
    )


@query("r04_progress_rows", "SELECT count(*) AS input_rows, true AS several_batches FROM events")
def _(spark, sf):
    """Progress of a run with several micro-batches."""
    source = stored(bus(spark, sf).repartition(4), "r04-bus")
    stream = bus_source.read_file_stream(spark, source, BUS, max_files_per_trigger=1)
    log = jobs.ProgressLog(spark)
    with log.watching():
        jobs.write_bounded(medallion.to_bronze(stream), work_dir(spark, "r04"), work_dir(spark, "r04-checkpoint"))
    return log.table().agg(
        F.sum("input_rows").alias("input_rows"), (F.countDistinct("batch_id") > 1).alias("several_batches")
    )


@query("r05_duplicates_within_watermark", "SELECT event_type AS event_source, count(*) AS events FROM events GROUP BY event_type")
def _(spark, sf):
    """Every record is delivered twice; positions repeat within the watermark."""
    records = bus(spark, sf)
    source = stored(records.unionByName(records), "r05-bus")
    bronze = medallion.to_bronze(bus_source.read_file_stream(spark, source, BUS))
    sink = work_dir(spark, "r05")
    jobs.write_bounded(jobs.dedupe_positions(bronze), sink, work_dir(spark, "r05-checkpoint"))
    return spark.read.parquet(sink).groupBy("event_source").agg(rollups.rows("events"))


@query(
    "r06_live_minutes",
    """SELECT date_trunc('minute', ts) AS minute, count(*) AS orders, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS gross_sales
    FROM events WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE GROUP BY 1""",
)
def _(spark, sf):
    """Closed minutes only: the watermark trails the newest event by one minute."""
    sales = table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("event_time"), "user_id", F.col("value").cast("decimal(12,2)").alias("amount")
    )
    stream = bus_source.read_file_stream(spark, stored(sales, "r06-sales"), sales.schema)
    minutes = jobs.live_minutes(stream, "event_time", "amount", "user_id")
    sink = work_dir(spark, "r06")
    jobs.write_bounded(minutes, sink, work_dir(spark, "r06-checkpoint"))
    return spark.read.parquet(sink).select("minute", "orders", F.col("gross_sales").cast("double").alias("gross_sales"))


@query(
    "r06_live_minute_customers",
    """SELECT date_trunc('minute', ts) AS minute, true AS within_five_percent
    FROM events WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE GROUP BY 1""",
)
def _(spark, sf):
    """The approximate customers of every closed minute next to the exact ones."""
    sales = table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("event_time"), "user_id", F.col("value").cast("decimal(12,2)").alias("amount")
    )
    stream = bus_source.read_file_stream(spark, stored(sales, "r06c-sales"), sales.schema)
    sink = work_dir(spark, "r06c")
    jobs.write_bounded(jobs.live_minutes(stream, "event_time", "amount", "user_id"), sink, work_dir(spark, "r06c-checkpoint"))
    exact = sales.groupBy(F.date_trunc("minute", "event_time").alias("minute")).agg(F.countDistinct("user_id").alias("exact"))
    close = F.abs(F.col("active_customers") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.05 * F.col("exact"))
    return spark.read.parquet(sink).join(exact, "minute").select("minute", close.alias("within_five_percent"))


@query("r07_stop_all", "SELECT 1 AS stopped, count(*) AS events FROM events")
def _(spark, sf):
    """Stop whatever runs in a session of its own; the stopped stream had taken in everything."""
    source = stored(bus(spark, sf), "r07-bus")
    sink, checkpoint = work_dir(spark, "r07"), work_dir(spark, "r07-checkpoint")
    own = spark.newSession()
    running = jobs.write_continuous(
        medallion.to_bronze(bus_source.read_file_stream(own, source, BUS)), sink, checkpoint, "1 second"
    )
    running.processAllAvailable()
    stopped = jobs.stop_all(own)
    return spark.read.parquet(sink).agg(F.lit(stopped).alias("stopped"), rollups.rows("events"))


@query(
    "r08_payment_sink",
    """SELECT o_orderstatus AS payment_status, count(*) AS payments, min(CAST(o_orderdate AS TIMESTAMP)) AS first_time FROM orders GROUP BY 1""",
)
def _(spark, sf):
    """One topic of a shared bus kept in its own typed table."""
    from contextlake.schemas import PAYMENT_EVENT

    records = typed_bus(spark, sf)
    stream = bus_source.read_file_stream(spark, stored(records, "r08-bus"), records.schema)
    typed = jobs.typed_stream(stream, "payments", PAYMENT_EVENT, jobs.payment_mapping())
    sink = work_dir(spark, "r08")
    jobs.write_bounded(typed, sink, work_dir(spark, "r08-checkpoint"))
    return spark.read.parquet(sink).groupBy("payment_status").agg(
        rollups.rows("payments"), F.min("event_time").alias("first_time")
    )


@query(
    "s16_state_kept_from_a_stream",
    """SELECT user_id, event_id AS version, event_type AS status FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND event_type <> 'error'""",
)
def _(spark, sf):
    """Change records out of order, in small batches of two runs, some delivered twice: the state of the batch query."""
    image = F.struct("user_id", F.col("event_id").alias("version"), F.col("event_type").alias("status"))
    gone = F.col("event_type") == "error"
    record = F.struct(
        F.when(gone, image).alias("before"),
        F.when(~gone, image).alias("after"),
        F.struct(F.col("event_id").alias("lsn"), F.lit("users").alias("table")).alias("source"),
        F.when(gone, "d").when(F.col("event_id") % 2 == 0, "u").otherwise("c").alias("op"),
    )
    records = table(spark, sf, "events").select(F.to_json(record).alias("json_payload"), "event_id")
    source, checkpoint = work_dir(spark, "s16-changes"), work_dir(spark, "s16-checkpoint")
    path = work_dir(spark, "s16-state")
    # The newest changes come first, and the second run starts anew on the same checkpoint.
    for run in (1, 0):
        part = records.filter((F.col("event_id") % 2 == run) | (F.col("event_id") % 10 == 3))
        part.select("json_payload").repartition(4).write.mode("append").parquet(source)
        stream = bus_source.read_file_stream(spark, source, part.select("json_payload").schema, max_files_per_trigger=1)
        parsed = bus_source.parse_cdc(stream, "struct<user_id:bigint,version:bigint,status:string>")
        changes.keep_state(parsed, changes.ChangeState(spark, path, ["user_id"], compact_every=3), checkpoint)
    return changes.ChangeState(spark, path, ["user_id"]).current()


@query(
    "r05_late_rows_beside_counts",
    """WITH runs AS (SELECT *, event_id % 5 = 0 AND ts < (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE AS second FROM events),
    mark AS (SELECT max(ts) AS newest FROM runs WHERE NOT second),
    judged AS (SELECT *, second AND date_trunc('minute', ts) + INTERVAL 1 MINUTE <= newest - INTERVAL 1 MINUTE AS late FROM runs, mark)
    SELECT 'on time' AS kind, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids, count(DISTINCT date_trunc('minute', ts)) AS minutes
    FROM judged WHERE NOT late AND date_trunc('minute', ts) + INTERVAL 1 MINUTE <= newest - INTERVAL 1 MINUTE
    UNION ALL SELECT 'late', count(*), CAST(sum(event_id) AS BIGINT), count(DISTINCT date_trunc('minute', ts)) FROM judged WHERE late""",
)
def _(spark, sf):
    """A fifth of the rows comes in a second run, after the watermark: counted minutes, and every late row once."""
    from datetime import timedelta

    rows = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("at"))
    newest = rows.agg(F.max("at")).first()[0]
    second = (F.col("event_id") % 5 == 0) & (F.col("at") < F.lit(newest) - F.expr("INTERVAL 2 MINUTES"))
    marked = rows.withColumn("second", second)
    source, checkpoint = work_dir(spark, "r05-rows"), work_dir(spark, "r05-late-checkpoint")
    counts = late.MinuteCounts(spark, work_dir(spark, "r05-minutes"), "at", "event_id", timedelta(minutes=1))
    for run in (False, True):
        marked.filter(F.col("second") == run).drop("second").coalesce(1).write.mode("append").parquet(source)
        late.keep_minutes(bus_source.read_file_stream(spark, source, rows.schema), counts, checkpoint)
    closed = counts.closed().agg(F.sum("rows").alias("rows"), F.sum("total").alias("ids"), rollups.rows("minutes"))
    behind = counts.late().agg(
        rollups.rows("rows"), F.sum("event_id").alias("ids"), F.count_distinct(F.date_trunc("minute", "at")).alias("minutes")
    )
    return closed.select(F.lit("on time").alias("kind"), "*").unionByName(behind.select(F.lit("late").alias("kind"), "*"))
