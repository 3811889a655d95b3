"""Sinks, upserts and maintenance."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from contextlake.operators import latest, rollups
from contextlake.operators.envelope import SIGNAL, envelope
from contextlake.plans import medallion
from contextlake.schemas import BUS
from contextlake.session import work_dir
from contextlake.sinks import tables as sinks
from contextlake.sources import bus as bus_source
from contextlake.sources import files
from contextlake.streaming import jobs

from .adapters import AS_OF, table, view
from .projection_queries import STATE_ID, STATE_SIZE, WIRE, bus
from .registry import query
from .source_queries import landing_events, stored

BRONZE_SUMMARY = f"""WITH {WIRE} SELECT event_type AS event_source, count(*) AS events, count({STATE_ID}) AS with_schema,
    CAST(sum({STATE_SIZE}) AS BIGINT) AS bytes, count(*) FILTER (WHERE state = 'good') AS decoded FROM wire GROUP BY 1"""


def bronze_summary(df):
    return df.groupBy("event_source").agg(
        rollups.rows("events"),
        F.count("schema_id").alias("with_schema"),
        F.sum("payload_size").alias("bytes"),
        F.count("json_payload").alias("decoded"),
    )


@query("k01_bounded_append", BRONZE_SUMMARY)
def _(spark, sf):
    """Bus to bronze in one bounded run, then a second run that must add nothing."""
    stream = bus_source.read_file_stream(spark, stored(bus(spark, sf), "k01-bus"), BUS)
    sink, checkpoint = work_dir(spark, "k01-bronze"), work_dir(spark, "k01-checkpoint")
    for _run in range(2):
        jobs.write_bounded(medallion.to_bronze(stream), sink, checkpoint, partition_by=["event_source"])
    return bronze_summary(spark.read.parquet(sink))


@query("k02_micro_batches", BRONZE_SUMMARY)
def _(spark, sf):
    """Timed micro-batches until the input is used up."""
    stream = bus_source.read_file_stream(spark, stored(bus(spark, sf).repartition(4), "k02-bus"), BUS, max_files_per_trigger=2)
    sink, checkpoint = work_dir(spark, "k02-bronze"), work_dir(spark, "k02-checkpoint")
    running = jobs.write_continuous(medallion.to_bronze(stream), sink, checkpoint, "1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return bronze_summary(spark.read.parquet(sink))


@query("k03_ensure_table", "SELECT event_type AS event_source, count(*) AS events FROM events GROUP BY event_type")
def _(spark, sf):
    """Create when missing (twice, the second is a no-op), then fill a new version of it."""
    name = f"spark_catalog.default.raw_{uuid.uuid4().hex}"
    events = view(spark, sf, "v_bronze").select("event_time", "json_payload", "offset_id", "event_source")
    for _run in range(2):
        sinks.ensure_table(spark, name, events.schema, location=work_dir(spark, "k03"))
    sinks.append_table(events, name)
    return spark.table(name).groupBy("event_source").agg(rollups.rows("events"))


@query(
    "k04_append_with_count",
    "SELECT event_type, count(*) AS in_table, (SELECT count(*) FROM events) AS reported FROM events GROUP BY event_type",
)
def _(spark, sf):
    """The writer reports its rows without a second scan."""
    path = work_dir(spark, "k04")
    reported = sinks.append_table(table(spark, sf, "events"), path, ["event_type"])
    return (
        spark.read.parquet(path)
        .groupBy("event_type")
        .agg(rollups.rows("in_table"))
        .withColumn("reported", F.lit(reported).cast("bigint"))
    )


@query(
    "k05_landing_write",
    """SELECT 'context_signals' AS landing_source, '2024-01-31' AS dt, count(*) AS events FROM v_signals""",
    ("v_signals",),
)
def _(spark, sf):
    root = work_dir(spark, "k05")
    sinks.write_landing(envelope(view(spark, sf, "v_signals"), SIGNAL, AS_OF), root, "2024-01-31")
    lines = spark.read.option("basePath", root).text(root)
    return lines.groupBy("landing_source", F.col("dt").cast("string").alias("dt")).agg(rollups.rows("events"))


@query(
    "k06_landing_manifest",
    """SELECT source_name, CAST(sum(n) AS BIGINT) AS events FROM (
        SELECT 'context_signals' AS source_name, count(*) AS n FROM v_signals
        UNION ALL SELECT 'weather_forecast', count(*) FROM (SELECT DISTINCT location_id, forecast_time FROM v_weather)) GROUP BY 1""",
    ("v_signals", "v_weather"),
)
def _(spark, sf):
    root = work_dir(spark, "k06")
    sinks.write_landing(landing_events(spark, sf), root, "2024-01-31", compression="gzip")
    manifest = sinks.landing_manifest(files.read_landing(spark, f"{root}/*/dt=*/*"))
    source = F.regexp_extract("path", r"landing_source=([^/]+)/", 1)
    return manifest.groupBy(source.alias("source_name")).agg(F.sum("rows").alias("events"))


@query(
    "k07_typed_inserts",
    """SELECT 'activity' AS name, count(*) AS n, max(logged_at) AS latest FROM v_activity
    UNION ALL SELECT 'feedback', count(*), max(created_at) FROM v_feedback
    UNION ALL SELECT 'scores', count(*), max(computed_at) FROM v_scores""",
    ("v_activity", "v_feedback", "v_scores"),
)
def _(spark, sf):
    """Typed appends of three tables; monthly folders, sorted files."""
    result = None
    for name, source, ts, sort in (
        ("activity", "v_activity", "logged_at", "activity_type"),
        ("feedback", "v_feedback", "created_at", "activity"),
        ("scores", "v_scores", "computed_at", "activity"),
    ):
        path = work_dir(spark, f"k07-{name}")
        sinks.write_monthly(view(spark, sf, source), path, ts, [sort, ts])
        rows = spark.read.parquet(path).agg(rollups.rows("n"), F.max(ts).alias("latest"))
        rows = rows.select(F.lit(name).alias("name"), "n", "latest")
        result = rows if result is None else result.unionByName(rows)
    return result


NEWEST_SIGNAL = """SELECT signal_id, domain, CAST(urgency AS BIGINT) AS urgency, occurred_at, event_id FROM v_signals
    QUALIFY row_number() OVER (PARTITION BY signal_id ORDER BY ingested_at DESC, event_id DESC) = 1"""


@query("k08_upsert", NEWEST_SIGNAL, ("v_signals",))
def _(spark, sf):
    """The second half of January arrives as an upsert over the first half."""
    signals = view(spark, sf, "v_signals").select("signal_id", "domain", "urgency", "occurred_at", "event_id", "ingested_at")
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    version = ["ingested_at", "event_id"]
    target = latest.keep_latest(signals.filter(F.col("ingested_at") < half), ["signal_id"], version)
    merged = sinks.upsert(target, signals.filter(F.col("ingested_at") >= half), ["signal_id"], version)
    return merged.drop("ingested_at")


@query("k08_upsert_touched_partitions", "SELECT user_id, max(event_id) AS event_id, user_id % 8 AS part FROM events GROUP BY user_id")
def _(spark, sf):
    """Only the partitions that new rows touch are rewritten in the stored table."""
    rows = table(spark, sf, "events").select("user_id", "event_id", "ts", (F.col("user_id") % 8).alias("part"))
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    path, staging = work_dir(spark, "k08"), work_dir(spark, "k08-staging")
    first = latest.keep_latest(rows.filter(F.col("ts") < half), ["user_id"], ["event_id"])
    first.write.partitionBy("part").parquet(path)
    sinks.merge_into_partitions(
        spark, path, rows.filter(F.col("ts") >= half), ["user_id"], ["event_id"], "part", staging
    )
    return spark.read.parquet(path).select("user_id", "event_id", F.col("part").cast("bigint").alias("part"))


@query(
    "k09_insert_if_absent",
    """SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY
        CASE WHEN event_type = 'signup' THEN 0 ELSE 1 END, CASE WHEN event_type = 'signup' THEN event_id ELSE -event_id END) = 1""",
)
def _(spark, sf):
    """Users with a signup keep their first one; others are inserted with their newest event."""
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    signups = events.filter(F.col("event_type") == "signup")
    target = latest.latest_by(signups, ["user_id"], [F.col("event_id").asc()])
    return target.unionByName(sinks.insert_new(target, events, ["user_id"], ["event_id"]))


@query(
    "k10_plain_inserts",
    """SELECT CAST(max(length(text)) AS BIGINT) > 1000 AS had_long, count(*) AS inserted,
    CAST(sum(least(length(text), 1000)) AS BIGINT) AS stored_characters FROM documents""",
)
def _(spark, sf):
    """Digest runs: the stored summary is cut to 1000 characters."""
    runs = table(spark, sf, "documents").select(
        F.lit("daily").alias("digest_type"), F.lit("sent").alias("status"), F.col("text").alias("summary"),
        F.length("text").alias("full_length"),
    )
    path = work_dir(spark, "k10")
    sinks.append_digest_runs(runs, path)
    return spark.read.parquet(path).agg(
        (F.max("full_length") > 1000).alias("had_long"),
        rollups.rows("inserted"),
        F.sum(F.length("summary")).alias("stored_characters"),
    )


@query("k11_keep_latest", NEWEST_SIGNAL, ("v_signals",))
def _(spark, sf):
    newest = latest.keep_latest(view(spark, sf, "v_signals"), ["signal_id"], ["ingested_at", "event_id"])
    return newest.select("signal_id", "domain", "urgency", "occurred_at", "event_id")


@query(
    "k12_update_where",
    """SELECT user_id, CASE WHEN segment = 'BUILDING' THEN CASE WHEN lifetime_value > 5000 THEN 'Premium'
        WHEN lifetime_value > 1000 THEN 'Standard' ELSE 'Basic' END ELSE segment END AS segment,
    round(CASE WHEN segment = 'BUILDING' THEN CAST(lifetime_value AS DOUBLE) * 1.1 ELSE CAST(lifetime_value AS DOUBLE) END, 4) AS lifetime_value
    FROM v_segments""",
    ("v_segments",),
)
def _(spark, sf):
    segments = view(spark, sf, "v_segments").withColumn("lifetime_value", F.col("lifetime_value").cast("double"))
    value = F.col("lifetime_value")
    updated = sinks.update_where(
        segments,
        F.col("segment") == "BUILDING",
        {
            "lifetime_value": value * 1.1,
            "segment": F.when(value > 5000, "Premium").when(value > 1000, "Standard").otherwise("Basic"),
        },
    )
    return updated.withColumn("lifetime_value", F.round("lifetime_value", 4))


@query("k13_rows_appended", "SELECT event_type, 2 * count(*) AS n FROM events GROUP BY event_type")
def _(spark, sf):
    path = work_dir(spark, "k13")
    events = table(spark, sf, "events")
    for _run in range(2):
        sinks.append_table(events, path)
    return spark.read.parquet(path).groupBy("event_type").agg(rollups.rows("n"))


@query("k14_compaction", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS checksum, true AS fewer_files FROM events GROUP BY event_type")
def _(spark, sf):
    """Many small files in, few larger files out, same rows."""
    scattered, compacted = work_dir(spark, "k14"), work_dir(spark, "k14-compacted")
    table(spark, sf, "events").repartition(12).write.partitionBy("event_type").parquet(scattered)
    sinks.compact(spark, scattered, compacted, ["event_type"])
    before, after = (sinks.file_stats(spark, p).select("files") for p in (scattered, compacted))
    return (
        spark.read.parquet(compacted)
        .groupBy("event_type")
        .agg(rollups.rows("n"), F.sum("event_id").alias("checksum"))
        .withColumn("fewer_files", after.scalar() < before.scalar())
    )


@query(
    "k15_state_as_of",
    """SELECT user_id, event_id, event_type FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
)
def _(spark, sf):
    moment = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    log = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return latest.state_as_of(log, ["user_id"], ["event_id"], "ts", moment).drop("ts")


@query("k16_file_stats")
def _(spark, sf):
    path = work_dir(spark, "k16")
    table(spark, sf, "events").repartition(6).write.parquet(path)
    return sinks.file_stats(spark, path)


@query(
    "k16_file_stats_order",
    "SELECT 6 AS files, true AS ordered, true AS spread FROM (SELECT count(*) FROM events)",
)
def _(spark, sf):
    """Six written files: least size, mean and most in order."""
    path = work_dir(spark, "k16-order")
    table(spark, sf, "events").repartition(6).write.parquet(path)
    stats = sinks.file_stats(spark, path)
    ordered = (F.col("min_bytes") > 0) & (F.col("min_bytes") <= F.col("mean_bytes")) & (F.col("mean_bytes") <= F.col("max_bytes"))
    return stats.select("files", ordered.alias("ordered"), (F.col("stddev_bytes") >= 0).alias("spread"))


@query(
    "k17_monthly_partitions",
    """SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month, count(*) AS n,
    CAST(sum(o_orderkey) AS BIGINT) AS checksum FROM orders GROUP BY 1""",
)
def _(spark, sf):
    path = work_dir(spark, "k17")
    sinks.write_monthly(table(spark, sf, "orders"), path, "o_orderdate", ["o_custkey"], codec="zstd")
    return (
        spark.read.parquet(path)
        .groupBy(F.col("month").cast("date").alias("month"))
        .agg(rollups.rows("n"), F.sum("o_orderkey").alias("checksum"))
    )


@query(
    "k18_medallion_load_is_repeatable",
    """SELECT 'bronze' AS layer, count(DISTINCT signal_id) AS n FROM v_signals
    UNION ALL SELECT 'silver', count(DISTINCT signal_id) FROM v_signals UNION ALL SELECT 'gold', 0""",
    ("v_signals",),
)
def _(spark, sf):
    """Landing to bronze, silver and gold, loaded twice: event ids keep it at one copy."""
    root = work_dir(spark, "k18-landing")
    sinks.write_landing(envelope(view(spark, sf, "v_signals"), SIGNAL, AS_OF), root, "2024-01-31")
    base = work_dir(spark, "k18-lake")
    paths = {layer: f"{base}/{layer}" for layer in ("bronze", "silver", "gold")}
    for _run in range(2):
        medallion.load_medallion(spark, f"{root}/*/dt=*/*", *paths.values(), work_dir(spark, "k18-staging"))
    result = None
    for layer, path in paths.items():
        schema = medallion.landing_to_bronze(files.read_landing(spark, root)).schema
        rows = spark.read.schema(schema).parquet(path).agg(rollups.rows("n")).select(F.lit(layer).alias("layer"), "n")
        result = rows if result is None else result.unionByName(rows)
    return result


@query(
    "k18_load_with_odd_lines",
    """WITH s AS (SELECT count(DISTINCT signal_id) AS ids, (SELECT count(*) FROM (SELECT DISTINCT * FROM v_signals)) AS lines
        FROM v_signals)
    SELECT 'bronze' AS layer, 2 * ids + lines AS n, 2 * ids + lines AS n_ids FROM s
    UNION ALL SELECT 'silver', ids + lines, ids + lines FROM s""",
    ("v_signals",),
)
def _(spark, sf):
    """Lines without source, without id, repeated and late ones, loaded twice: none is lost, none comes twice."""
    lines = envelope(view(spark, sf, "v_signals"), SIGNAL, AS_OF)
    nothing = F.lit(None).cast("string")
    odd = (
        lines.unionByName(lines.withColumns({"source_name": nothing, "event_id": F.concat(F.lit("n"), "event_id")}))
        .unionByName(lines.withColumns({"event_id": nothing, "event_time": F.lit("2019-05-05T00:00:00Z")}))
        .unionByName(lines.withColumn("ingested_at", F.lit("2024-03-01T00:00:00Z")))
    )
    root, base = work_dir(spark, "k18-odd-landing"), work_dir(spark, "k18-odd-lake")
    sinks.landing_writer(odd).json(f"{root}/landing_source=odd/dt=2024-01-31")
    paths = {layer: f"{base}/{layer}" for layer in ("bronze", "silver", "gold")}
    for _run in range(2):
        medallion.load_medallion(spark, f"{root}/*/dt=*/*", *paths.values(), work_dir(spark, "k18-odd-staging"))
    counts = [
        spark.read.parquet(paths[layer])
        .agg(rollups.rows("n"), F.count_distinct("event_id").alias("n_ids"))
        .select(F.lit(layer).alias("layer"), "n", "n_ids")
        for layer in ("bronze", "silver")
    ]
    return counts[0].unionByName(counts[1])


@query(
    "k08_merge_rows_without_partition",
    """SELECT user_id, max(event_id) AS event_id, CASE WHEN user_id % 4 > 0 THEN user_id % 4 END AS part
    FROM events GROUP BY user_id""",
    text=("part",),
)
def _(spark, sf):
    """A quarter of the users has no partition value; stored ones among them stay."""
    part = F.when(F.col("user_id") % 4 > 0, F.col("user_id") % 4)
    rows = table(spark, sf, "events").select("user_id", "event_id", "ts", part.alias("part"))
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    path, staging = work_dir(spark, "k08-null"), work_dir(spark, "k08-null-staging")
    latest.keep_latest(rows.filter(F.col("ts") < half), ["user_id"], ["event_id"]).write.partitionBy("part").parquet(path)
    sinks.merge_into_partitions(
        spark, path, rows.filter(F.col("ts") >= half), ["user_id"], ["event_id"], "part", staging
    )
    return spark.read.parquet(path).select("user_id", "event_id", F.col("part").cast("bigint").alias("part"))


@query(
    "k18_ids_are_one_row_in_all_loads",
    """WITH s AS (SELECT DISTINCT signal_id FROM v_signals)
    SELECT layer, n, n AS n_ids, n AS first_day FROM (
        SELECT 'bronze' AS layer, count(*) AS n FROM s UNION ALL SELECT 'silver', count(*) FROM s
        UNION ALL SELECT 'gold', count(*) FROM s)""",
    ("v_signals",),
)
def _(spark, sf):
    """Ids that come again with another day, from another source and both: each is one row, the first one loaded."""
    first = envelope(view(spark, sf, "v_signals"), SIGNAL, AS_OF).withColumns(
        {"event_time": F.lit("2024-01-06T00:00:00Z"), "event_type": F.lit("decision_signal")}
    )
    later = {"event_time": F.lit("2024-01-07T00:00:00Z"), "ingested_at": F.lit("2024-03-01T00:00:00Z")}
    other = {"source_name": F.lit("elsewhere"), "ingested_at": F.lit("2024-03-02T00:00:00Z")}
    root, base = work_dir(spark, "k18-ids-landing"), work_dir(spark, "k18-ids-lake")
    paths = {layer: f"{base}/{layer}" for layer in ("bronze", "silver", "gold")}
    for k, changed in enumerate(({}, later, {**later, **other})):
        sinks.landing_writer(first.withColumns(changed)).json(f"{root}/landing_source=ids/dt=2024-01-3{k}")
        medallion.load_medallion(spark, f"{root}/*/dt=*/*", *paths.values(), work_dir(spark, "k18-ids-staging"))
    counts = [
        spark.read.parquet(path)
        .agg(
            rollups.rows("n"),
            F.count_distinct("event_id").alias("n_ids"),
            F.count_if(F.col("event_day") == "2024-01-06").alias("first_day"),
        )
        .select(F.lit(layer).alias("layer"), "n", "n_ids", "first_day")
        for layer, path in paths.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])
