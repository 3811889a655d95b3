"""Streams and loads that stop half way, run twice or see late rows."""

from __future__ import annotations

import json
import logging

import pytest
from pyspark.sql import functions as F

from contextlake.operators.envelope import SIGNAL, custom_events, envelope
from contextlake.plans import medallion
from contextlake.schemas import BUS, ORDER_EVENT
from contextlake.session import work_dir
from contextlake.sinks import tables as sinks
from contextlake.sources import bus as bus_source
from contextlake.sources import files
from contextlake.streaming import jobs


def bus_rows(spark, ids, topic="orders", minute=0):
    return spark.createDataFrame([(i,) for i in ids], "i int").select(
        F.lit(topic).alias("topic"),
        F.lit(None).cast("binary").alias("key"),
        F.concat(
            F.unhex(F.lit("0000000001")),
            F.encode(F.concat(F.lit('{"order_id":"'), "i", F.lit('","amount":1.005,"ts":1704067200000}')), "utf-8"),
        ).alias("value"),
        F.lit(0).alias("partition"),
        F.col("i").cast("bigint").alias("offset"),
        F.timestamp_seconds(F.lit(1_704_067_200 + minute * 60) + F.col("i")).alias("timestamp"),
    )


def test_topics_are_trimmed():
    assert bus_source.topic_list(" a, b ,,c ") == ["a", "b", "c"]


def test_bus_needs_a_known_start(spark):
    with pytest.raises(ValueError):
        bus_source.read_bus(spark, "a", bootstrap="x:1", starting="yesterday")


def test_rerun_of_one_checkpoint_adds_only_new_files(spark):
    source, sink, checkpoint = (work_dir(spark, n) for n in ("in", "out", "cp"))
    stream = lambda: medallion.to_bronze(bus_source.read_file_stream(spark, source, BUS))
    bus_rows(spark, range(5)).write.parquet(source)
    for expected in (5, 5):
        jobs.write_bounded(stream(), sink, checkpoint)
        assert spark.read.parquet(sink).count() == expected
    bus_rows(spark, range(5, 8)).write.mode("append").parquet(source)
    jobs.write_bounded(stream(), sink, checkpoint)
    assert spark.read.parquet(sink).count() == 8


def test_replay_warning(spark, caplog):
    checkpoint = work_dir(spark, "warn")
    spark.range(1).write.parquet(checkpoint)
    with caplog.at_level(logging.WARNING):
        assert jobs.warn_if_replay_ignored(spark, checkpoint, "earliest")
        assert not jobs.warn_if_replay_ignored(spark, checkpoint, "latest")
        assert not jobs.warn_if_replay_ignored(spark, checkpoint + "-none", "earliest")
    assert "resumes from" in caplog.text


def test_repeats_within_the_watermark_are_dropped(spark):
    source = work_dir(spark, "dup")
    bus_rows(spark, [1, 2, 2, 3]).union(bus_rows(spark, [3])).coalesce(1).write.parquet(source)
    bronze = medallion.to_bronze(bus_source.read_file_stream(spark, source, BUS))
    sink = work_dir(spark, "dup-out")
    jobs.write_bounded(jobs.dedupe_positions(bronze), sink, work_dir(spark, "dup-cp"))
    assert sorted(r["offset"] for r in spark.read.parquet(sink).collect()) == [1, 2, 3]


def test_rows_behind_the_watermark_are_not_counted_twice(spark):
    """A minute is written once; a row for it that comes later is dropped."""
    source, sink, checkpoint = (work_dir(spark, f"late-{n}") for n in ("in", "out", "cp"))
    sales = lambda rows: spark.createDataFrame(rows, "t string, user_id int, amount double").select(
        F.col("t").cast("timestamp").alias("event_time"), "user_id", "amount"
    )
    first = sales([("2024-01-01 00:00:10", 1, 1.0), ("2024-01-01 00:00:20", 2, 2.0), ("2024-01-01 00:05:00", 1, 4.0)])
    first.write.parquet(source)

    def run():
        stream = bus_source.read_file_stream(spark, source, first.schema)
        jobs.write_bounded(jobs.live_minutes(stream, "event_time", "amount", "user_id"), sink, checkpoint)

    run()
    sales([("2024-01-01 00:00:30", 3, 8.0), ("2024-01-01 00:10:00", 1, 1.0)]).write.mode("append").parquet(source)
    run()
    got = {str(r["minute"]): (r["orders"], r["gross_sales"]) for r in spark.read.parquet(sink).collect()}
    assert got["2024-01-01 00:00:00"] == (2, 3.0)
    assert got["2024-01-01 00:05:00"] == (1, 4.0)


def test_typed_rows_round_money_half_up(spark):
    bronze = medallion.to_bronze(bus_rows(spark, [1]))
    row = jobs.typed_stream(bronze, "orders", ORDER_EVENT, jobs.order_mapping()).first()
    assert (str(row["amount"]), str(row["event_time"])) == ("1.01", "2024-01-01 00:00:00")


def test_progress_table_holds_every_batch(spark):
    """More batches than Spark itself remembers, in several blocks."""
    source = work_dir(spark, "listen")
    bus_rows(spark, range(110)).repartition(110, "offset").write.option("maxRecordsPerFile", 1).parquet(source)
    log = jobs.ProgressLog(spark, block=40)
    with log.watching():
        stream = bus_source.read_file_stream(spark, source, BUS, max_files_per_trigger=1)
        jobs.write_bounded(stream.select("offset"), work_dir(spark, "listen-out"), work_dir(spark, "listen-cp"))
    batches = log.table().filter("input_rows > 0")
    assert batches.agg(F.sum("input_rows"), F.countDistinct("batch_id")).first()[:] == (110, 110)


# ---- landing and medallion ----
def signals(spark, ids):
    return spark.createDataFrame(
        [(f"s{i}", "market", "m", "t", "neutral", 3, 50, "", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z") for i in ids],
        "signal_id string, domain string, source string, title string, direction string, urgency int, confidence int,"
        " summary string, occurred_at string, ingested_at string",
    )


def test_landing_lines_hold_objects(spark):
    import glob

    root = work_dir(spark, "landing")
    sinks.write_landing(envelope(signals(spark, [1]), SIGNAL, "2024-01-02 00:00:00"), root, "2024-01-02")
    (path,) = glob.glob(f"{root}/landing_source=context_signals/dt=2024-01-02/*.json")
    record = json.loads(open(path).read())
    assert record["payload"]["signal_id"] == "s1" and record["source_name"] == "context_signals"
    back = files.read_landing(spark, f"{root}/*/dt=*/*").first()
    assert json.loads(back["payload"])["urgency"] == 3


def test_written_landing_files_pass_the_landing_rules(spark):
    from contextlake.operators import quality

    root = work_dir(spark, "rules")
    sinks.write_landing(envelope(signals(spark, range(3)), SIGNAL, "2024-01-02 00:00:00"), root, "2024-01-02")
    lines = quality.landing_lines(files.read_landing_lines(spark, f"{root}/*/dt=*/*"))
    known = spark.createDataFrame([("context_signals",)], "source_name string")
    assert quality.validate_landing_lines(lines, known, ["path"]).count() == 0
    audit = quality.landing_audit(lines).first()
    assert tuple(audit) == ("context_signals", 3, 0, 0, 0)
    stranger = quality.validate_landing_lines(lines, known.filter("false"), ["path"])
    assert {r["rule"] for r in stranger.collect()} == {"unregistered source"}


def test_feed_dates_reach_silver(spark):
    from contextlake.operators.subscriptions import subscription_events, subscription_items

    subs = spark.createDataFrame(
        [("s1", "rss_feed", "https://x.org/feed", "X", "news", ["t"], True, "public_context")],
        "subscription_id string, source_type string, reference string, label string, domain string, tags array<string>,"
        " enabled boolean, privacy_class string",
    )
    feed = "<rss><item><title>a</title><link>https://x.org/1</link><pubDate>Tue, 02 Jan 2024 10:00:00 GMT</pubDate></item></rss>"
    items = subscription_items(subs, spark.createDataFrame([("s1", feed)], "subscription_id string, text string"))
    events = subscription_events(subs, items, "2024-01-03 00:00:00")
    silver = medallion.to_silver(medallion.landing_to_bronze(events.withColumn("landing_file", F.lit("x"))))
    assert [str(r["event_time"]) for r in silver.collect()] == ["2024-01-02 10:00:00"]
    assert events.first()["payload"].count("https://") == 0


def test_a_load_that_stopped_half_way_can_be_repeated(spark):
    root = work_dir(spark, "half")
    sinks.write_landing(envelope(signals(spark, range(6)), SIGNAL, "2024-01-02 00:00:00"), root, "2024-01-02")
    base = work_dir(spark, "half-lake")
    bronze, silver, gold = (f"{base}/{n}" for n in ("bronze", "silver", "gold"))
    # A run that died after bronze: silver and gold do not exist yet.
    landed = medallion.landing_to_bronze(files.read_landing(spark, f"{root}/*/dt=*/*"))
    landed.write.partitionBy("source_name").parquet(bronze)
    load = lambda: medallion.load_medallion(
        spark, f"{root}/*/dt=*/*", bronze, silver, gold, work_dir(spark, "half-staging")
    )
    assert load() == {"bronze": 0, "silver": 6, "gold": 0}
    sinks.write_landing(envelope(signals(spark, range(4, 9)), SIGNAL, "2024-01-03 00:00:00"), root, "2024-01-03")
    assert load() == {"bronze": 3, "silver": 3, "gold": 0}
    assert load() == {"bronze": 0, "silver": 0, "gold": 0}


def test_custom_events_need_registration_and_time(spark):
    rows = spark.createDataFrame(
        [("a", '{"occurred_at":"2024-01-01","deep":{"phone":"1","ok":2}}'), ("a", '{"x":1}'), ("b", '{"occurred_at":"2024-01-01"}')],
        "source_name string, row_json string",
    )
    events, rejected = custom_events(rows, spark.createDataFrame([("a",)], "source_name string"))
    (event,) = events.collect()
    assert json.loads(event["payload"]) == {"occurred_at": "2024-01-01", "deep": {"ok": 2}}
    assert sorted(r["reject_reason"] for r in rejected.collect()) == [
        "row has no occurred_at or event_time", "source is not registered",
    ]


def test_event_id_equals_hash_of_sorted_payload(spark):
    import hashlib

    from contextlake.operators.envelope import EnvelopeSpec

    df = spark.createDataFrame([("2024-01-01T00:00:00Z", "x", 3)], "at string, b string, a int")
    row = envelope(df, EnvelopeSpec("src", "kind", "at", ("b", "a"))).first()
    key = "src:kind:2024-01-01T00:00:00Z:" + json.dumps({"b": "x", "a": 3}, sort_keys=True)
    assert row["idempotency_key"] == key
    assert row["event_id"] == hashlib.sha256(key.encode()).hexdigest()[:32]


def test_cdc_state_drops_deleted_rows(spark):
    change = lambda op, lsn, k, v: json.dumps(
        {"op": op, "source": {"lsn": lsn, "table": "t"}, "before": {"k": k, "v": v} if op == "d" else None,
         "after": None if op == "d" else {"k": k, "v": v}}
    )
    rows = [change("c", 1, 1, "a"), change("u", 3, 1, "c"), change("u", 2, 1, "b"), change("c", 1, 2, "x"), change("d", 4, 2, "x")]
    df = spark.createDataFrame([(r,) for r in rows], "json_payload string")
    state = bus_source.cdc_current_state(bus_source.parse_cdc(df, "struct<k:int,v:string>"), ["k"])
    assert [tuple(r) for r in state.collect()] == [(1, "c")]


# ---- null keys, repeated ids and late days ----
def test_loads_keep_lines_without_source_or_id_once(spark):
    root, base = work_dir(spark, "odd"), work_dir(spark, "odd-lake")
    one = envelope(signals(spark, [1, 2]), SIGNAL, "2024-01-02 00:00:00")
    odd = (
        one.withColumn("event_id", F.lit(None).cast("string"))
        .unionByName(one.withColumn("source_name", F.lit(None).cast("string")))
        .unionByName(one.withColumns({"event_id": F.concat(F.lit("late"), "event_id"), "event_time": F.lit("2019-05-05T00:00:00Z")}))
        .unionByName(one)
    )
    again = odd.withColumn("ingested_at", F.lit("2024-02-01T00:00:00Z"))
    odd.unionByName(again).write.json(f"{root}/landing_source=x/dt=2024-01-02")
    paths = [f"{base}/{n}" for n in ("bronze", "silver", "gold")]
    load = lambda: medallion.load_medallion(spark, f"{root}/*/dt=*/*", *paths, work_dir(spark, "odd-staging"))
    # Lines that lost their id get one from source, type, time and payload; those that lost
    # their source keep the id of the whole line, so they are the same events.
    first = load()
    assert first["bronze"] == spark.read.parquet(paths[0]).select("event_id").distinct().count() == 6
    assert load() == {"bronze": 0, "silver": 0, "gold": 0}


def test_null_sources_are_known_on_the_next_load(spark):
    root, base = work_dir(spark, "nosource"), work_dir(spark, "nosource-lake")
    lines = envelope(signals(spark, range(3)), SIGNAL, "2024-01-02 00:00:00").withColumn("source_name", F.lit(None).cast("string"))
    lines.write.json(f"{root}/landing_source=x/dt=2024-01-02")
    paths = [f"{base}/{n}" for n in ("bronze", "silver", "gold")]
    load = lambda: medallion.load_medallion(spark, f"{root}/*/dt=*/*", *paths, work_dir(spark, "nosource-staging"))
    assert load() == {"bronze": 3, "silver": 0, "gold": 0}
    assert load() == {"bronze": 0, "silver": 0, "gold": 0}


def test_loads_read_touched_days_only(spark):
    root, base = work_dir(spark, "days"), work_dir(spark, "days-lake")
    events = envelope(signals(spark, range(40)), SIGNAL, "2024-01-02 00:00:00")
    days = events.withColumn("event_time", F.concat(F.lit("2024-01-"), F.lpad((F.hash("event_id") % 5 + 6).cast("string"), 2, "0"), F.lit("T00:00:00Z")))
    days.write.json(f"{root}/landing_source=x/dt=2024-01-02")
    paths = [f"{base}/{n}" for n in ("bronze", "silver", "gold")]
    medallion.load_medallion(spark, f"{root}/*/dt=*/*", *paths, work_dir(spark, "days-staging"))
    batch = spark.read.parquet(paths[0]).filter("event_day = '2024-01-06'").select(
        *medallion.identified(medallion.landing_to_bronze(files.read_landing(spark, root))).columns
    )
    wanted = batch.count()
    touched = sinks.touched_partitions(batch, medallion.LAYER_PARTITIONS, work_dir(spark, "days-touched"))
    held = medallion.held_ids(spark, batch, touched, paths[0])
    assert held.count() == wanted < 40
    held.collect()
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def lake(spark, name):
    base = work_dir(spark, f"{name}-lake")
    root = work_dir(spark, name)
    paths = [f"{base}/{n}" for n in ("bronze", "silver", "gold")]
    load = lambda: medallion.load_medallion(spark, f"{root}/*/dt=*/*", *paths, work_dir(spark, f"{name}-staging"))
    return root, paths, load


def test_an_id_is_one_row_whatever_its_day_or_source(spark):
    """One id with two days and two sources is one row of every layer, in one load or in two."""
    lines = envelope(signals(spark, range(3)), SIGNAL, "2024-01-02 00:00:00").withColumns(
        {"event_time": F.lit("2024-01-06T00:00:00Z"), "event_type": F.lit("decision_x")}
    )
    moved = lines.withColumns({"event_time": F.lit("2024-01-07T00:00:00Z"), "ingested_at": F.lit("2024-02-01T00:00:00Z")})
    renamed = lines.withColumns({"source_name": F.lit("elsewhere"), "ingested_at": F.lit("2024-02-02T00:00:00Z")})
    for name, loads in (("one", 1), ("two", 3)):
        root, paths, load = lake(spark, f"moved-{name}")
        for k, part in enumerate((lines, moved, renamed)):
            part.write.json(f"{root}/landing_source=x/dt=2024-01-0{k + 2}")
            if loads == 3:
                load()
        assert load() == {"bronze": 0, "silver": 0, "gold": 0} if loads == 3 else load()["gold"] == 3
        assert [spark.read.parquet(p).count() for p in paths] == [3, 3, 3]


def test_ties_of_one_id_are_broken_the_same_way_every_time(spark):
    """Two sources share an id and an ingestion time: each fresh lake keeps the same line."""
    one = envelope(signals(spark, range(20)), SIGNAL, "2024-01-02 00:00:00")
    both = one.unionByName(one.withColumn("source_name", F.lit("elsewhere"))).unionByName(one.withColumn("source_name", F.lit(None).cast("string")))
    seen = set()
    for k in range(3):
        root, paths, load = lake(spark, f"ties-{k}")
        both.repartition(3 + k).write.json(f"{root}/landing_source=x/dt=2024-01-02")
        load()
        rows = spark.read.parquet(paths[0]).select("event_id", "source_name").collect()
        seen.add(tuple(sorted((r["event_id"], r["source_name"]) for r in rows)))
        assert load() == {"bronze": 0, "silver": 0, "gold": 0}
    assert len(seen) == 1


@pytest.mark.parametrize("stop_after", ["begin", "bronze", "silver", "gold"])
def test_a_load_stopped_anywhere_is_settled_by_the_next(spark, monkeypatch, stop_after):
    root, paths, load = lake(spark, f"stop-{stop_after}")
    lines = envelope(signals(spark, range(6)), SIGNAL, "2024-01-02 00:00:00").withColumn("event_type", F.lit("decision_x"))
    lines.filter("event_id < '8'").write.json(f"{root}/landing_source=x/dt=2024-01-02")
    load()
    lines.write.json(f"{root}/landing_source=x/dt=2024-01-03")
    write, done = medallion._append_layer, []

    def stopping(spark, rows, path):
        if stop_after == "begin":
            raise RuntimeError("stopped")
        result = write(spark, rows, path)
        done.append(path)
        if path.endswith(stop_after):
            raise RuntimeError("stopped")
        return result

    monkeypatch.setattr(medallion, "_append_layer", stopping)
    with pytest.raises(RuntimeError, match="stopped"):
        load()
    monkeypatch.setattr(medallion, "_append_layer", write)
    load()
    assert [spark.read.parquet(p).count() for p in paths] == [6, 6, 6]
    assert load() == {"bronze": 0, "silver": 0, "gold": 0}
    index = medallion.IdIndex(spark, f"{paths[0]}_ids")
    assert index.pending() == {} and index.held().filter(F.size("layers") == 3).count() == 6


def test_index_is_read_by_bucket_and_compacted(spark):
    index = medallion.IdIndex(spark, work_dir(spark, "ids"), buckets=4)
    assert not index.exists
    ids = lambda a, b: spark.range(a, b).select(F.concat(F.lit("e"), "id").alias("event_id"), F.lit("bronze").alias("layer"))
    index.create(ids(0, 50))
    for k in range(5):
        load = index.begin(ids(50 * k, 50 * k + 70).select("*", F.lit("s").alias("source_name"), F.lit("d").alias("event_day")))
        index.finish(load, index.pending()[load])
    assert index.held().count() == 270 and index.generation() == (1, 4)
    batch = spark.range(260, 280).select(F.concat(F.lit("e"), "id").alias("event_id"))
    with_layers = index.with_held_layers(batch)
    assert with_layers.filter(F.size("held_layers") == 0).count() == 10
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = index.with_held_layers(batch)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The batch is dealt to the buckets; the index is not.
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert index.compact(files_per_bucket=2, ids_per_bucket=20) and index.generation() == (2, 14)
    assert not index.compact(files_per_bucket=2)
    assert index.held().count() == 270
    # Another session knows the index by its files alone.
    again = medallion.IdIndex(spark.newSession(), index.path)
    assert again.generation() == (2, 14) and again.held().count() == 270


def test_merge_keeps_rows_without_a_partition_value(spark):
    path = work_dir(spark, "null-part")
    schema = "k int, ver int, p string"
    spark.createDataFrame([(1, 1, None), (2, 1, None), (3, 1, "x"), (4, 1, "y"), (None, 1, "x")], schema).write.partitionBy("p").parquet(path)
    source = spark.createDataFrame([(9, 1, None), (2, 2, None), (3, 2, "x"), (None, 2, "x")], schema)
    sinks.merge_into_partitions(spark, path, source, ["k"], ["ver"], "p", work_dir(spark, "null-part-staging"))
    got = spark.read.parquet(path).select("k", "ver", "p").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(1, 1, None), (2, 2, None), (9, 1, None), (3, 2, "x"), (4, 1, "y"), (None, 2, "x")], key=repr
    )


def test_ids_tell_microseconds_apart(spark):
    from contextlake.operators.envelope import EnvelopeSpec

    df = spark.createDataFrame([(1, "2024-01-01 00:00:00.000001"), (1, "2024-01-01 00:00:00.000002")], "a int, t string")
    rows = envelope(df.withColumn("at", F.col("t").cast("timestamp")), EnvelopeSpec("s", "k", "at", ("a", "at"))).collect()
    assert len({r["event_id"] for r in rows}) == 2
    assert rows[0]["event_time"].startswith("2024-01-01T00:00:00.000001")
