"""Operators on small rows: ties, nulls, empty inputs, hot keys."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from contextlake.functions import hashing, json_tools, numbers, text, times, urls, wire
from contextlake.operators import latest, logs, messages, quality, rollups, sleep, tracks
from contextlake.session import config_frame, work_dir
from contextlake.sinks import tables as sinks
from contextlake.sources import files, inbox


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


# ---- functions ----
def test_text_functions(spark):
    got = one(
        spark,
        text.clean_label(F.lit("  Héllo, World! ")),
        text.slug(F.lit("__Ab c/Ü__")),
        text.slug(F.lit("---")),
        text.word_count(F.lit("naïve café, x_1 — 2")),
        text.classify_text(F.lit("Dinner after GYM")),
        text.clean_label(F.lit(None).cast("string")),
    )
    assert got == ("hllo world", "ab_c_ü", "unknown", 4, "training", "")


def test_sanitize_message_order(spark):
    raw = "Telegram token or chat id is not configured; token=abc123 bot123456789012345678901234 chat id 5"
    cleaned = one(spark, text.sanitize_message(F.lit(raw)))[0]
    assert cleaned == (
        "Telegram credentials missing; credential=[redacted] bot[redacted] chat identifier 5"
    )
    assert one(spark, F.length(text.sanitize_message(F.lit("x" * 500))))[0] == 180


def test_key_values_last_wins(spark):
    pairs = text.key_values(text.tokens(F.lit(" a=1 B=x_y a=2  plain_word ")))
    words = text.plain_words(text.tokens(F.lit(" a=1 plain_word ")))
    assert one(spark, text.value_of(pairs, "a"), text.value_of(pairs, "b"), text.value_of(pairs, "c"), words[0]) == (
        "2", "x y", None, "plain word",
    )


def test_hash_lengths_and_blank(spark):
    import hashlib

    got = one(spark, hashing.stable_hash(F.lit(" abc ")), hashing.stable_hash(F.lit("  ")), hashing.stable_hash(F.lit("abc"), 24))
    digest = hashlib.sha256(b"abc").hexdigest()
    assert got == (digest[:16], "", digest[:24])


def test_canonical_json_equals_sorted_dump(spark):
    import json

    df = spark.range(1).select(
        F.struct(F.lit('q"uote').alias("z"), F.array(F.lit(1), F.lit(2)).alias("a"), F.lit(1.5).alias("m"),
                 F.create_map(F.lit("k2"), F.lit("v"), F.lit("k1"), F.lit("w")).alias("map"),
                 F.lit(None).cast("int").alias("n"), F.lit(True).alias("b")).alias("p")
    )
    got = df.select(hashing.canonical_json(F.col("p"), df.schema["p"].dataType)).first()[0]
    want = {"z": 'q"uote', "a": [1, 2], "m": 1.5, "map": {"k1": "w", "k2": "v"}, "n": None, "b": True}
    assert got == json.dumps(want, sort_keys=True)


def test_lenient_times(spark):
    iso = lambda s: times.parse_iso(F.lit(s)).cast("string")
    assert one(spark, iso("2024-01-02T03:04:05Z"), iso("2024-01-02T03:04:05+03:00"), iso("2024-01-02T03:04"), iso("soon")) == (
        "2024-01-02 03:04:05", "2024-01-02 00:04:05", "2024-01-02 03:04:00", None,
    )


@pytest.mark.parametrize(
    "day, monday, sunday", [("2024-01-07", "2024-01-01", "2024-01-07"), ("2024-01-08", "2024-01-08", "2024-01-07")]
)
def test_week_starts(spark, day, monday, sunday):
    d = F.lit(day).cast("date")
    assert one(spark, times.week_start(d).cast("string"), times.week_start(d, "sunday").cast("string")) == (monday, sunday)


def test_durations(spark):
    minutes = lambda s: numbers.duration_minutes(F.lit(s))
    assert one(spark, minutes("7.5h"), minutes("7:30"), minutes("450"), minutes("0"), minutes("a:b"), minutes("h")) == (
        450, 450, 450, None, None, None,
    )


def test_ratio_and_bounds(spark):
    assert one(
        spark, numbers.ratio(F.lit(1), F.lit(3)), numbers.ratio(F.lit(1), F.lit(0)), numbers.ratio(F.lit(1), F.lit(0), 3, None),
        numbers.bounded_int(F.lit("10"), 1, 10), numbers.bounded_int(F.lit("10.0"), 1, 10), numbers.bounded_int(F.lit("11"), 1, 10),
    ) == (0.333, 0.0, None, 10, None, None)


def test_wire_format(spark):
    value = lambda h: F.unhex(F.lit(h))
    ok = value("0000000007" + b'{"a":1}'.hex())
    huge, short, magic = value("00FFFFFFFF7B7D"), value("00"), value("01000000077B7D")
    assert one(spark, wire.schema_id(ok), wire.schema_id(huge), wire.schema_id(short), wire.payload_size(short),
               wire.payload_size(short, True), wire.payload_size(F.lit(None).cast("binary"))) == (7, None, None, -4, 0, None)
    decode = wire.decode_json_payload
    assert one(spark, decode(ok), decode(magic), decode(short), decode(short, "json")) == (
        '{"a":1}', None, None, '{"error":"invalid or missing value"}',
    )


def test_jsonable_rewrites_decimals_and_bytes(spark):
    df = spark.range(1).select(
        F.struct(F.lit("1.50").cast("decimal(5,2)").alias("d"), F.unhex(F.lit("0AFF")).alias("b"),
                 F.array(F.lit("2.0").cast("decimal(3,1)")).alias("l")).alias("r")
    )
    assert df.select(F.to_json(wire.jsonable(F.col("r"), df.schema["r"].dataType))).first()[0] == '{"d":"1.50","b":"0aff","l":["2.0"]}'


def test_redaction_and_masking_at_depth(spark):
    raw = '{"a":[{"Work-Address":1,"b":{"notes":"x","c":null}}],"tokens":2}'
    assert one(spark, json_tools.redact_json(F.lit(raw)), json_tools.redact_json(F.lit("{broken"))) == (
        '{"a":[{"b":{"c":null}}],"tokens":2}', None,
    )
    assert one(spark, json_tools.mask_json(F.lit(raw)))[0] == '{"a":[{"Work-Address":1,"b":{"notes":"x","c":null}}],"tokens":"[redacted]"}'


def test_url_functions(spark):
    kinds = [
        ("https://t.me/chan", "telegram_channel"), ("wss://x.io/live", "event_stream"), ("https://x.io/feed", "rss_feed"),
        ("https://x.io/a.json", "api_json"), ("https://x.io/page", "news_url"), ("ftp://x.io/page", None),
    ]
    got = one(spark, *[urls.infer_source_type(F.lit(u)) for u, _k in kinds])
    assert got == tuple(k for _u, k in kinds)
    assert one(spark, urls.default_label(F.lit("https://X.io/a/my-page_1")), urls.default_label(F.lit("https://X.io/"))) == ("my page 1", "x.io")


# ---- latest ----
def test_latest_by_ties_and_top_k(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", 5, 3), ("a", 0, 4)], "k string, v int, id int")
    newest = latest.latest_by(df, ["k"], [F.col("v").desc(), F.col("id").desc()])
    assert sorted((r["k"], r["id"]) for r in newest.collect()) == [("a", 2), ("b", 3)]
    assert latest.latest_by(df, ["k"], [F.col("v").desc(), F.col("id")], 2).count() == 3


def test_latest_values_skip_nulls(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None)], "k string, ver int, v string")
    assert latest.latest_values(df, ["k"], ["v"], "ver", "latest").collect()[0][1:] == ("x", 2)


def test_share_of_empty_table(spark):
    assert latest.share(spark.createDataFrame([], "k string"), ["k"], "n").count() == 0


# ---- sinks ----
def test_upsert_and_insert_new(spark):
    ddl = "k string, ver int, v string"
    target = spark.createDataFrame([("a", 1, "old"), ("b", 1, "keep")], ddl)
    source = spark.createDataFrame([("a", 2, "mid"), ("a", 3, "new"), ("c", 1, "add")], ddl)
    merged = {r["k"]: r["v"] for r in sinks.upsert(target, source, ["k"], ["ver"]).collect()}
    assert merged == {"a": "new", "b": "keep", "c": "add"}
    assert [r["k"] for r in sinks.insert_new(target, source, ["k"], ["ver"]).collect()] == ["c"]


def test_update_reads_the_old_row(spark):
    df = spark.createDataFrame([(10, "P"), (1, "Q")], "v int, s string")
    got = sinks.update_where(df, F.col("s") == "P", {"v": F.col("v") * 2, "s": F.when(F.col("v") > 15, "big").otherwise("small")})
    assert sorted(tuple(r) for r in got.collect()) == [(1, "Q"), (20, "small")]


def test_merge_rewrites_only_touched_partitions(spark):
    import glob

    path, staging = work_dir(spark, "merge"), work_dir(spark, "merge-staging")
    spark.createDataFrame([("a", 1, 0), ("b", 1, 1)], "k string, ver int, p int").write.partitionBy("p").parquet(path)
    untouched = set(glob.glob(f"{path}/p=1/*.parquet"))
    source = spark.createDataFrame([("a", 2, 0), ("c", 1, 0)], "k string, ver int, p int")
    sinks.merge_into_partitions(spark, path, source, ["k"], ["ver"], "p", staging)
    assert sorted((r["k"], r["ver"]) for r in spark.read.parquet(path).collect()) == [("a", 2), ("b", 1), ("c", 1)]
    assert set(glob.glob(f"{path}/p=1/*.parquet")) == untouched


@pytest.mark.parametrize("partition_by", [(), ("p",)])
def test_append_reports_rows_also_when_there_are_none(spark, partition_by):
    path = work_dir(spark, "append")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, p int")
    none = df.join(df.select("k"), "k", "left_anti")
    assert sinks.append_table(df, path, partition_by) == 2
    assert sinks.append_table(none, path, partition_by) == 0
    assert spark.read.parquet(path).count() == 2


def test_ensure_table_needs_full_name(spark):
    with pytest.raises(ValueError):
        sinks.ensure_table(spark, "only_name", "event_source string")


def test_config_frame_refuses_facts(spark):
    with pytest.raises(ValueError):
        config_frame(spark, ((i,) for i in range(20_000)), "i int")


# ---- tracks ----
def plain_route(points):
    km = climb = 0.0
    for (a, b, e), (c, d, f) in zip(points, points[1:]):
        p1, p2 = math.radians(a), math.radians(c)
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
        km += 6371.0088 * 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h))
        climb += max(0.0, f - e)
    return km, climb


@pytest.mark.parametrize("chunk", [1, 3, 7, 1000])
def test_route_summary_does_not_depend_on_chunks(spark, chunk):
    rng = random.Random(3)
    data, want = [], {}
    for track in range(4):
        points = [(rng.uniform(-60, 60), rng.uniform(-170, 170), float(rng.randint(0, 50))) for _ in range(1 + track * 9)]
        want[track] = plain_route(points)
        data += [(track, i * 2, *p, f"2024-01-01T00:{i:02d}:00Z") for i, p in enumerate(points)]
    df = spark.createDataFrame(data, "track_id int, idx int, lat double, lon double, ele double, time string")
    for r in tracks.route_summary(df, chunk_points=chunk).collect():
        km, climb = want[r["track_id"]]
        assert r["distance_km"] == pytest.approx(km, abs=2e-3)
        assert r["elevation_gain_m"] == pytest.approx(climb, abs=0.05)
        assert r["point_count"] == 1 + r["track_id"] * 9
        assert r["duration_minutes"] == r["track_id"] * 9


# ---- logs ----
def test_empty_log_is_reported_missing(spark):
    empty = spark.createDataFrame([], "event_time string, component string, action string, status string, message string")
    rows = logs.run_health(empty, "2024-01-01 00:00:00").collect()
    assert [(r["source_name"], r["status"], r["error_count"]) for r in rows] == [("runtime_log", "missing", 1)]
    assert "Events: 0" in logs.log_text(empty, [F.col("event_time").desc()]).first()[0]


def test_run_health_overall_row_merges_components(spark):
    data = [
        ("2024-01-01T00:00:00Z", "a", "x", "ok", ""), ("2024-01-01T00:05:00Z", "b", "x", "ok", ""),
        ("2024-01-01T00:04:00Z", "b", "y", "Skipped", "password=hunter2 failed"),
    ]
    df = spark.createDataFrame(data, "event_time string, component string, action string, status string, message string")
    rows = {r["source_name"]: r for r in logs.run_health(df, "2024-01-01 01:00:00").collect()}
    assert rows["runtime"]["row_count"] == 3 and rows["runtime"]["status_counts"] == {"Skipped": 1, "ok": 2}
    assert rows["b"]["last_error"] == "password=[redacted] failed"
    assert (rows["a"]["status"], rows["b"]["status"]) == ("ok", "failed")
    assert rows["b"]["freshness_minutes"] == 55


# ---- sleep ----
def test_sleep_rejections(spark):
    ddl = "slept_at string, woke_at string, in_bed_minutes string, quality_score string, recovery_score string, source string"
    good = ("2024-01-01T23:00:00+03:00", "2024-01-02T06:30:00+03:00", None, "82", None, None)
    bad = [
        (None, "2024-01-02T06:30:00Z", None, "82", None, None),
        ("2024-01-02T07:00:00Z", "2024-01-02T06:30:00Z", None, "82", None, None),
        ("2024-01-01T23:00:00Z", "2024-01-02T06:30:00Z", "100", "82", None, None),
        ("2024-01-01T23:00:00Z", "2024-01-02T06:30:00Z", None, "0", None, None),
        ("tonight", "2024-01-02T06:30:00Z", None, "82", None, None),
    ]
    valid, rejected = sleep.normalize_sleep(spark.createDataFrame([good, *bad], ddl))
    night = valid.collect()
    assert [(n["duration_minutes"], n["recovery_score"], n["sleep_efficiency"], n["source"]) for n in night] == [(450, 82, 1.0, "local_sleep_log")]
    assert sorted(r["reject_reason"] for r in rejected.collect()) == sorted(
        ["slept_at and woke_at are required", "duration must be positive", "in_bed_minutes must be >= duration",
         "quality_score must be between 1 and 100", "time is not readable"]
    )


# ---- quality ----
def test_expectations_on_empty_table(spark):
    empty = spark.createDataFrame([], "label string, latitude double, longitude double")
    suite = [e for e in quality.core_suite() if e.dataset == "spots"]
    got = {r["id"]: r["passed"] for r in quality.run_expectations({"spots": empty}, suite).collect()}
    assert got == {"spots_have_rows": False, "spots_have_valid_coordinates": True, "spots_have_labels": True}


def test_freshness_levels(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string").withColumn("t", F.col("t").cast("timestamp"))
    level = lambda at: quality.freshness(df, "t", 360, 1440, at).first()["status"]
    assert [level(f"2024-01-{d} {h}") for d, h in (("01", "06:00:00"), ("01", "06:01:00"), ("02", "00:01:00"))] == ["ok", "warn", "error"]
    assert quality.freshness(df.limit(0), "t", 360).first()["status"] == "error"


def test_raise_mode_fails_on_a_bad_row(spark):
    df = spark.createDataFrame([(1,), (-1,)], "v int")
    valid, _ = quality.split_valid(df, {"negative": F.col("v") < 0}, mode="raise")
    with pytest.raises(Exception, match="negative"):
        valid.collect()


def test_unknown_check_is_not_a_violation(spark):
    df = spark.createDataFrame([(None, 1), (3, 2), (3, 2)], "v int, k int")
    got = {r["constraint"]: r["violations"] for r in quality.check_constraints(df, ["k"], {"small": F.col("v") < 3}).collect()}
    assert got == {"primary_key_not_null": 0, "small": 2, "primary_key_unique": 1}


# ---- messages ----
def parse(spark, fn, *lines):
    return fn(spark.createDataFrame([(t,) for t in lines], "text string")).collect()


def test_log_messages(spark):
    compact, keyed, short, unknown = parse(
        spark, messages.parse_log_messages, "/log skate 7 8 4 good dry  session",
        "/log activity=gym intensity=7 mood=8 fatigue=4 result=ok pain=YES loc=old_hall notes=two_words", "/log skate 7", "/log skate 7 8 0 good",
    )
    assert (compact["activity_type"], compact["notes"], compact["error"]) == ("skate", "dry  session", None)
    assert (keyed["pain_flag"], keyed["location_label"], keyed["notes"], keyed["error"]) == (True, "old hall", "two words", None)
    assert short["error"].startswith("use: /log")
    assert unknown["error"] == "fatigue must be an integer from 1 to 10"


def test_capture_messages(spark):
    sleep_row, pain, moto, bad, empty = parse(
        spark, messages.parse_capture_messages, "/sleep 7:30 quality=82", "/pain 0 fine", "/moto 6 bad slow bad turns", "/mood great", "/sleep",
    )
    assert (sleep_row["value"], sleep_row["unit"], sleep_row["payload"][0]["v"]) == (450, "minutes", "82")
    assert (pain["value"], pain["pain_flag"], pain["note"]) == (0, False, "fine")
    assert (moto["result"], moto["note"], moto["value"]) == ("bad", "slow bad turns", 6)
    assert bad["error"] == "mood must be an integer from 1 to 10"
    assert (empty["value"], empty["error"]) == (None, None)


def test_feedback_messages(spark):
    rows = parse(
        spark, messages.parse_feedback, "/done skate", "/skip walk rain today", "/feedback gym changed ok long_note here",
        "fb:done:skate:bad", "fb:undo:skate", "/done chess", "hello", "/feedback gym loved",
    )
    got = [(r["activity"], r["action"], r["result"], r["note"]) for r in rows[:4]]
    assert got == [("skate", "followed", "good", ""), ("walk", "skipped", "skipped", "rain"),
                   ("gym", "changed", "ok", "long note here"), ("skate", "followed", "bad", "telegram button")]
    assert [r["error"] for r in rows] == [None, None, None, None, "unknown callback action", "unknown activity",
                                          "use: /done, /skip, or /feedback", "unknown feedback action"]


# ---- sources ----
def test_json_lines_documents(spark):
    df = spark.createDataFrame([('{"a":1}\n{"a":2}\n',), ('[{"a":3}]',), ('{\n"events": [{"a":4}]\n}',)], "t string")
    rows = files.explode_json_rows(df, "t", files.SUBSCRIPTION_ROW_KEYS, allow_json_lines=True)
    assert sorted(r["row_json"] for r in rows.collect()) == ['{"a":1}', '{"a":2}', '{"a":3}', '{"a":4}']


def test_inbox_scan_by_name_and_keys(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    contents = {
        "deep/sleep_log.json": "[]", "a.ics": "BEGIN:VCALENDAR", "unknown.json": '{"rows":[{"Symbol_Bucket":1,"volatility_bucket":2}]}',
        "other.json": '{"x": 1}', "photo.jpg": "x", "todo.csv": "a,b",
    }
    for name, body in contents.items():
        (tmp_path / name).write_text(body)
    got = {r["path"].rsplit("/", 1)[1]: r["kind"] for r in inbox.scan_inbox(spark, str(tmp_path)).collect()}
    assert got == {"sleep_log.json": "sleep", "a.ics": "ics", "unknown.json": "market_watchlist_snapshot", "todo.csv": "tasks_and_projects"}


def test_lenient_json_lines_keep_corrupt_for_counting(spark, tmp_path):
    from contextlake.schemas import RUNTIME_LOG

    path = tmp_path / "log.jsonl"
    path.write_text('{"component":"a","status":"ok"}\n\n{broken\n{"component":"b","status":"failed"}\n')
    kept = files.read_jsonl_lenient(spark, str(path), RUNTIME_LOG)
    assert sorted(r["component"] for r in kept.collect()) == ["a", "b"]
    assert files.read_jsonl_lenient(spark, str(path), RUNTIME_LOG, keep_corrupt=True).count() == 3
    assert files.read_jsonl_lenient(spark, str(path), RUNTIME_LOG, {"status": "failed"}).count() == 1


def test_week_summary_lists_are_ordered(spark):
    data = [(1, "gym", "ok", 5, 5, 5, False, "2024-01-02 00:00:00")] * 2 + [(1, "walk", "bad", 5, 5, 5, True, "2024-01-02 00:00:00")]
    ddl = "user_id int, activity_type string, result string, intensity int, mood int, fatigue int, pain_flag boolean, logged_at string"
    df = spark.createDataFrame(data, ddl).withColumn("logged_at", F.col("logged_at").cast("timestamp"))
    row = rollups.week_summary(df, "user_id", "2024-01-03 00:00:00").first()
    assert [(a["activity_type"], a["sessions"]) for a in row["by_activity"]] == [("gym", 2), ("walk", 1)]
    assert (row["sessions"], row["pain_sessions"], row["avg_mood"]) == (3, 1, 5.0)
