"""Rule engines against plain Python on random rows, and their stated cases."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from contextlake.operators import profile, rules

HOUR = (
    "location_id string, forecast_time timestamp, temperature_c double, precipitation_mm double, rain_mm double,"
    " snowfall_cm double, snow_depth_cm double, wind_speed_kmh double, wind_gust_kmh double, visibility_m double, is_day boolean"
)


def hours(spark, location, values, n=4, is_day=True, start=8):
    base = dict(t=15.0, p=0.0, r=0.0, s=0.0, d=0.0, g=10.0, v=10000.0)
    base.update(values)
    data = [
        (location, f"2024-01-01 {start + i:02d}:00:00", base["t"], base["p"], base["r"], base["s"], base["d"], 5.0,
         base["g"], base["v"], is_day)
        for i in range(n)
    ]
    text = HOUR.replace("forecast_time timestamp", "forecast_time string")
    return spark.createDataFrame(data, text).withColumn("forecast_time", F.col("forecast_time").cast("timestamp"))


def scores(df):
    return {(r["location_id"], r["activity"]): r for r in df.collect()}


def test_clear_rain_and_snow_days(spark):
    weather = (
        hours(spark, "clear", {})
        .union(hours(spark, "rain", {"p": 0.5, "r": 0.5, "t": 8.0}))
        .union(hours(spark, "snow", {"t": -5.0, "d": 30.0, "s": 2.0}))
    )
    got = scores(rules.readiness_scores(weather))
    assert got["clear", "skate"]["score"] == 100
    assert got["clear", "skate"]["explanation"] == "conditions look usable"
    assert got["rain", "skate"]["score"] == 55
    assert got["rain", "skate"]["explanation"] == "wet pavement risk"
    assert got["snow", "snowboard"]["score"] == 75
    assert got["snow", "snowboard"]["decision"] == "go"
    assert got["clear", "volleyball"]["explanation"] == "indoor session is mostly readiness-driven"


def test_thresholds_are_configurable(spark):
    weather = hours(spark, "a", {"g": 38.0})
    relaxed = scores(rules.readiness_scores(weather, scoring={"skate": {"max_wind_gust_kmh": 60}}))
    assert relaxed["a", "skate"]["score"] == 100
    assert scores(rules.readiness_scores(weather))["a", "skate"]["score"] == 80


def test_night_counts_only_without_daylight(spark):
    night = hours(spark, "dark", {"t": -3.0}, n=12, is_day=False, start=0)
    mixed = hours(spark, "mixed", {"t": -30.0}, n=9, is_day=False, start=0).union(hours(spark, "mixed", {}, n=3, start=10))
    window = rules.daylight_window(night.union(mixed))
    counts = {r["location_id"]: r["count"] for r in window.groupBy("location_id").count().collect()}
    assert counts == {"dark": 8, "mixed": 3}
    got = scores(rules.readiness_scores(night.union(mixed)))
    assert got["mixed", "skate"]["score"] == 100
    assert got["dark", "skate"]["score"] == 75


def plain_recommendation(row, goals, priorities):
    """The rule table restated as ordinary arithmetic."""
    high = row["activity"] in rules.HIGH_IMPACT_ACTIVITIES
    team = high or row["activity"] == "volleyball"
    rec = row["latest_recovery"] or row["avg_recovery"]
    sleep = row["latest_minutes"] or row["avg_minutes"]
    goal, done = goals.get(row["activity"], 0), row["done"]
    steps = [
        (row["fatigue"] >= 7, -20),
        (row["pain"] > 0, -15),
        (0 < row["mood"] <= 4, -10),
        (row["sessions"] == 0 and row["activity"] in ("walk", "volleyball"), 5),
        (row["sessions"] >= 5 and high, -10),
        (0 < rec < 65 and team, -15),
        (0 < sleep < 390 and high, -10),
        (rec >= 75 and row["activity"] in ("walk", "gym"), 3),
        (goal > 0 and done < goal, min(10, 7 + max(0, goal - done - 1) * 2)),
        (priorities.get(row["activity"], 0) >= 8 and row["activity"] in goals, 3),
        (row["events"] >= 2 and row["rate"] >= 0.7, 8),
        (row["good"] >= 2 and row["good"] > row["bad"], 5),
        (row["events"] >= 2 and row["rate"] <= 0.35, -8),
        (row["bad"] >= 1 and row["bad"] >= row["good"], -7),
        (row["skipped"] >= 2 and row["decision"] == "go", -5),
    ]
    score = max(0, min(100, row["score"] + sum(delta for hit, delta in steps if hit)))
    if row["pain"] > 0 or row["fatigue"] >= 8 or 0 < rec < 55:
        decision = "recover" if score < 75 else "caution"
    elif 0 < rec < 65 and team:
        decision = "caution" if score >= 50 else "recover"
    else:
        decision = "go" if score >= 75 else "caution" if score >= 50 else "recover"
    return score, decision


def test_recommendations_equal_plain_rules_on_random_people(spark):
    rng = random.Random(7)
    people = []
    for user in range(400):
        people.append(
            dict(
                user_id=user, activity=rng.choice(["skate", "snowboard", "moto_lesson", "volleyball", "walk", "gym"]),
                score=rng.randint(0, 100), sessions=rng.randint(0, 7), fatigue=float(rng.randint(0, 10)),
                mood=float(rng.randint(0, 10)), pain=rng.choice([0, 0, 0, 1]), done=rng.randint(0, 3),
                events=rng.randint(0, 4), rate=rng.choice([0.0, 0.35, 0.5, 0.7, 1.0]), good=rng.randint(0, 3),
                bad=rng.randint(0, 3), skipped=rng.randint(0, 3), latest_recovery=rng.choice([0, 50, 60, 64, 65, 80]),
                avg_recovery=float(rng.choice([0, 58, 90])), latest_minutes=rng.choice([0, 300, 389, 390, 480]),
                avg_minutes=float(rng.choice([0, 350])),
            )
        )
    for p in people:
        p["decision"] = "go" if p["score"] >= 75 else "caution" if p["score"] >= 50 else "skip"
    df = spark.createDataFrame(people)
    counts = df.select("user_id", "activity", F.col("done").alias("sessions"))
    week = df.select("user_id", "sessions", F.col("fatigue").alias("avg_fatigue"), F.col("mood").alias("avg_mood"),
                     F.col("pain").alias("pain_sessions"))
    feedback = df.select("user_id", "activity", F.col("events").alias("feedback_events"), F.col("rate").alias("follow_rate"),
                         F.col("good").alias("good_results"), F.col("bad").alias("bad_results"),
                         F.col("skipped").alias("skipped_events"))
    recovery = df.select("user_id", F.col("latest_recovery").alias("latest_recovery_score"),
                         F.col("avg_recovery").alias("avg_recovery_score"),
                         F.col("latest_minutes").alias("latest_duration_minutes"),
                         F.col("avg_minutes").alias("avg_duration_minutes"))
    base = df.select("user_id", "activity", F.lit("loc").alias("location_id"), "score", "decision", F.lit("ok").alias("explanation"))
    got = {r["user_id"]: (r["score"], r["decision"]) for r in rules.recommend(base, week, counts, feedback, recovery).collect()}
    want = {p["user_id"]: plain_recommendation(p, rules.WEEKLY_GOALS, rules.PRIORITIES) for p in people}
    assert got == want


def test_missing_context_counts_as_zero(spark):
    base = spark.createDataFrame(
        [(1, "volleyball", "b", 80, "go", "ok"), (1, "volleyball", "a", 80, "go", "ok")],
        "user_id int, activity string, location_id string, score int, decision string, explanation string",
    )
    none = lambda ddl: spark.createDataFrame([], ddl)
    got = rules.recommend(
        base,
        none("user_id int, sessions int, avg_fatigue double, avg_mood double, pain_sessions int"),
        none("user_id int, activity string, sessions int"),
        none("user_id int, activity string, feedback_events int, follow_rate double, good_results int, bad_results int, skipped_events int"),
        goals={},
    ).collect()
    assert [(r["location_id"], r["score"]) for r in got] == [("a", 85)]
    assert got[0]["reasons"] == "ok, no sessions logged this week"


@pytest.mark.parametrize(
    "decision, score, fatigue, pain, rate, goals, recovery, expected",
    [
        (None, None, 0, 0, 0.0, 0, 0, "needs_data"),
        ("go", 90, 8, 0, 0.0, 1, 0, "recovery_first"),
        ("go", 90, 0, 0, 0.0, 1, 54, "recovery_first"),
        ("recover", 90, 0, 0, 0.0, 1, 0, "recovery_first"),
        ("go", 80, 0, 0, 0.9, 1, 0, "act_on_open_goal"),
        ("go", 79, 0, 0, 0.7, 1, 0, "trusted_go"),
        ("go", 79, 0, 0, 0.6, 1, 0, "good_window"),
        ("caution", 60, 0, 0, 0.9, 1, 0, "caution_window"),
    ],
)
def test_readiness_state(spark, decision, score, fatigue, pain, rate, goals, recovery, expected):
    values = [F.lit(v) for v in (decision, score, fatigue, pain, rate, goals, recovery)]
    d, s, f, p, r, g, rec = values
    state = profile.readiness_state(d.isNotNull(), d, s, f, p, r, g, rec)
    assert spark.range(1).select(state).first()[0] == expected


# ---- Avro records, without the Avro package ----
def test_avro_schema_gives_the_type_and_json_of_a_record(spark):
    from contextlake.functions.wire import avro_type, record_json

    schema = {
        "type": "record", "name": "Order",
        "fields": [
            {"name": "id", "type": "long"},
            {"name": "amount", "type": {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 2}},
            {"name": "raw", "type": ["null", "bytes"]},
            {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
            {"name": "tags", "type": {"type": "array", "items": {"type": "enum", "name": "Tag", "symbols": ["A"]}}},
            {"name": "by", "type": {"type": "map", "values": ["null", "Tag"]}},
        ],
    }
    dtype = avro_type(schema)
    assert dtype.simpleString() == (
        "struct<id:bigint,amount:decimal(12,2),raw:binary,at:timestamp,tags:array<string>,by:map<string,string>>"
    )
    df = spark.range(1).selectExpr(
        "named_struct('id', id, 'amount', cast(1.5 as decimal(12,2)), 'raw', X'0aFF', 'at', timestamp'2024-01-01 00:00:00',"
        " 'tags', array('A'), 'by', map('k', 'A')) AS r",
        f"cast(named_struct('id', null, 'amount', null, 'raw', null, 'at', null, 'tags', null, 'by', null) AS {dtype.simpleString()}) AS nothing",
    )
    row = df.select(record_json(F.col("r"), schema).alias("a"), record_json(F.col("nothing"), schema).alias("b")).first()
    assert row["a"] == '{"id":0,"amount":"1.50","raw":"0aff","at":"2024-01-01T00:00:00.000Z","tags":["A"],"by":{"k":"A"}}'
    assert row["b"] is None
