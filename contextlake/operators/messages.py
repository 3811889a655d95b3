"""Chat messages to rows: diary entries, quick captures, feedback and source commands.

A message that breaks a rule is kept with ``error`` set, so callers split a
batch into rows and a quarantine instead of failing on the first bad message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import bounded_int, duration_minutes, strict_int
from ..functions.text import (
    col,
    key_values,
    plain_words,
    strip,
    tokens,
    value_of,
)
from ..functions.urls import SOURCE_TYPES
from ..schemas import ACTIVITY_RESULTS, ACTIVITY_TYPES, FEEDBACK_ACTIONS

# ---- fixed values: words read as yes ----
YES_WORDS = ("1", "yes", "true", "y", "pain")

ACTIVITY_COLUMNS = (
    "activity_type", "start_time", "end_time", "location_label", "intensity", "mood", "fatigue",
    "pain_flag", "pain_text", "result", "notes",
)


def _spaces(value: Column) -> Column:
    return F.replace(value, F.lit("_"), F.lit(" "))


def _rest(text: Column, skipped: int) -> Column:
    """Text after the first ``skipped`` tokens, inner spacing kept."""
    return F.regexp_extract(text, rf"(?s)^(?:\S+\s+){{{skipped}}}(.*)$", 1)


def _is_yes(value: Column) -> Column:
    return F.coalesce(F.lower(value).isin(*YES_WORDS), F.lit(False))


def first_error(*checks: tuple[Column, str]) -> Column:
    """Message of the first failing check, null when all pass."""
    result = F.lit(None).cast("string")
    for broken, message in reversed(checks):
        result = F.when(F.coalesce(broken, F.lit(False)), F.lit(message)).otherwise(result)
    return result


def activity_checks() -> Column:
    scores = [
        (F.col(c).isNull(), f"{c} must be an integer from 1 to 10")
        for c in ("intensity", "mood", "fatigue")
    ]
    return first_error(
        (~F.coalesce(F.col("activity_type").isin(*ACTIVITY_TYPES), F.lit(False)), "unknown activity"),
        (~F.coalesce(F.col("result").isin(*ACTIVITY_RESULTS), F.lit(False)), "unknown result"),
        *scores,
    )


def parse_log_messages(df: DataFrame, text: str = "text") -> DataFrame:
    """``/log`` messages, compact or ``key=value``, to diary rows with ``error``."""
    body = strip(col(text))
    parts = tokens(body)
    staged = df.withColumns({"_text": body, "_parts": parts, "_pairs": key_values(parts, False)})
    part = lambda i: F.get(F.col("_parts"), F.lit(i))
    pairs = F.col("_pairs")
    keyed = F.contains(F.coalesce(part(1), F.lit("")), F.lit("="))

    def either(key: str, index: int) -> Column:
        return F.when(keyed, value_of(pairs, key)).otherwise(part(index))

    def keyed_only(value: Column) -> Column:
        return F.when(keyed, value)

    missing = F.array_compact(
        F.array(
            *[
                F.when(value_of(pairs, k).isNull(), F.lit(k))
                for k in ("activity", "intensity", "mood", "fatigue", "result")
            ]
        )
    )
    location = F.coalesce(value_of(pairs, "loc"), value_of(pairs, "location"))
    pain = F.coalesce(value_of(pairs, "pain"), value_of(pairs, "pain_flag"))
    staged = staged.withColumns(
        {
            "_intensity": either("intensity", 2),
            "_mood": either("mood", 3),
            "_fatigue": either("fatigue", 4),
            "_missing": F.size(missing),
            "_location": location,
            "_pain_text": value_of(pairs, "pain_text"),
        }
    )
    rows = staged.select(
        *df.columns,
        either("activity", 1).alias("activity_type"),
        keyed_only(value_of(pairs, "start")).alias("start_time"),
        keyed_only(value_of(pairs, "end")).alias("end_time"),
        keyed_only(_spaces(F.nullif("_location", F.lit("")))).alias("location_label"),
        bounded_int("_intensity", 1, 10).alias("intensity"),
        bounded_int("_mood", 1, 10).alias("mood"),
        bounded_int("_fatigue", 1, 10).alias("fatigue"),
        (keyed & _is_yes(pain)).alias("pain_flag"),
        keyed_only(_spaces(F.nullif("_pain_text", F.lit("")))).alias("pain_text"),
        either("result", 5).alias("result"),
        F.when(keyed, _spaces(F.coalesce(value_of(pairs, "notes"), F.lit(""))))
        .otherwise(_rest(F.col("_text"), 6))
        .alias("notes"),
        first_error(
            ((F.size("_parts") < 6) | (part(0) != "/log"), "use: /log activity intensity mood fatigue result notes"),
            (keyed & (F.col("_missing") > 0), "missing /log fields"),
        ).alias("_shape_error"),
    )
    return rows.withColumn("error", F.coalesce("_shape_error", activity_checks())).drop("_shape_error")


# ---- fixed values: command -> (domain, capture type) ----
CAPTURES = {
    "/sleep": ("recovery", "sleep"),
    "/mood": ("wellbeing", "mood"),
    "/pain": ("wellbeing", "pain"),
    "/plan": ("planning", "plan"),
    "/moto": ("activity", "activity"),
    "/trade": ("market", "trade_note"),
    "/note": ("personal", "note"),
}


def parse_capture_messages(df: DataFrame, text: str = "text") -> DataFrame:
    """Quick capture commands to (command, domain, type, value, unit, …, payload, error)."""
    parts = tokens(col(text))
    after = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    staged = df.withColumns(
        {
            "_command": F.get(parts, F.lit(0)),
            "_pairs": key_values(after),
            "_words": plain_words(after),
        }
    )
    command, pairs, words = F.col("_command"), F.col("_pairs"), F.col("_words")
    given = lambda key: F.nullif(value_of(pairs, key), F.lit(""))
    staged = staged.withColumns(
        {
            "_first": F.get(words, F.lit(0)),
            "_rest": F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
            "_minutes": value_of(pairs, "minutes"),
            "_stated": F.coalesce(
                F.get(F.filter(words, lambda w: w.isin(*ACTIVITY_RESULTS)), F.lit(0)), given("result"), F.lit("ok")
            ),
            "_pain_word": value_of(pairs, "pain"),
            "_mood_text": F.coalesce(given("mood"), F.get(words, F.lit(0))),
            "_pain_score": F.coalesce(given("pain"), F.get(words, F.lit(0))),
            "_intensity_text": F.coalesce(given("intensity"), F.get(words, F.lit(0))),
        }
    )
    first, rest_words, stated = F.col("_first"), F.col("_rest"), F.col("_stated")
    minutes = strict_int("_minutes")
    staged = staged.withColumns(
        {
            "_sleep": F.when(F.size(words) > 0, duration_minutes(first)).otherwise(F.when(minutes > 0, minutes)),
            "_mood": bounded_int("_mood_text", 1, 10),
            "_pain": bounded_int("_pain_score", 0, 10),
            "_intensity": bounded_int("_intensity_text", 1, 10),
            "_moto_words": F.when(strict_int(first).isNotNull(), rest_words).otherwise(words),
        }
    ).withColumn("_at", F.array_position("_moto_words", stated).cast("int"))
    sleep, mood, pain, intensity = (F.col(c) for c in ("_sleep", "_mood", "_pain", "_intensity"))
    moto_words, at = F.col("_moto_words"), F.col("_at")
    moto_note = F.when(
        at > 0,
        F.concat(
            F.slice(moto_words, F.lit(1), at - 1),
            F.slice(moto_words, at + 1, F.greatest(F.size(moto_words) - at, F.lit(0))),
        ),
    ).otherwise(moto_words)
    is_ = lambda name: command == name
    value = F.when(is_("/sleep"), sleep).when(is_("/mood"), mood).when(is_("/pain"), pain).when(
        is_("/moto"), intensity
    )
    domain, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (d, k) in CAPTURES.items():
        domain = F.when(is_(name), d).otherwise(domain)
        kind = F.when(is_(name), k).otherwise(kind)
    note_words = (
        F.when(command.isin("/sleep", "/mood", "/pain"), rest_words)
        .when(is_("/moto"), moto_note)
        .otherwise(words)
    )
    sleep_given = (F.size(words) > 0) | F.col("_minutes").isNotNull()
    return staged.select(
        *df.columns,
        command.alias("command"),
        domain.alias("domain"),
        kind.alias("capture_type"),
        value.alias("value"),
        F.when(is_("/sleep") & sleep.isNotNull(), "minutes")
        .when(is_("/mood"), "score_1_10")
        .when(is_("/pain"), "score_0_10")
        .when(is_("/moto") & intensity.isNotNull(), "intensity_1_10")
        .alias("unit"),
        F.when(is_("/moto"), "moto_lesson").alias("activity_type"),
        F.when(is_("/moto"), F.when(stated.isin(*ACTIVITY_RESULTS), stated).otherwise("ok")).alias("result"),
        F.coalesce(
            F.when(is_("/pain"), pain > 0).when(is_("/moto"), _is_yes(F.col("_pain_word"))), F.lit(False)
        ).alias("pain_flag"),
        F.concat_ws(" ", note_words).alias("note"),
        pairs.alias("payload"),
        first_error(
            (~F.coalesce(command.isin(*CAPTURES), F.lit(False)), "unsupported capture command"),
            (is_("/sleep") & sleep_given & sleep.isNull(), "sleep duration must be positive"),
            (is_("/mood") & mood.isNull(), "mood must be an integer from 1 to 10"),
            (is_("/pain") & pain.isNull(), "pain must be an integer from 0 to 10"),
        ).alias("error"),
    )


def capture_activities(captures: DataFrame) -> DataFrame:
    """Diary rows of lesson captures, with 5 for scores that were not given."""
    pairs = F.col("payload")
    used = set(ACTIVITY_COLUMNS) | {"command", "domain", "capture_type", "value", "unit", "note", "payload", "error"}
    lessons = captures.filter(F.col("error").isNull() & (F.col("activity_type") == "moto_lesson"))
    staged = lessons.withColumns(
        {
            "_mood": F.coalesce(value_of(pairs, "mood"), F.lit("5")),
            "_fatigue": F.coalesce(value_of(pairs, "fatigue"), F.lit("5")),
            "_location": F.coalesce(value_of(pairs, "loc"), value_of(pairs, "location")),
            "_pain_text": value_of(pairs, "pain_text"),
        }
    )
    rows = staged.select(
        *[c for c in captures.columns if c not in used],
        "activity_type",
        F.lit(None).cast("string").alias("start_time"),
        F.lit(None).cast("string").alias("end_time"),
        F.nullif("_location", F.lit("")).alias("location_label"),
        F.coalesce("value", F.lit(5)).alias("intensity"),
        bounded_int("_mood", 1, 10).alias("mood"),
        bounded_int("_fatigue", 1, 10).alias("fatigue"),
        "pain_flag",
        F.nullif("_pain_text", F.lit("")).alias("pain_text"),
        F.coalesce("result", F.lit("ok")).alias("result"),
        F.col("note").alias("notes"),
    )
    return rows.withColumn("error", activity_checks())


def capture_ack(df: DataFrame) -> Column:
    value = F.when(
        F.col("value").isNotNull(),
        F.concat(
            F.lit(" "), F.col("value").cast("string"),
            F.when(F.col("unit").isNotNull(), F.concat(F.lit(" "), "unit")).otherwise(""),
        ),
    ).otherwise("")
    note = F.when(F.col("note") != "", F.concat(F.lit(": "), "note")).otherwise("")
    return F.concat(F.lit("Captured "), "capture_type", value, note, F.lit("."))


def parse_feedback(df: DataFrame, text: str = "text", callback_prefix: str = "fb") -> DataFrame:
    """``/done``, ``/skip``, ``/feedback`` and button callbacks to feedback rows with ``error``."""
    body = strip(col(text))
    parts = tokens(body)
    staged = df.withColumns({"_text": body, "_parts": parts, "_fields": F.split(body, ":", 4)})
    part = lambda i: F.get(F.col("_parts"), F.lit(i))
    field = lambda i: F.get(F.col("_fields"), F.lit(i))
    size, command = F.size("_parts"), part(0)
    known = lambda c: F.when(c.isin(*ACTIVITY_RESULTS), c)
    callback = F.startswith(F.col("_text"), F.lit(f"{callback_prefix}:"))
    done, skip, feedback = (command == c for c in ("/done", "/skip", "/feedback"))
    button = "telegram button"
    rows = staged.select(
        *df.columns,
        F.when(callback, field(2)).otherwise(part(1)).alias("activity"),
        F.when(callback, F.when(field(1) == "done", "followed").when(field(1) == "skip", "skipped"))
        .when(done, "followed")
        .when(skip, "skipped")
        .when(feedback, part(2))
        .alias("action"),
        F.when(
            callback,
            F.when(field(1) == "done", F.coalesce(known(field(3)), F.lit("good"))).otherwise("skipped"),
        )
        .when(done, F.coalesce(known(part(2)), F.lit("good")))
        .when(skip, "skipped")
        .when(feedback, known(part(3)))
        .alias("result"),
        _spaces(
            F.coalesce(
                F.when(callback, F.lit(button))
                .when(done, part(3))
                .when(skip, part(2))
                .when(feedback, _rest(F.col("_text"), 4)),
                F.lit(""),
            )
        ).alias("note"),
        first_error(
            (callback & (F.size("_fields") < 3), "unknown callback"),
            (callback & ~field(1).isin("done", "skip"), "unknown callback action"),
            (~callback & ~F.coalesce(command.isin("/done", "/skip", "/feedback"), F.lit(False)),
             "use: /done, /skip, or /feedback"),
            (~callback & command.isin("/done", "/skip") & (size < 2), "activity is missing"),
            (~callback & (command == "/feedback") & (size < 3), "action is missing"),
        ).alias("_shape_error"),
    )
    content = first_error(
        (~F.coalesce(F.col("activity").isin(*ACTIVITY_TYPES), F.lit(False)), "unknown activity"),
        (~F.coalesce(F.col("action").isin(*FEEDBACK_ACTIONS), F.lit(False)), "unknown feedback action"),
    )
    return rows.withColumn("error", F.coalesce("_shape_error", content)).drop("_shape_error")


def parse_source_commands(df: DataFrame, text: str = "text") -> DataFrame:
    """``/source_add [type] <url> key=value… tag…`` to subscription requests with ``error``."""
    parts = tokens(col(text))
    typed = F.get(parts, F.lit(1)).isin(*SOURCE_TYPES, "auto")
    staged = df.withColumns(
        {"_parts": parts, "_skip": F.when(F.coalesce(typed, F.lit(False)), 2).otherwise(1)}
    )
    after = F.slice(
        F.col("_parts"), F.col("_skip") + 2, F.greatest(F.size("_parts") - F.col("_skip") - 1, F.lit(0))
    )
    pairs, words = key_values(after), plain_words(after)
    listed = F.transform(F.split(F.coalesce(value_of(pairs, "tags"), F.lit("")), ","), strip)
    take = lambda key, default: F.coalesce(value_of(pairs, key), F.lit(default))
    return staged.select(
        *df.columns,
        F.when(F.col("_skip") == 2, F.get("_parts", F.lit(1))).otherwise("auto").alias("source_type"),
        F.get("_parts", F.col("_skip")).alias("reference"),
        take("label", "").alias("label"),
        take("domain", "").alias("domain"),
        F.filter(F.concat(words, listed), lambda t: t != "").alias("tags"),
        take("cadence", "manual").alias("cadence"),
        take("privacy", "public_context").alias("privacy_class"),
        first_error(
            (F.coalesce(F.get("_parts", F.lit(0)) != "/source_add", F.lit(True)), "not a /source_add command"),
            (F.size("_parts") <= F.col("_skip"), "source URL is missing"),
        ).alias("error"),
    )
