"""Data quality: expectation suites, keys, references, columns, freshness, landing rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_tools import (
    FORBIDDEN_LANDING_KEYS,
    FORBIDDEN_MARKERS,
    has_forbidden_key,
    is_json_object,
)
from ..functions.text import col, strip
from ..functions.times import AsOf, age_minutes
from ..schemas import (
    ACTIVITY_RESULTS,
    ACTIVITY_TYPES,
    FEEDBACK_ACTIONS,
    LAKE_VERSION,
    READINESS_DECISIONS,
    RECOMMENDATION_DECISIONS,
    SIGNAL_DIRECTIONS,
    SIGNAL_DOMAINS,
)
from ..session import broadcast_if_small


# ---- predicates ----
def blank(c: str) -> Column:
    return strip(F.col(c)) == ""


def outside(c: str, low: float, high: float) -> Column:
    return ~F.col(c).between(low, high)


def not_in(c: str, values: Sequence[str]) -> Column:
    return ~F.col(c).isin(*values)


def any_of(*conditions: Column) -> Column:
    """OR that treats an unknown condition as false, as a WHERE clause does."""
    result = F.coalesce(conditions[0], F.lit(False))
    for condition in conditions[1:]:
        result = result | F.coalesce(condition, F.lit(False))
    return result


# ---- expectation suites ----
@dataclass(frozen=True)
class Expectation:
    """One rule over one dataset.

    ``violations`` counts rows matching ``predicate`` (expected 0); ``row_count``
    compares the number of rows with ``threshold``; ``freshness`` compares the
    age of the newest ``predicate`` timestamp with ``threshold`` minutes.
    """

    id: str
    dataset: str
    kind: Literal["violations", "row_count", "freshness"]
    predicate: Column | None = None
    operator: Literal["gt", "ge"] = "gt"
    threshold: float = 0
    severity: Literal["error", "warning"] = "error"


def run_expectations(
    tables: Mapping[str, DataFrame], suite: Sequence[Expectation], as_of: AsOf = None
) -> DataFrame:
    """Result rows (id, dataset, severity, observed, passed).

    All rules of a dataset share one aggregation, so a suite scans every table
    once, whatever the number of rules.
    """
    results: list[DataFrame] = []
    for dataset, df in tables.items():
        rules = [e for e in suite if e.dataset == dataset]
        if not rules:
            continue
        measures = []
        for i, rule in enumerate(rules):
            if rule.kind == "violations":
                measure = F.count_if(rule.predicate)
            elif rule.kind == "row_count":
                measure = F.count(F.lit(1))
            else:
                measure = age_minutes(F.max(rule.predicate), as_of)
            measures.append(measure.cast("double").alias(f"m{i}"))
        one_row = df.agg(*measures)
        entries = []
        for i, rule in enumerate(rules):
            observed = F.col(f"m{i}")
            if rule.kind == "violations":
                passed = observed == 0
            elif rule.kind == "row_count":
                passed = observed > rule.threshold if rule.operator == "gt" else observed >= rule.threshold
            else:
                passed = observed <= rule.threshold
            entries.append(
                F.struct(
                    F.lit(rule.id).alias("id"),
                    F.lit(dataset).alias("dataset"),
                    F.lit(rule.severity).alias("severity"),
                    observed.alias("observed"),
                    F.coalesce(passed, F.lit(False)).alias("passed"),
                )
            )
        results.append(one_row.select(F.inline(F.array(*entries))))
    result = results[0]
    for part in results[1:]:
        result = result.unionByName(part)
    return result


def core_suite() -> list[Expectation]:
    """The standing checks over the personal tables."""
    v = lambda i, d, *p, **k: Expectation(i, d, "violations", any_of(*p), **k)
    fresh = lambda i, d, c: Expectation(
        i, d, "freshness", F.col(c), threshold=360, severity="warning"
    )
    return [
        Expectation("spots_have_rows", "spots", "row_count"),
        v("spots_have_valid_coordinates", "spots", *bad_coordinates()),
        v("spots_have_labels", "spots", F.col("label").isNull(), blank("label")),
        v("diary_scores_in_range", "activity", *bad_diary_scores()),
        v("diary_known_types", "activity", not_in("activity_type", ACTIVITY_TYPES)),
        v("diary_known_results", "activity", not_in("result", ACTIVITY_RESULTS)),
        Expectation("weather_has_rows", "weather", "row_count"),
        fresh("weather_has_recent_fetch", "weather", "fetched_at"),
        v("weather_values_are_reasonable", "weather", *bad_weather()),
        Expectation("readiness_has_rows", "scores", "row_count"),
        fresh("readiness_has_recent_compute", "scores", "computed_at"),
        v("readiness_scores_are_valid", "scores", *bad_readiness()),
        Expectation("recommendations_have_rows", "recommendations", "row_count"),
        fresh("recommendations_have_recent_compute", "recommendations", "generated_at"),
        v("recommendations_are_valid", "recommendations", *bad_recommendations()),
        Expectation("feedback_rows", "feedback", "row_count", operator="ge"),
        v("feedback_actions_are_valid", "feedback", *bad_feedback()),
        Expectation("signal_rows", "signals", "row_count", operator="ge"),
        v("context_signals_are_valid", "signals", *bad_signals()),
        Expectation("profiles_have_rows", "profiles", "row_count"),
        v("profiles_are_valid", "profiles", *bad_profiles()),
    ]


def bad_coordinates() -> list[Column]:
    return [outside("latitude", -90, 90), outside("longitude", -180, 180)]


def bad_diary_scores() -> list[Column]:
    return [outside(c, 1, 10) for c in ("intensity", "mood", "fatigue")]


def bad_weather() -> list[Column]:
    negative = [F.col(c) < 0 for c in ("precipitation_mm", "wind_speed_kmh", "wind_gust_kmh")]
    return [outside("temperature_c", -60, 45), *negative]


def bad_readiness() -> list[Column]:
    return [outside("score", 0, 100), not_in("decision", READINESS_DECISIONS), blank("explanation")]


def bad_recommendations() -> list[Column]:
    return [
        outside("score", 0, 100),
        not_in("decision", RECOMMENDATION_DECISIONS),
        F.col("reasons").isNull(),
        blank("reasons"),
    ]


def bad_feedback() -> list[Column]:
    return [
        not_in("action", FEEDBACK_ACTIONS),
        F.col("result").isNotNull() & not_in("result", ACTIVITY_RESULTS),
    ]


def bad_signals() -> list[Column]:
    return [
        not_in("domain", SIGNAL_DOMAINS),
        not_in("direction", SIGNAL_DIRECTIONS),
        outside("urgency", 1, 10),
        outside("confidence", 1, 100),
        blank("title"),
    ]


def bad_profiles() -> list[Column]:
    return [
        outside("top_score", 0, 100),
        not_in("top_decision", RECOMMENDATION_DECISIONS),
        F.col("sessions_7d") < 0,
        outside("avg_mood_7d", 0, 10),
        outside("avg_fatigue_7d", 0, 10),
        outside("useful_decision_days_7d", 0, 7),
        outside("follow_rate_7d", 0, 1),
        outside("highest_signal_urgency", 0, 10),
        blank("context_summary"),
    ]


def violation_counters(df: DataFrame, checks: Mapping[str, Sequence[Column]]) -> DataFrame:
    """(check_name, observed_value) rows from one pass over a table."""
    measures = [F.count_if(any_of(*p)).alias(f"m{i}") for i, p in enumerate(checks.values())]
    entries = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"m{i}").cast("string").alias("observed_value"))
        for i, name in enumerate(checks)
    ]
    return df.agg(*measures).select(F.inline(F.array(*entries)))


# ---- freshness ----
def freshness(
    df: DataFrame,
    ts: str,
    warn_minutes: float,
    error_minutes: float | None = None,
    as_of: AsOf = None,
) -> DataFrame:
    """Newest timestamp, its age and a status; no rows at all is an error."""
    age = F.col("age_minutes")
    status = F.when(age.isNull(), "error")
    if error_minutes is not None:
        status = status.when(age > error_minutes, "error")
    status = status.when(age > warn_minutes, "warn" if error_minutes is not None else "error")
    return (
        df.agg(F.max(ts).alias("latest_at"))
        .withColumn("age_minutes", age_minutes("latest_at", as_of))
        .withColumn("status", status.otherwise("ok"))
    )


# ---- keys, references, columns ----
def duplicate_count(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows minus distinct keys, counted after a shuffle on the key itself."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    extra = F.sum("_n") - F.count(key)
    return per_key.agg(F.coalesce(extra, F.lit(0)).alias("duplicate_count")).select(
        F.lit(name).alias("key_name"), "duplicate_count"
    )


def ri_check(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, name: str) -> DataFrame:
    """Child rows whose key has no parent.

    Child rows are counted per key before the anti join, so a hot key crosses
    the network once per map task.
    """
    keys = child.groupBy(F.col(child_key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    parents = parent.select(F.col(parent_key).alias("_key"))
    orphans = keys.join(parents, "_key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("issue_count")).select(
        F.lit(name).alias("check_name"), "issue_count"
    )


def column_tests(
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """(column_name, test, failures) rows; null and enumeration tests share one pass."""
    accepted = accepted or {}
    tests = [(c, "not_null", F.count_if(F.col(c).isNull())) for c in not_null]
    tests += [
        (c, "accepted_values", F.count_if(any_of(not_in(c, values)))) for c, values in accepted.items()
    ]
    frames: list[DataFrame] = []
    if tests:
        row = df.agg(*[m.alias(f"m{i}") for i, (_c, _t, m) in enumerate(tests)])
        entries = [
            F.struct(
                F.lit(c).alias("column_name"), F.lit(t).alias("test"), F.col(f"m{i}").alias("failures")
            )
            for i, (c, t, _m) in enumerate(tests)
        ]
        frames.append(row.select(F.inline(F.array(*entries))))
    for c in unique:
        repeated = df.filter(F.col(c).isNotNull()).groupBy(c).count().filter("count > 1")
        frames.append(
            repeated.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(c).alias("column_name"), F.lit("unique").alias("test"), "failures"
            )
        )
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def check_constraints(
    df: DataFrame,
    primary_key: Sequence[str],
    checks: Mapping[str, Column],
    references: Mapping[str, tuple[DataFrame, str, str]] | None = None,
) -> DataFrame:
    """(constraint, violations) rows: key nulls, repeated keys, CHECKs, references.

    As in SQL, a CHECK fails only when it is false; unknown passes.
    """
    key_null = any_of(*[F.col(c).isNull() for c in primary_key])
    measures = {"primary_key_not_null": F.count_if(key_null)}
    measures |= {name: F.count_if(~condition) for name, condition in checks.items()}
    row = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures.values())])
    entries = [
        F.struct(F.lit(name).alias("constraint"), F.col(f"m{i}").alias("violations"))
        for i, name in enumerate(measures)
    ]
    result = row.select(F.inline(F.array(*entries)))
    repeated = df.groupBy(*primary_key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    result = result.unionByName(
        repeated.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("violations")).select(
            F.lit("primary_key_unique").alias("constraint"), "violations"
        )
    )
    for name, (parent, child_key, parent_key) in (references or {}).items():
        found = ri_check(df.filter(F.col(child_key).isNotNull()), parent, child_key, parent_key, name)
        result = result.unionByName(
            found.select(F.col("check_name").alias("constraint"), F.col("issue_count").alias("violations"))
        )
    return result


# ---- quarantine ----
def with_rejections(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reject_reason``: the first rule a row breaks, null for valid rows."""
    reason = F.lit(None).cast("string")
    for name, broken in reversed(list(rules.items())):
        reason = F.when(F.coalesce(broken, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def split_valid(
    df: DataFrame, rules: Mapping[str, Column], mode: Literal["quarantine", "raise"] = "quarantine"
) -> tuple[DataFrame, DataFrame]:
    """Valid rows and rejected rows with a reason; ``raise`` fails on the first bad row."""
    checked = with_rejections(df, rules)
    if mode == "raise":
        message = F.concat(F.lit("invalid row: "), F.col("reject_reason"))
        guard = F.when(F.col("reject_reason").isNull(), F.lit(True)).otherwise(
            F.raise_error(message).cast("boolean")
        )
        return checked.filter(guard).drop("reject_reason"), checked.limit(0)
    valid = checked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, checked.filter(F.col("reject_reason").isNotNull())


# ---- payload scans ----
def forbidden_rows(df: DataFrame, payload: str, markers: Sequence[str] = FORBIDDEN_MARKERS) -> DataFrame:
    return df.agg(F.count_if(F.col(payload).rlike("|".join(markers))).alias("forbidden_payload_rows"))


# ---- registry and landing ----
def check_registry(
    registry: DataFrame,
    privacy_classes: Sequence[str],
    raw_policies: Sequence[str],
    required: Sequence[str],
    bronze_prefix: str,
    silver_prefix: str,
) -> DataFrame:
    """(source_name, rule) rows, one per broken registry rule."""
    path_part = F.concat(F.lit("/"), F.col("source_name"), F.lit("/"))
    missing = {f"missing {c}": F.col(c).isNull() for c in required if c in registry.columns}
    rules = missing | {
        "unknown privacy_class": not_in("privacy_class", privacy_classes),
        "unknown raw_policy": not_in("raw_policy", raw_policies),
        "unknown local_policy": not_in("local_policy", [*raw_policies, "explicit_opt_in_pointer_only"]),
        "pii without commit_policy": F.col("pii") & any_of(F.col("commit_policy").isNull(), blank("commit_policy")),
        "landing_path must include source name": ~F.contains(F.col("landing_path"), path_part),
        "bronze_table outside bronze": ~F.startswith(F.col("bronze_table"), F.lit(bronze_prefix)),
        "silver_table outside silver": ~F.startswith(F.col("silver_table"), F.lit(silver_prefix)),
        "consumers must be listed": F.coalesce(F.size("consumers"), F.lit(0)) < 1,
        "required_fields must be listed": F.coalesce(F.size("required_fields"), F.lit(0)) < 1,
        "event_time_field must be required": ~F.coalesce(
            F.array_contains("required_fields", F.col("event_time_field")), F.lit(False)
        ),
        "idempotency_key must be listed": F.coalesce(F.size("idempotency_key"), F.lit(0)) < 1,
    }
    return explode_broken(registry, rules, ["source_name"])


def explode_broken(df: DataFrame, rules: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """One row per (row, broken rule)."""
    broken = F.array_compact(
        F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()])
    )
    return df.select(*keep, F.explode(broken).alias("rule"))


# ---- fixed values: envelope fields every landing event must carry ----
LANDING_REQUIRED_FIELDS = (
    "lake_version",
    "event_id",
    "source_name",
    "source_tier",
    "source_type",
    "event_type",
    "event_time",
    "ingested_at",
    "privacy_class",
    "consent_scope",
    "subject_id",
    "idempotency_key",
    "raw_policy",
    "local_policy",
    "payload_summary",
    "metrics",
    "tags",
    "quality_flags",
    "payload",
)


def landing_lines(df: DataFrame, path: str = "path", line: str = "line") -> DataFrame:
    """Source name of the path and a parse flag for raw landing lines.

    The source folder is ``<source>`` or ``<column>=<source>``, above ``dt=``.
    """
    return df.withColumn(
        "path_source", F.regexp_extract(F.col(path), r"(?:^|/)(?:[^/=]+=)?([^/=]+)/dt=[^/]+/[^/]+$", 1)
    ).withColumn("is_json", is_json_object(line))


def validate_landing_lines(
    df: DataFrame, registry: DataFrame, keep: Sequence[str], line: str = "line",
    lake_version: str = LAKE_VERSION,
) -> DataFrame:
    """(keep…, rule) rows for landing lines that break the envelope contract.

    ``df`` comes from :func:`landing_lines`. ``registry`` holds the known
    ``source_name`` values.
    """
    known = broadcast_if_small(registry.select(F.col("source_name").alias("path_source")).distinct())
    # Each line is parsed once for its keys and once for three fields, ahead of the rules.
    parsed = df.withColumns(
        {
            "_keys": F.coalesce(F.json_object_keys(F.when(F.col("is_json"), F.col(line))), F.array()),
            "_f": F.from_json(line, "lake_version string, source_name string, payload string"),
        }
    ).withColumns(
        {
            "_payload_keys": F.coalesce(F.array_size(F.json_object_keys("_f.payload")), F.lit(0)),
            "_forbidden": has_forbidden_key(F.col("_f.payload"), FORBIDDEN_LANDING_KEYS),
        }
    )
    checked = parsed.join(known.withColumn("_known", F.lit(True)), "path_source", "left")
    good, keys = F.col("is_json"), F.col("_keys")
    rules = {
        "line is not valid JSON": ~good,
        "unregistered source": F.col("_known").isNull(),
    }
    rules |= {
        f"missing {name}": good & ~F.array_contains(keys, name) for name in LANDING_REQUIRED_FIELDS
    }
    same = lambda a, b: F.coalesce(a == b, F.lit(False))
    rules |= {
        "unexpected lake_version": good & ~same(F.col("_f.lake_version"), F.lit(lake_version)),
        "source_name does not match path": good & ~same(F.col("_f.source_name"), F.col("path_source")),
        "payload must be a non-empty object": good & (F.col("_payload_keys") < 1),
        "payload contains a forbidden key": good & F.col("_forbidden"),
    }
    return explode_broken(checked, rules, keep)


def missing_sources(required: DataFrame, observed: DataFrame, key: str = "source_name") -> DataFrame:
    """Registered sources never observed."""
    return required.select(key).distinct().join(observed.select(key), key, "left_anti")


def uncovered_sources(registry: DataFrame, observed: DataFrame) -> DataFrame:
    """Registered sources without data whose producer is not marked as planned."""
    return registry.join(observed.select("source_name"), "source_name", "left_anti").filter(
        ~F.startswith(F.coalesce(F.col("producer"), F.lit("")), F.lit("planned-"))
    )


def landing_audit(df: DataFrame, line: str = "line", markers: Sequence[str] = FORBIDDEN_MARKERS) -> DataFrame:
    """Per path source: valid rows, forbidden phrases, bad JSON and name mismatches."""
    text = F.col(line)
    return df.groupBy("path_source").agg(
        F.count_if("is_json").alias("rows"),
        F.count_if(text.rlike("|".join(markers))).alias("forbidden_lines"),
        F.count_if(~F.col("is_json")).alias("invalid_json"),
        F.count_if(
            F.col("is_json")
            & ~F.coalesce(F.get_json_object(text, "$.source_name") == F.col("path_source"), F.lit(False))
        ).alias("source_mismatches"),
    )


def set_difference(a: DataFrame, b: DataFrame, name_a: str, name_b: str, key: str = "name") -> DataFrame:
    """Names on one side only, with the side they are missing from."""
    left = a.select(key).distinct()
    right = b.select(key).distinct()
    only_a = left.join(right, key, "left_anti").withColumn("missing_from", F.lit(name_b))
    only_b = right.join(left, key, "left_anti").withColumn("missing_from", F.lit(name_a))
    return only_a.unionByName(only_b)


def check_payloads(
    df: DataFrame,
    payload: str,
    keep: Sequence[str],
    required_keys: Sequence[str] = (),
    parallel_arrays: tuple[str, Sequence[str]] | None = None,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    patterns: Mapping[str, str] | None = None,
) -> DataFrame:
    """(keep…, rule) rows for payload text with a wrong shape.

    ``parallel_arrays`` = (path of the time array, paths of arrays that must be
    as long); ``ranges`` and ``patterns`` apply to scalar JSON paths.
    """
    text = col(payload)
    keys = F.coalesce(F.json_object_keys(text), F.array())
    rules: dict[str, Column] = {f"missing {k}": ~F.array_contains(keys, k) for k in required_keys}
    if parallel_arrays:
        time_path, others = parallel_arrays
        base = F.coalesce(F.json_array_length(F.get_json_object(text, time_path)), F.lit(0))
        rules["no time values"] = base == 0
        for path in others:
            size = F.coalesce(F.json_array_length(F.get_json_object(text, path)), F.lit(0))
            rules[f"{path} length must match time"] = size != base
    for path, (low, high) in (ranges or {}).items():
        number = F.coalesce(F.get_json_object(text, path).try_cast("double"), F.lit(0.0))
        rules[f"{path} must be {low:g}..{high:g}"] = ~number.between(low, high)
    for path, pattern in (patterns or {}).items():
        rules[f"{path} has a wrong form"] = ~F.coalesce(
            F.get_json_object(text, path).rlike(pattern), F.lit(False)
        )
    return explode_broken(df, rules, keep)
