"""Scalar functions over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from contextlake.functions import hashing, json_tools, numbers, text, times, urls

from .adapters import table, view
from .registry import half_up, query

WS = r"\s+"
LABEL_SQL = "substring(regexp_replace(lower(trim({c}, chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))), '[^a-z0-9_ -]', '', 'g'), 1, {n})"


@query(
    "f01_clean_label",
    f"SELECT doc_id, {LABEL_SQL.format(c='text', n=48)} AS label FROM documents",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.clean_label("text").alias("label"))


TRIM = "trim({c}, chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"


@query(
    "f02_display_label_and_preview",
    f"""SELECT doc_id, substring(regexp_replace({TRIM.format(c="regexp_replace(text, '[^a-zA-Z0-9а-яА-ЯёЁ ._:/-]+', '', 'g')")}, '\\s+', ' ', 'g'), 1, 80) AS label,
    substring({TRIM.format(c="regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')")}, 1, 160) AS preview FROM documents""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        text.clean_display_label("text").alias("label"),
        text.collapse("text", 160).alias("preview"),
    )


@query(
    "f03_slug",
    """SELECT p_partkey, coalesce(nullif(trim(regexp_replace(lower(p_name || ' / ' || p_type), '[^\\p{L}\\p{N}]', '_', 'g'), '_'), ''), 'unknown') AS slug
    FROM part""",
)
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", text.slug(F.concat("p_name", F.lit(" / "), "p_type")).alias("slug")
    )


@query(
    "f04_word_count",
    """SELECT doc_id, CAST(len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS BIGINT) AS words FROM documents""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.word_count("text").alias("words"))


def class_sql() -> str:
    whens = " ".join(
        f"WHEN regexp_matches(lower(text), '{'|'.join(words)}') THEN '{name}'" for name, words in text.TEXT_CLASSES
    )
    return f"CASE {whens} ELSE 'personal' END"


@query("f05_classify_text", f"SELECT doc_id, {class_sql()} AS class FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.classify_text("text").alias("class"))


def sanitize_sql(column: str) -> str:
    sql = column
    for pattern, replacement in text.MESSAGE_REDACTIONS:
        sql = f"regexp_replace({sql}, '{pattern}', '{replacement.replace('$1', chr(92) + '1')}', 'g')"
    return sql


@query(
    "f06_sanitize_message",
    f"SELECT doc_id, substring({sanitize_sql('text')}, 1, 180) AS message, length({sanitize_sql('text')}) AS sanitized_length FROM documents",
)
def _(spark, sf):
    clean = table(spark, sf, "documents").select("doc_id", text.sanitize_message("text", 2_000_000_000).alias("clean"))
    return clean.select("doc_id", F.substring("clean", 1, 180).alias("message"), F.length("clean").alias("sanitized_length"))


@query(
    "f07_predicates",
    """SELECT count(*) FILTER (WHERE trim(lang) = '') AS blank_lang,
    count(*) FILTER (WHERE regexp_matches(text, '[0-9]{3}')) AS with_numbers,
    count(*) FILTER (WHERE source LIKE 'w_b%') AS like_web FROM documents""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.agg(
        F.count_if(text.strip("lang") == "").alias("blank_lang"),
        F.count_if(F.col("text").rlike("[0-9]{3}")).alias("with_numbers"),
        F.count_if(F.col("source").like("w_b%")).alias("like_web"),
    )


@query(
    "f08_reason_list",
    """SELECT event_id, array_to_string(list_filter([CASE WHEN event_id % 2 = 0 THEN 'even' END, event_type,
        CASE WHEN value > 10 THEN 'large' END], lambda x: x IS NOT NULL AND x <> ''), ', ') AS reasons FROM events""",
)
def _(spark, sf):
    even = F.when(F.col("event_id") % 2 == 0, "even")
    return table(spark, sf, "events").select(
        "event_id",
        text.reason_list(even, F.col("event_type"), F.lit(""), even, F.when(F.col("value") > 10, "large")).alias("reasons"),
    )


@query(
    "f09_key_values",
    """SELECT event_id, event_type AS kind, CAST(user_id AS VARCHAR) AS owner, 'x ' || event_id AS words FROM events""",
)
def _(spark, sf):
    message = F.concat(
        F.lit("x KIND=old kind="), "event_type", F.lit(" owner="), "user_id", F.lit("  "), "event_id"
    )
    tokens = text.tokens(message)
    pairs = text.key_values(tokens)
    return table(spark, sf, "events").select(
        "event_id",
        text.value_of(pairs, "kind").alias("kind"),
        text.value_of(pairs, "owner").alias("owner"),
        F.concat_ws(" ", text.plain_words(tokens)).alias("words"),
    )


URL = "(url || '#part')"
HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


@query(
    "f10_url_parts",
    f"""WITH parts AS (SELECT page_id, url, {HOST} AS host, {PATH} AS path, regexp_extract(url, '^([A-Za-z]+):', 1) AS scheme FROM pages)
    SELECT page_id, host, path, scheme, regexp_replace(url, '#.*$', '') AS normalized, CASE WHEN host IN ('t.me', 'telegram.me') OR host LIKE '%.t.me' THEN 'telegram_channel'
        WHEN lower(path) LIKE '%stream%' OR lower(path) LIKE '%events%' THEN 'event_stream'
        WHEN regexp_matches(lower(path), '\\.(rss|xml|atom)$') OR lower(url || '#part') LIKE '%rss%' OR lower(url || '#part') LIKE '%feed%' THEN 'rss_feed'
        WHEN lower(path) LIKE '%.json' OR lower(path) LIKE '%api%' THEN 'api_json'
        WHEN scheme IN ('http', 'https') THEN 'news_url' END AS source_type FROM parts""",
)
def _(spark, sf):
    url = F.concat("url", F.lit("#part"))
    return table(spark, sf, "pages").select(
        "page_id",
        urls.url_host(url).alias("host"),
        urls.url_path(url).alias("path"),
        urls.url_scheme(url).alias("scheme"),
        urls.normalize_reference(url).alias("normalized"),
        urls.infer_source_type(url).alias("source_type"),
    )


@query(
    "f11_url_labels_and_ids",
    f"""SELECT page_id, 'web_' || substring(sha256('web_page:' || url), 1, 12) AS subscription_id,
    substring(sha256(url), 1, 24) AS reference_hash, 'web' AS domain FROM pages""",
)
def _(spark, sf):
    kind = F.lit("web_page")
    return table(spark, sf, "pages").select(
        "page_id",
        urls.subscription_id(kind, F.col("url")).alias("subscription_id"),
        urls.reference_hash("url").alias("reference_hash"),
        urls.default_domain(kind).alias("domain"),
    )


@query(
    "f12_duration_minutes",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(floor((1 + event_id % 12) * 60 + 30) AS BIGINT)
    WHEN 1 THEN (event_id % 12) * 60 + event_id % 60 WHEN 2 THEN nullif(event_id % 500, 0) ELSE NULL END AS minutes FROM events
    """,
    text=("minutes",),
)
def _(spark, sf):
    e = F.col("event_id")
    raw = (
        F.when(e % 4 == 0, F.concat((1 + e % 12).cast("string"), F.lit(".5H")))
        .when(e % 4 == 1, F.concat((e % 12).cast("string"), F.lit(":"), F.lpad((e % 60).cast("string"), 2, "0")))
        .when(e % 4 == 2, (e % 500).cast("string"))
        .otherwise(F.lit("long sleep"))
    )
    return table(spark, sf, "events").select("event_id", numbers.duration_minutes(raw).alias("minutes"))


@query(
    "f13_confidence_from_summary",
    """SELECT profile_id, profile_id % 101 AS confidence,
    CASE WHEN profile_id % 4 = 0 THEN '' ELSE 'sleep_recovery_missing|context_signals_stale' END AS gaps FROM v_profiles""",
    ("v_profiles",),
)
def _(spark, sf):
    return view(spark, sf, "v_profiles").select(
        "profile_id",
        text.extract_confidence("context_summary").alias("confidence"),
        text.extract_gaps("context_summary").alias("gaps"),
    )


@query(
    "f14_stable_hash",
    f"""SELECT doc_id, substring(sha256({TRIM.format(c='text')}), 1, 16) AS text_hash,
    substring(sha256({TRIM.format(c="'  ' || source")}), 1, 16) AS source_hash, '' AS blank_hash FROM documents""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        hashing.stable_hash("text").alias("text_hash"),
        hashing.stable_hash(F.concat(F.lit("  "), "source")).alias("source_hash"),
        hashing.stable_hash(F.lit("   ")).alias("blank_hash"),
    )


@query(
    "f15_parse_times",
    """SELECT event_id, date_trunc('second', ts) AS zulu, date_trunc('second', ts) - INTERVAL 3 HOUR AS shifted,
    date_trunc('second', ts) AS naive, date_trunc('second', ts) AS ical, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS ical_day,
    date_trunc('second', ts) AS rfc, CAST(NULL AS TIMESTAMP) AS bad FROM events""",
)
def _(spark, sf):
    at = lambda pattern: F.date_format("ts", pattern)
    return table(spark, sf, "events").select(
        "event_id",
        times.parse_iso(at("yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("zulu"),
        times.parse_iso(at("yyyy-MM-dd'T'HH:mm:ss'+03:00'")).alias("shifted"),
        times.parse_iso(at("yyyy-MM-dd HH:mm:ss")).alias("naive"),
        times.parse_ical(at("yyyyMMdd'T'HHmmss'Z'")).alias("ical"),
        times.parse_ical(at("yyyyMMdd")).alias("ical_day"),
        times.parse_rfc822(at("EEE, dd MMM yyyy HH:mm:ss 'GMT'")).alias("rfc"),
        times.parse_iso(F.concat(F.lit("on "), at("yyyy"))).alias("bad"),
    )


@query(
    "f16_date_parts",
    """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS monday,
    CAST(CAST(ts AS DATE) - CAST(dayofweek(ts) AS INT) AS VARCHAR)[1:10] AS sunday, date_trunc('minute', ts) AS minute,
    CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS month FROM events""",
)
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.to_date("ts").alias("day"),
        times.week_start("ts").alias("monday"),
        times.week_start("ts", "sunday").alias("sunday"),
        times.minute("ts").alias("minute"),
        times.month_of("ts").alias("month"),
    )


@query(
    "f17_ages",
    """SELECT event_id, CAST(floor(greatest(date_diff('microsecond', ts, TIMESTAMP '2024-01-20 00:00:00'), 0) / 60000000) AS BIGINT) AS minutes,
    ts < TIMESTAMP '2024-01-13 00:00:00' AS older_than_week FROM events""",
)
def _(spark, sf):
    now = F.lit("2024-01-20 00:00:00").cast("timestamp")
    return table(spark, sf, "events").select(
        "event_id",
        times.minutes_between(F.col("ts").cast("timestamp"), now).alias("minutes"),
        times.older_than_days("ts", 7, now).alias("older_than_week"),
    )


@query(
    "f18_first_filled",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type WHEN event_id % 3 = 1 THEN props ELSE 'none' END AS value FROM events""",
)
def _(spark, sf):
    e = F.col("event_id")
    first = F.when(e % 3 == 0, F.col("event_type")).otherwise("")
    second = F.when(e % 3 == 1, F.col("props"))
    return table(spark, sf, "events").select("event_id", text.first_filled(first, second, F.lit("none")).alias("value"))


@query(
    "f19_haversine",
    """WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_partkey % 900 AS DOUBLE) / 10 - 45 AS a, CAST(l_suppkey % 1800 AS DOUBLE) / 10 - 90 AS b,
        CAST(l_suppkey % 900 AS DOUBLE) / 10 - 45 AS c, CAST(l_partkey % 1800 AS DOUBLE) / 10 - 90 AS d FROM lineitem),
    h AS (SELECT *, pow(sin(radians(c - a) / 2), 2) + cos(radians(a)) * cos(radians(c)) * pow(sin(radians(d - b) / 2), 2) AS h FROM p)
    SELECT l_orderkey, l_linenumber, l_partkey, round(6371.0088 * 2 * atan2(sqrt(h), sqrt(1 - h)), 5) AS km FROM h""",
)
def _(spark, sf):
    degrees = lambda c, m, half: F.col(c).cast("double") % m / 10 - half
    km = numbers.haversine_km(
        degrees("l_partkey", 900, 45), degrees("l_suppkey", 1800, 90),
        degrees("l_suppkey", 900, 45), degrees("l_partkey", 1800, 90),
    )
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(km, 5).alias("km"))


@query(
    "f20_bounds_and_ratios",
    f"""SELECT event_id, greatest(0, least(100, event_id % 300 - 100)) AS clamped,
    coalesce({half_up('CAST(event_id % 7 AS DOUBLE) / nullif(event_id % 5, 0)', 3)}, 0) AS ratio,
    CASE WHEN event_id % 5 = 0 THEN 0 ELSE round(CAST(event_id % 7 - event_id % 5 AS DOUBLE) / (event_id % 5) * 100, 6) END AS change FROM events""",
)
def _(spark, sf):
    e = F.col("event_id")
    change = numbers.percent_change((e % 5).cast("double"), (e % 7).cast("double"))
    return table(spark, sf, "events").select(
        "event_id",
        numbers.clamp(e % 300 - 100).alias("clamped"),
        numbers.ratio(e % 7, e % 5).alias("ratio"),
        F.round(change, 6).alias("change"),
    )


@query(
    "f21_lenient_casts",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(floor(value) AS BIGINT) END AS whole,
    CASE WHEN event_id % 3 = 0 THEN round(value, 6) END AS number,
    CASE event_id % 3 WHEN 0 THEN false WHEN 1 THEN true END AS flag,
    CASE WHEN event_id % 11 BETWEEN 1 AND 10 THEN event_id % 11 END AS bounded FROM events""",
    text=("bounded", "flag", "whole",),
)
def _(spark, sf):
    e = F.col("event_id")
    raw = F.when(e % 3 == 0, F.col("value").cast("string")).when(e % 3 == 1, "Yes").otherwise("")
    return table(spark, sf, "events").select(
        "event_id",
        numbers.optional_int(raw).alias("whole"),
        numbers.optional_float(raw).alias("number"),
        numbers.optional_bool(raw).alias("flag"),
        numbers.bounded_int((e % 11).cast("string"), 1, 10).alias("bounded"),
    )


@query(
    "f22_arrays_and_maps",
    """SELECT event_id, 3 AS size, 'a|' || event_type AS first_two, true AS has_b,
    CASE WHEN event_id % 2 = 0 THEN '{"kept":"' || event_type || '"}' ELSE '{}' END AS compacted FROM events""",
)
def _(spark, sf):
    items = F.array(F.lit("a"), "event_type", F.lit("b"))
    kept = F.when(F.col("event_id") % 2 == 0, F.col("event_type"))
    raw = F.create_map(F.lit("kept"), kept, F.lit("blank"), F.lit(""))
    compacted = F.map_filter(raw, lambda _k, v: v.isNotNull() & (v != ""))
    return table(spark, sf, "events").select(
        "event_id",
        F.size(items).alias("size"),
        F.slice(items, 1, 2).alias("first_two"),
        F.array_contains(items, "b").alias("has_b"),
        F.to_json(compacted).alias("compacted"),
    )


@query(
    "f23_json_extract",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing FROM events""",
)
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k"),
        F.get_json_object("props", "$.missing").alias("missing"),
    )


@query(
    "f24_canonical_json_and_event_id",
    """WITH c AS (SELECT event_id, '{"count": ' || user_id || ', "flag": ' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END
        || ', "name": "' || event_type || '", "nothing": null, "tags": ["a", "' || event_type || '"]}' AS canonical FROM events)
    SELECT event_id, canonical, substring(sha256('src:kind:2024-01-01T00:00:00Z:' || canonical), 1, 32) AS id FROM c""",
)
def _(spark, sf):
    payload = F.struct(
        F.array(F.lit("a"), "event_type").alias("tags"),
        F.col("event_type").alias("name"),
        F.col("user_id").alias("count"),
        (F.col("event_id") % 2 == 0).alias("flag"),
        F.lit(None).cast("string").alias("nothing"),
    )
    staged = table(spark, sf, "events").select("event_id", payload.alias("p"))
    canonical = hashing.canonical_json(F.col("p"), staged.schema["p"].dataType)
    key = hashing.event_key(F.lit("src"), F.lit("kind"), F.lit("2024-01-01T00:00:00Z"), F.col("canonical"))
    return staged.select("event_id", canonical.alias("canonical")).withColumn("id", hashing.event_id(key))


@query(
    "f25_forbidden_key_probe",
    """SELECT event_id, event_id % 3 = 0 AS forbidden FROM events""",
)
def _(spark, sf):
    e = F.col("event_id")
    body = F.when(e % 3 == 0, F.lit('{"a":{"Home-Address" : "x"}}')).when(
        e % 3 == 1, F.to_json(F.struct(F.lit('{"token": "inside a string"}').alias("a"), F.col("event_type").alias("note_type")))
    ).otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", json_tools.has_forbidden_key(body).alias("forbidden"))
