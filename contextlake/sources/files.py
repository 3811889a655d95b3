"""File inputs: landing JSON lines, lenient logs, CSV, and documents inside text columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.hashing import stable_hash
from ..functions.json_tools import is_json_object
from ..functions.text import classify_text, col, strip
from ..functions.times import parse_ical, parse_rfc822, seconds_between
from ..schemas import ENVELOPE

# ---- fixed values: keys whose list holds the rows of a JSON document ----
FILE_ROW_KEYS = ("events", "rows", "items", "nights", "notes", "trades", "sessions")
SUBSCRIPTION_ROW_KEYS = ("events", "items", "rows", "entries")


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landing envelopes with an explicit schema; ``payload`` stays JSON text.

    Adds ``landing_file``. No inference pass, no merging of payload schemas.
    """
    return (
        spark.read.schema(ENVELOPE)
        .json(path)
        .select("*", F.col("_metadata.file_path").alias("landing_file"))
    )


def read_landing_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw landing lines with their file, the input of the landing checks; blank lines dropped."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")
    )
    return lines.filter(strip(F.col("line")) != "")


def read_jsonl_lenient(
    spark: SparkSession,
    path: str,
    schema: StructType,
    equals: Mapping[str, str] | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """JSON lines where malformed lines are skipped, or kept for counting."""
    corrupt = "_corrupt_record"
    wide = StructType([*schema.fields, StructField(corrupt, StringType())])
    rows = (
        spark.read.schema(wide)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .json(path)
    )
    if not keep_corrupt:
        rows = rows.filter(F.col(corrupt).isNull()).drop(corrupt)
    for name, value in (equals or {}).items():
        rows = rows.filter(F.col(name) == value)
    return rows


def read_csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column stays text."""
    return spark.read.option("header", True).option("multiLine", False).csv(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole small files as (path, text): notes, calendars, tracks, single JSON documents."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def file_name(path: str | Column) -> Column:
    return F.substring_index(col(path), "/", -1)


def file_extension(path: str | Column) -> Column:
    name = file_name(path)
    dotted = F.contains(name, F.lit("."))
    return F.when(dotted, F.lower(F.substring_index(name, ".", -1))).otherwise("")


def json_records(body: Column, keys: Sequence[str] = FILE_ROW_KEYS) -> Column:
    """Records of a JSON document as an array of texts, the document parsed once.

    A list gives its elements, an object the first of ``keys`` that holds a list,
    anything else itself. Text that only looks like a list is no list.
    """
    candidates = F.from_json(body, ", ".join(f"`{k}` array<string>" for k in keys))
    single = let(candidates, lambda c: F.coalesce(*[c[k] for k in keys], F.array(body)))
    return F.when(F.startswith(body, F.lit("[")), F.from_json(body, "array<string>")).otherwise(single)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it occurs."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def explode_json_rows(
    df: DataFrame,
    text: str,
    keys: Sequence[str] = FILE_ROW_KEYS,
    allow_json_lines: bool = False,
) -> DataFrame:
    """One row per record of a JSON document held in a text column.

    The document may be a list, an object with one of ``keys`` holding a list,
    or a single object. Adds ``row_number`` (from 1), ``row_json`` and
    ``is_object``; records that are not objects are kept and flagged.
    """
    body = strip(col(text))
    rows = json_records(body, keys)
    if allow_json_lines:
        # JSON lines: several lines, the first of which is a whole object by itself.
        lines = F.filter(F.split(body, r"\r?\n"), lambda x: strip(x) != "")
        by_line = (F.size(lines) > 1) & is_json_object(F.get(lines, F.lit(0)))
        rows = F.when(by_line, lines).otherwise(rows)
    return df.select("*", F.posexplode(rows).alias("_pos", "row_json")).select(
        *df.columns,
        (F.col("_pos") + 1).alias("row_number"),
        "row_json",
        is_json_object("row_json").alias("is_object"),
    )


def parse_notes(df: DataFrame, text: str = "text") -> DataFrame:
    """Markdown notes: ``---`` front matter, title (metadata or first ``# `` line), body."""
    body = F.col(text)
    pattern = r"(?s)^---\n(.*?)---\n(.*)$"
    has_meta = F.startswith(body, F.lit("---\n")) & body.rlike(pattern)
    meta = F.when(has_meta, F.regexp_extract(body, pattern, 1)).otherwise("")
    content = F.when(has_meta, F.regexp_extract(body, pattern, 2)).otherwise(body)
    lines = F.filter(F.split(meta, "\n"), lambda x: F.contains(x, F.lit(":")))
    pairs = F.transform(
        lines,
        lambda x: F.struct(
            strip(F.substring_index(x, ":", 1)).alias("k"),
            strip(F.regexp_replace(x, "^[^:]*:", "")).alias("v"),
        ),
    )

    def meta_value(key: str) -> Column:
        return F.try_element_at(F.filter(F.col("_pairs"), lambda p: p["k"] == key), F.lit(-1))["v"]

    heading = strip(F.regexp_extract(content, r"(?m)^# (.*)$", 1))
    return (
        df.withColumn("_pairs", pairs)
        .select(
            *df.columns,
            F.coalesce(F.nullif(meta_value("title"), F.lit("")), heading).alias("title"),
            F.coalesce(meta_value("summary"), content).alias("summary"),
            meta_value("created_at").alias("created_at"),
            meta_value("occurred_at").alias("occurred_at"),
            meta_value("updated_at").alias("updated_at"),
            meta_value("date").alias("date"),
            meta_value("tags").alias("tags"),
            meta_value("mood").alias("mood"),
        )
    )


def calendar_blocks(df: DataFrame, text: str = "text", path: str | None = "path") -> DataFrame:
    """Calendar events of iCalendar text: unfolded lines, one row per closed VEVENT.

    Titles leave only as a hash and a category. ``tzid`` is kept because the
    times of zoned events are read as UTC.
    """
    unfolded = F.regexp_replace(F.col(text), r"\r?\n[ \t]", "")
    blocks = F.transform(
        F.regexp_extract_all(unfolded, F.lit(r"(?s)BEGIN:VEVENT\r?\n(.*?)END:VEVENT"), F.lit(1)),
        lambda b: F.concat(F.lit("\n"), b),
    )

    def prop(name: str) -> Column:
        found = F.regexp_extract(F.col("_block"), rf"(?im)^{name}(?:;[^:\r\n]*)?:([^\r\n]*)", 1)
        return strip(found)

    exploded = df.select("*", F.posexplode(blocks).alias("_pos", "_block"))
    read = exploded.withColumns(
        {"_from": prop("DTSTART"), "_to": prop("DTEND"), "_title": prop("SUMMARY")}
    )
    timed = read.withColumn("_start", parse_ical("_from")).withColumn(
        "_end", F.coalesce(parse_ical("_to"), F.col("_start"))
    )
    name = file_name(path) if path else F.lit("")
    return timed.select(
        *[c for c in df.columns if c != text],
        (F.col("_pos") + 1).alias("block_number"),
        F.nullif(prop("UID"), F.lit("")).alias("uid"),
        F.col("_start").alias("started_at"),
        F.col("_end").alias("ended_at"),
        F.greatest(F.floor(seconds_between(F.col("_start"), F.col("_end")) / 60), F.lit(0))
        .cast("int")
        .alias("duration_minutes"),
        (~F.contains("_from", F.lit("T"))).alias("all_day"),
        F.nullif(
            F.regexp_extract(F.col("_block"), r"(?im)^DTSTART;[^:\r\n]*TZID=([^:;\r\n]*)", 1),
            F.lit(""),
        ).alias("tzid"),
        stable_hash("_title").alias("summary_hash"),
        classify_text("_title").alias("summary_category"),
        (prop("LOCATION") != "").alias("location_present"),
        (prop("DESCRIPTION") != "").alias("description_present"),
        F.regexp_count(F.col("_block"), F.lit(r"(?im)^ATTENDEE[;:]")).alias("attendee_count"),
        F.lower(F.coalesce(F.nullif(prop("STATUS"), F.lit("")), F.lit("CONFIRMED"))).alias("status"),
        stable_hash(name).alias("source_file_hash"),
        (file_extension(path) if path else F.lit("ics")).alias("source_extension"),
    )


def track_points(df: DataFrame, text: str = "text") -> DataFrame:
    """Track points of GPX text in document order; elevation defaults to 0, time to ''."""
    pieces = F.regexp_extract_all(
        F.col(text), F.lit(r"(?s)<(?:\w+:)?trkpt\b[^>]*?(?:/>|>.*?</(?:\w+:)?trkpt>)"), F.lit(0)
    )

    def attr(name: str) -> Column:
        raw = F.regexp_extract(F.col("_piece"), rf"""\b{name}\s*=\s*["']([^"']*)["']""", 1)
        return raw.try_cast("double")

    def child(name: str) -> Column:
        return F.regexp_extract(F.col("_piece"), rf"(?s)<(?:\w+:)?{name}>(.*?)</(?:\w+:)?{name}>", 1)

    return df.select(*[c for c in df.columns if c != text], F.posexplode(pieces).alias("idx", "_piece")).select(
        *[c for c in df.columns if c != text],
        "idx",
        attr("lat").alias("lat"),
        attr("lon").alias("lon"),
        F.coalesce(strip(child("ele")).try_cast("double"), F.lit(0.0)).alias("ele"),
        strip(child("time")).alias("time"),
    )


def feed_items(df: DataFrame, text: str = "text") -> DataFrame:
    """Items of RSS text, or Atom entries when there are no items."""
    options = {"ignoreNamespace": "true"}
    rss_schema = "title string, link string, pubDate string, date string, description string"
    atom_schema = (
        "title string, link struct<_href:string>, published string, updated string, summary string"
    )
    rss_pieces = F.regexp_extract_all(F.col(text), F.lit(r"(?s)<item\b.*?</item>"), F.lit(0))
    atom_pieces = F.regexp_extract_all(
        F.col(text), F.lit(r"(?s)<(?:\w+:)?entry\b.*?</(?:\w+:)?entry>"), F.lit(0)
    )
    is_rss = F.size(rss_pieces) > 0
    exploded = df.select(
        "*",
        is_rss.alias("_rss"),
        F.posexplode(F.when(is_rss, rss_pieces).otherwise(atom_pieces)).alias("_pos", "_piece"),
    )
    parsed = exploded.withColumn(
        "_i", F.when(F.col("_rss"), F.from_xml("_piece", rss_schema, options))
    ).withColumn("_e", F.when(~F.col("_rss"), F.from_xml("_piece", atom_schema, options)))

    def pick(rss: Column, atom: Column) -> Column:
        return strip(F.coalesce(F.when(F.col("_rss"), rss).otherwise(atom), F.lit("")))

    def filled(*fields: str) -> Column:
        return F.coalesce(*[F.nullif(strip(F.col(f)), F.lit("")) for f in fields])

    published = pick(filled("_i.pubDate", "_i.date"), filled("_e.published", "_e.updated"))
    return parsed.select(
        *[c for c in df.columns if c != text],
        (F.col("_pos") + 1).alias("item_number"),
        pick(F.col("_i.title"), F.col("_e.title")).alias("title"),
        pick(F.col("_i.link"), F.col("_e.link._href")).alias("url"),
        published.alias("published_at"),
        parse_rfc822(published).alias("published_time"),
        pick(F.col("_i.description"), F.col("_e.summary")).alias("summary"),
    )
