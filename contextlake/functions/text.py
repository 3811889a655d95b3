"""Text cleaning, labelling and splitting as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\f\x0b"


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: str | Column) -> Column:
    return F.btrim(col(value), F.lit(WHITESPACE))


def blank_to_null(value: str | Column) -> Column:
    c = col(value)
    return F.when(strip(c) != "", c)


def first_filled(*values: str | Column) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(col(v).cast("string"), F.lit("")) for v in values])


def collapse(value: str | Column, limit: int) -> Column:
    """Collapse runs of white space, strip, cut (preview text)."""
    return F.substring(strip(F.regexp_replace(col(value), r"\s+", " ")), 1, limit)


def clean_label(value: str | Column, limit: int = 48) -> Column:
    """Lower-case label restricted to ``[a-z0-9_ -]``; null becomes ''."""
    text = F.lower(strip(F.coalesce(col(value).cast("string"), F.lit(""))))
    return F.substring(F.regexp_replace(text, "[^a-z0-9_ -]", ""), 1, limit)


def clean_display_label(value: str | Column, limit: int = 80) -> Column:
    """Label that keeps case, Latin and Cyrillic letters; spaces collapsed."""
    text = F.coalesce(col(value).cast("string"), F.lit(""))
    kept = strip(F.regexp_replace(text, "[^a-zA-Z0-9а-яА-ЯёЁ ._:/-]+", ""))
    return F.substring(F.regexp_replace(kept, r"\s+", " "), 1, limit)


def slug(value: str | Column) -> Column:
    text = F.regexp_replace(F.lower(col(value)), r"[^\p{L}\p{N}]", "_")
    return F.coalesce(F.nullif(F.btrim(text, F.lit("_")), F.lit("")), F.lit("unknown"))


def word_count(value: str | Column) -> Column:
    """Number of maximal runs of letters, digits or underscore."""
    text = F.coalesce(col(value), F.lit(""))
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}_]+"))


# ---- fixed values: ordered keyword classes ----
TEXT_CLASSES = (
    ("health", ("doctor", "medical", "therapy", "dentist")),
    ("work", ("work", "sync", "standup", "review", "meeting")),
    ("training", ("train", "gym", "run", "ride", "moto")),
    ("social", ("family", "friend", "dinner", "coffee")),
)


def classify_text(value: str | Column, classes=TEXT_CLASSES, default: str = "personal") -> Column:
    """First class with one of its keywords in the text."""
    text = F.lower(F.coalesce(col(value), F.lit("")))
    result = F.lit(default)
    for name, words in reversed(classes):
        # Plain substring search is several times cheaper than a regex alternation.
        hit = F.contains(text, F.lit(words[0]))
        for word in words[1:]:
            hit = hit | F.contains(text, F.lit(word))
        result = F.when(hit, F.lit(name)).otherwise(result)
    return result


# ---- fixed values: ordered message redactions (pattern, replacement) ----
MESSAGE_REDACTIONS = (
    (r"(?i)telegram token or chat id is not configured", "Telegram credentials missing"),
    (r"\b\d{6,}:[A-Za-z0-9_-]{20,}\b", "[redacted-token]"),
    (r"(?i)(token|secret|password|api[_-]?key)=\S+", "$1=[redacted]"),
    (r"(?i)(bot)[A-Za-z0-9:_-]{20,}", "$1[redacted]"),
    (r"(?i)chat id", "chat identifier"),
    (r"(?i)token", "credential"),
)


def sanitize_message(value: str | Column, limit: int = 180) -> Column:
    text = F.coalesce(col(value), F.lit(""))
    for pattern, replacement in MESSAGE_REDACTIONS:
        text = F.regexp_replace(text, pattern, replacement)
    return F.substring(text, 1, limit)


def reason_list(*reasons: Column) -> Column:
    """Join reasons with ', ' keeping order, dropping nulls, blanks and repeats."""
    return join_reasons(F.array(*reasons))


def join_reasons(reasons: Column) -> Column:
    kept = F.filter(reasons, lambda r: r.isNotNull() & (r != ""))
    return F.concat_ws(", ", F.array_distinct(kept))


def tokens(value: str | Column) -> Column:
    """White-space tokens of a text; an empty text has none."""
    return F.filter(F.split(strip(col(value)), r"\s+"), lambda t: t != "")


def key_values(token_array: Column, underscores_to_spaces: bool = True) -> Column:
    """``key=value`` tokens as an ordered array of (k, v) structs."""

    def pair(token: Column) -> Column:
        key = F.lower(strip(F.substring_index(token, "=", 1)))
        value = strip(F.regexp_replace(token, "^[^=]*=", ""))
        if underscores_to_spaces:
            value = F.replace(value, F.lit("_"), F.lit(" "))
        return F.struct(key.alias("k"), value.alias("v"))

    return F.transform(F.filter(token_array, lambda t: F.contains(t, F.lit("="))), pair)


def plain_words(token_array: Column, underscores_to_spaces: bool = True) -> Column:
    words = F.filter(token_array, lambda t: ~F.contains(t, F.lit("=")))
    if underscores_to_spaces:
        words = F.transform(words, lambda t: F.replace(t, F.lit("_"), F.lit(" ")))
    return words


def value_of(pairs: Column, key: str) -> Column:
    """Last value stored under a key (later tokens win), null when absent."""
    return F.try_element_at(F.filter(pairs, lambda p: p["k"] == key), F.lit(-1))["v"]


def extract_confidence(summary: str | Column) -> Column:
    raw = F.regexp_extract(col(summary), r"(?:^|;)\s*confidence=(\d+)/", 1)
    return F.coalesce(raw.try_cast("int"), F.lit(0))


def extract_gaps(summary: str | Column) -> Column:
    """Gap names stored in a profile summary; empty array for 'none'."""
    raw = strip(F.regexp_extract(col(summary), r"(?:^|;)\s*data_gaps=([^;]*)", 1))
    names = F.filter(F.transform(F.split(raw, ","), strip), lambda g: g != "")
    return F.when((raw == "none") | (raw == ""), F.array().cast("array<string>")).otherwise(names)
