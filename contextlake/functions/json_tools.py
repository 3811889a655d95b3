"""Removal and masking of private keys at any depth of JSON text.

Structs with a known schema are rebuilt with expressions. Text of unknown shape
needs a real walk, the one place where an Arrow-batched Python function is used.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from .text import col, strip

# ---- fixed values: keys never allowed in a stored payload ----
FORBIDDEN_KEYS = (
    "address",
    "api_key",
    "chat_id",
    "email",
    "home",
    "home_address",
    "note",
    "notes",
    "pain_text",
    "phone",
    "raw_diary_notes",
    "secret",
    "telegram_bot_token",
    "token",
    "work_address",
)
# ---- fixed values: further keys refused in landing files ----
FORBIDDEN_LANDING_KEYS = FORBIDDEN_KEYS + ("raw_payload", "message_body", "document_number")
# ---- fixed values: key parts that mark a log field as sensitive ----
SENSITIVE_KEY_PARTS = (
    "token",
    "secret",
    "password",
    "passwd",
    "chat_id",
    "cookie",
    "authorization",
    "api_key",
    "dsn",
    "credential",
)
# ---- fixed values: markers that must not occur in payload text ----
FORBIDDEN_MARKERS = (
    "TELEGRAM_BOT_TOKEN",
    "TELEGRAM_CHAT_ID",
    "pain_text",
    "raw_diary_notes",
    "raw_sleep_notes",
    "home_address",
)


def normalized_key(name: str) -> str:
    return name.lower().replace("-", "_")


def is_json_object(value: str | Column) -> Column:
    """True for text that is a JSON object.

    The parser stops after the first value, so the closing bracket is checked
    as well.
    """
    text = strip(col(value))
    whole = F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}"))
    return F.coalesce(whole & F.try_parse_json(text).isNotNull(), F.lit(False))


def redact_struct(value: Column, dtype: DataType, keys: Iterable[str] = FORBIDDEN_KEYS) -> Column:
    """Rebuild a typed value without the forbidden fields (no Python workers)."""
    banned = {normalized_key(k) for k in keys}
    if isinstance(dtype, StructType):
        kept = [f for f in dtype.fields if normalized_key(f.name) not in banned]
        rebuilt = F.struct(*[redact_struct(value[f.name], f.dataType, keys).alias(f.name) for f in kept])
        return F.when(value.isNotNull(), rebuilt)
    if isinstance(dtype, ArrayType):
        return F.transform(value, lambda x: redact_struct(x, dtype.elementType, keys))
    if isinstance(dtype, MapType):
        allowed = F.map_filter(
            value, lambda k, _v: ~F.translate(F.lower(k), "-", "_").isin(*banned)
        )
        return F.transform_values(allowed, lambda _k, v: redact_struct(v, dtype.valueType, keys))
    return value


def redact_json(value: str | Column, keys: Iterable[str] = FORBIDDEN_KEYS) -> Column:
    """JSON text without the forbidden keys at any depth; malformed text gives null."""
    return _json_walker(tuple(normalized_key(k) for k in keys), "drop")(col(value))


def mask_json(value: str | Column, parts: Iterable[str] = SENSITIVE_KEY_PARTS) -> Column:
    """JSON text with ``[redacted]`` under every key that contains a sensitive part."""
    return _json_walker(tuple(parts), "mask")(col(value))


def has_forbidden_key(value: str | Column, keys: Iterable[str] = FORBIDDEN_LANDING_KEYS) -> Column:
    """True when a forbidden key occurs at any depth of valid JSON text.

    A key is a quoted name after ``{`` or ``,`` and before ``:``. Quotes inside
    JSON strings are escaped, so the pattern cannot match string content and
    the check stays in the JVM.
    """
    names = "|".join(sorted({normalized_key(k).replace("_", "[_-]") for k in keys}))
    return F.coalesce(col(value).rlike(rf'(?i)[{{,]\s*"(?:{names})"\s*:'), F.lit(False))


def _json_walker(names: tuple[str, ...], mode: str):
    banned = frozenset(names)

    # Nested so that it ships to the workers by value.
    @F.pandas_udf(StringType())
    def run(series: pd.Series) -> pd.Series:
        def walk(node):
            if isinstance(node, dict):
                out = {}
                for key, item in node.items():
                    name = key.lower().replace("-", "_")
                    if mode == "drop":
                        if name not in banned:
                            out[key] = walk(item)
                    elif any(part in name for part in names):
                        out[key] = "[redacted]"
                    else:
                        out[key] = walk(item)
                return out
            if isinstance(node, list):
                return [walk(item) for item in node]
            return node

        def one(text):
            if text is None:
                return None
            try:
                return json.dumps(walk(json.loads(text)), ensure_ascii=False, separators=(",", ":"))
            except (ValueError, RecursionError):
                return None

        return pd.Series([one(text) for text in series], dtype=object)

    return run
