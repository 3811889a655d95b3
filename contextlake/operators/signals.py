"""Context signals: generic rows, repository activity and market bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import bounded_int, optional_float, percent_change
from ..functions.text import first_filled, slug
from ..functions.times import AsOf, recent
from ..schemas import SIGNAL_DIRECTIONS, SIGNAL_DOMAINS
from .latest import latest_by, top_text
from .quality import split_valid

SIGNAL_COLUMNS = (
    "signal_id", "domain", "source", "title", "direction", "urgency", "confidence", "summary",
    "occurred_at", "ingested_at",
)


_BAR = ", ".join(f"{name} string" for name in ("symbol", "open", "o", "high", "h", "low", "l", "close", "c", "timestamp", "t"))
_REPOSITORY = (
    "full_name string, name string, pushed_at string, updated_at string, open_issues_count string, open_issues string,"
    " stargazers_count string, stars string, archived boolean"
)
_SIGNAL = ", ".join(
    f"{name} string"
    for name in ("signal_id", "domain", "source", "title", "direction", "urgency", "confidence", "summary", "occurred_at")
)


def _number(record: Column, *names: str) -> Column:
    """First of the fields that holds a number other than zero."""
    return F.coalesce(*[F.nullif(optional_float(record[n]), F.lit(0.0)) for n in names])


def market_rows(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Price bars of market payloads, the input of :func:`market_signals`.

    ``symbols`` is a list of bars or an object of bars by symbol; fields have
    long or one-letter names. Adds ``provider``. Payloads without bars give no rows.
    """
    head = df.withColumn("_p", F.from_json(payload, "provider string, symbols string"))
    text = F.ltrim("_p.symbols")
    listed = F.transform(
        F.from_json(text, f"array<struct<{_as_fields(_BAR)}>>"),
        lambda b: F.struct(F.coalesce(b["symbol"], F.lit("UNKNOWN")).alias("key"), b.alias("value")),
    )
    named = F.map_entries(F.from_json(text, f"map<string,struct<{_as_fields(_BAR)}>>"))
    bars = F.when(F.startswith(text, F.lit("[")), listed).otherwise(
        F.transform(named, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    )
    each = head.select(*keep, F.coalesce("_p.provider", F.lit("fixture")).alias("provider"), F.explode(bars).alias("_b"))
    bar = F.col("_b.value")
    return each.select(
        *keep,
        "provider",
        F.col("_b.key").alias("symbol"),
        _number(bar, "open", "o").alias("open"),
        _number(bar, "high", "h").alias("high"),
        _number(bar, "low", "l").alias("low"),
        _number(bar, "close", "c").alias("close"),
        first_filled(bar["timestamp"], bar["t"]).alias("bar_time"),
    )


def repository_rows(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Repository rows of payloads with a ``repositories`` list, the input of :func:`repo_signals`."""
    schema = f"repositories array<struct<{_as_fields(_REPOSITORY)}>>"
    each = df.select(*keep, F.explode(F.from_json(payload, schema)["repositories"]).alias("_r"))
    r = F.col("_r")
    return each.select(
        *keep,
        first_filled(r["full_name"], r["name"]).alias("full_name"),
        r["pushed_at"].alias("pushed_at"),
        r["updated_at"].alias("updated_at"),
        _number(r, "open_issues_count", "open_issues").cast("int").alias("open_issues_count"),
        _number(r, "stargazers_count", "stars").cast("int").alias("stargazers_count"),
        r["archived"].alias("archived"),
    )


def signal_rows(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Items of payloads with a ``signals`` list and their ``row_number`` from 1, for :func:`normalize_signals`."""
    schema = f"signals array<struct<{_as_fields(_SIGNAL)}>>"
    each = df.select(*keep, F.posexplode(F.from_json(payload, schema)["signals"]).alias("_i", "_s"))
    return each.select(*keep, (F.col("_i") + 1).alias("row_number"), "_s.*")


def _as_fields(ddl: str) -> str:
    return ",".join(":".join(part.split()) for part in ddl.split(","))


def normalize_signals(
    df: DataFrame, row_number: str, ingested_at: str = "ingested_at", keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """(valid signals, rejected rows): known enums, bounded numbers, default id and title."""
    domain = F.lower(F.coalesce("domain", F.lit("")))
    direction = F.lower(F.coalesce("direction", F.lit("neutral")))
    source = F.coalesce("source", F.lit("manual"))
    signal_id = F.coalesce(
        F.nullif("signal_id", F.lit("")), F.concat_ws("_", domain, source, F.col(row_number).cast("string"))
    )
    rows = df.select(
        *keep,
        signal_id.alias("signal_id"),
        domain.alias("domain"),
        source.alias("source"),
        F.coalesce("title", signal_id).alias("title"),
        direction.alias("direction"),
        bounded_int(F.coalesce(F.col("urgency").cast("string"), F.lit("1")), 1, 10).alias("urgency"),
        bounded_int(F.coalesce(F.col("confidence").cast("string"), F.lit("1")), 1, 100).alias("confidence"),
        F.coalesce("summary", F.lit("")).alias("summary"),
        F.coalesce("occurred_at", ingested_at).alias("occurred_at"),
        F.col(ingested_at).alias("ingested_at"),
    )
    return split_valid(
        rows,
        {
            "unknown domain": ~F.col("domain").isin(*SIGNAL_DOMAINS),
            "unknown direction": ~F.col("direction").isin(*SIGNAL_DIRECTIONS),
            "urgency must be an integer from 1 to 10": F.col("urgency").isNull(),
            "confidence must be an integer from 1 to 100": F.col("confidence").isNull(),
        },
    )


def repo_signals(df: DataFrame, ingested_at: str = "ingested_at", keep: tuple[str, ...] = ()) -> DataFrame:
    """Repository rows (full_name, pushed_at text, open issues, stars, archived) to signals."""
    name = first_filled("full_name", F.lit("unknown/repo"))
    issues = F.coalesce("open_issues_count", F.lit(0))
    stars = F.coalesce("stargazers_count", F.lit(0))
    archived = F.coalesce("archived", F.lit(False))
    busy = issues >= 10
    pushed = first_filled("pushed_at", "updated_at", F.col(ingested_at).cast("string"))

    def choose(if_archived, if_busy, otherwise):
        return F.when(archived, if_archived).when(busy, if_busy).otherwise(otherwise)

    return df.select(
        *keep,
        F.concat(F.lit("github_"), slug(name), F.lit("_"), F.substring(pushed, 1, 10)).alias("signal_id"),
        F.lit("github").alias("domain"),
        F.lit("github_api").alias("source"),
        choose("Archived repo", "Issue backlog needs attention", "Project focus window").alias("title"),
        choose("neutral", "negative", "positive").alias("direction"),
        choose(
            F.lit(2),
            F.least(F.lit(10), F.lit(4) + F.floor(issues / 5).cast("int")),
            F.when(stars > 0, 5).otherwise(4),
        ).cast("int").alias("urgency"),
        F.lit(75).alias("confidence"),
        choose(
            F.concat(name, F.lit(" is archived; keep it out of active focus decisions.")),
            F.concat(name, F.lit(" has "), issues, F.lit(" open issues; schedule focused maintenance.")),
            F.concat(name, F.lit(" is active enough to use as a career/project context signal.")),
        ).alias("summary"),
        pushed.alias("occurred_at"),
        F.col(ingested_at).alias("ingested_at"),
    )


def market_signals(
    df: DataFrame, provider: str = "fixture", ingested_at: str = "ingested_at", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Price bars (symbol, open, high, low, close, bar_time text) to signals."""
    opened = F.coalesce("open", F.lit(0.0))
    closed = F.coalesce(F.nullif(F.col("close"), F.lit(0.0)), opened)
    high = F.coalesce(F.nullif(F.col("high"), F.lit(0.0)), closed)
    low = F.coalesce(F.nullif(F.col("low"), F.lit(0.0)), closed)
    symbol = F.upper(F.coalesce("symbol", F.lit("UNKNOWN")))
    when_text = first_filled("bar_time", F.col(ingested_at).cast("string"))
    bars = df.withColumns(
        {
            "_symbol": symbol,
            "_move": percent_change(opened, closed),
            "_range": percent_change(low, high),
            "_at": when_text,
        }
    )
    move, span = F.col("_move"), F.col("_range")
    volatile = (F.abs(move) >= 2.5) | (span >= 4)

    def choose(if_volatile, if_up, otherwise):
        return F.when(volatile, if_volatile).when(move >= 0.8, if_up).otherwise(otherwise)

    return bars.select(
        *keep,
        F.concat(F.lit("market_"), slug("_symbol"), F.lit("_"), F.substring("_at", 1, 10)).alias("signal_id"),
        F.lit("market").alias("domain"),
        F.lit(provider).alias("source"),
        choose("Market volatility watch", "Positive market context", "Calm market context").alias("title"),
        choose("negative", "positive", "neutral").alias("direction"),
        choose(
            F.least(F.lit(10), F.greatest(F.lit(6), (F.abs(move) + span).try_cast("int"))), F.lit(5), F.lit(3)
        ).alias("urgency"),
        F.lit(70).alias("confidence"),
        choose(
            F.format_string(
                "%s moved %.1f%% with %.1f%% intraday range; keep trading context separate from recovery decisions.",
                "_symbol", "_move", "_range",
            ),
            F.format_string(
                "%s is up %.1f%%; useful for watchlist review, not for impulsive action.", "_symbol", "_move"
            ),
            F.format_string("%s has no large move in the latest snapshot.", "_symbol"),
        ).alias("summary"),
        F.col("_at").alias("occurred_at"),
        F.col(ingested_at).alias("ingested_at"),
    )


def recent_signals(
    df: DataFrame, n: int = 5, as_of: AsOf = None, keys: tuple[str, ...] = (), days: int = 7
) -> DataFrame:
    """Most urgent signals of the last days, overall or per key."""
    order = [F.col("urgency").desc(), F.col("confidence").desc(), F.col("occurred_at").desc(), F.col("signal_id")]
    kept = df.filter(recent("occurred_at", f"{days} days", as_of))
    return latest_by(kept, keys, order, n) if keys else kept.orderBy(*order).limit(n)


def signal_lines(df: DataFrame, keys: tuple[str, ...], n: int = 3) -> DataFrame:
    """Text of the strongest signals per key."""
    from .digests import signal_text

    order = [F.col("urgency").desc(), F.col("confidence").desc(), F.col("signal_id").asc()]
    return top_text(df, keys, order, signal_text(), n, "signal_lines")
