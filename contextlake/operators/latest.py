"""Latest-row, top-k, share and time-travel operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import col


def latest_by(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], k: int = 1
) -> DataFrame:
    """First ``k`` rows per key in the given order.

    The rank filter becomes a window group limit, so every map task ships at
    most ``k`` rows per key and a hot key costs no more than any other.
    ``order_by`` must end in a unique column for a repeatable answer.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def latest_values(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], version: str, latest_name: str
) -> DataFrame:
    """Last non-null value of each column per key (values may come from different rows)."""
    picks = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(version))).alias(c) for c in values
    ]
    return df.groupBy(*keys).agg(*picks, F.max(version).alias(latest_name))


def keep_latest(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Replacing-table semantics: the row with the highest version per key."""
    return latest_by(df, keys, [F.col(c).desc() for c in version])


def state_as_of(
    log: DataFrame, keys: Sequence[str], version: Sequence[str], ts: str, as_of: Column
) -> DataFrame:
    """Table state at a moment, rebuilt from an append log."""
    return keep_latest(log.filter(col(ts) <= as_of), keys, version)


def share(df: DataFrame, keys: Sequence[str], count_name: str, digits: int = 4) -> DataFrame:
    """Rows per key and their share of the total.

    The total is a scalar subquery over the grouped rows, so no window without
    partitions pulls the groups into one task.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
    total = counts.agg(F.sum(count_name)).scalar()
    return counts.withColumn(
        "share", F.round(F.col(count_name).cast("double") / total.cast("double"), digits)
    )


def top_n(df: DataFrame, order_by: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def top_text(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], text: Column, n: int, name: str
) -> DataFrame:
    """Newline-joined text of the first ``n`` rows per key."""
    ranked = (
        df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order_by)))
        .filter(F.col("_rank") <= n)
        .withColumn("_text", text)
    )
    rows = F.array_sort(F.collect_list(F.struct("_rank", "_text")))
    return ranked.groupBy(*keys).agg(
        F.concat_ws("\n", F.transform(rows, lambda r: r["_text"])).alias(name)
    )
