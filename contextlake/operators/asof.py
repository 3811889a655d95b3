"""What was known at a moment: the last earlier row of another table, key by key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY = timedelta(days=1)


def known_then(
    moments: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    at: str,
    since: str,
    tie: Sequence[str] = (),
    inclusive: bool = True,
    chunk: timedelta = DAY,
    name: str = "known",
) -> DataFrame:
    """Rows of ``moments`` with ``name``, the newest row of ``facts`` of their key up to then, as a struct.

    A fact counts from its ``since`` on (after it, without ``inclusive``); of facts of one
    moment the last by ``tie`` counts. It is null where no fact was known.

    Both sides are stacked and sorted by time within a key and a ``chunk`` of time, so a key
    with most of the rows is spread over as many tasks as it has chunks. What a chunk knows
    from those before it is carried over through one row per key and chunk. No moment
    meets more than one fact, and there is no join by range.

    Null keys know nothing, nor do moments without a time; facts without a time are never
    known. Repeated moments stay repeated. Columns of both sides may have equal names.
    """
    width = int(chunk.total_seconds() * 1_000_000)

    def staged(df: DataFrame, time: str, is_fact: bool) -> DataFrame:
        whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        micros = F.unix_micros(F.col(f"`{time}`").cast("timestamp"))
        return df.select(
            *[F.col(f"`{k}`").alias(f"key_{i}") for i, k in enumerate(keys)],
            micros.alias("micros"),
            F.floor(micros / width).alias("chunk"),
            # At one moment facts come before the question if they count, else after it.
            F.lit(is_fact != inclusive).alias("late"),
            whole.alias("fact" if is_fact else "moment"),
        )

    found = staged(facts, since, True).filter("micros IS NOT NULL")
    asked = staged(moments, at, False)
    by = [f"key_{i}" for i in range(len(keys))]
    no_fact, no_moment = F.lit(None).cast(found.schema["fact"].dataType), F.lit(None).cast(asked.schema["moment"].dataType)
    columns = [*by, "micros", "chunk", "late", "moment", "fact"]
    stacked = asked.withColumn("fact", no_fact).select(*columns).unionByName(found.withColumn("moment", no_moment).select(*columns))
    order: list[Column] = [F.col("micros"), F.col("late"), *[F.col(f"fact.`{c}`") for c in tie]]
    inside = W.partitionBy(*by, "chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = stacked.withColumn("inside", F.last("fact", ignorenulls=True).over(inside)).filter("moment IS NOT NULL")
    rank = F.struct("micros", *[F.col(f"fact.`{c}`") for c in tie])
    # A row for every chunk of either side; the ranks of moments are null and never the greatest.
    ends = stacked.groupBy(*by, "chunk").agg(F.max_by("fact", F.when(F.col("fact").isNotNull(), rank)).alias("last"))
    along = W.partitionBy(*by).orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col("chunk").alias("_chunk"),
        F.last("last", ignorenulls=True).over(along).alias("carried"),
    )
    same = [F.col(c) == F.col(f"_{c}") for c in [*by, "chunk"]]
    joined = seen.join(carried, reduce(lambda a, b: a & b, same), "left")
    nothing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in [*by, "micros"]])
    known = F.when(~nothing, F.coalesce("inside", "carried"))
    return joined.select("moment.*", known.alias(name))

