"""Mixing sources to target weights: exact budgets over hash-random document orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import unpacked, whole_text, word_count

#: Documents of a block on average at most; a block is sorted and summed in one task.
BLOCK_ROWS = 65_536


def source_targets(sizes: DataFrame, weights: Sequence[int], most_repeats: int) -> DataFrame:
    """One row per source (``g``, ``source_size``): its target in words.

    Sources in code point order, null last, take the weights in turn. A target
    stops at ``most_repeats`` times the size; the excess goes to the others by
    weight until none is above. Sorting by size per weight makes the stopped
    sources a prefix, so running sums find the level without iterating.

    The running sums hold all sources, one row each, in one task; no limit on
    their number is checked.
    """
    everything = W.orderBy("g")
    filling = W.orderBy("level", "g")
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    rank = F.row_number().over(everything) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights)) + 1)
    return (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * most_repeats)
        .withColumn("level", F.col("cap") / F.col("weight"))
        .withColumn("rest", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("rest_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("open", F.col("cap") * F.col("rest_weight") > F.col("weight") * F.col("rest"))
        # The first source below its stop sets the level for itself and all after it.
        .withColumn("first", F.min(F.when(F.col("open"), F.struct("level", "g", "rest", "rest_weight"))).over(whole))
        .withColumn(
            "target",
            F.when(
                F.col("first").isNotNull() & (F.struct("level", "g") >= F.struct("first.level", "first.g")),
                (F.col("weight") * F.col("first.rest")).cast("double") / F.col("first.rest_weight"),
            ).otherwise(F.col("cap").cast("double")),
        )
        .select("g", "source_size", "target")
    )


def block_digits(rows: int, block_rows: int = BLOCK_ROWS) -> int:
    """Hex digits of a key that name a block: 4,096 blocks a source, more for many rows."""
    digits = 3
    while rows > block_rows * 16**digits:
        digits += 1
    return digits


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    most_repeats: int = 3,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep_text: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """How many words of each document a mix with the given source weights takes.

    Every document gets a random key, the MD5 of seed, id and text. Its first
    digits range-partition each source into blocks in key order; block sums give
    each block its start, and a running sum inside the block the start of every
    document. A source is taken whole as often as its budget holds it; the rest
    of the budget cuts the key order at an exact word. Texts are hashed and counted where
    they are read and only moved with ``keep_text``. Returns ``doc`` (the row
    as a struct, without its text unless ``keep_text``), ``size``, ``source_size``, ``target``, ``copies`` (whole
    repeats), ``part`` (words of one more repeat, the size itself for a whole
    one), ``taken`` = copies * size + part.

    The sum of ``taken`` over a source is its target rounded down. Reruns agree:
    nothing depends on partitioning. A source with a third of all rows is spread over 4,096
    blocks, and over more when blocks would have more than ``block_rows`` rows; no block or
    source is gathered, sums stream.

    Defined cases: a null text has size 0, and nothing is taken from it. A null
    source is a source of its own, ordered last; the empty name is another one.
    Repeated rows are separate documents; equal rows are interchangeable. A null
    id takes part through its text. An empty table gives an empty result.
    """
    text = whole_text(f"`{text_col}`")
    source = F.col(f"`{source_col}`").cast("string")
    row_id = F.col(f"`{id_col}`").cast("string")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id, F.lit("null")), F.lit(":"), F.md5(text)))
    columns = [c for c in docs.columns if keep_text or c != text_col]
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
        # Names sort by code point; the prefix puts the null source after all.
        F.coalesce(F.concat(F.lit("0"), source), F.lit("1")).alias("g"),
        key.alias("key"),
        word_count(text).alias("size"),
    ).withColumn("block", F.substring("key", 1, block_digits(docs.count(), block_rows)))
    blocks = sized.groupBy("g", "block").agg(F.sum("size").alias("block_size"))
    targets = source_targets(
        blocks.groupBy("g").agg(F.sum("block_size").alias("source_size")), weights, most_repeats
    ).withColumnRenamed("g", "source_key")
    starts = blocks.withColumn(
        "start",
        F.sum("block_size").over(W.partitionBy("g").orderBy("block")) - F.col("block_size"),
    )
    plan = starts.join(targets, F.col("g") == F.col("source_key")).select(
        "g", "block", "start", "source_size", "target"
    )
    inside = W.partitionBy("g", "block").orderBy("key", "size").rowsBetween(W.unboundedPreceding, -1)
    budget = F.floor("target").cast("long")
    return (
        sized.join(plan, ["g", "block"])
        .withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .withColumn("copies", F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0).cast("long"))
        .withColumn("rest", budget - F.col("copies") * F.col("source_size"))
        .withColumn("part", F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("before"))).cast("long"))
        .select(
            "doc", "size", "source_size", "target", "copies", "part",
            (F.col("copies") * F.col("size") + F.col("part")).alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of ``docs``.

    A document appears once for every whole repeat; the one at the cut of its
    source appears once more with its first ``part`` words, white space as it was.

    Defined cases as in :func:`mix_sources`: null and empty texts have no words and are never
    taken. Repeated rows and ties of the key are separate documents. Very long texts are cut
    without recursion. Rows with a null id or source take part. An empty table gives an
    empty result; extra columns are carried, whatever their names.
    """
    text_col = options.get("text_col", "text")
    mixed = mix_sources(docs, keep_text=True, **options)
    text = F.col("doc").getField(text_col)
    repeats = F.when(F.col("copies") > 0, F.array_repeat(F.lit(-1).cast("long"), F.col("copies").cast("int"))).otherwise(
        F.array().cast("array<bigint>")
    )
    extra = F.when(F.col("part") > 0, F.array(F.col("part"))).otherwise(F.array().cast("array<bigint>"))
    one = mixed.select("doc", "size", F.explode(F.concat(repeats, extra)).alias("take"))
    # Possessive, so that the matcher neither recurses nor backtracks on a long text.
    first_words = F.concat(F.lit("^(?:[\\x20\\x09-\\x0D]*+[^\\x20\\x09-\\x0D]++){"), "take", F.lit("}+"))
    cut = F.call_function("regexp_extract", text, first_words, F.lit(0))
    whole = (F.col("take") < 0) | (F.col("take") >= F.col("size"))
    return unpacked(one, docs, {text_col: F.when(whole, text).otherwise(cut)})
