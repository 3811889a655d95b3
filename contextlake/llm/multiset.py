"""Document fingerprints: a homomorphic multiset hash over paragraphs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let, packed, whole_text

#: A paragraph ends at a line feed or, inside a line, after a sentence.
PARAGRAPH_END = "(?<=[.!?])[\\x20\\t]+|\\n"
#: A longer paragraph counts as its pieces of so many characters.
MOST_CHARS = 200
#: Words of the vector are sums modulo 2^48. A lane has a word of its own, so no count of paragraphs overflows it.
MODULUS_BITS = 48
_MASK = (1 << MODULUS_BITS) - 1
HASHES = 2
#: Lanes are added up in pairs, 32 bits each; a text has fewer than 2^31 paragraphs.
PAIRS = 24
_PAIR = 1 | 1 << 32
_LOW = (1 << 32) - 1
#: Rows of the ordered table that one block holds on average, and the most blocks.
BLOCK_ROWS = 500
MOST_BLOCKS = 1 << 16
_NULL_BLOCKS = 64


def multiset_hash(text: Column) -> Column:
    """The text's vector (array of longs): number of paragraphs, then for each hash its full sum and its lane sums.

    Every paragraph adds a vector made of its hashes; all sums are modulo 2^48.
    The order of paragraphs is lost, so equal multisets give equal vectors.
    """
    return let(paragraphs(text), lambda p: F.concat(F.array(F.size(p).cast("long")), *[_vector(p, seed) for seed in range(HASHES)]))


def paragraphs(text: Column) -> Column:
    """The units that are hashed; empty ones are none."""
    cut = F.transform(
        F.filter(F.split(text, PARAGRAPH_END, -1), lambda p: p != ""),
        lambda p: F.when(F.length(p) <= MOST_CHARS, F.array(p)).otherwise(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.length(p) - 1) / MOST_CHARS).cast("int")),
                lambda k: F.substring(p, k * MOST_CHARS + 1, F.lit(MOST_CHARS)),
            )
        ),
    )
    return F.flatten(cut)


def _vector(parts: Column, seed: int) -> Column:
    def sums(hashes: Column) -> Column:
        def pair(j: Column) -> Column:
            return F.aggregate(
                hashes,
                F.lit(0).cast("long"),
                lambda acc, h: acc + F.call_function("shiftrightunsigned", h, j).bitwiseAND(F.lit(_PAIR)),
            )

        pairs = F.transform(F.sequence(F.lit(0), F.lit(PAIRS - 1)), pair)
        return F.concat(
            F.array(_sum(hashes)),
            F.flatten(F.transform(pairs, lambda w: F.array(w.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(w, 32)))),
        )

    return let(F.transform(parts, lambda p: F.xxhash64(p, F.lit(seed))), sums)


def _sum(hashes: Column) -> Column:
    return F.aggregate(
        hashes, F.lit(0).cast("long"), lambda acc, h: (acc + h.bitwiseAND(F.lit(_MASK))).bitwiseAND(F.lit(_MASK))
    )


def add(a: Column, b: Column) -> Column:
    """Fingerprint vector after inserting the paragraphs of ``b``."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(_MASK)))


def remove(a: Column, b: Column) -> Column:
    """Fingerprint vector after deleting the paragraphs of ``b``."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(_MASK)))


def to_hex(vector: Column) -> Column:
    """Fixed-width lower-case hex text of a vector."""
    return F.lower(F.array_join(F.transform(vector, lambda w: F.lpad(F.hex(w), MODULUS_BITS // 4, "0")), ""))


def lanes(vector: Column) -> Column:
    """Signed lanes: each paragraph counts +1 or -1 in each, by one bit of its hashes."""
    return let(vector, _lanes)


def _lanes(vector: Column) -> Column:
    def signed(word: Column) -> Column:
        return F.shiftright(F.shiftleft(word, 64 - MODULUS_BITS), 64 - MODULUS_BITS)

    counts = F.concat(*[F.slice(vector, 3 + seed * (2 * PAIRS + 1), 2 * PAIRS) for seed in range(HASHES)])
    return let(signed(F.element_at(vector, 1)), lambda n: F.transform(counts, lambda x: 2 * signed(x) - n))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from two vectors: twice the paragraphs in common over all paragraphs.

    Products of signed lanes estimate how many paragraphs two multisets share.
    Equal vectors give 1, two empty texts too, an empty and another text 0.
    """
    pairs = F.arrays_zip(lanes(a).alias("x"), lanes(b).alias("y"))
    # In doubles: squares of lanes of very long texts do not fit a long.
    pairs = F.transform(pairs, lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))
    zero = F.struct(F.lit(0.0).alias("xy"), F.lit(0.0).alias("xx"))
    sums = F.aggregate(
        pairs,
        zero,
        lambda acc, p: F.struct(
            (acc["xy"] + p["x"] * p["y"]).alias("xy"),
            (acc["xx"] + p["x"] * p["x"] + p["y"] * p["y"]).alias("xx"),
        ),
        lambda acc: F.when(
            acc["xx"] > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * acc["xy"] / acc["xx"]))
        ).otherwise(F.lit(0.0)),
    )
    return F.when(a == b, F.lit(1.0)).otherwise(sums)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row (``doc``, without its text) with its ``text`` and ``next_text``, that of the next id; after the last, the first.

    Quantiles of the ids cut the order into blocks; a block is one window. The
    first row of every block is also given to the block before, so no row looks
    beyond its block. One shuffle carries the texts. Only the quantiles and the
    first keys of the blocks, a bounded number, pass through the driver.
    """
    n = docs.count()
    blocks = max(1, min(MOST_BLOCKS, math.ceil(n / BLOCK_ROWS)))
    row_id = F.col("doc").getField(id_col)
    rows = (
        packed(docs)
        .select(
            F.col("doc").dropFields(f"`{text_col}`").alias("doc") if len(docs.columns) > 1 else "doc",
            row_id.alias("id"),
            whole_text(f"doc.`{text_col}`").alias("text"),
        )
        .withColumn("text_hash", F.xxhash64("text"))
    )
    cuts = (
        docs.select(F.percentile_approx(f"`{id_col}`", [k / blocks for k in range(1, blocks)] or [0.5], max(10_000, 10 * blocks)))
        .first()[0]
        or []
    )
    cuts = sorted(set(cuts))
    # Binary search for the number of cuts at or below the id.
    steps = [1 << k for k in reversed(range(max(1, len(cuts)).bit_length()))]
    bounds = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array(F.lit(0)).cast("array<bigint>")
    place = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(cuts)) & (F.get(bounds, at + step - 1) <= F.col("id")), at + step
        ).otherwise(at),
    )
    # Rows without id come last, in blocks by the hash of their text.
    null_place = F.lit(len(cuts) + 1) + F.shiftrightunsigned(F.col("text_hash").bitwiseXOR(F.lit(-(1 << 63))), 58).cast("int")
    rows = rows.withColumn("block", F.when(F.col("id").isNull(), null_place).otherwise(place))
    key = F.struct(F.col("id").isNull().alias("no_id"), "id", F.col("text_hash"))
    firsts = sorted(rows.groupBy("block").agg(F.min(key).alias("first")).collect(), key=lambda r: r["block"])
    count = len(cuts) + 1 + _NULL_BLOCKS
    before, ids, hashes = [-1] * count, [None] * count, [None] * count
    for k, r in enumerate(firsts):
        before[r["block"]] = firsts[k - 1]["block"]
        ids[r["block"]], hashes[r["block"]] = r["first"]["id"], r["first"]["text_hash"]
    at = F.col("block")
    is_first = F.get(_literal(ids), at).eqNullSafe(F.col("id")) & (F.get(_literal(hashes), at) == F.col("text_hash"))
    here = F.struct(at.alias("block"), F.lit(False).alias("guest"))
    there = F.struct(F.get(_literal(before), at).cast("int").alias("block"), F.lit(True).alias("guest"))
    placed = rows.select(
        "doc", "id", "text", "text_hash", F.explode(F.when(is_first, F.array(here, there)).otherwise(F.array(here))).alias("in")
    )
    order = W.partitionBy("in.block").orderBy("in.guest", F.col("id").asc_nulls_last(), "text_hash")
    return (
        placed.withColumn("next_text", F.lead("text").over(order))
        .filter(~F.col("in.guest"))
        .select("doc", "text", "next_text")
    )


def _literal(values: list[int | None]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc`` with ``n_chars``, the ``vector`` of the text, the ``edited`` text, its ``edited_vector``
    and the ``next_vector``.

    The edited text replaces the last quarter of the code points by the start of
    the next document (all of it if it is shorter).

    Defined cases: a null text is empty; an empty text has the zero vector. The
    order is by id, equal ids by the hash of the text, null ids last; ids are
    numbers. Equal rows are each other's next document. A single document is its
    own next. An empty table gives an empty result. Extra columns stay in ``doc``.
    """
    edited = F.concat(
        F.expr("left(text, length(text) - int(floor(length(text) / 4)))"),
        F.expr("left(next_text, int(floor(length(text) / 4)))"),
    )
    return (
        with_next(docs, id_col, text_col)
        .withColumn("edited", edited)
        .select(
            "doc",
            F.length("text").cast("long").alias("n_chars"),
            "edited",
            multiset_hash(F.col("text")).alias("vector"),
            multiset_hash(F.col("edited")).alias("edited_vector"),
            multiset_hash(F.col("next_text")).alias("next_vector"),
        )
    )
