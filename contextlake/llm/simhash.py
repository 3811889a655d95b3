"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, stored, unpacked

BITS = 64
SEED = 42
SHINGLE_WORDS = 3
#: Shingles whose bits are counted at once.
_COUNT_AT_ONCE = 1 << 15


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 majority bits over the XXH64 of word shingles, repeats included, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(line, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = len(words) - shingle_words + 1
    hashed = xxhash.xxh64_intdigest
    pairs = zip(starts[:n].tolist(), ends[shingle_words - 1 :].tolist(), strict=True)
    hashes = np.fromiter((hashed(line[a:b], SEED) for a, b in pairs), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, _COUNT_AT_ONCE):
        part = hashes[at : at + _COUNT_AT_ONCE]
        # One column per bit, lowest first on every machine.
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > n, bitorder="little").view("<u8")
    return int(majority[0])


def fingerprints(docs: DataFrame, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``doc`` (the row as a struct), ``fp``, the fingerprint as a signed long, and ``text_hash``."""

    def work(texts: pa.Array) -> list[pa.Array]:
        whole = [t.as_py() for t in texts]
        found = np.fromiter(map(fingerprint, whole), np.uint64, len(whole))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, whole), np.uint64, len(whole))
        return [pa.array(found.view(np.int64), pa.int64()), pa.array(hashes.view(np.int64), pa.int64())]

    return map_texts(docs, work, {"fp": "long", "text_hash": "long"}, text_col, keep_text)


def ball_links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Links (``a`` < ``b``) whose components are those of "differ in ``distance`` bits or fewer".

    ``fps`` holds distinct fingerprints ``fp``. Each emits all variants within half
    the distance; two fingerprints that close share a variant. For distance 2 the
    fingerprints of a variant lie in its ball of radius 1: at most 65, all within
    2 bits of each other. So a variant's first fingerprint is linked to each of
    the others, verified, instead of all to all; no partner is lost.
    """
    if distance != 2:
        raise ValueError("balls of radius 1 prove a distance of 2")
    masks = F.concat(F.array(F.lit(0).cast("long")), F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), _bit))
    variants = fps.select("fp", F.explode(masks).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant")
    )
    groups = variants.groupBy("variant").agg(F.collect_set("fp").alias("members")).filter(F.size("members") > 1)
    first = groups.select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
    return (
        first.filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
        .distinct()
    )


def _bit(k):
    return F.call_function("shiftleft", F.lit(1).cast("long"), k)


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node its links reach. Nodes without links are absent.

    Alternates two rules until nothing changes: every node points its larger
    neighbours at its smallest one, then every node points itself and its smaller
    neighbours at the smallest. Each round at least halves long chains; a round
    is written to the shared folder, so no lineage grows. Only a count and a
    checksum of the links reach the driver.
    """
    links = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    state = None
    while True:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a0"), "m").filter("a0 <> m").distinct()
        # Now a0 > m; point a0 and its smaller neighbours at the smallest of them.
        down = large.groupBy("a0").agg(F.min("m").alias("low"))
        small = (
            large.join(down, "a0")
            .select(F.explode(F.array("a0", "m")).alias("b"), F.col("low").alias("a"))
            .filter("a <> b")
            .distinct()
        )
        links = stored(small.select("a", "b"), "links")
        now = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("check")).first()
        now = (now["n"], now["check"])
        if now == state:
            return links.select(F.col("b").alias("node"), F.col("a").alias("root"))
        state = now


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False
) -> DataFrame:
    """Each row as ``doc`` with its ``fp``, the smallest id of its component
    (``component_id``), and ``stays``, true for one row of each component.

    Fingerprints link at 2 differing bits or fewer. Equal fingerprints are one
    node, so a third of all rows with one text costs one node; the final join by
    fingerprint has one row on the small side and is split where a key is hot.
    The row that stays has the smallest id, then the smallest text hash, then the
    first place in the stored table.

    Defined cases: texts without words, null or empty, have fingerprint zero and
    link like any other. Rows with a null id belong to components but never name
    one; a component of such rows only has a null id. Repeated rows fall together.
    Empty tables give an empty result; extra columns are carried in ``doc``.
    """
    # Written once, the numbers of the rows stay what they are.
    marked = stored(
        fingerprints(docs, text_col, keep_text).withColumn("row", F.monotonically_increasing_id()), "fingerprints"
    )
    row_id = F.col(f"doc.`{id_col}`")
    rank = F.struct(row_id.isNull().alias("no_id"), row_id.alias("id"), "text_hash", "row")
    nodes = stored(marked.groupBy("fp").agg(F.min(rank).alias("first")), "fingerprint-nodes")
    roots = components(ball_links(nodes.select("fp")))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("winner"))
    names = stored(
        rooted.join(named, "root").select(
            "fp", F.col("winner.id").alias("component_id"), F.col("winner.row").alias("staying")
        ),
        "fingerprint-components",
    )
    return marked.join(names, "fp").select(
        "doc", "fp", "component_id", (F.col("row") == F.col("staying")).alias("stays")
    )


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the one that stays.

    Defined cases as in :func:`near_duplicates`: texts without words, null or empty, are one
    group; of ties and repeated rows one stays, rows with a null id last. Very long texts
    are hashed whole. An empty table gives an empty result; all columns keep their names.
    """
    found = near_duplicates(docs, id_col, text_col, keep_text=True).filter("stays")
    return unpacked(found, docs, {})
