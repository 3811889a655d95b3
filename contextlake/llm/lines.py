"""Line dedup: lines that many documents share stay in one of them only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, packed, stored, whole_text


def drop_shared_lines(
    docs: DataFrame,
    min_chars: int = 20,
    min_docs: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Drop lines whose key is found in ``min_docs`` documents or more.

    A key is the line without white space at its ends, A-Z lower-cased. The
    document with the largest id keeps all its lines of a key. Returns ``doc``
    (the whole input row as a struct), ``n_lines``, ``n_dropped``, ``kept_text``.

    Only hashes travel: distinct (key hash, id) pairs are counted after a
    map-side distinct, and the hashes over the threshold are written to the
    shared folder. A line in a third of all documents is one row there; the
    join that brings dropped positions back is split where a key is hot.

    Defined cases: a null or empty text is one empty line. Rows that repeat an
    id are one document: they count once and keep or lose the same keys. Rows
    without an id count nowhere and keep all their lines. An empty table gives
    an empty result. Extra columns are carried inside ``doc`` whatever their names.
    """
    rows = packed(docs).select(
        "doc", F.col("doc").getField(id_col).alias("id"), whole_text(f"doc.`{text_col}`").alias("text")
    )
    # Rows of one id with different texts are told apart by the hash of the text.
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    lines = (
        rows.filter(F.col("id").isNotNull())
        .select("id", "text_hash", F.posexplode(F.split(ascii_lower(F.col("text")), "\n", -1)).alias("pos", "line"))
        .select("id", "text_hash", "pos", F.btrim("line", F.lit(BLANKS)).alias("key"))
        .filter(F.length("key") >= min_chars)
        .select("id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    shared = stored(
        lines.groupBy("h1", "h2", "id")
        .agg(F.count(F.lit(1)).alias("lines"))
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "keeper"),
        "shared-lines",
    )
    dropped = (
        lines.join(shared, ["h1", "h2"])
        .filter(F.col("id") != F.col("keeper"))
        .groupBy("id", "text_hash")
        .agg(F.sort_array(F.collect_set(F.col("pos") + 1)).alias("at"))
    )
    joined = rows.join(dropped, ["id", "text_hash"], "left")
    all_lines = F.split("text", "\n", -1)
    # Slices between dropped positions, so that a long document costs its length once.
    kept = F.flatten(
        F.zip_with(
            F.concat(F.array(F.lit(0)), "at"),
            F.concat("at", F.array(F.size("lines") + 1)),
            lambda before, after: F.slice("lines", before + 1, after - before - 1),
        )
    )
    return joined.withColumn("lines", all_lines).select(
        "doc",
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("at").isNull(), 0).otherwise(F.size("at")).cast("long").alias("n_dropped"),
        F.when(F.col("at").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )

