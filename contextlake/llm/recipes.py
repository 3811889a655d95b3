"""Exact dedup by content-defined chunk recipes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, stored, whole_text

#: Bytes of the shortest and the longest chunk; on average a cut follows after 2,048 more than the shortest.
LEAST_BYTES, MOST_BYTES, CUT_BITS = 512, 16_384, 11
DIGEST_BYTES = 16
#: Bytes that decide about a cut.
_WINDOW = 32
#: Bytes of text whose cuts are looked for at once.
_BLOCK = 1 << 20
_GEAR = np.random.default_rng(12).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_candidates(text: bytes) -> np.ndarray:
    """Places at which the bytes before, and nothing else, ask for a cut.

    A gear hash of the last 32 bytes, made by doubling: a sum over 2k bytes is the sum
    over k bytes plus that of the k bytes before them, shifted by k.
    """
    data = np.frombuffer(text, np.uint8)
    found = []
    for start in range(0, len(data), _BLOCK):
        first = max(start - _WINDOW, 0)
        hashes = _GEAR[data[first : start + _BLOCK]]
        k = 1
        while k < _WINDOW:
            earlier = hashes[:-k] << np.uint32(k)
            hashes[k:] += earlier
            k *= 2
        places = np.flatnonzero(hashes >> np.uint32(32 - CUT_BITS) == 0) + first + 1
        found.append(places[places > start])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_ends(text: bytes) -> list[int]:
    """Ends of the chunks of a text; equal stretches of text soon get equal chunks again."""
    n, at, ends = len(text), 0, []
    candidates = cut_candidates(text) if n > LEAST_BYTES else np.zeros(0, np.int64)
    while at < n:
        k = int(np.searchsorted(candidates, at + LEAST_BYTES))
        wanted = int(candidates[k]) if k < len(candidates) else n
        at = min(wanted, at + MOST_BYTES, n)
        ends.append(at)
    return ends


def _chunks(text: bytes) -> Iterator[bytes]:
    at = 0
    for end in chunk_ends(text):
        yield text[at:end]
        at = end


def _digest(chunk: bytes, width: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk)[:width]


def chunk_contents(docs: DataFrame, text_col: str = "text", digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """A row (``digest``, ``chunk``) for every chunk of every text, A-Z lower-cased."""
    rows = docs.select(whole_text(f"`{text_col}`").cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            for text in batch.column(0):
                parts = list(_chunks(text.as_py().lower()))
                digests = [_digest(c, digest_bytes) for c in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array(parts, pa.binary())], names=["digest", "chunk"]
                )

    return rows.mapInArrow(run, "digest binary, chunk binary")


def recipes(
    docs: DataFrame, text_col: str = "text", digest_bytes: int = DIGEST_BYTES, with_chunks: bool = False
) -> DataFrame:
    """Each row without its text as ``doc``, its ``text_sha256`` and ``recipe``: the digests of
    its chunks in order, joined. ``with_chunks`` adds the chunks."""

    def work(texts: pa.Array) -> list[pa.Array]:
        lower = [t.as_py().lower() for t in texts]
        parts = [list(_chunks(t)) for t in lower]
        out = [
            pa.array([hashlib.sha256(t).hexdigest() for t in lower], pa.string()),
            pa.array([b"".join(_digest(c, digest_bytes) for c in p) for p in parts], pa.binary()),
        ]
        return [*out, pa.array(parts, pa.list_(pa.binary()))] if with_chunks else out

    fields = {"text_sha256": "string", "recipe": "binary"} | ({"chunks": "array<binary>"} if with_chunks else {})
    return map_texts(docs, work, fields, text_col)


def collided_digests(chunks: DataFrame) -> DataFrame:
    """Digests under which there are different chunks.

    Equal chunks meet as bytes, not as digests, and are one row before anything is
    shuffled; each different chunk moves once a map task. Digests that this does not
    return are verified: one digest is one content.
    """
    distinct = chunks.groupBy("digest", "chunk").agg(F.count(F.lit(1)).alias("times"))
    return distinct.groupBy("digest").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1").select("digest")


def _with_variants(full: DataFrame, collided: DataFrame, digest_bytes: int) -> DataFrame:
    """``variants`` of each row: place and number of every chunk whose digest has several contents."""
    placed = full.select("row", "recipe", F.posexplode("chunks").alias("place", "chunk")).select(
        "row",
        "place",
        F.expr(f"substring(recipe, place * {digest_bytes} + 1, {digest_bytes})").alias("digest"),
        "chunk",
    )
    placed = placed.join(collided, "digest", "left_semi")
    order = Window.partitionBy("digest").orderBy("chunk")
    numbered = placed.select("digest", "chunk").distinct().withColumn("number", F.row_number().over(order))
    listed = (
        placed.join(numbered, ["digest", "chunk"])
        .groupBy("row")
        .agg(F.to_json(F.array_sort(F.collect_list(F.struct("place", "number")))).alias("variants"))
    )
    return full.drop("chunks").join(listed, "row", "left").withColumn("variants", F.coalesce("variants", F.lit("")))


def identified(docs: DataFrame, text_col: str = "text", digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """Rows whose (``recipe``, ``variants``) are equal exactly where their texts are.

    Chunks become verified identifiers: a digest alone where all its chunks are equal, else
    the digest and the number of the content among those of its digest. ``variants`` holds
    these numbers; it is empty as long as no two chunks share a digest by chance.
    """
    collided = stored(collided_digests(chunk_contents(docs, text_col, digest_bytes)), "collided-digests")
    if collided.isEmpty():
        plain = recipes(docs, text_col, digest_bytes).withColumn("row", F.monotonically_increasing_id())
        return stored(plain.withColumn("variants", F.lit("")), "recipes")
    full = recipes(docs, text_col, digest_bytes, with_chunks=True).withColumn("row", F.monotonically_increasing_id())
    return stored(_with_variants(stored(full, "recipes-with-chunks"), collided, digest_bytes), "recipes")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = DIGEST_BYTES
) -> DataFrame:
    """Groups of rows with equal texts, A-Z lower-cased: ``doc`` (the row without its text),
    ``keep_id`` (the largest id of the group), ``group_size``, ``kept`` and ``text_sha256``.

    Texts are cut where their content says so, chunks are deduplicated to verified
    identifiers and rows compared by their ordered identifiers: some 16 bytes for every
    2,500 of text. No text moves as a whole, and a chunk that many rows share
    moves once a task. Groups are counted before they are shuffled; the result is joined
    to the rows with one row per group on the other side, so a hot group can be split.

    Defined cases: null counts as empty; empty texts are one group with an empty recipe.
    Rows with a null id stay behind all others; a group of only such rows has a null
    ``keep_id``. Of repeated rows with the largest id one stays. Texts of any length are cut
    block by block. An empty table gives an empty result; extra columns stay in ``doc``.
    """
    rows = identified(docs, text_col, digest_bytes)
    row_id = F.col(f"doc.`{id_col}`")
    rank = F.struct(row_id.isNotNull().alias("known"), row_id.alias("id"), (-F.col("row")).alias("first"))
    found = (
        rows.groupBy("recipe", "variants")
        .agg(F.max(rank).alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select("recipe", "variants", "group_size", F.col("best.id").alias("keep_id"), (-F.col("best.first")).alias("staying"))
    )
    # As a table of their own the groups are dealt anew for the join, which can then split a hot one.
    groups = stored(found, "recipe-groups")
    return rows.join(groups, ["recipe", "variants"]).select(
        "doc", "keep_id", "group_size", (F.col("row") == F.col("staying")).alias("kept"), "text_sha256"
    )
