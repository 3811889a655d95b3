"""Substring dedup: fixed-block anchors found by rolling windows, extended to exact repeats."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import work_dir
from .common import whole_text

WINDOW_WORDS = 13
#: Text bytes that a task works on at once; a longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20
#: Bits of an anchor's hash that travel, besides those that name its bucket, and its two flags.
ANCHOR_BITS = 38
_IS_BLOCK, _IS_SEVERAL = np.uint64(1), np.uint64(2)
_ODD = np.random.default_rng(13).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


# --- Chunks -----------------------------------------------------------------------------------


def _chunked(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> DataFrame:
    """One row per chunk of documents: ``chunk``, ``docs``, ``ids``, ``lengths``, ``texts`` (Zstandard).

    Made where the rows are read, without a shuffle. The table is bucketed by
    ``chunk`` in the shared folder, so that later joins move the other side only. Its
    name leaves the catalog at once: the frame knows its files.
    """
    columns = [c for c in docs.columns if c != text_col]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        whole_text(f"`{text_col}`").cast("binary").alias("text"),
    )

    def chunk(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        texts = [t.as_py() for t in table.column("text")]
        one = pa.array([0, len(texts)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([int.from_bytes(os.urandom(8), "little") >> 1], pa.int64()),
                pa.ListArray.from_arrays(one, _flat(table.column("doc"))),
                pa.ListArray.from_arrays(one, _flat(table.column("id"))),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                pa.array([pa.compress(b"".join(texts), codec="zstd", asbytes=True)], pa.binary()),
            ],
            names=["chunk", "docs", "ids", "lengths", "texts"],
        )

    def run(batches):
        held, size = [], 0
        for batch in batches:
            lengths = [len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(2)]
            start = 0
            for k, n in enumerate(lengths):
                if size and size + n > chunk_bytes:
                    held.append(batch.slice(start, k - start))
                    yield chunk([p for p in held if p.num_rows])
                    held, size, start = [], 0, k
                size += n + 8  # empty texts need room as well
            held.append(batch.slice(start))
        held = [p for p in held if p.num_rows]
        if held:
            yield chunk(held)

    kind = rows.schema["doc"].dataType.simpleString()
    schema = f"chunk long, docs array<{kind}>, ids array<bigint>, lengths array<bigint>, texts binary"
    spark = docs.sparkSession
    name, path = f"text_chunks_{uuid.uuid4().hex}", work_dir(spark, "text-chunks")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows.mapInArrow(run, schema).write.bucketBy(buckets, "chunk").option("path", path).option(
        "compression", "uncompressed"
    ).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, one chunk in Python at a time."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks)


class Words:
    """Words of a chunk in one row of arrays; windows never reach across documents."""

    def __init__(self, row: dict, window: int, keep_words: bool = False) -> None:
        self.window, self.block = window, (window + 1) // 2
        size = sum(row["lengths"])
        text = pa.decompress(row["texts"], size, codec="zstd", asbytes=True) if size else b""
        self.ids = row["ids"]
        self.words: list[list[bytes]] = []
        hashed, at = [], 0
        counts = np.zeros(len(self.ids), np.int64)
        for k, n in enumerate(row["lengths"]):
            words = text[at : at + n].split()
            at += n
            if keep_words:
                self.words.append(words)
            # Texts without a whole window, or without an id, neither give nor meet repeats.
            if len(words) >= window and self.ids[k] is not None:
                counts[k] = len(words)
                hashed.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        self.counts = counts
        self.hashes = np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)
        del hashed, text
        self.starts = np.cumsum(counts) - counts
        # Four bytes hold any place in a chunk.
        self.doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        self.place = np.arange(len(self.hashes), dtype=np.int32) - self.starts.astype(np.int32)[self.doc]
        self.left = counts.astype(np.int32)[self.doc] - self.place

    def rolling(self, words: int, seed: int) -> np.ndarray:
        """A hash of the ``words`` words from each word on; only valid inside a document."""
        n = max(len(self.hashes) - words + 1, 0)
        out = np.zeros(len(self.hashes), np.uint64)
        for k in range(words):
            out[:n] += self.hashes[k : k + n] * _ODD[seed + k]
        out ^= out >> np.uint64(32)
        out *= _ODD[63]
        out ^= out >> np.uint64(29)
        return out

    def anchors(self, bits: int) -> np.ndarray:
        """Leading bits of the hash of a block's length of words, from each word on."""
        return self.rolling(self.block, 0) >> np.uint64(64 - bits - ANCHOR_BITS)

    @property
    def has_block(self) -> np.ndarray:
        return self.left >= self.block


# --- Step 1: which anchors are repeated -------------------------------------------------------


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs."""
    ranked = np.sort(values)
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
    return ranked[first], np.diff(np.append(first, len(ranked)))


def _anchor_messages(table: DataFrame, window: int, bits: int) -> DataFrame:
    """Per chunk and bucket: the distinct anchors of all rolling windows, five bytes each.

    The lowest bits say whether one of them is a fixed block (its place in its
    document is a multiple of the block length) and whether the chunk has several.
    """

    def run(batches):
        for batch in batches:
            for row in _each(batch):
                words = Words(row, window)
                anchors = words.anchors(bits)
                seen, times = _distinct(anchors[words.has_block])
                blocks = anchors[words.has_block & (words.place % words.block == 0)]
                entries = seen << np.uint64(2)
                entries[np.searchsorted(seen, np.unique(blocks))] |= _IS_BLOCK
                entries[times > 1] |= _IS_SEVERAL
                yield _by_bucket(row["chunk"], seen >> np.uint64(ANCHOR_BITS), _as_bytes(entries, 5), 5)

    return table.select("chunk", "ids", "lengths", "texts").mapInArrow(run, "bucket int, chunk long, entries binary")


def _as_bytes(values: np.ndarray, width: int) -> bytes:
    """The low bytes; what they drop is the bucket."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _from_bytes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").reshape(-1).astype(np.uint64)


def _by_bucket(chunk: int, buckets: np.ndarray, data: bytes, width: int) -> pa.RecordBatch:
    """Messages of one chunk: the entries are in bucket order."""
    names, first = np.unique(buckets, return_index=True)
    ends = np.append(first[1:], len(buckets))[: len(first)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names.astype(np.int32), pa.int32()),
            pa.array([chunk] * len(names), pa.int64()),
            pa.array([data[a * width : b * width] for a, b in zip(first, ends, strict=True)], pa.binary()),
        ],
        names=["bucket", "chunk", "entries"],
    )


_REPLY = "chunk long, bucket int, bits binary, more binary"


def _repeated_anchors(messages: DataFrame) -> DataFrame:
    """Answers to the messages, bit by bit in their order: ``bits``, repeated at all; ``more``,
    repeated and a fixed block somewhere."""

    def run(group: pa.Table) -> pa.Table:
        parts = [_from_bytes(e, 5) & np.uint64((1 << (ANCHOR_BITS + 2)) - 1) for e in group.column("entries").to_pylist()]
        ranked = np.sort(np.concatenate(parts))
        values = ranked >> np.uint64(2)
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        flags = np.bitwise_or.reduceat(ranked, first)
        times = np.diff(np.append(first, len(ranked)))
        repeated = (times > 1) | ((flags & _IS_SEVERAL) > 0)
        found = values[first][repeated]
        blocks = values[first][repeated & ((flags & _IS_BLOCK) > 0)]
        return _answers(group, [(_within(p >> np.uint64(2), found), _within(p >> np.uint64(2), blocks)) for p in parts])

    return messages.groupBy("bucket").applyInArrow(run, _REPLY)


def _within(values: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    if not len(ranked):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ranked, values), len(ranked) - 1)
    return ranked[at] == values


def _answers(group: pa.Table, pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    """Only chunks with a set bit get an answer."""
    some = [k for k, (a, _) in enumerate(pairs) if a.any()]
    rows = pa.array(some, pa.int64())
    return pa.table(
        {
            "chunk": group.column("chunk").take(rows),
            "bucket": group.column("bucket").take(rows),
            "bits": pa.array([np.packbits(pairs[k][0]).tobytes() for k in some], pa.binary()),
            "more": pa.array([np.packbits(pairs[k][1]).tobytes() for k in some], pa.binary()),
        }
    )


def _unanswer(buckets: np.ndarray, replies: list[dict] | None, field: str) -> np.ndarray:
    """The bits of a chunk's entries, in their order; false where no answer came."""
    out = np.zeros(len(buckets), bool)
    for reply in replies or []:
        a, b = np.searchsorted(buckets, [reply["bucket"], reply["bucket"] + 1])
        out[a:b] = np.unpackbits(np.frombuffer(reply[field], np.uint8), count=b - a).astype(bool)
    return out


# --- Step 2: extend anchors to windows that are repeated as a whole ---------------------------

_KEY = np.dtype([("high", "<u8"), ("low", "<u2"), ("doc", "<i8")])


class Candidates:
    """Windows of a chunk that may stand elsewhere: every anchor in them is repeated,
    and one of them is a fixed block somewhere."""

    def __init__(self, words: Words, bits: int, replies: list[dict] | None) -> None:
        anchors = words.anchors(bits)
        seen, _ = _distinct(anchors[words.has_block])
        buckets = seen >> np.uint64(ANCHOR_BITS)
        repeated = _within(anchors, seen[_unanswer(buckets, replies, "bits")]) & words.has_block
        blocks = _within(anchors, seen[_unanswer(buckets, replies, "more")]) & words.has_block
        inside = words.window - words.block + 1
        self.at = np.flatnonzero(
            (words.left >= words.window) & (_ahead(repeated, inside) == inside) & (_ahead(blocks, inside) > 0)
        )
        high = words.rolling(words.window, 16)[self.at]
        low = (words.rolling(words.window, 32)[self.at] >> np.uint64(48)).astype("<u2")
        ids = np.array([-1 if i is None else i for i in words.ids], np.int64)
        self.doc = ids[words.doc[self.at]]
        order = np.lexsort((self.doc, low, high))
        high, low, doc = high[order], low[order], self.doc[order]
        new = np.ones(len(order), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        #: Which entry each window belongs to; an entry holds the smallest id of its windows.
        self.entry = np.zeros(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.entries = np.zeros(int(new.sum()), _KEY)
        self.entries["high"], self.entries["low"], self.entries["doc"] = high[new], low[new], doc[new]

    def buckets(self, bits: int) -> np.ndarray:
        return self.entries["high"] >> np.uint64(64 - bits)


def _ahead(flags: np.ndarray, n: int) -> np.ndarray:
    """How many of the ``n`` flags from each place on are set."""
    total = np.zeros(len(flags) + n, np.int32)
    np.cumsum(flags, out=total[1 : len(flags) + 1])
    total[len(flags) + 1 :] = total[len(flags)]
    return total[n:] - total[:-n]


def _window_messages(joined: DataFrame, window: int, bits: int) -> DataFrame:
    """Per chunk and bucket: the distinct candidate windows with their smallest id."""

    def run(batches):
        for batch in batches:
            for row in _each(batch):
                found = Candidates(Words(row, window), bits, row["anchors"])
                yield _by_bucket(row["chunk"], found.buckets(bits), found.entries.tobytes(), _KEY.itemsize)

    return joined.select("chunk", "ids", "lengths", "texts", "anchors").mapInArrow(
        run, "bucket int, chunk long, entries binary"
    )


def _earlier_windows(messages: DataFrame) -> DataFrame:
    """Answers: does a document with a smaller id than the chunk's smallest have the window?"""

    def run(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(e, _KEY) for e in group.column("entries").to_pylist()]
        every = np.concatenate(parts)
        order = np.lexsort((every["doc"], every["low"], every["high"]))
        ranked = every[order]
        new = np.ones(len(ranked), bool)
        new[1:] = (ranked["high"][1:] != ranked["high"][:-1]) | (ranked["low"][1:] != ranked["low"][:-1])
        least = ranked["doc"][new][np.cumsum(new) - 1]
        later = np.zeros(len(ranked), bool)
        later[order] = ranked["doc"] > least
        ends = np.cumsum([len(p) for p in parts])
        pieces = np.split(later, ends[:-1])
        return _answers(group, [(p, p) for p in pieces])

    return messages.groupBy("bucket").applyInArrow(run, _REPLY)


# --- Step 3: cut -----------------------------------------------------------------------------


def _with_replies(table: DataFrame, replies: DataFrame, name: str) -> DataFrame:
    """One list of answers per chunk: at most one answer per bucket."""
    lists = replies.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits", "more")).alias(name))
    return table.join(lists, "chunk", "left")


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Remove the words of windows that also start in a document with a smaller id.

    Returns ``doc`` (the row without its text), ``n_words``, ``n_removed`` and
    ``kept_text``, the kept words joined by blanks. Windows are judged on the input.

    A window of ``window`` words contains, wherever it starts, one whole block of
    (window + 1) / 2 words of the fixed blocks of its document. So every rolling
    run of that length is looked up among the fixed blocks (step 1); windows whose
    runs are all repeated, one of them on a block, are compared whole by 80 bits
    and the smallest id found (step 2); adjacent windows join to maximal repeats,
    which are cut (step 3). Between chunks and buckets travel distinct hashes of a
    chunk, never pairs: a passage in a third of all documents is one entry per
    chunk, and one bit comes back for each. The buckets' number grows with the
    chunks', so a bucket stays as small as a chunk.

    Ids must be whole numbers: they are compared as such.

    Defined cases: null and empty texts have no words. Rows without an id keep
    all words and count for nobody. Rows that repeat an id do not cut each other.
    Texts of fewer words than a window stay. Empty tables give an empty result;
    extra columns stay in ``doc``. A text of any length is handled in one task.
    """
    if id_col not in docs.columns:
        raise ValueError(f"no column {id_col}")
    table = _chunked(docs, id_col, text_col, chunk_bytes)
    bits = max(1, (table.count() - 1).bit_length())
    anchors = _repeated_anchors(_anchor_messages(table, window, bits))
    spark = docs.sparkSession
    path = work_dir(spark, "repeated-anchors")
    anchors.write.parquet(path)
    anchored = _with_replies(table, spark.read.schema(anchors.schema).parquet(path), "anchors")
    earlier = _earlier_windows(_window_messages(anchored, window, bits))
    path = work_dir(spark, "earlier-windows")
    earlier.write.parquet(path)
    both = _with_replies(anchored, spark.read.schema(earlier.schema).parquet(path), "earlier")

    def run(batches):
        for batch in batches:
            for k, row in enumerate(_each(batch.select(["chunk", "ids", "lengths", "texts", "anchors", "earlier"]))):
                words = Words(row, window, keep_words=True)
                found = Candidates(words, bits, row["anchors"])
                later = _unanswer(found.buckets(bits), row["earlier"], "bits")
                cut = found.at[later[found.entry] | (found.doc > found.entries["doc"][found.entry])]
                change = np.zeros(len(words.hashes) + 1, np.int32)
                np.add.at(change, cut, 1)
                np.add.at(change, cut + window, -1)
                covered = np.cumsum(change)[:-1] > 0
                n_words, n_removed, kept = [], [], []
                for own, start, n in zip(words.words, words.starts, words.counts, strict=True):
                    gone = covered[start : start + n]
                    removed = int(gone.sum())
                    left = own if not removed else [own[i] for i in np.flatnonzero(~gone)]
                    n_words.append(len(own))
                    n_removed.append(removed)
                    kept.append(b" ".join(left).decode("utf-8"))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(batch.schema.get_field_index("docs")).slice(k, 1).flatten(),
                        pa.array(n_words, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(kept, pa.string()),
                    ],
                    names=["doc", "n_words", "n_removed", "kept_text"],
                )

    doc = table.schema["docs"].dataType.elementType.simpleString()
    return both.mapInArrow(run, StructType.fromDDL(f"doc {doc}, n_words long, n_removed long, kept_text string"))
