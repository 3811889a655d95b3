"""Alignment of two tokenizers over a corpus: which tokens stand for the same bytes, and how often."""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import map_texts, stored
from .pair_index import BUCKET_KEYS, PairIndex, bucket_of, hashed_bucket

#: A text is cut at single blanks between other characters: both tokenizers begin a token there.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Characters after which the next such blank ends a block.
BLOCK_CHARS = 1 << 15
#: Slots that a task holds counts for at once (16 MB of counts, 17 MB of keys and bits); more
#: distinct pairs are counted range by range.
RANGE_SLOTS = 1 << 21
#: Slots of a block of counts, and vectors that are added in one step of the tree.
COUNT_BLOCK, FAN_IN = 1 << 14, 16
#: Bytes of A's ids that are aligned at once.
PART_BYTES = 1 << 19
#: Distinct pairs that a task remembers as sent.
_MOST_SENT = 1 << 22


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


#: White space for some engines or Unicode versions only.
_UNSURE = "\x1c\x1d\x1e\x1f\u180e"


def stable_class(c: str) -> bool:
    """Is ``c`` a letter, a number, white space or something else in every Unicode version?"""

    def of(category: str) -> str:
        return category[0] if category[0] in "LNZ" else "-"

    return of(unicodedata.category(c)) == of(unicodedata.ucd_3_2_0.category(c)) and c not in _UNSURE


class ByteLevel:
    """A byte-level BPE of the tokenizers library; special strings are plain text.

    A vocabulary whose ids follow its merges is the same as ranks of byte strings, which
    tiktoken encodes several times as fast. Both split a text by classes of characters; where
    the classes depend on the Unicode version, the library itself is asked.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.library.encode_special_tokens = True
        table = byte_of_character()
        self.bytes = [b""] * self.library.get_vocab_size()
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = bytes(table[c] for c in token)
        self.ranked = self._ranked(path)
        self._stable = {chr(k): stable_class(chr(k)) for k in range(0x80)}

    def _ranked(self, path: str):
        """The vocabulary for tiktoken; None unless that is proven to be the same."""
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        split = spec["pre_tokenizer"]
        same = (
            spec["normalizer"] is None
            and split["type"] == "ByteLevel"
            and split["use_regex"]
            and not split["add_prefix_space"]
            and not spec["model"].get("ignore_merges")
            and all(vocab[a + b] == 256 + rank for rank, (a, b) in enumerate(pairs))
        )
        ranks = {self.bytes[i]: i for i in range(256 + len(pairs))}
        if not same or len(ranks) != 256 + len(pairs):
            return None
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, block: str) -> list[int]:
        known = self._stable
        for c in set(block) - known.keys():
            known[c] = stable_class(c)
        if self.ranked is not None and all(map(known.__getitem__, set(block))):
            return self.ranked.encode_ordinary(" " + block)
        return self.library.encode(" " + block, add_special_tokens=False).ids


class Pieces:
    """A SentencePiece model, which puts a blank before every text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            whole = bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode()
            self.bytes.append(whole)
        if any("▁" in p[1:].lstrip("▁") for p in map(self.library.id_to_piece, range(len(self.bytes))) if p):
            raise ValueError("pieces reach across blanks, so texts cannot be cut at them")

    def encode(self, block: str) -> list[int]:
        return self.library.encode(block, num_threads=1)


class Both:
    """Token ids of a text by two tokenizers, block by block."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.coders = [ByteLevel(p) if p.endswith(".json") else Pieces(p) for p in (path_a, path_b)]
        self.kinds = ["H" if len(c.bytes) <= 1 << 16 else "I" for c in self.coders]

    def ids(self, text: str) -> tuple[bytes, bytes]:
        """Ids of both tokenizers; empty for an empty text or one that tokens do not join to."""
        out: tuple[list[bytes], list[bytes]] = ([], [])
        for block in _blocks(text):
            whole = (" " + block).encode()
            for parts, coder, kind in zip(out, self.coders, self.kinds, strict=True):
                own = coder.encode(block)
                if b"".join(map(coder.bytes.__getitem__, own)) != whole:
                    return b"", b""
                parts.append(array(kind, own).tobytes())
        return b"".join(out[0]), b"".join(out[1])


def id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def _blocks(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + BLOCK_CHARS) if len(text) - at > BLOCK_CHARS else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end + 1


@cache
def both(path_a: str, path_b: str) -> Both:
    return Both(path_a, path_b)


@cache
def token_lengths(path_a: str, path_b: str) -> list[np.ndarray]:
    return [np.array([len(x) for x in c.bytes], np.int64) for c in both(path_a, path_b).coders]


@cache
def written_ids(size: int) -> list[bytes]:
    """Decimal ids followed by a comma, a bar, a semicolon or nothing: four runs of ``size``."""
    return [b"%d%s" % (i, mark) for mark in (b",", b"|", b";", b"") for i in range(size)]


def encoded(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """``doc`` (the row without its text) and the ids of both tokenizers as little-endian bytes."""

    def work(texts: pa.Array) -> list[pa.Array]:
        coder = both(path_a, path_b)
        found = [coder.ids(t.as_py().decode("utf-8")) for t in texts]
        return [pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)]

    return map_texts(docs, work, {"a": "binary", "b": "binary"}, text_col)


class Aligned:
    """Links and groups of a batch of documents, laid end to end.

    Both tokenizers cover the same bytes, so between two neighbouring ends of either lie
    the bytes of one A and one B token: that is a link, and there are no others.
    """

    def __init__(self, a: pa.Array, b: pa.Array, path_a: str, path_b: str) -> None:
        length_a, length_b = token_lengths(path_a, path_b)
        self.a, self.count_a = _flat_ids(a, len(length_a))
        self.b, self.count_b = _flat_ids(b, len(length_b))
        self.size_b = len(length_b)
        self.ends_a, self.ends_b = np.cumsum(length_a[self.a]), np.cumsum(length_b[self.b])
        total = int(self.ends_a[-1]) if len(self.a) else 0
        is_a, is_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        is_a[self.ends_a] = True
        is_b[self.ends_b] = True
        ends = np.flatnonzero(is_a | is_b)
        self.common = np.flatnonzero(is_a & is_b)
        at_a, at_b = is_a[ends], is_b[ends]
        self.link_a = np.cumsum(at_a) - at_a
        self.link_b = np.cumsum(at_b) - at_b
        borders = np.concatenate([[0], np.cumsum(length_a[self.a])])[np.cumsum(self.count_a)]
        #: Links and groups of each document: up to these indices.
        self.link_ends = np.searchsorted(ends, borders, "right")
        self.group_ends = np.searchsorted(self.common, borders, "right")

    @property
    def keys(self) -> np.ndarray:
        """The id pair of each link as one number."""
        return self.a[self.link_a].astype(np.uint64) * np.uint64(self.size_b) + self.b[self.link_b].astype(np.uint64)

    def group_digests(self, size: int) -> list[str]:
        """SHA-256 of the groups of each document; empty without tokens."""
        key = np.concatenate([2 * np.searchsorted(self.common, self.ends_a), 2 * np.searchsorted(self.common, self.ends_b) + 1])
        order = np.argsort(key, kind="stable")
        key = key[order]
        mark = np.full(len(key), 3)
        step = key[1:] - key[:-1]
        # Within one side a comma; from A to B of a group a bar; to the next group a semicolon.
        mark[:-1] = np.where(step == 0, 0, np.where(key[:-1] % 2 == 0, 1, 2))
        ends = np.cumsum(self.count_a + self.count_b)
        mark[ends[ends > 0] - 1] = 3
        codes = (mark * size + np.concatenate([self.a, self.b])[order]).tolist()
        text, out, at = written_ids(size).__getitem__, [], 0
        for end in ends.tolist():
            out.append(hashlib.sha256(b"".join(map(text, codes[at:end]))).hexdigest() if end > at else "")
            at = end
        return out


def _flat_ids(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of id bytes, and how many each row has."""
    kind = np.dtype(id_type(size))
    parts = [x.as_buffer() for x in column]
    ids = np.frombuffer(b"".join(parts), kind).astype(np.int64)
    return ids, np.array([len(p) // kind.itemsize for p in parts], np.int64)


def _parts(batches) -> Iterator[pa.RecordBatch]:
    """Runs of rows with some PART_BYTES of ids each, so that arrays stay small; a longer row is its own."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index("a"))).to_numpy(zero_copy_only=False)
        run = np.cumsum(sizes.astype(np.int64) + 64) // PART_BYTES
        starts = np.flatnonzero(np.diff(run, prepend=-1))
        for at, end in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
            yield batch.slice(at, end - at)


def per_document(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values`` up to each of ``ends`` from the one before."""
    total = np.concatenate([[0], np.cumsum(values)])[ends]
    return np.diff(total, prepend=0)


def distinct_pairs(ids: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Every linked id pair of the corpus once, as ``pair``; a task sends each of its pairs about once."""

    def run(batches):
        sent = np.zeros(0, np.uint64)
        for batch in _parts(batches):
            pairs = np.unique(Aligned(batch.column(0), batch.column(1), path_a, path_b).keys)
            at = np.minimum(np.searchsorted(sent, pairs), max(len(sent) - 1, 0))
            new = pairs if not len(sent) else pairs[sent[at] != pairs]
            if len(new):
                yield pa.RecordBatch.from_arrays([pa.array(new.view(np.int64))], names=["pair"])
                sent = new if len(sent) > _MOST_SENT else np.union1d(sent, new)

    return ids.select("a", "b").mapInArrow(run, "pair long").distinct()


def pair_buckets(pairs: DataFrame, buckets: int) -> DataFrame:
    """The perfect hash, bucket by bucket: ``bucket``, ``sizes``, ``bits``, ``keys``."""

    def place(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            own = pa.array(bucket_of(keys, buckets))
            yield pa.RecordBatch.from_arrays([own, batch.column(0)], names=["bucket", "pair"])

    def build(group: pa.Table) -> pa.Table:
        sizes, bits, keys = hashed_bucket(group.column("pair").to_numpy().view(np.uint64))
        return pa.table({"bucket": group.column("bucket").slice(0, 1), "sizes": [sizes], "bits": [bits], "keys": [keys]})

    placed = pairs.mapInArrow(place, "bucket long, pair long")
    return placed.groupBy("bucket").applyInArrow(build, "bucket long, sizes array<bigint>, bits binary, keys binary")


def read_index(hashed: DataFrame, first: int, last: int, buckets: int) -> PairIndex:
    """The index of a range of buckets, which RANGE_SLOTS bounds."""
    rows = {r["bucket"]: r for r in hashed.filter(F.col("bucket").between(first, last - 1)).collect()}
    empty = ([], b"", b"")
    each = [(r["sizes"], bytes(r["bits"]), bytes(r["keys"])) if (r := rows.get(k)) else empty for k in range(first, last)]
    return PairIndex(first, buckets, each)


def count_vectors(ids: DataFrame, index, path_a: str, path_b: str) -> DataFrame:
    """Each task's dense vector of counts by slot, in blocks: ``block``, ``part``, ``counts``."""

    def run(batches):
        held: PairIndex = index.value
        counts = np.zeros(len(held.keys), np.int64)
        for batch in _parts(batches):
            pairs, times = np.unique(Aligned(batch.column(0), batch.column(1), path_a, path_b).keys, return_counts=True)
            slots = held.slots(pairs)
            counts[slots[slots >= 0]] += times[slots >= 0]
        part = TaskContext.get().partitionId()
        for at in range(0, len(counts), COUNT_BLOCK):
            block = counts[at : at + COUNT_BLOCK]
            if block.any():
                row = [[at // COUNT_BLOCK], [part], [block.astype("<i8").tobytes()]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[0], pa.int64()), pa.array(row[1], pa.int64()), pa.array(row[2], pa.binary())],
                    names=["block", "part", "counts"],
                )

    return ids.select("a", "b").mapInArrow(run, "block long, part long, counts binary")


def tree_sum(vectors: DataFrame, parts: int) -> DataFrame:
    """Sums of the vectors of each block, FAN_IN at a time; a step holds FAN_IN blocks."""

    def add(group: pa.Table) -> pa.Table:
        total = 0
        for c in group.column("counts"):
            total = total + np.frombuffer(c.as_buffer(), "<i8")
        return pa.table(
            {
                "block": group.column("block").slice(0, 1),
                "part": group.column("part").slice(0, 1),
                "counts": pa.array([total.tobytes()], pa.binary()),
            }
        )

    schema = vectors.schema
    while True:
        vectors = vectors.withColumn("part", F.floor(F.col("part") / FAN_IN))
        vectors = vectors.groupBy("block", "part").applyInArrow(add, schema)
        parts = -(-parts // FAN_IN)
        if parts <= 1:
            return vectors.select("block", "counts")


def read_counts(summed: DataFrame, slots: int) -> np.ndarray:
    """The dense vector of one range, which RANGE_SLOTS bounds."""
    out = np.zeros(slots, np.int64)
    for row in summed.collect():
        block = np.frombuffer(row["counts"], "<i8")
        at = row["block"] * COUNT_BLOCK
        out[at : at + len(block)] = block
    return out


def look_up(ids: DataFrame, found, path_a: str, path_b: str, first: bool) -> DataFrame:
    """Adds what one range of pairs says about each document; the first range adds the rest too."""
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kinds = ["long", "long", "long", "long", "string"]
    columns = [c for c in ids.columns if c not in ("n_best", "count_sum")] + (names if first else [])
    schema = StructType(
        [
            *[ids.schema[c] for c in columns if not (first and c in names)],
            *(StructType.fromDDL(", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))) if first else []),
            *StructType.fromDDL("n_best long, count_sum long"),
        ]
    )

    def run(batches):
        index, counts, best = found.value
        for batch in _parts(batches):
            get = lambda name, b=batch: b.column(b.schema.get_field_index(name))
            own = Aligned(get("a"), get("b"), path_a, path_b)
            pairs, back = np.unique(own.keys, return_inverse=True)
            slots = index.slots(pairs)
            held = slots >= 0
            count, is_best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            count[held], is_best[held] = counts[slots[held]], best[slots[held]]
            n_best = per_document(is_best[back], own.link_ends)
            count_sum = per_document(count[back], own.link_ends)
            if first:
                extra = [
                    pa.array(own.count_a),
                    pa.array(own.count_b),
                    pa.array(np.diff(own.group_ends, prepend=0)),
                    pa.array(np.diff(own.link_ends, prepend=0)),
                    pa.array(own.group_digests(max(map(len, token_lengths(path_a, path_b)))), pa.string()),
                ]
                kept = batch.columns
            else:
                n_best += get("n_best").to_numpy()
                count_sum += get("count_sum").to_numpy()
                kept, extra = [get(c) for c in columns], []
            yield pa.RecordBatch.from_arrays([*kept, *extra, pa.array(n_best), pa.array(count_sum)], names=schema.names)

    return ids.mapInArrow(run, schema)


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", range_slots: int = RANGE_SLOTS
) -> DataFrame:
    """How the tokens of A and B of each text meet: ``doc`` (the row without its text), ``n_a``,
    ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, ``n_best``, ``count_sum``.

    ``path_a`` and ``path_b`` name tokenizer files on every executor: ``.json`` for a byte-level
    BPE, which is given a blank before the text, or ``.model`` for SentencePiece, which adds it.
    Texts are encoded once and stored as ids. The distinct linked pairs get a minimal perfect
    hash, made in buckets. Every task counts its links in a dense vector by slot, each key
    verified, and the vectors are added in a tree. A second pass aligns the ids again and looks
    the counts up. No pair of a document is ever shuffled with it, so no pair is a hot key.

    What a task and the driver hold is bounded by ``range_slots``: more distinct pairs than
    that are counted and looked up range by range, each a pass over the stored ids. The best
    count of each B id is a vector as long as B's vocabulary.

    Defined cases: null and empty texts, and texts that the tokens of A or B do not join to
    (with a blank before them), have no tokens: zeros and an empty digest. Ids and repeated
    rows do not matter, each row counts. Very long texts are encoded block by block,
    cut at single blanks; a run without any is one block. An empty table gives an empty result; extra columns stay in ``doc``.
    """
    ids = stored(encoded(docs, path_a, path_b, text_col), "token-ids")
    pairs = stored(distinct_pairs(ids, path_a, path_b), "token-pairs")
    buckets = max(1, -(-pairs.count() // BUCKET_KEYS))
    hashed = stored(pair_buckets(pairs, buckets), "token-pair-index")
    context, parts = docs.sparkSession.sparkContext, ids.rdd.getNumPartitions()
    step = max(1, range_slots // BUCKET_KEYS)
    ranges = [(at, min(at + step, buckets)) for at in range(0, buckets, step)]
    size_a, size_b = map(len, token_lengths(path_a, path_b))
    best, sums = np.zeros(size_b, np.int64), []
    for first, last in ranges:
        index = read_index(hashed, first, last, buckets)
        shared = context.broadcast(index)
        sums.append(stored(tree_sum(count_vectors(ids, shared, path_a, path_b), parts), "token-pair-counts"))
        shared.unpersist()
        counts = read_counts(sums[-1], len(index.keys))
        np.maximum.at(best, (index.keys % np.uint64(size_b)).astype(np.int64), counts)
    out = ids
    for k, (first, last) in enumerate(ranges):
        index = read_index(hashed, first, last, buckets)
        counts = read_counts(sums[k], len(index.keys))
        is_best = counts == best[(index.keys % np.uint64(size_b)).astype(np.int64)]
        out = look_up(out, context.broadcast((index, counts, is_best)), path_a, path_b, first=k == 0)
        if len(ranges) > 1:
            out = stored(out, "token-pair-ranges")
    return out.select("doc", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
