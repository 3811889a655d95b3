"""BPE encoding and decoding with a public vocabulary, by contiguous rank arrays."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from .common import ROWS_AT_ONCE, map_texts

_NONE = 1 << 60
#: Words of more parts than this are merged through a heap, in n log n steps.
SHORT_PARTS = 64
#: Words, and units of words, that a worker remembers at most; bounds its memory.
MOST_REMEMBERED = 400_000
#: Bytes of one text that are split into words at once.
BLOCK_BYTES = 1 << 20

_PLAIN_UNITS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


class Merges(dict):
    """Rank of each pair of ids that merges; ``made`` has the id that a rank makes."""

    def __init__(self, vocab: dict[str, int], pairs: list[list[str]]) -> None:
        super().__init__(((vocab[a], vocab[b]), rank) for rank, (a, b) in enumerate(pairs))
        self.made = [vocab[a + b] for a, b in pairs]


def merge_short(ids: list[int], merges: Merges) -> list[int]:
    """Merge a short word: part ids and the ranks of neighbours side by side.

    The smallest rank is found by scanning, its right boundary is deleted, and
    only the two neighbouring ranks are looked up again.
    """
    rank_of, made = merges.get, merges.made
    ranks = [rank_of(pair, _NONE) for pair in zip(ids, ids[1:], strict=False)]
    while ranks:
        rank = min(ranks)
        if rank == _NONE:
            break
        at = ranks.index(rank)
        ids[at] = made[rank]
        del ids[at + 1], ranks[at]
        if at:
            ranks[at - 1] = rank_of((ids[at - 1], ids[at]), _NONE)
        if at < len(ranks):
            ranks[at] = rank_of((ids[at], ids[at + 1]), _NONE)
    return ids


def merge_long(ids: list[int], merges: Merges) -> list[int]:
    """The same merges in the same order for a word of any length."""
    n = len(ids)
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    alive = [True] * n
    heap = [(merges[pair], at, pair) for at, pair in enumerate(zip(ids, ids[1:], strict=False)) if pair in merges]
    heapq.heapify(heap)
    while heap:
        rank, at, pair = heapq.heappop(heap)
        after = right[at]
        if not alive[at] or after < 0 or (ids[at], ids[after]) != pair:
            continue
        ids[at] = merges.made[rank]
        alive[after] = False
        right[at] = right[after]
        if right[after] >= 0:
            left[right[after]] = at
        for first in (left[at], at):
            second = right[first] if first >= 0 else -1
            if second >= 0 and (ids[first], ids[second]) in merges:
                key = ids[first], ids[second]
                heapq.heappush(heap, (merges[key], first, key))
    return [i for i, on in zip(ids, alive, strict=True) if on]


class Memory(dict):
    """A dict of two generations: when the young one is full, the old one goes.

    What was used lately is looked up in the old generation and moves over, so
    common words stay however many rare ones pass by.
    """

    def __init__(self, most: int = MOST_REMEMBERED) -> None:
        super().__init__()
        self.half, self.old = most // 2, {}

    def __missing__(self, key):
        """The remembered value, or None; called for keys the young generation lacks."""
        value = self.old.get(key)
        if value is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value


class WordBpe:
    """Encoder for a vocabulary file with word ends, lower case and dropped white space.

    Normalising and splitting follow the file's own description: plain ASCII words
    are split here, all others by the file's normalizer and pre-tokenizer.
    Merging is done here.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.names = {i: name for name, i in self.vocab.items()}
        self.merges = Merges(self.vocab, model["merges"])
        self.special = {t["content"].encode(): t["id"] for t in described["added_tokens"]}
        self.names |= {i: name.decode() for name, i in self.special.items()}
        self.by_decimal = {str(i): name for i, name in self.names.items()}
        self._specials = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")")
        library = Tokenizer.from_file(path)
        self._normalize = library.normalizer.normalize_str
        self._split = library.pre_tokenizer.pre_tokenize_str
        self._words, self._units = Memory(), Memory()

    def unit(self, unit: str) -> tuple[int, str]:
        """Number of tokens and blank-joined ids of one pre-token, written in the
        vocabulary's byte letters."""
        known = self._units[unit]
        if known is None:
            parts = [*unit[:-1], unit[-1] + self.suffix]
            ids = [self.vocab[p] for p in parts if p in self.vocab]
            ids = (merge_short if len(ids) <= SHORT_PARTS else merge_long)(ids, self.merges)
            known = len(ids), " ".join(map(str, ids))
            if len(unit) <= 64:
                self._units.keep(unit, known)
        return known

    def word(self, word: bytes) -> tuple[int, str]:
        """The same of a word without white space."""
        known = self._words[word]
        if known is None:
            if word.isalpha():  # ASCII letters only
                known = self.unit(word.lower().decode())
            else:
                # Printable ASCII letters stand for themselves in the vocabulary.
                if word.isascii() and word.decode().isprintable():
                    units = [u.decode() for u in _PLAIN_UNITS.findall(word.lower())]
                else:
                    units = [u for u, _ in self._split(self._normalize(word.decode("utf-8")))]
                found = [f for u in units if (f := self.unit(u))[0]]
                known = (
                    found[0]
                    if len(found) == 1
                    else (sum([f[0] for f in found]), " ".join([f[1] for f in found]))
                )
            if len(word) <= 64:
                self._words.keep(word, known)
        return known

    def pieces(self, text: bytes) -> Iterator[list[tuple[int, str]]]:
        """Encoded words of a text, block by block."""
        get, word = self._words.get, self.word
        for at, piece in enumerate(self._specials.split(text)):
            if at % 2:
                i = self.special[piece]
                yield [(1, str(i))]
                continue
            for block in blocks(piece):
                yield [known for w in block.split() if (known := get(w) or word(w))[0]]

    def encode(self, text: str) -> list[int]:
        return [int(i) for known in self.pieces(text.encode("utf-8")) for _, ids in known for i in ids.split()]

    def decode(self, ids: list[int]) -> str:
        """Token names joined by blanks: the vocabulary file has no decoder."""
        return " ".join([self.names[i] for i in ids])

    def decode_written(self, ids: str) -> str:
        """The same of decimal ids joined by blanks."""
        return " ".join(map(self.by_decimal.__getitem__, ids.split(" ")))


def blocks(text: bytes) -> Iterator[bytes]:
    """A text cut before white space into pieces of about ``BLOCK_BYTES``."""
    start = 0
    while len(text) - start > BLOCK_BYTES:
        found = _SPACE.search(text, start + BLOCK_BYTES)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


@cache
def encoder(path: str) -> WordBpe:
    """One encoder per worker and file."""
    return WordBpe(path)


@cache
def id_names(path: str) -> dict[int, str]:
    """Token names by id, all that decoding needs: no merges and no words."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    names = {i: name for name, i in described["model"]["vocab"].items()}
    return names | {t["id"]: t["content"] for t in described["added_tokens"]}


def names_alone(path: str) -> dict[int, str]:
    """The names for a worker that decodes: an encoder that an earlier task left in it goes."""
    encoder.cache_clear()
    return id_names(path)


def encode_documents(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Token ids of every whole text: ``doc`` (the row without its text) and ``ids``.

    ``path`` names the vocabulary file on every executor. Special strings inside
    a text become their own ids; nothing is added, cut or padded. Tasks keep no
    more than a bounded number of words; no shuffle.

    Defined cases: null and empty texts, and texts of white space, have no ids.
    Repeated rows are encoded each; a null id or other column is carried along.
    An empty table gives an empty result.
    """

    def work(texts: pa.Array) -> list[pa.Array]:
        bpe = encoder(path)
        ids = [
            [int(i) for known in bpe.pieces(t.as_py()) for _, part in known for i in part.split()] for t in texts
        ]
        return [pa.array(ids, pa.list_(pa.int32()))]

    return map_texts(docs, work, {"ids": "array<int>"}, text_col)


def decode_documents(
    encoded: DataFrame, path: str, ids_col: str = "ids", doc_col: str = "doc", keep_ids: bool = False
) -> DataFrame:
    """``doc`` and the decoded ``text`` of each row of ids, with ``keep_ids`` its ``ids`` between them.

    Defined cases: null and empty lists of ids give an empty text, special ids their own
    strings. Ids that the vocabulary lacks fail. Repeated rows and null ids of documents do not
    matter, ``doc`` is carried. A text of any length is joined at once. An empty table gives
    an empty result. A task holds the texts of a few rows and the names of the tokens. Where the
    ids come straight from :func:`encode_documents`, its worker runs beside this one.
    """

    def run(batches):
        names = names_alone(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = [" ".join([names[i] for i in ids.as_py() or []]) for ids in part.column(1)]
                kept = part.columns if keep_ids else part.columns[:1]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=made)

    df = encoded.selectExpr(f"`{doc_col}` AS doc", f"`{ids_col}` AS ids")
    made = ["doc", "ids", "text"] if keep_ids else ["doc", "text"]
    schema = StructType([df.schema[c] for c in made[:-1]]).add("text", "string")
    return df.mapInArrow(run, schema)


def digest_documents(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Encode and decode whole texts, keeping counts and digests only.

    ``doc``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by blanks) and
    ``decoded_sha256``, which is made from the ids alone. Ids and decoded text flow
    through the digests block by block, so a text of any length needs little memory.
    Cases as in :func:`encode_documents`.
    """

    def work(texts: pa.Array) -> list[pa.Array]:
        bpe = encoder(path)
        counts, of_ids, of_text = [], [], []
        for text in texts:
            n, ids, names = 0, hashlib.sha256(), hashlib.sha256()
            for known in bpe.pieces(text.as_py()):
                if known:
                    if n:
                        ids.update(b" ")
                        names.update(b" ")
                    n += sum([k[0] for k in known])
                    written = " ".join([k[1] for k in known])
                    ids.update(written.encode())
                    names.update(bpe.decode_written(written).encode("utf-8"))
            counts.append(n)
            of_ids.append(ids.hexdigest())
            of_text.append(names.hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]

    fields = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    return map_texts(docs, work, fields, text_col)
