"""Token counts by the tokenizer library, with overlap resynchronisation for huge texts."""

from __future__ import annotations

import os
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import Memory
from .common import map_texts

#: Texts of more characters are encoded in overlapping chunks.
HUGE_CHARS = 65_536
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256


class Counter:
    """Counts tokens as the library gives them, words of ordinary texts only once."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._known = Memory()

    def ordinary(self, texts: list[bytes]) -> list[int]:
        """Counts of texts of moderate size.

        This vocabulary's words never reach across white space, so words are
        looked up, and the library encodes all unknown words of the batch at once.
        """
        known = self._known
        words = [t.split() for t in texts]
        counts = {w: known[w] for w in set().union(*words)}
        missing = [w for w, n in counts.items() if n is None]
        if missing:
            encoded = self.library.encode_batch_fast([w.decode("utf-8") for w in missing], add_special_tokens=False)
            for w, e in zip(missing, encoded, strict=True):
                counts[w] = n = len(e)
                if len(w) <= 64:
                    known.keep(w, n)
        return [sum([counts[w] for w in each]) for each in words]

    def _chunk(self, text: str, start: int, end: int):
        """Tokens of a piece as (id, start, end) in the whole text, and where words begin."""
        e = self.library.encode(text[start:end], add_special_tokens=False)
        tokens = [(i, start + a, start + b) for i, (a, b) in zip(e.ids, e.offsets, strict=True)]
        w = e.word_ids
        first = [k for k in range(len(w)) if k == 0 or w[k] != w[k - 1]]
        return tokens, first

    def huge(self, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
        """Count of a text of any size, chunk by chunk.

        Two neighbouring chunks are spliced at a boundary that is proven stable:
        both see the same whole word before it and the same whole word after it,
        neither word touching an end of its chunk. Splitting has no memory at a
        word boundary, so from there on the right chunk gives the tokens of the
        whole text. If the overlap has no such boundary it is doubled, at last up
        to the start of the left chunk, and the right chunk grows as needed.
        """
        n, start = len(text), 0
        end = min(n, chunk)
        tokens, first = self._chunk(text, start, end)
        done = 0
        base = 0  # tokens of the current chunk before this index are counted
        while end < n:
            width = overlap
            while True:
                right_start = max(start, end - width)
                right_end = min(n, max(right_start + chunk, end + width))
                right, right_first = self._chunk(text, right_start, right_end)
                at = _splice(tokens, first, right, right_first, right_start, start, end)
                if at is not None and at[0] >= base:
                    done += at[0] - base
                    base = at[1]
                    break
                if right_start == start:
                    # Nothing stable inside the whole left chunk: one longer chunk from
                    # the same start replaces it, with the counted tokens at the same indices.
                    break
                width *= 2
            tokens, first, start, end = right, right_first, right_start, right_end
        return done + len(tokens) - base


def _splice(left, left_first, right, right_first, right_start, left_start, left_end) -> tuple[int, int] | None:
    """Indices (left, right) of the first token after the last common stable boundary."""
    spans = {}
    for before, k, after in zip(left_first, left_first[1:], left_first[2:], strict=False):
        if left[before][1] >= right_start:
            spans[tuple(left[before:after])] = k
    found = None
    for before, k, after in zip(right_first, right_first[1:], [*right_first[2:], len(right)], strict=False):
        if right[after - 1][2] >= left_end:
            break
        if right[before][1] > right_start or right_start == left_start:
            at = spans.get(tuple(right[before:after]))
            found = (at, k) if at is not None else found
    return found


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", limit: int = 2048) -> DataFrame:
    """Token counts of whole texts: ``doc`` (the row without its text), ``n_bytes``,
    ``n_tokens``, ``over_limit``.

    ``path`` names the tokenizer file on every executor; its words must not reach
    across white space. Special strings inside a text count as the library counts
    them; nothing is added, cut or padded. No shuffle; memory is bounded by one
    text and a fixed number of words.

    Defined cases: null and empty texts have 0 bytes and 0 tokens. Repeated rows
    are counted each, null ids are carried. An empty table gives an empty result.
    """

    def work(texts: pa.Array) -> list[pa.Array]:
        c = counter(path)
        data = [t.as_py() for t in texts]
        counts = [0] * len(data)
        small = []
        for k, t in enumerate(data):
            if len(t) > HUGE_CHARS and len(s := t.decode("utf-8")) > HUGE_CHARS:
                counts[k] = c.huge(s)
            elif any(s.encode() in t for s in c.specials):
                counts[k] = len(c.library.encode(t.decode("utf-8"), add_special_tokens=False))
            else:
                small.append(k)
        for k, count in zip(small, c.ordinary([data[k] for k in small]), strict=True):
            counts[k] = count
        sizes = [len(t) for t in data]
        return [
            pa.array(sizes, pa.int64()),
            pa.array(counts, pa.int64()),
            pa.array([k > limit for k in counts], pa.bool_()),
        ]

    return map_texts(docs, work, {"n_bytes": "long", "n_tokens": "long", "over_limit": "boolean"}, text_col)
