"""Spelling variants by permuterm rotations."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, whole_text

LEAST_LENGTH, LEAST_TIMES = 6, 5
#: A form occurs this many times as often as its variants.
FORM_RATIO = 5
#: One occurrence in so many loses a character.
NOISE = 199
TERMINATOR = "$"
#: Rotations of longer words are written as fingerprints: their texts would grow with the square.
SHORT_CHARS = 64
#: Words that a task counts before it sends what it has.
_MOST_COUNTED = 300_000
_PRIME, _BASE = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F
_WHOLE, _GAP, _FIRST_GAP = 0, 1, 2


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES, noise: int | None = NOISE,
) -> DataFrame:
    """``word`` and ``n`` of all words of a length and a number of occurrences, over all texts.

    Words are runs of letters, A-Z lower-cased. With ``noise``, a run whose CRC-32 with the
    document's id is divisible by it loses the character that the checksum names.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("id"), whole_text(f"`{text_col}`").alias("text")
    )
    runs = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")

    def run(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                own = Counter(runs.findall(_lower(text.as_py())))
                if noise:
                    start = zlib.crc32(f"{name.as_py()}:".encode())
                    for word in [w for w in own if zlib.crc32(w.encode(), start) % noise == 0]:
                        at = zlib.crc32(word.encode(), start) % len(word)
                        times = own.pop(word)
                        # Changed words never meet unchanged ones of this document by way of ``own``.
                        if len(word) > least_length:
                            counts[word[:at] + word[at + 1 :]] += times
                counts.update(own)
                if len(counts) > _MOST_COUNTED:
                    yield _counted(counts)
                    counts = Counter()
        if counts:
            yield _counted(counts)

    counted = rows.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_times)


def _lower(text: str) -> str:
    return text.encode("utf-8").lower().decode("utf-8")


def _counted(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
    )


# --- Words up to SHORT_CHARS: rotations as texts ----------------------------------------------


def rotations(words: DataFrame) -> DataFrame:
    """All rotations of the words with their terminator, and all that end before an edited character.

    ``key``, ``kind``, ``word``, ``n``. The key of a whole rotation is the rotation. With the
    character to be edited last, the key is the rest: words that differ in that character
    alone share it, and so does the rotation of the word that lacks the character. Within a
    run of equal characters only the first marks the lack, so each pair meets in one group.
    """
    size = F.length("word")
    i = F.col("i")
    left = F.substring(F.col("word"), F.lit(1), i)
    whole = F.struct(
        F.concat(F.substring(F.col("word"), i + 1, size), F.lit(TERMINATOR), left).alias("key"), F.lit(_WHOLE).alias("kind")
    )
    first = (i == 0) | (F.substring(F.col("word"), i, F.lit(1)) != F.substring(F.col("word"), i + 1, F.lit(1)))
    gap = F.struct(
        F.concat(F.substring(F.col("word"), i + 2, size), F.lit(TERMINATOR), left).alias("key"),
        F.when(first, F.lit(_FIRST_GAP)).otherwise(F.lit(_GAP)).alias("kind"),
    )
    placed = words.select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("i"))
    both = placed.select("word", "n", F.explode(F.when(i < size, F.array(whole, gap)).otherwise(F.array(whole))).alias("r"))
    return both.select("r.key", "r.kind", "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """Per word and group of rotations: ``near``, the number of its near words there, and the
    best of them, ``form_n`` and ``form``.

    Rotations are dealt by key, sorted and scanned. A group holds one word for each character
    that can stand at the edited place and one without it, so the alphabet bounds it. A row
    tells how many the others are and which is best: no pairs are written.
    """

    def scan(batches):
        held: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else _joined(held, batch)
            last = int(_group_starts(rows.column("key"))[-1])
            if last:
                yield _scanned(rows.slice(0, last))
            held = rows.slice(last)
        if held is not None:
            yield _scanned(held)

    sorted_rows = rotations(words).repartition("key").sortWithinPartitions("key", F.col("n").desc(), "word")
    return sorted_rows.mapInArrow(scan, "word string, near long, form_n long, form string")


def _joined(a: pa.RecordBatch, b: pa.RecordBatch) -> pa.RecordBatch:
    return pa.Table.from_batches([a, b]).combine_chunks().to_batches()[0]


def _group_starts(keys: pa.Array) -> np.ndarray:
    new = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(new) + 1])


def _scanned(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Whole groups, each sorted by falling n, then by word."""
    kind = rows.column("kind").to_numpy()
    starts = _group_starts(rows.column("key"))
    none = len(kind)
    place = np.arange(len(kind))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(kind))))
    first_of = lambda flag: np.minimum.reduceat(np.where(flag, place, none), starts)[group]
    count_of = lambda flag: np.add.reduceat(flag.astype(np.int64), starts)[group]
    is_gap, lacks, is_whole = kind != _WHOLE, kind == _FIRST_GAP, kind == _WHOLE
    best_gap = first_of(is_gap)
    other_gap = np.where(best_gap == place, first_of(is_gap & (place != best_gap)), best_gap)
    whole = np.where(lacks, first_of(is_whole), none)
    near = np.where(is_whole, count_of(lacks), count_of(is_gap) - 1 + (whole < none))
    best = np.where(is_whole, first_of(lacks), np.minimum(other_gap, whole))
    own = np.flatnonzero(near > 0)
    theirs = pa.array(best[own])
    word, n = rows.column("word"), rows.column("n")
    return pa.RecordBatch.from_arrays(
        [word.take(pa.array(own)), pa.array(near[own]), n.take(theirs), word.take(theirs)],
        names=["word", "near", "form_n", "form"],
    )


# --- Longer words: rotations as fingerprints --------------------------------------------------


def rotation_marks(word: str) -> Iterator[tuple[bytes, int]]:
    """Fingerprints of the rotations of a word, in steps of constant cost each: (key, kind)."""
    n, powers, prefix = len(word), [1], [0]
    for c in word:
        powers.append(powers[-1] * _BASE % _PRIME)
        prefix.append((prefix[-1] * _BASE + ord(c)) % _PRIME)

    def mark(start: int, end: int) -> bytes:
        """Of ``word[start:]``, the terminator and ``word[:end]``."""
        tail = prefix[n] - prefix[start] * powers[n - start]
        value = ((tail * _BASE + ord(TERMINATOR)) * powers[end] + prefix[end]) % _PRIME
        return value.to_bytes(16, "little")

    for i in range(n + 1):
        yield mark(i, i), _WHOLE
        if i < n:
            yield mark(i + 1, i), _FIRST_GAP if i == 0 or word[i] != word[i - 1] else _GAP


def long_neighbours(words: DataFrame, short_chars: int) -> DataFrame:
    """Near words of words over ``short_chars``, a row for each: as ``neighbours``, ``near`` is 1.

    Keys are fingerprints; the few words that share one, no more than the alphabet has
    characters, are compared themselves.
    """
    kept = words.filter(F.length("word") >= short_chars).select("word", "n", F.sha2("word", 256).alias("ref"))

    def run(batches):
        for batch in batches:
            for word, ref in zip(batch.column(0), batch.column(1), strict=True):
                marks = rotation_marks(word.as_py())
                while part := [m for _, m in zip(range(10_000), marks, strict=False)]:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([k for k, _ in part], pa.binary()),
                            pa.array([k for _, k in part], pa.int32()),
                            pa.array([ref.as_py()] * len(part), pa.string()),
                        ],
                        names=["key", "kind", "ref"],
                    )

    marked = kept.select("word", "ref").mapInArrow(run, "key binary, kind int, ref string")
    met = marked.groupBy("key").agg(F.collect_set(F.struct("ref", "kind")).alias("met")).filter(F.size("met") > 1)
    pairs = (
        met.select("met", F.explode("met").alias("x"))
        .select("x", F.explode("met").alias("y"))
        .filter(
            (F.col("x.ref") != F.col("y.ref"))
            & ((F.col("x.kind") > _WHOLE) | (F.col("y.kind") == _FIRST_GAP))
            & ((F.col("y.kind") > _WHOLE) | (F.col("x.kind") == _FIRST_GAP))
        )
        .select(F.col("x.ref").alias("ref"), F.col("y.ref").alias("other"))
        .distinct()
    )
    theirs = kept.select(F.col("word").alias("form"), F.col("n").alias("form_n"), F.col("ref").alias("other"))
    compared = pairs.join(kept, "ref").join(theirs, "other")
    # Two words of the border length met as texts already.
    longest = F.greatest(F.length("word"), F.length("form"))
    return compared.filter((longest > short_chars) & (F.levenshtein("word", "form", 1) == 1)).select(
        "word", F.lit(1).cast("long").alias("near"), "form_n", "form"
    )


# --- Forms and roots --------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the end of the way from ``word`` by ``form``.

    A form occurs five times as often as its word, so ways have no cycle and 27 steps at
    most; every round doubles the steps.
    """
    way = stored(forms.select("word", F.col("form").alias("root")), "spelling-ways")
    while True:
        ahead = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if way.join(ahead, "root", "left_semi").isEmpty():
            return way
        way = stored(
            way.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-ways"
        )


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
    least_times: int = LEAST_TIMES, noise: int | None = NOISE, ratio: int = FORM_RATIO, short_chars: int = SHORT_CHARS,
) -> DataFrame:
    """Every word of the texts with its usual form: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Two words are near if one character inserted, deleted or replaced makes one the other.
    The form of a word is its near word of largest ``n`` (of these the first in code point
    order) if that is at least ``ratio`` times its own, else null; ``root`` follows forms to
    the last. All rotations of terminator-marked words are sorted and groups that share a
    prefix scanned; the alphabet bounds a group, so a frequent word or a crowded neighbourhood
    makes no large one. Counts are added up in every task before they are shuffled.

    Defined cases: null and empty texts have no words. A null id counts as the text "null".
    Repeated rows count each. Runs longer than ``short_chars`` take the same keys as
    fingerprints, at a cost in proportion to their length. An empty table, or one without
    frequent words, gives an empty result; extra columns are not read.
    """
    words = stored(word_counts(docs, id_col, text_col, least_length, least_times, noise), "spelling-words")
    short = neighbours(words.filter(F.length("word") <= short_chars))
    near = short.unionByName(long_neighbours(words, short_chars))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("best")
    summed = near.groupBy("word").agg(F.sum("near").alias("n_near"), best)
    accepted = -F.col("best.less") >= ratio * F.col("n")
    found = stored(
        words.join(summed, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(accepted, F.col("best.form")).alias("form"),
            F.when(accepted, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
