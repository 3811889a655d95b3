"""Spelling variants against a comparison of all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from contextlake.llm import spelling


def counted_by_hand(rows, least_length=6, least_times=5, noise=199):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if noise and (h := zlib.crc32(f"{'null' if i is None else i}:{word}".encode())) % noise == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_times}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    short, long = sorted((a, b), key=len)
    k = next((k for k in range(len(short)) if short[k] != long[k]), len(short))
    return short[k:] == long[k + 1 :]


def variants_by_hand(counts):
    close = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(close[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def check(spark, frame, rows, **options):
    got = spelling.spelling_variants(frame(rows, partitions=4), **options)
    found = sorted([tuple(r) for r in got.select(*COLUMNS).collect()], key=repr)
    wanted = variants_by_hand(counted_by_hand(rows, noise=options.get("noise", 199)))
    assert found == wanted
    return wanted


@pytest.fixture(scope="module")
def words():
    """Crowded words: few letters, runs of equal ones, chains of forms, ties, accents."""
    rng = random.Random(4)
    made = ["".join(rng.choice("aabé") for _ in range(rng.randint(6, 9))) for _ in range(300)]
    made += ["kitten" + "s" * k for k in range(4)] + ["ÀÉÎÕÜß", "àéîõüß", "aaaaaa", "aaaaaaa", "baaaaaa", "abaaaaa"]
    return made


def test_counts_and_variants(spark, frame, cases, words):
    rng = random.Random(8)
    rows = list(cases)
    for i in range(120):
        rows.append((1000 + i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 120))), "a"))
    rows += [(None, "Kitten KITTENS kittens1kittens" * 3, "a")] * 2
    chain = [("wanderer", 3500), ("wandarer", 600), ("wandarar", 100), ("wondarar", 18)]
    rows += [(2000, "\n".join(" ".join([w] * n) for w, n in chain), "a")]
    wanted = check(spark, frame, rows)
    assert any(r[1] for r in wanted) and any(r[4] > 3 for r in wanted)
    assert {r[0]: r[2] for r in wanted}["wondarar"] == "wanderer"


def test_noise_takes_a_character(frame, cases, words):
    rows = [(i, " ".join(words), "a") for i in range(60)]
    got = {r["word"]: r["n"] for r in spelling.word_counts(frame(rows), noise=7).collect()}
    assert got == counted_by_hand(rows, noise=7) != counted_by_hand(rows, noise=None)


# Every word over six characters is long here, and words of six and seven meet at the border.
@pytest.mark.parametrize("short_chars", [6, 8])
def test_long_words_give_the_same(spark, frame, words, short_chars):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(words) for _ in range(150)), "a") for i in range(40)]
    check(spark, frame, rows, noise=None, short_chars=short_chars)


def test_very_long_words(spark, frame):
    rng = random.Random(9)
    run = "".join(rng.choice("acgt") for _ in range(60_000))
    other = run[:30_000] + "x" + run[30_001:]
    rows = [(i, run, "a") for i in range(30)] + [(40 + i, other, "a") for i in range(5)] + [(50 + i, run[:-1], "a") for i in range(6)]
    found = spelling.spelling_variants(frame(rows), noise=None).collect()
    got = {(len(r["word"]), "x" in r["word"]): (r["n"], r["n_near"], r["form"] == run, r["root"] == run) for r in found}
    assert got == {(60_000, False): (30, 2, False, True), (60_000, True): (5, 1, True, True), (59_999, False): (6, 1, True, True)}


def test_marks_are_equal_where_rotations_are():
    texts, marks = {}, {}
    for word in ("abcabc", "abcabd", "aabc", "abc"):
        for k, (key, kind) in enumerate(spelling.rotation_marks(word)):
            i = k // 2
            rotation = word[i:] + "$" + word[:i] if kind == 0 else word[i + 1 :] + "$" + word[:i]
            texts.setdefault(rotation, set()).add(key)
            marks.setdefault(key, set()).add(rotation)
    assert all(len(v) == 1 for v in [*texts.values(), *marks.values()])


def test_nothing_gives_nothing(frame):
    assert spelling.spelling_variants(frame([])).count() == 0
    assert spelling.spelling_variants(frame([(1, None, None), (2, "rare words only", "a")])).count() == 0
