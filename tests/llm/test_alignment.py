"""Alignment of two tokenizers against the libraries on whole texts and a plain count of links."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from contextlake.llm import alignment, pair_index
from contextlake.llm.queries import ALIGNED

PATHS = tuple(map(public_tokenizers.path, ALIGNED))


def tokens_by_hand(library_a, library_b, text):
    """(id, bytes) of both tokenizers for a whole text."""
    table = {**{chr(b): b for b in range(256)}, **alignment.byte_of_character()}
    ids_a = library_a.encode(" " + text, add_special_tokens=False).ids
    a = [(i, bytes(table[c] for c in library_a.id_to_token(i))) for i in ids_a]
    b = []
    for i in library_b.encode(text):
        piece = library_b.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if library_b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    same = text and b"".join(x for _, x in a) == whole == b"".join(x for _, x in b)
    return (a, b) if same else ([], [])


def spans(tokens):
    at, out = 0, []
    for i, x in tokens:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def align_by_hand(a, b):
    """Links by comparing byte ranges, groups by common ends."""
    a, b = spans(a), spans(b)
    links, first = [], 0
    for i, s, e in a:
        while first < len(b) and b[first][2] <= s:
            first += 1
        k = first
        while k < len(b) and b[k][1] < e:
            links.append((i, b[k][0]))
            k += 1
    common = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, start = [], 0
    for end in common:
        inside = lambda tokens: ",".join(str(i) for i, s, e in tokens if start <= s and e <= end)  # noqa: B023, E731
        groups.append(f"{inside(a)}|{inside(b)}")
        start = end
    return links, groups


@pytest.fixture(scope="module")
def rows(cases):
    rng = random.Random(11)
    odd = "  two  blanks \n\n line\tx y a　 b ​ . 中文字符 naïve 🙂🙂 don't I'LL 12 345 x\x00y \x1c z \x85 q ..."
    mixed = "".join(rng.choice([" ", "  ", "\n", "a", "Bc", "é", "7", "'s", "中", " ", " ", "🙂"]) for _ in range(3000))
    return [
        (i, t if t is None or len(t) < 4000 else t[:4000], s) for i, t, s in cases
    ] + [
        (100, odd, "a"), (101, mixed, "a"), (102, "<|endoftext|> </s> <s>x<unk> <0x0A>", "a"), (103, "has ▁ mark", "a"),
        (104, " ", "a"), (105, "   ", "a"), (106, "\n", "a"), (107, "end ", "a"), (108, " start", "a"), (109, "é", "a"),
        (None, "no id here", "a"), (110, "m" * 2500, "a"),
    ]


@pytest.fixture(scope="module")
def by_hand(rows):
    library_a = Tokenizer.from_file(PATHS[0])
    library_a.encode_special_tokens = True
    library_b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    docs = [tokens_by_hand(library_a, library_b, t or "") for _, t, _ in rows]
    aligned = [align_by_hand(a, b) for a, b in docs]
    counts = Counter(link for links, _ in aligned for link in links)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for (i, *_), (a, b), (links, groups) in zip(rows, docs, aligned, strict=True):
        out.append((
            i, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
        ))
    return sorted(out, key=repr)


# The small range makes every bucket a pass of its own.
@pytest.mark.parametrize("range_slots", [alignment.RANGE_SLOTS, 1])
def test_alignment_equals_whole_texts(frame, rows, by_hand, range_slots, monkeypatch):
    monkeypatch.setattr(alignment, "BUCKET_KEYS", 2000)
    found = alignment.align_tokenizers(frame(rows, partitions=5), *PATHS, range_slots=range_slots)
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    got = sorted([tuple(r) for r in found.select("doc.doc_id", *columns).collect()], key=repr)
    assert got == by_hand
    assert any(r[1] == 0 for r in got) and sum(r[4] for r in got) > 5000


def test_long_texts_are_cut_at_unit_borders(rows, monkeypatch):
    coder = alignment.Both(*PATHS)
    texts = [t for _, t, _ in rows if t]
    whole = [coder.ids(t) for t in texts]
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 5)
    assert [alignment.Both(*PATHS).ids(t) for t in texts] == whole


def test_ranks_and_library_give_the_same():
    rng = random.Random(6)
    coder = alignment.ByteLevel(PATHS[0])
    marks = [chr(k) for k in [*range(0x250), *range(0x2000, 0x2070), *range(0x4E00, 0x4E20), 0x180E, 0x1F642, 0x1E900, 0x16FE4]]
    assert not alignment.stable_class(chr(0x180E)) and alignment.stable_class("🙂") and alignment.stable_class("é")
    for _ in range(300):
        text = "".join(rng.choice(marks + [" ", "a", "7", "'s"] * 40) for _ in range(60))
        want = coder.library.encode(" " + text, add_special_tokens=False).ids
        assert coder.encode(text) == want
        stable = "".join(c for c in text if alignment.stable_class(c))
        assert coder.ranked.encode_ordinary(" " + stable) == coder.library.encode(" " + stable, add_special_tokens=False).ids


def test_nothing_gives_nothing(frame):
    assert alignment.align_tokenizers(frame([]), *PATHS).count() == 0
    only_null = alignment.align_tokenizers(frame([(1, None, None), (2, "", None)]), *PATHS)
    assert [tuple(r)[1:] for r in only_null.collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_index_is_minimal_perfect_and_verified():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 62, 30_000, dtype=np.uint64))
    buckets = 7
    own = pair_index.bucket_of(keys, buckets)
    rows = [pair_index.hashed_bucket(keys[own == k]) for k in range(buckets)]
    index = pair_index.PairIndex(0, buckets, rows)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    assert (index.keys[index.slots(keys)] == keys).all()
    others = np.setdiff1d(rng.integers(0, 1 << 62, 5000, dtype=np.uint64), keys)
    assert (index.slots(others) == -1).all()
    part = pair_index.PairIndex(2, buckets, rows[2:5])
    inside = (own >= 2) & (own < 5)
    assert sorted(part.slots(keys[inside]).tolist()) == list(range(int(inside.sum())))
    assert (part.slots(keys[~inside]) == -1).all()
    assert (pair_index.PairIndex(0, 1, [([], b"", b"")]).slots(keys[:3]) == -1).all()


def test_tree_adds_every_part(spark):
    rng = np.random.default_rng(2)
    vectors = [(k % 3, k, rng.integers(0, 99, 4)) for k in range(700)]
    df = spark.createDataFrame([(b, p, v.astype("<i8").tobytes()) for b, p, v in vectors], "block long, part long, counts binary")
    got = {r["block"]: np.frombuffer(r["counts"], "<i8").tolist() for r in alignment.tree_sum(df, 700).collect()}
    assert got == {b: sum(v for k, _, v in vectors if k == b).tolist() for b in range(3)}
