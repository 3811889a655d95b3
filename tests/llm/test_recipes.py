"""Exact dedup by chunk recipes against plain grouping of texts."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from contextlake.llm import recipes


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def by_hand(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[lower(text or "")].append(i)
    out = []
    for i, text, *_ in rows:
        own = groups[lower(text or "")]
        known = [k for k in own if k is not None]
        out.append((i, max(known) if known else None, len(own), hashlib.sha256(lower(text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows(cases):
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefghij \n") for _ in range(90_000))
    changed = long[:45_000] + "#" + long[45_001:]
    return [
        *cases, (60, long, "a"), (61, long.upper(), "b"), (62, changed, "a"), (63, long[1:], "a"), (64, long + "x", "a"),
        (None, cases[8][1], "a"), (None, "only nulls", "a"), (None, "only nulls", "a"), (70, "ÄÖ", "a"), (71, "äö", "a"),
        (72, "ab" * 40_000, "a"), (73, "ab" * 40_000, "a"), (74, "ab" * 40_001, "a"),
    ]


# One digest byte makes chunks collide by the dozen.
@pytest.mark.parametrize("digest_bytes", [16, 1])
def test_groups_equal_those_of_whole_texts(frame, rows, digest_bytes):
    found = recipes.exact_duplicates(frame(rows), digest_bytes=digest_bytes)
    assert {"doc", "keep_id", "group_size", "kept", "text_sha256"} == set(found.columns)
    got = found.select("doc.doc_id", "keep_id", "group_size", "text_sha256", "kept").collect()
    assert sorted([tuple(r)[:4] for r in got], key=repr) == by_hand(rows)
    kept = defaultdict(list)
    for r in got:
        if r["kept"]:
            kept[r["text_sha256"]].append(r["doc_id"])
    assert set(kept) == {r["text_sha256"] for r in got}
    assert all(len(ids) == 1 for ids in kept.values())
    assert {h: ids[0] for h, ids in kept.items()} == {r["text_sha256"]: r["keep_id"] for r in got}


def test_collisions_are_found_and_told_apart(frame, rows):
    chunks = recipes.chunk_contents(frame(rows), digest_bytes=1)
    contents = defaultdict(set)
    for digest, chunk in chunks.collect():
        contents[bytes(digest)].add(bytes(chunk))
    expected = {d for d, c in contents.items() if len(c) > 1}
    assert {bytes(r[0]) for r in recipes.collided_digests(chunks).collect()} == expected != set()
    assert recipes.collided_digests(recipes.chunk_contents(frame(rows))).isEmpty()


def test_chunks_join_to_the_text_and_follow_its_content():
    rng = random.Random(3)
    text = bytes(rng.choice(b"abcdefgh ") for _ in range(3_000_000))
    ends = recipes.chunk_ends(text)
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert ends[-1] == len(text) and max(sizes) <= recipes.MOST_BYTES and min(sizes[:-1]) >= recipes.LEAST_BYTES
    moved = recipes.chunk_ends(b"a few bytes before" + text)
    shared = {e + 18 for e in ends} & set(moved)
    assert len(shared) > 0.9 * len(ends)
    assert recipes.chunk_ends(b"") == [] and recipes.chunk_ends(b"x") == [1]
    # Blocks do not matter: cuts are those of the whole text looked at at once.
    whole, recipes._BLOCK = recipes.cut_candidates(text).tolist(), 100_000
    try:
        assert [c for c in recipes.cut_candidates(text).tolist() if c > 32] == [c for c in whole if c > 32]
    finally:
        recipes._BLOCK = 1 << 20


def test_nothing_gives_nothing(frame):
    assert recipes.exact_duplicates(frame([])).count() == 0
