"""Each operator against a plain computation, over nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contextlake.llm import bpe, lines, mixing, multiset, pii, quality, simhash, substrings, token_counts, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path("word_bpe_49k.json")
BLANKS = " \t\n\x0b\x0c\r"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_empty_tables(spark, frame):
    none = frame([])
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    assert lines.drop_shared_lines(none).count() == 0
    assert mixing.mix_sources(none).count() == 0
    assert mixing.mixed_documents(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.one_of_each_group(none).count() == 0
    assert quality.judge_documents(none, measures=("n_words",)).count() == 0
    assert bpe.encode_documents(none, PATH).count() == 0
    assert token_counts.count_tokens(none, PATH).count() == 0
    assert multiset.fingerprint_documents(none).count() == 0
    assert pii.find_personal_data(none).count() == 0
    assert substrings.remove_repeats(none).count() == 0
    assert urls.judge_urls(none.withColumnRenamed("text", "url"), rules).count() == 0


def test_line_dedup(frame, cases):
    rows = [*cases, (None, cases[8][1], "a"), (None, None, None)]
    holders = defaultdict(set)
    for i, text, _ in rows:
        for line in (text or "").split("\n"):
            key = lower(line).strip(BLANKS)
            if i is not None and len(key) >= 20:
                holders[key].add(i)
    want = Counter()
    for i, text, _ in rows:
        every = (text or "").split("\n")
        left = [
            x
            for x in every
            if i is None
            or len(holders[k := lower(x).strip(BLANKS)]) < 3
            or max(holders[k]) == i
        ]
        want[i, len(every), len(every) - len(left), "\n".join(left)] += 1
    got = lines.drop_shared_lines(frame(rows)).select("doc.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert Counter(map(tuple, got)) == want
    assert any(r["n_dropped"] for r in got)


def mix_by_hand(rows, weights=(5, 2, 1), most=3):
    size = Counter()
    for _, text, source in rows:
        size[source] += len(WORD.findall(text or ""))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    target = dict.fromkeys(names, Fraction(0))
    rest, full = Fraction(sum(size.values())), set()
    while rest > 0:
        left = [s for s in names if s not in full]
        share = sum(weight[s] for s in left)
        for s in left:
            target[s] += rest * weight[s] / share
        rest = Fraction(0)
        for s in left:
            if target[s] >= most * size[s]:
                rest += target[s] - most * size[s]
                target[s] = Fraction(most * size[s])
                full.add(s)
    return size, target


def test_mixing_meets_budgets(frame, cases):
    rows = [*cases, (None, "null id text", "a"), (60, "lone", "rare")]
    size, target = mix_by_hand(rows)
    got = mixing.mix_sources(frame(rows)).select("doc.doc_id", "doc.source", "size", "source_size", "target", "taken")
    found = got.collect()
    assert len(found) == len(rows)
    taken = Counter()
    for r in found:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(float(target[r["source"]]), abs=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert {s: int(t) for s, t in target.items()} == {s: taken[s] for s in target}


def test_mixing_does_not_depend_on_partitions(frame, cases):
    one, other = (
        sorted(map(tuple, mixing.mix_sources(frame(cases, partitions=p)).select("doc.doc_id", "taken").collect()))
        for p in (1, 7)
    )
    assert one == other


def test_mixed_documents_hold_the_words(frame, cases):
    docs = frame(cases)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.select("source", "text").collect():
        words[r["source"]] += len(WORD.findall(r["text"] or ""))
    _, target = mix_by_hand(cases)
    assert {s: int(t) for s, t in target.items()} == {s: words[s] for s in target}


def test_mixing_all_empty(frame):
    got = mixing.mix_sources(frame([(1, None, None), (2, "", "a")])).select("size", "target", "taken").collect()
    assert [tuple(r) for r in got] == [(0, 0.0, 0)] * 2


def fingerprint_by_hand(text: str) -> int:
    words = WORD.findall(lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(fps):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    ordered = sorted(root)
    for k, a in enumerate(ordered):
        for b in ordered[:k]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in ordered}


def test_simhash(frame, cases):
    rows = [*cases, (None, "", "a"), (None, "only here without an id", "a")]
    fps = {r: fingerprint_by_hand(r[1] or "") for r in rows}
    root = components_by_hand(fps.values())
    least = {}
    for r in rows:
        if r[0] is not None:
            key = root[fps[r]]
            least[key] = min(least.get(key, r[0]), r[0])
    got = simhash.near_duplicates(frame(rows)).select("doc.doc_id", "fp", "component_id", "stays").collect()
    assert Counter((r[0], r[1] % 2**64, r[2]) for r in got) == Counter(
        (r[0], fps[r], least.get(root[fps[r]])) for r in rows
    )
    assert sum(r["stays"] for r in got) == len(set(root.values()))
    assert simhash.one_of_each_group(frame(rows)).count() == len(set(root.values()))


def test_simhash_chain_of_links(spark):
    """A chain longer than any ball is one component; neighbours two bits apart are linked."""
    rng = random.Random(3)
    fps, f = [], rng.getrandbits(64)
    for k in range(40):
        fps.append(f)
        f ^= (1 << (k % 60)) | (1 << ((k + 3) % 64))
    fps += [rng.getrandbits(64) for _ in range(50)] + [0, 3, 2**63, 2**64 - 1]
    signed = [(x - 2**64 if x >= 2**63 else x,) for x in set(fps)]
    links = simhash.ball_links(spark.createDataFrame(signed, "fp long"))
    got = {r["node"] % 2**64: r["root"] % 2**64 for r in simhash.components(links).collect()}
    want = components_by_hand(fps)
    groups = defaultdict(set)
    for x, r in want.items():
        groups[r].add(x)
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == {
        frozenset([r, *[x for x in got if got[x] == r]]) for r in set(got.values())
    }


def test_url_filter(spark):
    rules = [
        ("net", "/", "block"),
        ("example.net", "/en/", "allow"),
        ("example.com", "/de/", "block"),
        ("org", "/fr/", "allow"),
        ("a.org", "/fr/x", "block"),
        ("a.org", "/fr/x", "allow"),
        (None, None, "block"),
        ("com", "/", None),
    ]
    pages = [
        None, "", "no scheme", "http://", "http://x.NET", "http://x.NET/", "https://Sub.example.net/en/1?a=/de/",
        "https://notexample.net/en/1", "http://example.com/de", "http://example.com/de/#x", "x://a.org/fr/xyz",
        "http://b.a.org/fr/y", "http://net/", "http://a.net:80/", "http://u@a.net/", "http://a\nb.net/p\nq", "a://b://c.net/",
    ]
    rows = [(k, u) for k, u in enumerate(pages)] + [(5, "http://x.NET/")] * 2

    def judge(url):
        m = re.match(r"(?s:.*?)://([^/?#]*)([^?#]*)", url or "")
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fits = [
            (len((h or "") + (p or "")), len(h or ""), (h or "") + (p or ""), v)
            for h, p, v in rules
            if v and (host == (h or "") or host.endswith("." + (h or "")) and h) and path.startswith(p or "")
        ]
        best = max(fits, key=lambda f: (f[:2], f[3] == "block"), default=None)
        return host, path, best and best[2], best[3] if best else "allow"

    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "url AS host", "page_id AS rule", "1 AS best")
    got = urls.judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
    got = got.select("page.page_id", "host", "path", "rule", "verdict").collect()
    assert Counter(map(tuple, got)) == Counter((i, *judge(u)) for i, u in rows)
    nothing = urls.judge_urls(df, spark.createDataFrame([], "host string, path string, verdict string"))
    assert {r["verdict"] for r in nothing.collect()} == {"allow"}


ODD_TEXTS = [
    "It's a TEST, don't!!", "ÀÉ é ẞ İ Σας", "日本語 text ½ Ⅷ ٣", "a\x1cb\u00a0c\u2028d \u3000", "<|endoftext|> x <|startoftext|><|",
    "🙂👨‍👩‍👧 'S 'll’s", "q" * 300 + "é" * 200, "\x00 \x7f",
]


def test_token_counts(frame, cases, library):
    rows = [*cases, *[(100 + k, t, "o") for k, t in enumerate(ODD_TEXTS)], (None, "null id", None)]
    rows.append((200, " ".join(ODD_TEXTS * 400), "long"))
    want = Counter()
    for i, text, _ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want[i, len((text or "").encode()), n, n > 2048] += 1
    got = token_counts.count_tokens(frame(rows), PATH).select("doc.doc_id", "n_bytes", "n_tokens", "over_limit")
    assert Counter(map(tuple, got.collect())) == want


def test_overlaps_are_widened_until_chunks_agree(library):
    counter = token_counts.Counter(PATH)
    rng = random.Random(5)
    pieces = ["a", "bc", " ", "é", "1", "'s", "!", "中", "x" * 50, "<|endoftext|>"]
    for _ in range(200):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 60)))
        want = len(library.encode(text, add_special_tokens=False).ids)
        assert counter.huge(text, chunk=12, overlap=2) == want


def test_bpe_round_trip(frame, cases, library):
    rows = [*cases, *[(100 + k, t, "o") for k, t in enumerate(ODD_TEXTS)], (None, "null id", None)]
    docs = frame(rows)
    coded = bpe.encode_documents(docs, PATH)
    want = {}
    for i, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[i] = ids, library.decode(ids, skip_special_tokens=False)
    got = coded.select("doc.doc_id", "ids").collect()
    assert len(got) == len(rows) and all(list(r["ids"]) == want[r["doc_id"]][0] for r in got)
    decoded = bpe.decode_documents(coded, PATH).select("doc.doc_id", "text").collect()
    assert all(r["text"] == want[r["doc_id"]][1] for r in decoded)
    digests = bpe.digest_documents(docs, PATH).select("doc.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    for i, n, ids, text in digests.collect():
        assert (n, ids, text) == (len(want[i][0]), sha(" ".join(map(str, want[i][0]))), sha(want[i][1]))


def test_long_words_merge_like_short_ones():
    coder = bpe.encoder(PATH)
    rng = random.Random(2)
    for _ in range(100):
        word = "".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 60)))
        parts = [coder.vocab[c] for c in [*word[:-1], word[-1] + coder.suffix]]
        assert bpe.merge_short(list(parts), coder.merges) == bpe.merge_long(list(parts), coder.merges)


def test_quality_measures(frame, cases):
    rows = [*cases, (None, "# $ % " * 30, "x"), (70, "a b c d e f g h " * 9, "x"), (71, "a\na\n \n\nb\na", "x")]

    def measure(text):
        words = WORD.findall(text)
        seen, covered = defaultdict(list), set()
        for i in range(len(words) - 7):
            seen[tuple(words[i : i + 8])].append(i)
        for starts in seen.values():
            if len(starts) > 1:
                covered.update(p for s in starts for p in range(s, s + 8))
        full = [x for x in text.split("\n") if WORD.search(x)]
        n, chars, symbols = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text))
        dup = len(full) - len(set(full))
        failed = n < 20 or 100 * len(covered) > 30 * n
        kept = not failed and 10 * symbols <= chars and 2 * dup <= len(full) and 2 * n <= chars <= 20 * n
        return n, chars, symbols, dup, len(covered), failed, kept

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = quality.judge_documents(frame(rows), measures=names).select("doc.doc_id", *names, "base_failed", "kept")
    assert Counter(map(tuple, got.collect())) == Counter((i, *measure(t or "")) for i, t, _ in rows)
    # The order of the rules changes nothing.
    back = quality.judge_documents(frame(rows), rules=quality.RULES[::-1], sample_rows=1).filter("kept").count()
    assert back == sum(measure(t or "")[-1] for _, t, _ in rows)


def test_cascade_starts_with_the_rule_worth_most(frame):
    cheap = quality.Rule("cheap", lambda m: len(m.text) < 5)
    slow = quality.Rule("slow", lambda m: sum(range(20_000)) < 0)
    rows = [(k, "x" * (k % 10), "a") for k in range(50)]
    assert [r.name for r in quality.order_rules(frame(rows), [slow, cheap])] == ["cheap", "slow"]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        total += sum(divmod(int(c) * (1 + k % 2), 10))
    return total % 10 == 0


def base_by_hand(text: str):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),  # noqa: B023
                "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),  # noqa: B023
                "phone": lambda: 8 <= len(digits) <= 15,  # noqa: B023
            }[kind]():
                found.append((kind, m.start(), m.end()))
    return found


def test_personal_data_patterns(frame, cases):
    rng = random.Random(4)
    bits = ["a@b.c", "x", "@", ".", "-", "+", "1", "255", "256.", "1.2.3.4", "4111 1111 1111 1111", "+49 (30) 123-4567", " ", "é", "🙂", "\n", "_"]
    rows = [(1000 + k, "".join(rng.choice(bits) for _ in range(rng.randint(1, 25))), "a") for k in range(300)]
    rows += [*cases, (None, "me@home.org", "x"), (2000, "1" * 4000 + " a@b.cd " * 700, "x"), (2001, "a" * 20000, "x")]
    rows += [(2002, "a@b.c_d@e.f1.2.3.4.5.6.7.8", "x"), (2003, "+1 2", "x"), (2004, "0001.02.003.255 1.1.1.999", "x")]
    got = pii.find_personal_data(frame(rows)).select("doc.doc_id", pii.span_text(F.col("base")).alias("base"))
    want = Counter((i, ",".join(f"{k}:{a}:{b}" for k, a, b in base_by_hand(t or ""))) for i, t, _ in rows)
    assert Counter(map(tuple, got.collect())) == want


def test_personal_data_terms_that_reveal(frame):
    """A name met with one address in several contexts is a span; common words and clean documents are not."""
    rows = [(k, f"number {k} says the captain Wolfram wrote from who@home.org to us {k}", "a") for k in range(4)]
    rows += [(10 + k, f"number {k} says the common words that all of us use", "a") for k in range(60)]
    rows += [(90, "who@home.org Wolfram", "a"), (91, "Wolframs says the captain", "a")]
    docs = frame(rows)
    found = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs).select("doc.doc_id", "spans").collect()}
    for k in range(4):
        terms = {(s["kind"], s["value"]) for s in found[k]}
        assert ("email", "who@home.org") in terms and ("term", "wolfram") in terms
        assert not {"says", "the", "number"} & {v for _, v in terms}
    assert all(found[10 + k] == [] for k in range(60)) and found[91] == []
    clean = pii.sanitised(pii.find_personal_data(docs, keep_text=True), docs)
    assert clean.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in clean.select("doc_id", "text").collect()}
    assert "Wolfram" not in texts[0] and "<email>" in texts[0] and texts[10] == rows[4][1]


def test_personal_data_terms_far_from_the_entity(frame):
    """Every occurrence of a telling term counts and is a span, in all documents with personal data."""
    far = "word " * 30
    rows = [(k, f"Wolfram {k} {far}\nwrite to who@home.org\nİlkyaz Wolfram", "a") for k in range(3)]
    rows += [(3, f"who@home.org {far} wolfram 3 İlkyaz", "a"), rows[0]]  # a repeated row is one more document
    rows += [(4, "Wolfram on +49 30 1234567", "a"), (5, "rare pair@home.org", "a"), (6, "rare pair@home.org", "a")]
    rows += [(10 + k, f"word number {k} write to all", "a") for k in range(60)]
    docs = frame(rows)
    found = pii.find_personal_data(docs, keep_text=True).select("doc.doc_id", "doc.text", "spans").collect()
    assert len(found) == len(rows)
    for r in found:
        spans = {(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "term"}
        assert spans == {m.span() for m in re.finditer("wolfram|İlkyaz", r["text"], re.I)}
    clean = pii.sanitised(pii.find_personal_data(docs, keep_text=True), docs).select("text").collect()
    assert not [r for r in clean if re.search("wolfram|İlkyaz", r["text"], re.I)]


def vector_by_hand(text):
    parts = []
    for p in re.split(r"(?<=[.!?])[\x20\t]+|\n", text):
        parts += [p[i : i + 200] for i in range(0, len(p), 200)]
    return Counter(parts)


def test_multiset_fingerprints(frame, cases):
    rows = sorted([r for k, r in enumerate(cases) if r not in cases[:k]], key=lambda r: r[0])
    got = multiset.fingerprint_documents(frame(rows)).select(
        "doc.doc_id", "n_chars", "edited", multiset.to_hex(F.col("vector")).alias("fp"), "vector", "next_vector",
        multiset.likeness(F.col("vector"), F.col("edited_vector")).alias("near"),
        multiset.likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
    ).collect()
    got = sorted(got, key=lambda r: r["doc_id"])
    by_parts = defaultdict(set)
    for k, r in enumerate(got):
        text, after = rows[k][1] or "", rows[(k + 1) % len(rows)][1] or ""
        quarter = len(text) // 4
        assert r["edited"] == text[: len(text) - quarter] + after[:quarter]
        assert r["n_chars"] == len(text) and 0 <= r["near"] <= 1 and 0 <= r["near_next"] <= 1
        assert r["next_vector"] == got[(k + 1) % len(got)]["vector"]
        by_parts[frozenset(vector_by_hand(text).items())].add(r["fp"])
        assert r["vector"][0] == sum(vector_by_hand(text).values())
    assert all(len(f) == 1 for f in by_parts.values())
    assert len({next(iter(f)) for f in by_parts.values()}) == len(by_parts)


def test_fingerprints_are_homomorphic(spark):
    a, b, ab = "One. Two.\nThree", "Four!\nOne.", "Three\nOne. Four! Two.\nOne."
    df = spark.createDataFrame([(a, b, ab)], "a string, b string, ab string")
    va, vb, vab = (multiset.multiset_hash(F.col(c)) for c in ("a", "b", "ab"))
    row = df.select((multiset.add(va, vb) == vab).alias("x"), (multiset.remove(vab, vb) == va).alias("y")).first()
    assert row["x"] and row["y"]


def test_likeness_of_paragraphs_repeated_very_often(frame):
    """Lanes hold any count of equal lines; 52,500 of 70,000 give 0.96."""
    counts = (52_500, 70_000, 100_000, 140_000)
    got = multiset.fingerprint_documents(frame([(n, "x\n" * n, "a") for n in counts])).select(
        "doc.doc_id",
        multiset.likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
        multiset.likeness(F.col("vector"), multiset.remove(F.col("next_vector"), F.col("vector"))).alias("left"),
    ).collect()
    assert {r["doc_id"] for r in got} == set(counts)
    for r in got:
        n, after = r["doc_id"], counts[(counts.index(r["doc_id"]) + 1) % 4]
        assert r["near_next"] == pytest.approx(2 * n * after / (n * n + after * after))
        rest = after - n  # below zero for the last
        assert r["left"] == pytest.approx(max(0, 2 * n * rest / (n * n + rest * rest)))


def test_next_document_over_blocks(frame, monkeypatch):
    """Many small blocks, null ids, repeated ids: each row sees the following one."""
    monkeypatch.setattr(multiset, "BLOCK_ROWS", 3)
    rng = random.Random(9)
    rows = [(rng.choice([k, k * k * k, -k]), f"t{k}", "a") for k in range(60)] + [(5, "again", "a"), (5, "again", "a")]
    rows += [(None, f"null {k}", "a") for k in range(20)]
    got = multiset.with_next(frame(rows)).select("doc.doc_id", "text", "next_text").collect()
    assert Counter((r[0], r[1]) for r in got) == Counter((i, t) for i, t, _ in rows)
    follows = [r["next_text"] for r in got]
    assert Counter(follows) == Counter(t for _, t, _ in rows)
    ids = sorted({i for i, _, _ in rows if i is not None})
    where = defaultdict(set)
    for i, t, _ in rows:
        where[t].add(i)
    for r in got:
        if r["doc_id"] is not None:
            after = ids[ids.index(r["doc_id"]) + 1] if r["doc_id"] != ids[-1] else None
            assert where[r["next_text"]] & {r["doc_id"], after}


def remove_by_hand(rows, n=13):
    least = {}
    split = [(i, WORD.findall(t or "")) for i, t, _ in rows]
    for i, words in split:
        if i is not None:
            for k in range(len(words) - n + 1):
                w = tuple(words[k : k + n])
                least[w] = min(least.get(w, i), i)
    for i, words in split:
        gone = set()
        if i is not None:
            for k in range(len(words) - n + 1):
                if least[tuple(words[k : k + n])] < i:
                    gone.update(range(k, k + n))
        yield i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)


@pytest.mark.parametrize("chunk_bytes", [300, 8 << 20])
def test_substring_dedup(frame, cases, chunk_bytes):
    rng = random.Random(8)
    pool = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 400)) for _ in range(rng.randint(10, 60))) for _ in range(12)]
    rows = [*cases, (None, cases[9][1], "a"), (-5, cases[20][1], "a")]
    for k in range(80):
        rows.append((300 + k, " ".join(rng.choice(pool) if rng.random() < 0.6 else f"u{rng.random()}" for _ in range(6)), "m"))
    got = substrings.remove_repeats(frame(rows), chunk_bytes=chunk_bytes)
    got = got.select("doc.doc_id", "n_words", "n_removed", "kept_text").collect()
    assert Counter(map(tuple, got)) == Counter(remove_by_hand(rows))
    assert sum(r["n_removed"] for r in got) > 1000
