"""Terms that reveal entities, against counts made by hand over a random corpus."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

from contextlake.llm import pii


def entities(spans):
    found = set()
    for kind, _, _, value in spans:
        value = value.lower()
        digits = re.sub("[^0-9]", "", value)
        group = {
            "email": value.rsplit("@", 1)[-1], "ip": ".".join(value.split(".")[:3]), "card": digits[:6], "phone": digits[:2],
        }[kind]
        found |= {f"{kind}:{value}", f"{kind}:class:{group}"}
    return found


def added_by_hand(rows, base, least=3, remove_at=0.9, generalise_at=0.8):
    """Added spans per row from corpus counts; ``base`` holds the pattern spans of each row."""
    n = len(rows)
    terms = [{m.lower() for m in re.findall(r"[^\W\d_]{3,}", t or "")} for _, t, _ in rows]
    owned = [entities(b) for b in base]
    n_term = Counter(t for ts in terms for t in ts)
    n_entity = Counter(e for es in owned for e in es)
    n_both, texts, own_texts = Counter(), defaultdict(set), defaultdict(set)
    for (_, text, _), ts, es in zip(rows, terms, owned, strict=True):
        for e in es:
            own_texts[e].add(text)
            for t in ts:
                n_both[e, t] += 1
                texts[e, t].add(text)
    telling = {}
    for (e, t), both in n_both.items():
        if len(own_texts[e]) >= least and n_term[t] >= least and len(texts[e, t]) >= least and n_entity[e] < n:
            share = math.log2(both * n / (n_entity[e] * n_term[t])) / math.log2(n / n_entity[e])
            telling[t] = max(telling.get(t, 0), share)
    out = []
    for (_, text, _), b in zip(rows, base, strict=True):
        spans = []
        for m in re.finditer(r"[^\W\d_]{3,}", text or "") if b else []:
            share = telling.get(m.group().lower(), 0)
            if share >= generalise_at - 1e-12 and not any(m.start() < e and s < m.end() for _, s, e, _ in b):
                spans.append(("term" if share >= remove_at - 1e-12 else "hint", m.start(), m.end()))
        out.append(sorted(spans))
    return out


def test_disclosure_equals_counts_by_hand(frame):
    rng = random.Random(21)
    domains = ["alpha.org", "beta.net", "gamma.io"]
    words = {d: [f"{d[:2]}{w}" for w in ("team", "lane", "dock")] for d in domains}
    common = [f"word{chr(97 + k)}" for k in range(20)] + ["Straße", "naïve"]
    rows = []
    for k in range(260):
        parts = rng.choices(common, k=rng.randint(3, 15))
        if k % 3 == 0:
            d = rng.choice(domains)
            parts += [f"user{k}@{d}"] + rng.sample(words[d], rng.randint(1, 3))
        if k % 7 == 0:
            parts += [f"10.2.3.{k % 250}", "router"] + ["router"] * (k % 2)
        if k % 11 == 0:
            parts += ["+49 30 12345" + str(100 + k), "hotline"]
        if k % 4 == 1:
            parts += [rng.choice(sum(words.values(), []))]
        rng.shuffle(parts)
        rows.append((k, " ".join(parts), "a"))
    rows += [rows[9], rows[9], (900, rows[12][1], "a"), (901, None, "a"), (None, rows[21][1], "b")]
    found = pii.find_personal_data(frame(rows), keep_text=True).select("doc.doc_id", "doc.text", "base", "spans").collect()
    by_row = defaultdict(list)
    for r in found:
        by_row[r["doc_id"], r["text"]].append(r)
    got_base, got_added = [], []
    for i, text, _ in rows:
        r = by_row[i, text].pop()
        base = [tuple(s) for s in r["base"]]
        got_base.append(base)
        got_added.append(sorted((s["kind"], s["start"], s["end"]) for s in r["spans"] if tuple(s) not in base))
    want = added_by_hand(rows, got_base)
    assert got_added == want
    kinds = Counter(kind for spans in want for kind, _, _ in spans)
    assert kinds["term"] > 20 and kinds["hint"] > 5


def test_many_spans_of_one_document(spark, frame):
    """Thousands of spans in one text are told apart by position, not pair by pair."""
    rows = [(k, f"who{k}@home.org signed " * 3, "a") for k in range(4)] + [(9, "plain words only", "a")] * 5
    rows.append((8, "signed x@home.org " * 6000, "a"))
    found = pii.find_personal_data(frame(rows)).select("doc.doc_id", "base", "spans").collect()
    size = {r["doc_id"]: (len(r["base"]), len(r["spans"])) for r in found}
    assert size[8] == (6000, 12_000) and size[0] == (3, 6) and size[9] == (0, 0)
