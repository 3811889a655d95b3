"""The pipeline against plain computations, stage by stage, and the plans of the native operators."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_text_operators import (
    BLANKS,
    WORD,
    components_by_hand,
    fingerprint_by_hand,
    lower,
    mix_by_hand,
    sha,
)
from tokenizers import Tokenizer

import corpus_pipeline
from contextlake.llm import lines, mixing, multiset, pii, urls


@pytest.fixture(scope="module")
def documents(spark, cases):
    """Clean, junk and copied documents with the columns of the real table."""
    rng = random.Random(1)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in "lmnrst"]
    rows = []
    for k in range(120):
        lines_ = [" ".join(rng.choice(words) for _ in range(rng.randint(8, 20))) for _ in range(rng.randint(2, 6))]
        if k % 5 == 0:
            lines_.append("Licensed under some terms that everybody repeats.")
        text = "\n".join(lines_)
        if k % 11 == 3:
            text = rows[k - 1][1] + " tail"
        if k % 13 == 5:
            text = "$$$ ### " * 20
        rows.append((k, text, "en", f"src{k % 5}", len(text)))
    rows += [(200, None, None, None, None), (201, "", "en", "", 0), rows[7], rows[7]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "source").collect()]


def kept(text):
    words = WORD.findall(text)
    seen, covered = defaultdict(list), set()
    for i in range(len(words) - 7):
        seen[tuple(words[i : i + 8])].append(i)
    for starts in seen.values():
        if len(starts) > 1:
            covered.update(p for s in starts for p in range(s, s + 8))
    full = [x for x in text.split("\n") if WORD.search(x)]
    n, chars = len(words), sum(map(len, words))
    return not (
        n < 20
        or 100 * len(covered) > 30 * n
        or 10 * len(re.findall(r"[#*$%&|<>]", text)) > chars
        or 2 * (len(full) - len(set(full))) > len(full)
        or not 2 * n <= chars <= 20 * n
    )


def test_stages(spark, documents):
    docs, made = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, None).persist()
        made[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
    good = rows_of(made["quality rules"])
    assert Counter(good) == Counter(r for r in rows_of(documents) if kept(r[1] or ""))

    holders = defaultdict(set)
    for i, text, _ in good:
        for line in text.split("\n"):
            if len(key := lower(line).strip(BLANKS)) >= 20:
                holders[key].add(i)
    stay = lambda i, x: len(h := holders[lower(x).strip(BLANKS)]) < 3 or max(h) == i
    cut = [(i, "\n".join(x for x in t.split("\n") if stay(i, x)), s) for i, t, s in good]
    assert Counter(rows_of(made["line dedup"])) == Counter(cut) and Counter(cut) != Counter(good)

    fps = {r: fingerprint_by_hand(r[1]) for r in cut}
    root = components_by_hand(fps.values())
    first = {}
    for r in cut:
        key = root[fps[r]]
        first[key] = min(first.get(key, r), r)
    single = rows_of(made["near duplicates"])
    assert {root[fps[r]]: r[0] for r in single} == {k: r[0] for k, r in first.items()} and len(single) == len(first)

    _, target = mix_by_hand(single)
    mixed = rows_of(made["source mixing"])
    words = Counter()
    for _, text, source in mixed:
        words[source] += len(WORD.findall(text))
    assert dict(words) == {s: int(t) for s, t in target.items()}
    whole = {r[0]: r[1] for r in single}
    assert all(whole[i].startswith(t) for i, t, _ in mixed)

    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    last = made[corpus_pipeline.STAGES[-1][0]].select("doc_id", "ids", "n_tokens", "decoded_sha256").collect()
    assert Counter((i, tuple(ids)) for i, ids, *_ in last) == Counter(
        (i, tuple(library.encode(t, add_special_tokens=False).ids)) for i, t, _ in mixed
    )
    assert all(n == len(ids) for _, ids, n, _ in last)
    assert all(sha(library.decode(list(ids), skip_special_tokens=False)) == text for _, ids, _, text in last)


def test_columns_of_the_stages_own_names(spark, documents):
    """Documents that carry working names and a very long text go through every stage."""
    names = ("n_tokens", "ids", "doc", "row", "kept", "key", "g", "take", "fp", "decoded_sha256", "lines", "size")
    docs = documents.filter("doc_id IS NOT NULL").selectExpr("*", *[f"concat('x', doc_id) AS `{n}`" for n in names])
    words = [f"{a}{b}{c}{d}" for a in "bdfgklm" for b in "aeiou" for c in "lmnrst" for d in "aeiou"]
    rng = random.Random(3)
    long = "\n".join(" ".join(rng.choice(words) for _ in range(14)) for _ in range(9000))
    docs = docs.unionByName(docs.limit(1).withColumns({"text": F.lit(long), "doc_id": F.lit(999).cast("long"), "source": F.lit("long")}))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, None)
        assert docs.dtypes == before.dtypes
        docs = docs.persist()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, None)
    own = {"n_tokens", "ids", "decoded_sha256"}
    assert [c for c in docs.columns if c not in own and c != "text"] == [c for c in last.columns if c not in own]
    rows = last.select("doc_id", "n_tokens", "row", F.size("ids").alias("size")).collect()
    assert all(r["n_tokens"] == r["size"] for r in rows)
    assert sum(r["n_tokens"] for r in rows if r["doc_id"] == 999) > 100_000


def test_run_writes_between_stages(spark, documents, tmp_path):
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "source", "n_tokens", "ids"} <= set(result.columns) and result.count() > 0


def test_pipeline_of_nothing(spark, documents, tmp_path):
    documents.filter("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_native_operators_run_no_python(frame, cases, spark):
    docs = frame(cases)
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    frames = [
        lines.drop_shared_lines(docs),
        mixing.mixed_documents(docs),
        urls.judge_urls(docs.withColumnRenamed("text", "url"), rules),
        pii.find_personal_data(docs),
        multiset.fingerprint_documents(docs).select(multiset.likeness(F.col("vector"), F.col("next_vector"))),
    ]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan), plan
