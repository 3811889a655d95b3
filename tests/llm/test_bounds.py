"""Very long inputs, block sizes and the SQL twins on texts with every kind of white space."""

from __future__ import annotations

import time
from collections import Counter

import duckdb
import pyarrow as pa
from test_text_operators import mix_by_hand

from contextlake.llm import mixing, quality, queries, substrings, urls


def test_very_long_urls_take_seconds(spark):
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("x.a.org", "/fr/", "allow"), ("b.c", "", "block")], "host string, path string, verdict string"
    )
    many = "a." * 500_000
    pages = [
        (1, f"http://{many}net/x", "net/", "block"),
        (2, f"http://{many}x.a.org/fr/" + "p/" * 500_000, "x.a.org/fr/", "allow"),
        (3, f"http://{many}b.c", "b.c", "block"),
        (4, "." * 1_000_000 + "://" + "." * 1_000_000, None, "allow"),
        (5, "x" * 2_000_000, None, "allow"),
    ]
    df = spark.createDataFrame([p[:2] for p in pages], "page_id long, url string")
    began = time.monotonic()
    got = urls.judge_urls(df, rules).select("page.page_id", "rule", "verdict").collect()
    assert sorted(map(tuple, got)) == [(i, rule, verdict) for i, _, rule, verdict in pages]
    assert time.monotonic() - began < 60


def test_block_size_does_not_change_the_mix(frame, cases):
    assert [mixing.block_digits(n, 10) for n in (0, 40_960, 40_961, 655_361)] == [3, 3, 4, 5]
    want = mixing.mix_sources(frame(cases))
    assert "text" not in want.schema["doc"].dataType.fieldNames()
    columns = ("doc.doc_id", "taken", "part", "copies")
    fine = mixing.mix_sources(frame(cases), block_rows=1e-4)
    assert Counter(map(tuple, fine.select(*columns).collect())) == Counter(map(tuple, want.select(*columns).collect()))
    _, target = mix_by_hand(cases)
    taken = Counter()
    for r in fine.select("doc.source", "taken").collect():
        taken[r["source"]] += r["taken"]
    assert {s: int(t) for s, t in target.items()} == {s: taken[s] for s in target}


def test_quality_sql_knows_all_white_space(spark, tmp_path):
    lines = ["one two\r\n", "three\x0bfour\x0cfive\r\n", "one two\r\n", "\r\n", "\x0b\n", "six\tseven  eight\r"]
    texts = ["".join(lines) * k for k in range(4)] + [None, "", "\r", "a\rb " * 30, "x y z w\r\n" * 40, "no break here at all"]
    rows = [(k, t) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op9_quality"](spark, str(tmp_path))
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r[0] for r in rows], "text": pa.array([r[1] for r in rows], pa.string())}))
    columns = ("doc_id", *queries.MEASURES, "base_failed", "kept")
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES['op9_quality']})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want)


def test_sample_stays_where_it_is_read(frame, cases, monkeypatch):
    """The sample for the order of rules is judged in the scan; no text is shuffled or gathered."""
    plans = []
    inner = quality.map_texts

    def seen(*args, **kwargs):
        out = inner(*args, **kwargs)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(quality, "map_texts", seen)
    quality.order_rules(frame(cases), sample_rows=10)
    assert plans and "Sample" in plans[0] and plans[0].count("Exchange") == 1  # the test frame's own


def test_substring_dedup_leaves_no_table(spark, frame, cases):
    before = {t.name for t in spark.catalog.listTables()}
    kept = substrings.remove_repeats(frame(cases))
    assert {t.name for t in spark.catalog.listTables()} == before and kept.count() == len(cases)
