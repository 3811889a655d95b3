"""State that batches add to: change streams out of order, late rows, batches that run again."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from contextlake.operators import rollups
from contextlake.session import work_dir
from contextlake.streaming import changes, late

CHANGE = "op string, lsn long, before struct<k:int,v:string>, after struct<k:int,v:string>"


def change(op, lsn, k, v):
    image = None if k is None else (k, v)
    return (op, lsn, image, None) if op == "d" else (op, lsn, None, image)


def test_state_of_batches_out_of_order(spark):
    rng = random.Random(3)
    log = [change(rng.choice("cuud"), lsn, rng.randint(1, 12), f"v{lsn}") for lsn in range(120)]
    want = {}
    for op, _, before, after in log:
        want[(before or after)[0]] = None if op == "d" else after[1]
    rows = log + rng.sample(log, 30) + [(None, 500, None, None), ("u", 600, None, None)]
    rng.shuffle(rows)
    path = work_dir(spark, "state")
    state = changes.ChangeState(spark, path, ["k"], compact_every=3)
    with pytest.raises(ValueError):
        state.current()
    for n in range(8):
        batch = spark.createDataFrame(rows[n::8], CHANGE)
        state.add(batch, n)
        if n in (2, 5, 7):
            state.add(batch, n)  # the batch runs again after a restart
    assert {r["k"]: r["v"] for r in state.current().collect()} == {k: v for k, v in want.items() if v is not None}
    assert state._base() == 5 and state._since(5) == [6, 7]
    assert changes.ChangeState(spark, path, ["k"]).current().count() == state.current().count()


def test_a_late_change_does_not_bring_a_deleted_row_back(spark):
    state = changes.ChangeState(spark, work_dir(spark, "deleted"), ["k"], compact_every=2)
    for n, rows in enumerate(([change("c", 1, 1, "a"), change("c", 2, 2, "b")], [change("d", 9, 1, "a")], [change("u", 5, 1, "late")], [])):
        state.add(spark.createDataFrame(rows, CHANGE), n)
    assert [tuple(r) for r in state.current().collect()] == [(2, "b")]
    state.add(spark.createDataFrame([change("u", 10, 1, "new"), change("d", 10, 2, "b"), change("u", 10, 2, "x")], CHANGE), 4)
    assert [tuple(r) for r in state.current().collect()] == [(1, "new")]


def test_a_base_that_was_not_finished_does_not_count(spark):
    state = changes.ChangeState(spark, work_dir(spark, "unfinished"), ["k"], compact_every=9)
    for n in range(3):
        state.add(spark.createDataFrame([change("c", n, n, "a")], CHANGE), n)
    spark.createDataFrame([], CHANGE).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False).parquet(
        f"{state.path}/base/upto=2"
    )
    assert state._base() == -1 and state.current().count() == 3


def test_late_rows_are_kept_once(spark):
    start = datetime(2024, 1, 1)
    batches = [
        [(1, 0), (2, 30), (3, 200)],  # seconds
        [(4, 10), (5, 100), (6, 150), (7, 400), (8, None)],
        [(9, 59), (10, 299), (11, 330)],
        [],
    ]
    counts = late.MinuteCounts(spark, work_dir(spark, "minutes"), "at", "id", timedelta(minutes=1))
    assert counts.closed() is None and counts.late() is None
    newest, sums, behind = None, {}, []
    for n, batch in enumerate(batches):
        rows = [(i, None if s is None else start + timedelta(seconds=s)) for i, s in batch]
        for _run in range(2 if n != 1 else 3):
            counts.add(spark.createDataFrame(rows, "id long, at timestamp"), n)
        mark = None if newest is None else newest - 60
        for i, s in batch:
            if s is not None and mark is not None and s // 60 * 60 + 60 <= mark:
                behind.append(i)
            elif s is not None:
                rows_, total = sums.get(s // 60, (0, 0))
                sums[s // 60] = rows_ + 1, total + i
        newest = max([s for _, s in batch if s is not None] + ([newest] if newest is not None else []))
    got = {(r["minute"] - start).seconds // 60: (r["rows"], r["total"]) for r in counts.closed().collect()}
    assert got == {m: v for m, v in sums.items() if m * 60 + 60 <= newest - 60} != {}
    assert sorted(r["id"] for r in counts.late().collect()) == sorted(behind) == [4, 5, 9, 10]


def test_sketches_of_parts_are_the_sketch_of_the_whole(spark):
    rows = spark.range(40_000).select(
        F.lit("s").alias("source"), F.timestamp_seconds(F.col("id") % 7200).alias("at"), (F.col("id") % 9000).alias("key")
    )
    minutes = rollups.minute_sketches(rows, "source", "at", "key")
    hours = rollups.merge_sketches(minutes, ["source", F.date_trunc("hour", "minute").alias("hour")])
    whole = rollups.sketched_keys(rollups.merge_sketches(hours, ["source"])).first()
    direct = rows.agg(F.hll_sketch_estimate(F.hll_sketch_agg("key", rollups.SKETCH_LOG_BUCKETS))).first()[0]
    assert whole["rows"] == 40_000 and abs(whole["approx_keys"] - 9000) <= 4 * rollups.SKETCH_ERROR * 9000
    assert abs(whole["approx_keys"] - direct) <= 1


@pytest.mark.parametrize("inclusive", [True, False])
def test_moments_see_the_last_earlier_fact(spark, inclusive):
    from contextlake.operators.asof import known_then

    rng = random.Random(4)
    base = datetime(2024, 1, 1)
    time = lambda: None if rng.random() < 0.05 else base + timedelta(minutes=rng.randint(0, 4000))
    # Key 1 has most of the rows, over several chunks.
    key = lambda: rng.choice([1] * 8 + [2, 3, None])
    facts = [(k, key(), time()) for k in range(300)]
    moments = [(k, key(), time()) for k in range(300)] + [(5, 1, base)] * 2
    want = []
    for i, k, t in moments:
        known = [
            (s, n) for n, kk, s in facts
            if k is not None and kk == k and t is not None and s is not None and (s <= t if inclusive else s < t)
        ]
        want.append((i, k, t, max(known)[1] if known else None))
    got = known_then(
        spark.createDataFrame(moments, "id int, k int, t timestamp"), spark.createDataFrame(facts, "n int, k int, t timestamp"),
        ["k"], "t", "t", tie=["n"], inclusive=inclusive, chunk=timedelta(hours=5),
    ).select("id", "k", "t", "known.n")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert not any(x in got._jdf.queryExecution().executedPlan().toString() for x in ("NestedLoop", "Cartesian", "Python"))


def test_suite_state_reads_touched_partitions_only(spark):
    from contextlake.operators import quality, suite_state

    suite = [
        quality.Expectation("rows", "t", "row_count", threshold=2),
        quality.Expectation("bad", "t", "violations", F.col("x") < 0),
        quality.Expectation("fresh", "t", "freshness", F.col("at"), threshold=60),
    ]
    state = suite_state.SuiteState(spark, work_dir(spark, "suite"), suite)
    path, as_of = work_dir(spark, "suite-table"), "2024-01-01 02:00:00"
    schema = "x int, at timestamp, day string"
    at = lambda m: datetime(2024, 1, 1, 1, m)
    loads = [
        [(1, at(0), "a"), (-1, at(1), "a"), (5, None, "b")],
        [(-2, at(50), None)],
        [(3, at(2), "a")],  # the day is written again, without its violation
    ]

    def observed(results):
        return {r["id"]: (r["observed"], r["passed"]) for r in results.collect()}

    for n, rows in enumerate(loads):
        brought = spark.createDataFrame(rows, schema)
        brought.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
        table = spark.read.schema(schema).parquet(path)
        state.add(n, "t", table, "day", brought)
        whole = observed(quality.run_expectations({"t": table}, suite, as_of))
        assert observed(state.results(["t"], as_of)) == whole
    state.compact("t")
    assert observed(state.results(["t"], as_of)) == whole and whole["rows"] == (3.0, True)
    touched = suite_state.touched_partitions(spark.createDataFrame([("a",)], "day string"), ["day"], work_dir(spark, "suite-a"))
    rows = state.touched_rows(table, touched, "day")
    assert rows.count() == 1
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString().lower()
    # An emptied partition counts as such.
    state.add(9, "t", table.filter("day <> 'b'"), "day", spark.createDataFrame([("b",)], "day string"))
    assert observed(state.results(["t"], as_of))["rows"] == (2.0, False)
