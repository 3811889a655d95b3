"""What grows with the input: bytes of landing files, parses of a record, steps beside each other."""

from __future__ import annotations

import glob
import gzip
import os
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contextlake.operators import imports, sleep, subscriptions
from contextlake.session import work_dir
from contextlake.sinks import tables as sinks
from query_catalog import QUERIES


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """A folder with an events table of a few rows."""
    folder = str(tmp_path_factory.mktemp("growth"))
    spark.range(60).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2024-01-30 10:00:00' + make_dt_interval(0, 0, CAST(id AS INT)) AS ts",
        "id % 7 AS user_id", "element_at(array('click', 'view', 'purchase', 'signup', 'error'), CAST(id % 5 + 1 AS INT)) AS event_type",
        "id / 4D AS value", "'{\"k\": 1}' AS props",
    ).write.parquet(f"{folder}/events.parquet")
    return folder


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_compressed_landing_is_cut_into_files(spark, monkeypatch):
    """Each file of a compressed landing is read by one task, so it holds a bounded number of lines."""
    monkeypatch.setattr(sinks, "LINES_PER_FILE", 4)
    root = work_dir(spark, "landing-gz")
    rows = spark.range(10).selectExpr("'s' AS source_name", "CAST(id AS STRING) AS event_id", "'{}' AS provenance",
        "'{}' AS payload_summary", "to_json(struct(id)) AS payload")
    sinks.write_landing(rows, root, "2024-01-02", compression="gzip")
    found = glob.glob(f"{root}/landing_source=s/dt=2024-01-02/*.json*")
    sizes = [len(gzip.open(path).read().splitlines()) for path in found if path.endswith(".json.gz")]
    assert len(sizes) == len(found) and max(sizes) <= 4 and sum(sizes) == 10
    sinks.write_landing(rows, root, "2024-01-02")
    assert spark.read.json(root).select("event_id", "payload.id").distinct().count() == 10
    assert spark.read.json(root).count() == 20


@pytest.mark.parametrize(
    "name", ["s06_landing_read", "k06_landing_manifest", "k18_load_with_odd_lines", "k18_ids_are_one_row_in_all_loads"]
)
def test_landing_of_large_tables_is_compressed(spark, events, monkeypatch, name):
    """Plain JSON lines were most of the bytes that these queries wrote."""
    import query_catalog.sink_queries as sink_queries
    import query_catalog.source_queries as source_queries

    made = []

    def noted(spark_, folder):
        made.append(work_dir(spark_, folder))
        return made[-1]

    for module in (sink_queries, source_queries):
        monkeypatch.setattr(module, "work_dir", noted)
    assert QUERIES[name](spark, events).count() > 0
    found = [f for root in made for f in glob.glob(f"{root}/**/*.json*", recursive=True)]
    assert found and all(f.endswith(".json.gz") for f in found)


def test_times_of_a_night_are_read_once(spark):
    names = ("slept_at", "woke_at", "in_bed_minutes", "quality_score", "recovery_score", "source", "user_id")
    nights = spark.range(3).select(*[F.concat(F.lit("2024"), "id").alias(c) for c in names])
    valid, _rejected = sleep.normalize_sleep(nights, keep=("user_id",))
    assert plan_of(valid.select("user_id", "duration_minutes")).count("timestampdiff") == 1


def test_a_record_is_parsed_once(spark):
    rows = spark.range(3).select(F.lit("{}").alias("x"), F.to_json(F.struct("id")).alias("row_json"), F.lit("a.json").alias("path"), "id")
    rows = rows.withColumn("row_number", F.col("id"))
    for kind in ("training_sessions", "tasks_and_projects"):
        part = imports.summarize_source(rows, kind).filter(F.col("reject_reason").isNull()).select("row_number", "labels", "metrics")
        assert plan_of(part).count("from_json") == 1


def size_of(df) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def test_columns_kept_of_a_record_are_not_taken_for_a_small_table(spark, events):
    """Two columns of a parsed record, one row per event, are estimated as large as two columns of the table."""
    rows = spark.read.parquet(f"{events}/events.parquet").select(F.col("props").alias("row_json"), F.col("event_type").alias("path"))
    for parsed in (imports.learning_sessions(rows), imports.trade_entries(rows)):
        assert size_of(parsed.select("source_file_hash", "reject_reason")) >= 0.9 * size_of(rows)


@pytest.mark.parametrize("name", ["d11_learning_and_trades", "d11_rows_without_time"])
def test_lessons_and_trades_are_not_broadcast(spark, events, name):
    """They have a row per event; the small table of this test would be broadcast without a hint."""
    plan = QUERIES[name](spark, events)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") >= 2


def test_pipeline_encodes_and_decodes_one_after_the_other(spark):
    """The ids are written between the two: no task runs two Python workers, each with a vocabulary."""
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "some text", "a"), (2, None, "b")], "doc_id long, text string, ids string")
    coded = corpus_pipeline.encode(spark, docs, "")
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert [(r.doc_id, r.n_tokens, len(r.ids)) for r in coded.orderBy("doc_id").collect()] == [(1, 2, 2), (2, 0, 0)]


def test_subscriptions_meet_in_many_parts(spark):
    """Parts are not joined again by their bytes: what a task sorts follows the rows."""
    subs = spark.range(40).selectExpr(
        "CAST(id % 20 AS STRING) AS subscription_id", "IF(id % 2 = 0, 'api_json', 'rss_feed') AS source_type", "true AS enabled",
        "'l' AS label", "'r' AS reference",
    ).distinct()
    text = F.expr("""IF(id % 2 = 0, '[{"title": "a"}, {"title": "b"}]', '<rss><item><title>a</title></item></rss>')""")
    contents = spark.range(20).select(F.col("id").cast("string").alias("subscription_id"), text.alias("text"))
    items = subscriptions.subscription_items(subs, contents, checked_at="2024-01-31 00:00:00")
    plan = items._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{subscriptions.PARTS}), REPARTITION_BY_NUM") >= 4
    assert items.groupBy("subscription_id").count().groupBy("count").count().collect() != []
    assert items.count() == 10 * 2 + 10


def test_parts_are_renamed_without_asking_for_blocks(spark):
    """Written parts at any depth get their names; files are listed a folder at a time."""
    from query_catalog.source_queries import _rename_parts

    root = work_dir(spark, "named")
    spark.range(9).selectExpr("CAST(id AS STRING) AS v", "id % 3 AS p").write.partitionBy("p").option("maxRecordsPerFile", 1).text(root)
    _rename_parts(spark, root, "n{}.md")
    found = sorted(f.rsplit("/", 1)[1] for f in glob.glob(f"{root}/p=*/*"))
    assert found == sorted(f"n{k}.md" for k in range(9)) and not glob.glob(f"{root}/_SUCCESS")
    assert "listFiles" not in _rename_parts.__code__.co_names


def test_pipeline_sends_texts_and_ids_to_python_once(spark, monkeypatch):
    """Python workers and Arrow buffers hold the text of a batch, or its ids, one time."""
    import corpus_pipeline

    docs = spark.createDataFrame(
        [(1, "Some text", "a", 9), (2, None, "b", None), (3, "", "b", 0)], "doc_id long, text string, source string, n_chars long"
    )
    sent = []

    def noted(self, *args, _map=type(docs).mapInArrow, **options):
        sent.append(self.schema.simpleString())
        return _map(self, *args, **options)

    monkeypatch.setattr(type(docs), "mapInArrow", noted)
    for stage in (corpus_pipeline.keep_good, corpus_pipeline.drop_copies, corpus_pipeline.encode):
        stage(spark, docs, "")
    big = [len(re.findall(r"text:|ids:", kind)) for kind in sent]
    assert len(big) == 5 and max(big) == 1, sent


def test_a_worker_that_decodes_keeps_no_encoder():
    """Workers serve one task after another; the encoder with its words was most of their memory."""
    import public_tokenizers

    from contextlake.llm import bpe

    path = public_tokenizers.path("word_bpe_49k.json")
    ids = bpe.encoder(path).encode("Some text")
    names = bpe.names_alone(path)
    assert bpe.encoder.cache_info().currsize == 0
    assert " ".join(names[i] for i in ids) == bpe.encoder(path).decode(ids)


def test_a_kept_text_is_read_where_it_is_sent(spark):
    """Of any type, at any place, null or not, beyond one slice of rows."""
    from contextlake.llm.common import map_texts

    def work(texts):
        return [pa.array([t.as_py() for t in texts], pa.binary())]

    rows = [(k, None if k % 5 == 0 else f"té{k}" * (k % 3), k) for k in range(600)]
    docs = spark.createDataFrame(rows, "id long, `a text` string, n int").coalesce(1)
    for column, want in (("a text", [(t or "").encode() for _, t, _ in rows]), ("n", [str(n).encode() for *_, n in rows])):
        found = map_texts(docs, work, {"seen": "binary"}, column, keep_text=True).orderBy("doc.id").collect()
        assert [bytes(r.seen) for r in found] == want
        assert [tuple(r.doc) for r in found] == rows


@pytest.fixture
def staged(monkeypatch):
    """Rows of each staged file of an import, by its folder, and the plans of what it lands."""
    from contextlake.plans import inbox

    rows, plans = {}, []

    def noted(df, path, *partitions, write=inbox._written):
        found = write(df, path, *partitions)
        counts = found.groupBy(F.input_file_name()).count().collect()
        rows[path] = sorted(r["count"] for r in counts)
        return found

    def planned(lines, *args, writer=sinks.landing_writer):
        plans.append(lines._jdf.queryExecution().executedPlan().toString())
        return writer(lines, *args)

    monkeypatch.setattr(inbox, "_written", noted)
    monkeypatch.setattr(inbox, "ROWS_PER_FILE", 2, raising=False)
    monkeypatch.setattr(sinks, "landing_writer", planned)
    return rows, plans


def test_an_inbox_is_landed_compressed_and_without_a_shuffle(spark, events, staged, monkeypatch):
    """Plain envelopes were nine tenths of the bytes on disk, and dealing them out most of the shuffle."""
    import query_catalog.source_queries as source_queries

    made, plans = {}, staged[1]

    def noted(spark_, folder):
        made[folder] = work_dir(spark_, folder)
        return made[folder]

    monkeypatch.setattr(source_queries, "work_dir", noted)
    rows = {r["source_name"]: r for r in QUERIES["s19_inbox_to_envelopes"](spark, events).collect()}
    assert {n: (r["n"], r["n_ids"], r["rejected"]) for n, r in rows.items()} == {
        "trade_journal_summary": (51, 51, 9), "training_sessions": (48, 48, 12), "sleep_quality": (53, 53, 7),
        "calendar_events": (60, 60, 0), "personal_notes_summary": (5, 5, 0),
    }
    found = glob.glob(f"{made['s19-landing']}/**/*.json*", recursive=True)
    assert found and all(f.endswith(".json.gz") for f in found)
    assert plans and not any("Exchange" in p for p in plans)


def test_staged_rows_of_an_inbox_lie_in_many_files(spark, tmp_path, staged):
    """A kind with all the rows is parsed and landed by several tasks; nothing staged is left."""
    from contextlake.plans import inbox

    rows, _plans = staged
    (tmp_path / "trade_log.csv").write_text("date,symbol\n" + "2024-01-01,ABC\n" * 5)
    landing, rejects = work_dir(spark, "staged-landing"), work_dir(spark, "staged-rejects")
    inbox.import_inbox(spark, str(tmp_path), landing, rejects, "2024-02-01 00:00:00", "2024-02-01")
    assert sorted(rows.values()) == [[1], [1, 2, 2], [1, 2, 2]]
    assert not any(os.path.exists(path.removeprefix("file:")) for path in rows)
    lines = spark.read.json(landing)
    assert lines.count() == lines.select("event_id").distinct().count() == 5
    assert spark.read.parquet(rejects).count() == 0
