"""Local exports: record numbers of CSV files in many splits, and one inbox from files to envelopes."""

from __future__ import annotations

import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from contextlake.plans import inbox
from contextlake.plans.medallion import load_medallion
from contextlake.session import work_dir
from contextlake.sources import csv_records, files


@pytest.fixture
def fine_splits(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "300")
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    return session


def test_csv_numbers_are_those_of_the_whole_file(fine_splits, tmp_path):
    rng = random.Random(1)
    want = {}
    for name, head in (("a.csv", ["id", "text", "n"]), ("B.CSV", ["n", "id"]), ("one.csv", ["id"]), ("twice.csv", ["id", "x", "x"])):
        with (tmp_path / name).open("w", newline="") as file:
            out = csv.writer(file)
            file.write("\n  \n")
            out.writerow(head)
            for k in range(rng.randint(60, 200)):
                row = {"id": f"{name}{k}", "text": rng.choice(['plain', 'a, "b"', "it's", "é, ü", " "]), "n": str(k) if k % 3 else "", "x": f"x{k}"}
                out.writerow([row[h] for h in head])
                if k % 7 == 0:
                    file.write("\r\n")
        with (tmp_path / name).open(newline="") as file:
            lines = [line for line in file if line.strip()]
            for k, row in enumerate(csv.DictReader(lines), start=1):
                want[name, k] = {h: v for h, v in row.items() if v}
    (tmp_path / "head_only.csv").write_text("id,n\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "other.txt").write_text("id\n1\n")
    records = csv_records.csv_records(fine_splits, str(tmp_path))
    got = {(r["file"].rsplit("/", 1)[1], r["row_number"]): json.loads(r["row_json"]) for r in records.collect()}
    trimmed = {key: {h: v for h, v in row.items() if v.strip()} for key, row in got.items()}
    assert trimmed == {key: {h: v for h, v in row.items() if v.strip()} for key, row in want.items()}
    splits = csv_records.csv_lines(fine_splits, str(tmp_path)).groupBy("file").agg(F.count_distinct("block").alias("n"))
    assert max(r["n"] for r in splits.collect()) > 5
    assert csv_records.csv_records(fine_splits, str(tmp_path), "*.nothing").count() == 0


def test_fields_beyond_or_before_the_header_end(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1\n1,2,3\n,\n\"q\"\"q\",\"w\n")
    rows = csv_records.csv_records(spark, str(tmp_path)).orderBy("row_number").collect()
    assert [(r["row_number"], json.loads(r["row_json"])) for r in rows][:3] == [(1, {"a": "1"}), (2, {"a": "1", "b": "2"}), (3, {})]
    assert json.loads(rows[3]["row_json"])["a"] == 'q"q'


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "in"
    (root / "deep er").mkdir(parents=True)
    put = lambda name, text: (root / name).write_text(text)
    put("trade_journal.csv", "date,symbol,side,pnl_r\n2024-01-01,ABC,Long,1.5\n,ABC,Long,2\n2024-01-03,X,short,oops\n")
    put("sleep_log.csv", "slept_at,woke_at,quality_score\n2024-01-01T22:00:00,2024-01-02T06:00:00,80\n2024-01-02T22:00:00,2024-01-02T21:00:00,80\n")
    put("deep er/moto.json", json.dumps({"rows": [{"date": "2024-01-04", "topic": "Braking!", "lesson": "L1"}, 7, {"topic": "none"}]}))
    put("training.json", json.dumps([{"date": "2024-01-05", "activity_type": "Run", "duration_minutes": "30"}, {"activity_type": "walk"}]))
    put("data_source_runs.json", json.dumps([{"observed_at": "2024-01-05", "source_name": "abc", "status": "ok", "freshness_minutes": 3}]))
    put("by_keys.json", json.dumps([{"metric_date": "2024-01-06", "metric_name": "steps", "metric_value": 9, "unit": "n"}]))
    put("broken_health.json", "{not json")
    put("unknown.json", json.dumps([{"zzz": 1}]))
    put("skipped.bin", "x")
    put("my note.md", "---\ndate: 2024-01-07\ntags: One, two\n---\n# Title\nsome words here")
    put("empty.md", "")
    put("summary_list.json", json.dumps({"notes": [{"title": "t", "body": "b c", "tags": ["A"]}]}))
    put("cal.ics", "BEGIN:VCALENDAR\nBEGIN:VEVENT\nDTSTART:20240108T100000Z\nDTEND:20240108T113000Z\nSUMMARY:Team sync\nEND:VEVENT\n"
        "BEGIN:VEVENT\nSUMMARY:no start\nEND:VEVENT\nEND:VCALENDAR\n")
    return str(root)


def test_inbox_ends_in_envelopes_and_rejects(spark, folder):
    landing, rejects = work_dir(spark, "inbox-landing"), work_dir(spark, "inbox-rejects")
    inbox.import_inbox(spark, folder, landing, rejects, "2024-02-01 00:00:00", "2024-02-01")
    rows = files.read_landing(spark, f"{landing}/*/dt=*/*").collect()
    got = sorted((r["source_name"], r["event_time"][:10]) for r in rows)
    assert got == [
        ("calendar_events", "2024-01-08"), ("data_source_runs", "2024-01-05"), ("health_summary", "2024-01-06"),
        ("moto_learning_log", "2024-01-04"), ("personal_notes_summary", "2024-01-07"), ("personal_notes_summary", "2024-02-01"),
        ("sleep_quality", "2024-01-02"), ("trade_journal_summary", "2024-01-01"),
        ("trade_journal_summary", "2024-01-03"), ("training_sessions", "2024-01-05"),
    ]
    assert len({r["event_id"] for r in rows}) == len(rows)
    by_source = {r["source_name"]: json.loads(r["payload"]) for r in rows}
    assert by_source["training_sessions"]["activity_type"] == "run" and by_source["training_sessions"]["duration_minutes"] == 30
    assert by_source["training_sessions"]["row_number"] == 1 and by_source["moto_learning_log"]["topic"] == "braking"
    assert by_source["calendar_events"]["duration_minutes"] == 90 and by_source["data_source_runs"]["status"] == "ok"
    assert "tracked_source_hash" in by_source["data_source_runs"]
    text = " ".join(r["payload"] + r["idempotency_key"] for r in rows)
    assert all(secret not in text for secret in ("ABC", "Team sync", "Title", "some words", "trade_journal.csv"))
    refused = sorted(map(tuple, spark.read.parquet(rejects).select("source_name", "row_number", "reject_reason").collect()))
    assert refused == [
        ("calendar_events", 2, "missing or unreadable DTSTART"),
        ("health_summary", 1, "row is not a JSON object"),
        ("moto_learning", 2, "row is not a JSON object"),
        ("moto_learning_log", 3, "missing one of occurred_at, completed_at, started_at, date"),
        ("sleep_quality", 2, "duration must be positive"),
        ("trade_journal_summary", 2, "missing one of occurred_at, closed_at, entry_time, date"),
        ("training_sessions", 2, "missing one of occurred_at, started_at, date"),
    ]


def test_an_inbox_imported_twice_is_loaded_once(spark, folder):
    """Ids come from file and row, so a second import, at another time, adds nothing to the lake."""
    landing, base = work_dir(spark, "inbox-twice"), work_dir(spark, "inbox-lake")
    paths = [f"{base}/{n}" for n in ("bronze", "silver", "gold")]
    counts = []
    for day in ("2024-02-01", "2024-03-01"):
        inbox.import_inbox(spark, folder, landing, work_dir(spark, "inbox-no"), f"{day} 00:00:00", day)
        counts.append(load_medallion(spark, f"{landing}/*/dt=*/*", *paths, work_dir(spark, "inbox-staging")))
    assert counts[0]["bronze"] == counts[0]["silver"] == 10 and counts[1] == {"bronze": 0, "silver": 0, "gold": 0}


def test_an_empty_inbox(spark, tmp_path):
    (tmp_path / "nothing.bin").write_text("x")
    assert inbox.read_inbox(spark, str(tmp_path)).count() == 0
