"""Run registered queries and compare them with their SQL on DuckDB.

    python tools/check_queries.py [--sf 0.01] [name-prefix …]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from query_catalog import ORACLES, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = []
    for row in df.itertuples(index=False, name=None):
        rows.append(tuple(cell(v) for v in row))
    return sorted(rows, key=repr)


def cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


def kinds(df: pd.DataFrame) -> dict[str, str]:
    return {c: df[c].dtype.kind for c in sorted(df.columns)}


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--plans", action="store_true")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name in QUERIES:
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if args.plans:
                df.explain("formatted")
            got = df.toPandas()
        except Exception as error:
            bad += 1
            print(f"FAIL {name}: spark: {str(error)[:700]}", flush=True)
            continue
        seconds = time.time() - start
        if name not in ORACLES:
            print(f"rows {name}: {len(got)} rows {seconds:.1f}s", flush=True)
            continue
        try:
            want = duck.execute(ORACLES[name]).df()
        except Exception as error:
            bad += 1
            print(f"FAIL {name}: sql: {str(error)[:700]}", flush=True)
            continue
        problems = []
        if sorted(got.columns) != sorted(want.columns):
            problems.append(f"columns {sorted(got.columns)} != {sorted(want.columns)}")
        elif len(got) != len(want):
            problems.append(f"rows {len(got)} != {len(want)}")
        if not problems:
            if kinds(got) != kinds(want):
                a, b = kinds(got), kinds(want)
                diff = {c: (a[c], b[c]) for c in a if a[c] != b[c]}
                if diff:
                    print(f"note {name}: types {diff}", flush=True)
            a, b = normal(got), normal(want)
            if a != b:
                in_a, in_b = set(a), set(b)
                extra = [r for r in a if r not in in_b][:2]
                lost = [r for r in b if r not in in_a][:2]
                problems.append(f"values {sorted(got.columns)}\n   spark {extra}\n   sql   {lost}")
        if problems:
            bad += 1
            print(f"FAIL {name}: " + "; ".join(problems), flush=True)
        else:
            print(f"ok   {name}: {len(got)} rows {seconds:.1f}s", flush=True)
    print("bad", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
