"""Session helpers: defaults, shared work folders and size-checked small frames."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MAX_CONFIG_ROWS = 10_000


def build_session(app_name: str, **conf: str) -> SparkSession:
    """Create or reuse a session pinned to UTC with AQE and skew handling on."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint location.

    The cluster names that location in ``spark.checkpoint.dir``. Only a local
    master (tests) may fall back to a temporary folder: executors on other
    machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="contextlake-")
    return f"{base.rstrip('/')}/contextlake/{name}-{uuid.uuid4().hex}"


def broadcast_if_small(df: DataFrame, limit: int = MAX_CONFIG_ROWS) -> DataFrame:
    """A lookup frame with a broadcast hint if it has at most ``limit`` rows, as it is beyond.

    Rows are counted up to the limit only.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def config_frame(
    spark: SparkSession, rows: Iterable[Sequence], schema: str | StructType
) -> DataFrame:
    """Broadcastable frame for configuration (goals, registry, locations).

    The row count is checked here, on data the driver already holds, so the
    broadcast hint can never grow with the fact tables.
    """
    data = [tuple(row) for row in rows]
    if len(data) > MAX_CONFIG_ROWS:
        raise ValueError(
            f"{len(data)} rows is not configuration (limit {MAX_CONFIG_ROWS}); "
            "store it as a table and join without a hint"
        )
    return F.broadcast(spark.createDataFrame(data, schema))
