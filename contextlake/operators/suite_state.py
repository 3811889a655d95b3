"""Expectation results kept per partition, so that a load is checked by what it brought."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import AsOf, age_minutes
from ..session import config_frame, work_dir
from ..sinks.tables import partition_key, prune_to, touched_partitions
from ..streaming import folders
from .latest import keep_latest
from .quality import Expectation

_STATE = "dataset string, part string, rule string, total double, newest timestamp, load long"


class SuiteState:
    """Additive measures of a suite's rules per dataset and partition, one folder per load.

    Violations and row counts add up, newest times have a maximum; the last load of a
    partition counts, so a partition that was rewritten or emptied replaces its numbers.
    ``compact`` folds the loads into one. Loads have rising numbers; one that is run again
    writes the same folder.
    """

    def __init__(self, spark: SparkSession, path: str, suite: Sequence[Expectation]) -> None:
        self.spark, self.path, self.suite = spark, path.rstrip("/"), tuple(suite)

    def _rules(self, dataset: str) -> list[Expectation]:
        return [e for e in self.suite if e.dataset == dataset]

    def measured(self, dataset: str, df: DataFrame, part: Column) -> DataFrame:
        """``part``, ``rule``, ``total``, ``newest`` of every partition of ``df``, in one aggregation."""
        rules, measures = self._rules(dataset), []
        for i, rule in enumerate(rules):
            if rule.kind == "violations":
                measures.append(F.count_if(rule.predicate).cast("double").alias(f"m{i}"))
            elif rule.kind == "row_count":
                measures.append(F.count(F.lit(1)).cast("double").alias(f"m{i}"))
            else:
                measures.append(F.max(rule.predicate).cast("timestamp").alias(f"m{i}"))
        no_time, no_total = F.lit(None).cast("timestamp"), F.lit(None).cast("double")
        entries = [
            F.struct(
                F.lit(rule.id).alias("rule"),
                (no_total if rule.kind == "freshness" else F.col(f"m{i}")).alias("total"),
                (F.col(f"m{i}") if rule.kind == "freshness" else no_time).alias("newest"),
            )
            for i, rule in enumerate(rules)
        ]
        return df.groupBy(part.alias("part")).agg(*measures).select("part", F.inline(F.array(*entries)))

    def touched_rows(self, table: DataFrame, touched: DataFrame, by: str) -> DataFrame:
        """Rows of the touched partitions; the files of others are not read."""
        return prune_to(table, touched, [by])

    def add(self, load: int, dataset: str, table: DataFrame, by: str, brought: DataFrame) -> None:
        """Measure the partitions of ``table`` (partitioned by column ``by``) whose values ``brought`` has."""
        touched = touched_partitions(brought, [by], work_dir(self.spark, "suite-touched"))
        rows = self.measured(dataset, self.touched_rows(table, touched, by), partition_key(by))
        rules = F.array(*[F.struct(F.lit(r.id).alias("rule"), F.lit(r.kind).alias("kind")) for r in self._rules(dataset)])
        # A partition without rows has zeros: it may have had rows before.
        wanted = touched.select(F.col(f"touched_{by}").alias("part")).distinct().select("part", F.inline(rules))
        found = wanted.join(rows, ["part", "rule"], "left").select(
            F.lit(dataset).alias("dataset"),
            "part",
            "rule",
            F.when(F.col("kind") != "freshness", F.coalesce("total", F.lit(0.0))).alias("total"),
            "newest",
            F.lit(load).cast("long").alias("load"),
        )
        found.write.mode("overwrite").parquet(f"{self.path}/{dataset}/load={load}")

    def _loads(self, dataset: str) -> list[int]:
        return folders.complete(self.spark, f"{self.path}/{dataset}", "load")

    def state(self, dataset: str) -> DataFrame:
        """The measures that count: of each partition those of its last load."""
        paths = [f"{self.path}/{dataset}/load={n}" for n in self._loads(dataset)]
        if not paths:
            return self.spark.createDataFrame([], _STATE)
        return keep_latest(self.spark.read.schema(_STATE).parquet(*paths), ["part", "rule"], ["load"])

    def compact(self, dataset: str) -> None:
        """Fold all loads into the last one's folder number plus one."""
        loads = self._loads(dataset)
        if len(loads) > 1:
            self.state(dataset).write.mode("overwrite").parquet(f"{self.path}/{dataset}/load={loads[-1] + 1}")
            for n in loads:
                folders.remove(self.spark, f"{self.path}/{dataset}/load={n}")

    def results(self, datasets: Sequence[str], as_of: AsOf = None) -> DataFrame:
        """(id, dataset, severity, observed, passed), as a run over the whole tables gives them."""
        measures = None
        for dataset in datasets:
            part = self.state(dataset)
            measures = part if measures is None else measures.unionByName(part)
        sums = measures.groupBy(F.col("rule").alias("id")).agg(F.sum("total").alias("total"), F.max("newest").alias("newest"))
        rules = config_frame(
            self.spark,
            [(r.id, r.dataset, r.severity, r.kind, r.operator, float(r.threshold)) for r in self.suite if r.dataset in datasets],
            "id string, dataset string, severity string, kind string, operator string, threshold double",
        )
        is_fresh = F.col("kind") == "freshness"
        observed = F.when(is_fresh, age_minutes("newest", as_of).cast("double")).otherwise(F.coalesce("total", F.lit(0.0)))
        passed = (
            F.when(F.col("kind") == "violations", F.col("observed") == 0)
            .when(is_fresh, F.col("observed") <= F.col("threshold"))
            .when(F.col("operator") == "gt", F.col("observed") > F.col("threshold"))
            .otherwise(F.col("observed") >= F.col("threshold"))
        )
        return (
            sums.join(rules, "id", "right")
            .withColumn("observed", observed)
            .select("id", "dataset", "severity", "observed", F.coalesce(passed, F.lit(False)).alias("passed"))
        )
