"""CSV records with their place in the file, whatever splits the file is read in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A field after a comma (one stands before the line as well): quoted, with doubled quotes inside, or plain.
#: Possessive, so that a long field neither recurses nor backtracks.
_QUOTED = '"((?:[^"]++|"")*+)"'
_FIELD = f',({_QUOTED}[^,]*+|[^,]*+)'


def csv_lines(spark: SparkSession, path: str | Sequence[str], glob: str = "*.[cC][sS][vV]") -> DataFrame:
    """Lines that are not blank: ``file``, ``block`` (start of the split), ``place`` (rising by one
    from line to line of a split) and ``line``."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path)
    filled = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line")
    ).filter(F.btrim("line", F.lit(" \t\r")) != "")
    return filled.withColumn("place", F.monotonically_increasing_id())


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``file``, ``line``, ``row_number`` (0 for the header, then from 1) and the ``header`` of the file.

    A task numbers the lines of its split by itself. Counts per split are summed along
    each file, so that a split knows how many lines stand before it: one row per
    split is shuffled, never a line, and no window holds the lines of a file.
    """
    splits = lines.groupBy("file", "block").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("lines"), F.min_by("line", "place").alias("top")
    )
    along = W.partitionBy("file").orderBy("block")
    before = splits.select(
        "file",
        "block",
        "first",
        F.coalesce(F.sum("lines").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.first("top").over(along).alias("header"),
    )
    return lines.join(before, ["file", "block"]).select(
        "file", "line", (F.col("before") + F.col("place") - F.col("first")).alias("row_number"), "header"
    )


def csv_fields(line: Column) -> Column:
    """Fields of a line as an array of texts, quotes taken off."""
    plain = lambda f: F.replace(F.regexp_replace(f, f"^{_QUOTED}", "$1"), F.lit('""'), F.lit('"'))
    fields = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    return F.transform(fields, lambda f: F.when(F.startswith(f, F.lit('"')), plain(f)).otherwise(f))


def csv_records(spark: SparkSession, path: str | Sequence[str], glob: str = "*.[cC][sS][vV]") -> DataFrame:
    """Records of CSV files as ``file``, ``row_number`` (from 1) and ``row_json``.

    Every file has a header of its own; a record is one line, blank lines do not count. A
    missing or empty field is left out, fields beyond the header are dropped, and of
    columns with one name the last counts.
    """
    numbered = numbered_lines(csv_lines(spark, path, glob)).filter("row_number > 0")
    cells = numbered.select(
        "file", "row_number", F.arrays_zip(csv_fields(F.col("header")).alias("name"), csv_fields(F.col("line")).alias("value")).alias("cells")
    )
    last = F.expr(
        "filter(cells, (c, i) -> c.name IS NOT NULL AND c.value <> ''"
        " AND NOT exists(slice(cells, i + 2, size(cells)), d -> d.name <=> c.name))"
    )
    return cells.select("file", "row_number", F.to_json(F.map_from_entries(last)).alias("row_json"))
