"""Column expressions and small plan helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..session import work_dir

#: White space that separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Letters outside A-Z that a full lower-casing would change.
_OTHER_UPPER = "[[\\p{IsUppercase}\\p{Lt}]&&[^A-Z]]"


def whole_text(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; the fast path serves texts without other capitals."""
    return F.when(~text.rlike(_OTHER_UPPER), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )


def word_count(text: Column) -> Column:
    """Number of runs of characters that are no white space."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def packed(df: DataFrame, name: str = "doc") -> DataFrame:
    """All columns as one struct, so that no input name can clash with a working column."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def unpacked(df: DataFrame, schema_of: DataFrame, replace: dict[str, Column], name: str = "doc") -> DataFrame:
    """The columns of ``schema_of`` from a packed frame, some of them replaced."""
    return df.select(
        *[
            (replace[c] if c in replace else F.col(name).getField(c)).alias(c)
            for c in schema_of.columns
        ]
    )


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared work folder and read it back.

    Cuts the lineage with files every executor can reach; a lost executor costs
    only the tasks that were running on it.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows handed to a text function at once.
ROWS_AT_ONCE = 256


def map_texts(
    docs: DataFrame,
    work: Callable[[pa.Array], list[pa.Array]],
    fields: dict[str, str],
    text_col: str = "text",
    keep_text: bool = False,
) -> DataFrame:
    """Run a function over whole texts in Arrow batches, no shuffle.

    ``work`` gets UTF-8 texts (empty for null) and returns one array per entry of
    ``fields``. The result has ``doc``, the input row as a struct (without the
    text unless ``keep_text``), and the fields. A string that is kept goes to Python
    once, inside ``doc``.
    """
    columns = [c for c in docs.columns if keep_text or c != text_col]
    inside = columns.index(text_col) if text_col in columns and isinstance(docs.schema[text_col].dataType, StringType) else None
    sent = [F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc")]
    if inside is None:
        sent.append(whole_text(f"`{text_col}`").cast("binary").alias("text"))
    df = docs.select(*sent)
    names = ["doc", *fields]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                doc = part.column(0)
                texts = part.column(1) if inside is None else doc.field(inside).cast(pa.binary()).fill_null(b"")
                yield pa.RecordBatch.from_arrays([doc, *work(texts)], names=names)

    schema = StructType([df.schema["doc"], *StructType.fromDDL(", ".join(f"{k} {v}" for k, v in fields.items()))])
    return df.mapInArrow(run, schema)
