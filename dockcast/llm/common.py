"""Columns and helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The blanks that separate words.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text; no words for null."""
    return bind(
        F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANK_RUN)),
    )


def without_blanks(text: Column) -> Column:
    """The text with every blank deleted; empty for null."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def held_out(doc_id: Column) -> Column:
    """Rows a model must not learn from: crc32 of the id as text is divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut into short runs of rows, so that Python objects of few texts live at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]
