"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialize(df: DataFrame, name: str, arrow_rows: int | None = None, **options) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: work done once, lineage cut, safe against lost executors.  ``arrow_rows`` bounds
    the rows that go to a Python worker at once, for rows that are large."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(ARROW_ROWS)
    try:
        if arrow_rows:
            spark.conf.set(ARROW_ROWS, str(min(arrow_rows, int(before)) if int(before) > 0 else arrow_rows))
        df.write.options(**options).parquet(path)
    finally:
        if arrow_rows:
            spark.conf.set(ARROW_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text="text"):
    """64-bit hash of a text; with ``doc_id`` it identifies a document row
    (rows equal in both are repeats of one row and share one verdict)."""
    return F.xxhash64(F.col(text))


def same_document(left: DataFrame, right: DataFrame):
    """Null-safe equality on (doc_id, text_hash) for joins."""
    return (left["doc_id"].eqNullSafe(right["doc_id"])) & (left["text_hash"] == right["text_hash"])


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows: a worker holds the Python objects and the
    output of one slice at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
