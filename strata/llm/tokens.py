"""Token ids in Parquet files.

A document is one row: its ids as a list column, delta-encoded, with dictionary
encoding kept for the small columns, row groups and pages of set sizes, and page
indexes, so that a reader of some columns or some documents touches only those
pages.  Files follow ascending doc_id; each row carries its start within its file
set (shard), and the start of a shard is the sum of the shards before it.

Defined cases: a null or empty text has only the end id; rows are ordered by
(doc_id, hash of the text), null ids first, so repeated rows follow one another;
an empty table writes no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from strata.llm.units import UnitTable, cut_punctuation, list_array, slices, split_space_led

END_ID = 2
SCHEMA = "shard int, shard_start bigint, doc_id bigint, n_tokens int, ids array<int>"
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",              # delta encoding of integers
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#ids.list.element": "false",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
}


class ByteLevelEncoder:
    """Ids of whole texts by a byte-level tokenizer of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True     # special strings in a text are ordinary text
        self._table = UnitTable(self._units, cut_punctuation)

    def _units(self, units: list[str]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # the cores belong to Spark's tasks
        return [e.ids for e in self._tokenizer.encode_batch_fast(units, add_special_tokens=False)], [3] * len(units)

    def encode(self, texts: pa.Array, tail: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text); no text is null."""
        ids, n, _ = self._table.encode(texts, split_space_led, tail)
        return ids, n


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteLevelEncoder:
    return ByteLevelEncoder(path)


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Rows of SCHEMA in ascending doc_id order, one shard per partition."""
    ordered = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
               .withColumn("_tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
               .select("doc_id", "text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, start = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            row = 0
            for texts in slices(batch.column(1)):
                ids, n = enc.encode(texts, end_id)
                starts = start + np.cumsum(n) - n
                start += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(texts), shard, np.int32)), pa.array(starts),
                     batch.column(0).slice(row, len(texts)), pa.array(n.astype(np.int32)), list_array(ids, n)],
                    names=["shard", "shard_start", "doc_id", "n_tokens", "ids"])
                row += len(texts)

    return ordered.mapInArrow(encode, SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    encode_documents(docs, tokenizer_path, end_id).write.options(**FILE_OPTIONS).parquet(path)


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents first <= doc_id <= last.

    Only the columns used are read, and the bounds are pushed to the row groups
    and page indexes.  Shard starts come from the counts alone: one row per
    file set, so their table is small whatever the number of documents."""
    stored = spark.read.schema(SCHEMA).parquet(path)
    totals = stored.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    before, offsets = 0, []
    for r in totals:
        offsets.append((r["shard"], before))
        before += r["n"]
    shards = spark.createDataFrame(offsets, "shard int, before bigint")
    rows = stored
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    return rows.join(F.broadcast(shards), "shard").select(
        "doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids")


@F.arrow_udf(LongType())
def ids_crc32(ids: pa.Array) -> pa.Array:
    """Unsigned crc32 of each list's ids as little-endian unsigned 32-bit integers (null: null)."""
    flat, ends = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
    return pa.array([None if null else zlib.crc32(flat[a:b].tobytes())
                     for a, b, null in zip(ends[:-1], ends[1:], ids.is_null().to_pylist())], pa.int64())
