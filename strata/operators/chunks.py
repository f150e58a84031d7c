"""Text units and word chunks.

Tokenise, explode the chunk start offsets, slice: one whole-stage-codegen
stage per document partition (the token array is read by reference for
every start, so a long document is never copied per chunk) and no shuffle:
the work is partitioned exactly like the document scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import config as C
from strata.functions.text import tier_of, tokens


def with_tier(docs: DataFrame) -> DataFrame:
    return docs.withColumn("level", tier_of(F.col("doc_id")))


def token_chunks(docs: DataFrame, size: int = C.UNIT_SIZE, overlap: int = C.UNIT_OVERLAP,
                 keys=("doc_id", "level")) -> DataFrame:
    """Windows of ``size`` tokens every ``size-overlap`` tokens, starting at
    0 while start < n; the contained tail is kept; never across documents.

    One ``explode`` of the start offsets: inside whole-stage codegen the
    token array is read by reference for every start, so the cost is linear
    in the output, not in chunks x document length.
    Output: id, <keys>, chunk_ix, text, n_tokens (empty units dropped).
    """
    stride = size - overlap
    toks = docs.select(*keys, tokens(F.col("text")).alias("toks"))
    n = F.size("toks")
    starts = toks.select(*keys, "toks", F.explode(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)),
                                                             F.lit(stride))).alias("s"))
    out = starts.select(*keys, (F.col("s") / stride).cast("int").alias("chunk_ix"),
                        F.array_join(F.slice("toks", F.col("s") + 1, F.lit(size)), " ").alias("text"),
                        F.least(F.lit(size), F.size("toks") - F.col("s")).cast("int").alias("n_tokens"))
    out = out.where(F.col("n_tokens") > 0)
    uid = F.md5(F.concat_ws(":", F.col(keys[0]).cast("string"), F.col("chunk_ix").cast("string")))
    return out.select(uid.alias("id"), *keys, "chunk_ix", "text", "n_tokens")


def word_chunks(docs: DataFrame, max_words: int = C.WORD_CHUNK, overlap: int = C.WORD_OVERLAP) -> DataFrame:
    """Vector-path chunker: > max_words words -> windows of max_words words
    every max_words-overlap words re-joined by one space; otherwise the raw
    text whole (its whitespace kept)."""
    stride = max_words - overlap
    toks = docs.select("doc_id", "text", tokens(F.col("text")).alias("toks"))
    long_doc = F.size("toks") > max_words
    starts = F.when(long_doc, F.sequence(F.lit(0), F.size("toks") - 1, F.lit(stride))).otherwise(F.array(F.lit(0)))
    s = toks.select("doc_id", "text", "toks", long_doc.alias("long"), F.explode(starts).alias("s"))
    body = F.when(F.col("long"), F.array_join(F.slice("toks", F.col("s") + 1, F.lit(max_words)), " ")) \
        .otherwise(F.col("text"))
    return s.select("doc_id", (F.col("s") / stride).cast("int").alias("chunk_ix"), body.alias("document_text"))


def truncate_tokens(col, n: int = C.EMBED_TRUNCATE):
    return F.array_join(F.slice(tokens(col), 1, n), " ")


def text_units(documents: DataFrame) -> DataFrame:
    """Tiered documents -> text units (id, doc_id, level, chunk_ix, text, n_tokens)."""
    from strata.sources.tables import spread_small
    return token_chunks(with_tier(spread_small(documents.select("doc_id", "text"))))
