"""Importance resampling of documents towards a target text set.

Features are runs of words, hashed into buckets.  A 256-byte table lower-cases A-Z and
blanks separators directly in UTF-8, ``bytes.split`` gives the words, and the crc32 of a
run is the seed of the crc32 of the run one word longer, so no run is put together as
text.  A Counter for each partition reduces the features to at most one row a bucket;
Spark adds these up over the corpus and over the target.  A document's weight is the
mean gain of its features (log ratio of the smoothed bucket shares), and Gumbel noise
from a hash of its id makes the highest scores a sample without replacement.

Memory: a task holds one text's words and ``buckets`` counts, the driver ``buckets``
gains, whatever the number of documents.  The ranking is a range-partitioned sort of
rows of six numbers.

Defined cases: null, empty and wordless texts have no features, weight 0 and no rank
when ``min_words`` is positive; a very long text is one row like any other, its words
held at once; ties in score go to the smaller doc_id (null ids first), then to fewer
words, rows equal in all that are interchangeable; repeated rows count and may be drawn
separately; an empty table gives an empty result, an empty target gains of the prior
alone; only ``doc_id`` and ``text`` are read, so other columns may have any names.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize
from strata.operators.windows import global_row_number

BUCKETS = 10_000
MAX_WORDS = 1          # words of the longest run
MIN_WORDS = 20         # shorter documents are not drawn
PERCENT = 10           # of the documents long enough
SEED = "2024:"

#: Digits, a-z and all bytes of non-ASCII characters stay, A-Z is lower-cased, the rest separates.
_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_FOLD).split()


def feature_hashes(ws: list[bytes], max_words: int = MAX_WORDS) -> list[int]:
    """crc32 of each run of 1 to ``max_words`` words joined by one space, repeats included."""
    runs = list(map(zlib.crc32, ws))
    found = list(runs)
    for n in range(1, max_words):
        runs = [zlib.crc32(w, zlib.crc32(b" ", run)) for run, w in zip(runs, ws[n:])]
        found += runs
    return found


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> DataFrame:
    """(bucket, n): features of all texts by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0):
                hashes = Counter(feature_hashes(words(text.as_py()), max_words))
                for h, n in hashes.items():
                    total[h % buckets] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())],
                                         names=["bucket", "n"])

    return docs.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> np.ndarray:
    """Gain of each bucket: floor(1000 ln) of its smoothed share in ``target`` over that in ``docs``."""
    both = [F.sum(F.when(F.col("of") == of, F.col("n")).otherwise(0)).alias(of) for of in ("source", "target")]
    rows = (bucket_counts(docs, buckets, max_words).withColumn("of", F.lit("source"))
            .unionByName(bucket_counts(target, buckets, max_words).withColumn("of", F.lit("target")))
            .groupBy("bucket").agg(*both).collect())            # ``buckets`` rows at most
    source, wanted = np.zeros(buckets), np.zeros(buckets)
    for r in rows:
        source[r["bucket"]], wanted[r["bucket"]] = r["source"], r["target"]
    s_all, t_all = float(source.sum()) + buckets, float(wanted.sum()) + buckets
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all)))
                     for s, t in zip(source.tolist(), wanted.tolist())], np.int64)


def weights(docs: DataFrame, gains: np.ndarray, max_words: int = MAX_WORDS) -> DataFrame:
    """(doc_id, n_words, n_features, weight): weight is the floored mean gain, 0 without features."""
    buckets = len(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weight = [], [], []
            for text in batch.column(1):
                ws = words(text.as_py())
                hashes = feature_hashes(ws, max_words)
                n_words.append(len(ws))
                n_features.append(len(hashes))
                weight.append(int(gains[np.array(hashes, np.int64) % buckets].sum()) // len(hashes) if hashes else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel(doc_id, seed: str = SEED):
    """floor(1000 x) of a Gumbel draw x that the id alone decides."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share)))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             buckets: int = BUCKETS, max_words: int = MAX_WORDS, seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` as (doc_id, n_words, n_features, weight, score, rank): of the N
    documents of ``min_words`` words or more, the floor(percent * N / 100) highest scores
    are drawn and numbered from 1; the others have no rank."""
    gains = bucket_gains(docs, target, buckets, max_words)
    rows = weights(docs, gains, max_words).withColumn("score", F.col("weight") + gumbel("doc_id", seed))
    rows = materialize(rows.withColumn("long_enough", F.col("n_words") >= min_words), "weights")
    drawn = percent * rows.where("long_enough").count() // 100
    order = [F.col("long_enough").desc(), F.col("score").desc(), *(F.col(c) for c in ("doc_id", "n_words", "n_features"))]
    ranked = global_row_number(rows, order, "rank")
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score",
                         F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
