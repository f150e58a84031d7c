"""Vector tables, embeddings and nearest-neighbour search.

Exact search: the (size-checked) query matrix is broadcast once; each corpus
partition scores its rows with one numpy matrix product per Arrow batch and
emits only its local top-k per query.  The shuffle therefore carries
``partitions x queries x k`` rows whatever the corpus size, and a final
``row_number() <= k`` per query merges the partial lists exactly.
Above ``max_broadcast_queries`` the queries are processed in bounded groups
(each group broadcast separately), so no size limit is ever skipped.

Embedding: hashed term frequency (md5 bucket of each lower-cased word,
L2-normalised), a deterministic stand-in behind the same batch seam a model
would use.  PCA: Spark ML PCA on explicitly centred vectors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import config as C

EMBED_DIM = 256
EMBED_WORD_RE = "[^ \t\n\r\f.,;:!?()\"'|*#%$&<>\\[\\]{}-]+"
MAX_BROADCAST_QUERIES = 4096


# ------------------------------------------------------------------ vector tables

def vector_dim(vectors: DataFrame, col: str = "embedding") -> int:
    """Declared dimension of a vector table = the most common length."""
    row = (vectors.groupBy(F.size(col).alias("d")).count()
           .orderBy(F.col("count").desc(), F.col("d")).first())
    return int(row["d"]) if row else 0


def split_valid(vectors: DataFrame, dim: int, col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine): wrong dimension or zero norm -> quarantine."""
    norm = F.sqrt(F.aggregate(F.transform(col, lambda x: x.cast("double") * x.cast("double")),
                              F.lit(0.0), lambda a, b: a + b))
    ok = (F.size(col) == dim) & (norm > 0)
    v = vectors.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    return v.where("_ok").drop("_ok"), v.where(~F.col("_ok")).drop("_ok")


def centroids(vectors: DataFrame, key: str, col: str = "embedding") -> DataFrame:
    """Element-wise mean vector per key (combinable aggregate, no collect of
    a group: one row per (key, position) is averaged, then the dim-sized
    result is assembled)."""
    e = vectors.select(key, F.posexplode(col).alias("i", "x"))
    m = e.groupBy(key, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return (m.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("s"))
            .select(key, F.transform("s", lambda s: s["x"]).alias("vector")))


# ------------------------------------------------------------------ exact top-k

class _Held:
    def __init__(self, value):
        self.value = value


def _topk_kernel(bq, k: int, id_col: str, vec_col: str, group_col: str | None):
    def run(batches):
        qids, qmat = bq.value
        qn = qmat / np.linalg.norm(qmat, axis=1, keepdims=True)
        best: dict = {}                                    # group -> (scores, ids), each (q, <=k)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            groups = pdf[group_col].to_numpy() if group_col else np.zeros(len(pdf), dtype=object)
            ids_all = pdf[id_col].to_numpy(dtype=np.int64)
            m_all = np.stack(pdf[vec_col].to_numpy()).astype(np.float64)
            m_all = m_all / np.linalg.norm(m_all, axis=1, keepdims=True)
            for gv in pd.unique(groups):
                sel = groups == gv
                ids, m = ids_all[sel], m_all[sel]
                sc = np.round(qn @ m.T + 1.0, 6)           # (q, n)
                allid = np.broadcast_to(ids, sc.shape)
                if gv in best:
                    sc = np.concatenate([best[gv][0], sc], axis=1)
                    allid = np.concatenate([best[gv][1], allid], axis=1)
                order = np.lexsort((allid, -sc), axis=1)[:, :k]   # score desc, id asc
                best[gv] = (np.take_along_axis(sc, order, axis=1), np.take_along_axis(allid, order, axis=1))
        for gv, (sc, ids) in best.items():
            n = ids.shape[1]
            out = {"query_id": np.repeat(qids, n), id_col: ids.reshape(-1), "score": sc.reshape(-1)}
            if group_col:
                out[group_col] = gv
            yield pd.DataFrame(out)
    return run


def topk_cosine(corpus: DataFrame, queries: DataFrame, k: int = C.VECTOR_TOP_K,
                id_col: str = "vec_id", vec_col: str = "embedding", group_col: str | None = None,
                max_broadcast_queries: int = MAX_BROADCAST_QUERIES) -> DataFrame:
    """corpus(id_col, vec_col[, group_col]) x queries(query_id, vector)
    -> (query_id[, group_col], id_col, score, rk): the top k per query (and
    per group, e.g. per tier, in one pass over the corpus).

    score = cosine similarity + 1.0 (rounded to 6 places); ties by id.
    Corpus and queries must be valid (same dim, non-zero)."""
    spark = corpus.sparkSession
    fields = [T.StructField("query_id", T.LongType()), T.StructField(id_col, T.LongType()),
              T.StructField("score", T.DoubleType())]
    if group_col:
        fields.append(T.StructField(group_col, corpus.schema[group_col].dataType))
    out_schema = T.StructType(fields)
    qsorted = queries.select(F.col("query_id").cast("long"), "vector")
    cols = [F.col(id_col).cast("long"), vec_col] + ([group_col] if group_col else [])
    # size check without a second pass: fetch at most max+1 query rows
    rows = qsorted.limit(max_broadcast_queries + 1).collect()
    if len(rows) <= max_broadcast_queries:
        groups = [rows]
    else:   # too many to broadcast at once: bounded groups of queries, each broadcast separately
        n_groups = -(-qsorted.count() // max_broadcast_queries)
        groups = [qsorted.where(F.pmod(F.col("query_id"), F.lit(n_groups)) == g).collect() for g in range(n_groups)]
    parts = []
    for grp in groups:
        if not grp:
            continue
        qids = np.array([r["query_id"] for r in grp], dtype=np.int64)
        qmat = np.array([r["vector"] for r in grp], dtype=np.float64)
        from strata.session import _context
        sc = _context(spark)
        # bounded (checked above): broadcast once per executor; on a session
        # without a SparkContext the matrix ships inside the function closure
        bq = sc.broadcast((qids, qmat)) if sc is not None else _Held((qids, qmat))
        parts.append(corpus.select(*cols).mapInPandas(_topk_kernel(bq, k, id_col, vec_col, group_col), out_schema))
    if not parts:
        return spark.createDataFrame([], out_schema.add("rk", T.IntegerType()))
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    w = Window.partitionBy("query_id", *([group_col] if group_col else [])).orderBy(F.col("score").desc(),
                                                                                   F.col(id_col))
    return res.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k)


# ------------------------------------------------------------------ embeddings

def text_terms(df: DataFrame, id_col: str, text_col: str, dim: int = EMBED_DIM) -> DataFrame:
    """(id, bucket, tf): hashed term frequencies; bucket = md5(word) mod dim."""
    words = df.select(id_col, F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(EMBED_WORD_RE), 0)).alias("w"))
    bucket = F.pmod(F.conv(F.substring(F.md5("w"), 1, 8), 16, 10).cast("long"), F.lit(dim))
    return words.groupBy(id_col, bucket.alias("bucket")).agg(F.count(F.lit(1)).cast("double").alias("tf"))


def _densify(dim: int):
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def densify(buckets: pd.Series, tfs: pd.Series) -> pd.Series:
        """(bucket ids, term frequencies) -> L2-normalised dense vector, per Arrow batch."""
        out = []
        for b, t in zip(buckets, tfs):
            v = np.zeros(dim)
            np.add.at(v, np.asarray(b, dtype=np.int64), np.asarray(t, dtype=np.float64))
            n = np.linalg.norm(v)
            out.append(v / n if n > 0 else v)
        return pd.Series(out)
    return densify


def embed_text(df: DataFrame, id_col: str, text_col: str, dim: int = EMBED_DIM) -> DataFrame:
    """-> (id, embedding array<double>[dim], L2-normalised); texts without
    words produce no row."""
    t = text_terms(df, id_col, text_col, dim)
    # bounded group: at most `dim` buckets per text
    sparse = t.groupBy(id_col).agg(F.collect_list("bucket").alias("b"), F.collect_list("tf").alias("tf"))
    return sparse.select(id_col, _densify(dim)(F.col("b"), F.col("tf")).alias("embedding"))


def pca_reduce(vectors: DataFrame, k: int, id_col: str = "vec_id", col: str = "embedding") -> tuple[DataFrame, object]:
    """Centre, fit PCA, project; sign rule: the largest-magnitude loading of
    each component is positive.  Returns (projected frame, (mean, components))
    so queries can be projected into the same space."""
    v = vectors.select(id_col, array_to_vector(col).alias("x"))
    scaler = StandardScaler(inputCol="x", outputCol="xc", withMean=True, withStd=False).fit(v)
    vc = scaler.transform(v)
    model = PCA(k=k, inputCol="xc", outputCol="p").fit(vc)
    pc = model.pc.toArray()                                    # (d, k)
    flip = np.sign(pc[np.abs(pc).argmax(axis=0), np.arange(pc.shape[1])])
    flip[flip == 0] = 1.0
    out = model.transform(vc).select(id_col, vector_to_array("p").alias("p"))
    flip_lit = F.array(*[F.lit(float(f)) for f in flip])
    out = out.select(id_col, F.zip_with("p", flip_lit, lambda a, b: a * b).alias(col))
    mean = scaler.mean.toArray()
    return out, (mean, pc * flip)


def project(queries: DataFrame, model, col: str = "vector") -> DataFrame:
    """Project query vectors with a fitted (mean, components) pair (a small
    d x k driver-side model, applied as column expressions)."""
    mean, comps = model
    centred = F.zip_with(col, F.array(*[F.lit(float(m)) for m in mean]), lambda a, b: a - b)
    cols = []
    for j in range(comps.shape[1]):
        cj = F.array(*[F.lit(float(c)) for c in comps[:, j]])
        cols.append(F.aggregate(F.zip_with(centred, cj, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b))
    return queries.withColumn(col, F.array(*cols))


def lsh_topk(corpus: DataFrame, queries: DataFrame, k: int = C.VECTOR_TOP_K, bucket_length: float = 0.6,
             tables: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Approximate top-k: random-projection LSH on unit vectors; candidates
    share a bucket in any table (equi-join on (table, hash)), re-ranked
    exactly.  Scale path for very large corpora."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    def unit(df, idc, c):
        # the norm is its own column: referencing it inside the lambda would
        # re-evaluate it for every element
        sq = F.aggregate(F.transform(c, lambda y: y.cast("double") * y.cast("double")), F.lit(0.0), lambda a, b: a + b)
        d = df.withColumn("_n", F.sqrt(sq))
        return d.select(idc, array_to_vector(F.transform(c, lambda x: x / F.col("_n"))).alias("x"))
    cv = unit(corpus.select(F.col(id_col).alias("cid"), vec_col), "cid", F.col(vec_col))
    qv = unit(queries.select(F.col("query_id").cast("long"), "vector"), "query_id", F.col("vector"))
    lsh = BucketedRandomProjectionLSH(inputCol="x", outputCol="h", bucketLength=bucket_length,
                                      numHashTables=tables, seed=7).fit(cv)

    def keys(df, idc):
        h = lsh.transform(df)
        return h.select(idc, "x", F.posexplode(F.transform("h", lambda v: vector_to_array(v)[0])).alias("t", "b"))
    ck, qk = keys(cv, "cid"), keys(qv, "query_id")
    cand = qk.join(ck.withColumnRenamed("x", "cx"), ["t", "b"]).select("query_id", "cid", "x", "cx").dropDuplicates(
        ["query_id", "cid"])
    dot = F.aggregate(F.zip_with(vector_to_array("x"), vector_to_array("cx"), lambda a, b: a * b),
                      F.lit(0.0), lambda a, b: a + b)
    scored = cand.select("query_id", F.col("cid").alias(id_col), F.round(dot + 1.0, 6).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(id_col))
    return scored.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k)
