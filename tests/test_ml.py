import numpy as np
from pyspark.sql import functions as F

from strata.operators import vectors as V
from strata.operators.walks import random_walks


def _vec_df(spark, m):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)],
                                 "vec_id long, embedding array<double>")


def test_pca_matches_numpy_and_projects_queries(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(40, 6)) @ rng.normal(size=(6, 6))
    red, model = V.pca_reduce(_vec_df(spark, m), k=3)
    got = np.array([r.embedding for r in sorted(red.collect(), key=lambda r: r.vec_id)])
    c = m - m.mean(axis=0)
    _, _, vt = np.linalg.svd(c, full_matrices=False)
    comps = vt[:3].T
    comps *= np.sign(comps[np.abs(comps).argmax(axis=0), np.arange(3)])   # sign rule
    assert np.allclose(got, c @ comps, atol=1e-6)
    q = spark.createDataFrame([(0, [float(x) for x in m[5]])], "query_id long, vector array<double>")
    pq = np.array(V.project(q, model).first().vector)
    assert np.allclose(pq, got[5], atol=1e-6)        # query lands where its corpus twin is


def test_lsh_recall(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(300, 8))
    corpus = _vec_df(spark, m).repartition(4)
    qs = spark.createDataFrame([(i, [float(x) for x in m[i] + rng.normal(scale=0.05, size=8)]) for i in range(10)],
                               "query_id long, vector array<double>")
    exact = {(r.query_id, r.vec_id) for r in V.topk_cosine(corpus, qs, k=5).collect()}
    approx = {(r.query_id, r.vec_id) for r in V.lsh_topk(corpus, qs, k=5).collect()}
    assert len(exact & approx) / len(exact) >= 0.6


def test_walks_follow_edges(spark):
    edges = [("A", "B"), ("B", "C"), ("C", "D"), ("D", "A"), ("A", "C"), ("E", "F")]
    ents = spark.createDataFrame([("t", n) for n in "ABCDEF"], "level string, title string")
    rels = spark.createDataFrame([("t", a, b) for a, b in edges], "level string, source string, target string")
    walks = random_walks(ents, rels, num_walks=3, walk_length=12).collect()
    und = {frozenset(e) for e in edges}
    assert len(walks) == 18
    for w in walks:
        assert len(w.walk) == 12
        assert all(frozenset((a, b)) in und for a, b in zip(w.walk, w.walk[1:]))
