import numpy as np

from strata.operators.vectors import split_valid, topk_cosine, vector_dim


def test_topk_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(60, 8)).astype(np.float32)
    m[7] = m[3]                                   # exact duplicate: tie broken by id
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(m)]
    rows.append((100, [0.0] * 8, 0))              # zero vector -> quarantine
    rows.append((101, [1.0] * 5, 0))              # wrong dimension -> quarantine
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    dim = vector_dim(df)
    valid, bad = split_valid(df, dim)
    assert dim == 8 and sorted(r.vec_id for r in bad.collect()) == [100, 101]
    qs = spark.createDataFrame([(0, [float(x) for x in m[3]]), (1, [1.0] * 8)], "query_id long, vector array<double>")
    got = {(r.query_id, r.rk): r.vec_id for r in topk_cosine(valid, qs, k=5).collect()}
    for qi, q in enumerate([m[3].astype(float), np.ones(8)]):
        s = (m.astype(float) @ q) / (np.linalg.norm(m.astype(float), axis=1) * np.linalg.norm(q)) + 1
        s = np.round(s, 6)
        order = sorted(range(60), key=lambda i: (-s[i], i))[:5]
        assert [got[(qi, k)] for k in range(1, 6)] == order
    assert got[(0, 1)] == 3 and got[(0, 2)] == 7
