import math
import random

import pytest

from strata.operators import search as S


def _scores(reports, questions):
    """{(question, level): [(impact, community, tokens, score)]} over all pairs, best first."""
    out = {}
    for level in sorted({r[0] for r in reports}):
        rows = [(c, t, set(text.split())) for lv, c, t, text in reports if lv == level]
        df = {}
        for _, _, ws in rows:
            for w in ws:
                df[w] = df.get(w, 0) + 1
        impact = {w: math.floor(1000 * math.log((len(rows) + 1) / n)) for w, n in df.items()}
        for q, text in questions:
            qw = {w for w in (text or "").split() if impact.get(w, 0) > 0}
            total = sum(impact[w] for w in qw)
            hits = [(sum(impact[w] for w in qw & ws), c, t) for c, t, ws in rows if qw & ws]
            out[q, level] = sorted(((i, c, t, 100 * i // total) for i, c, t in hits), key=lambda h: (-h[0], h[1]))
    return out


def _prefix(hits, budget):
    out, used = [], 0
    for i, c, t, s in hits:
        used += t
        if used > budget:
            break
        out.append((c, i, s))
    return out


def _frames(spark, reports, questions):
    ctx = spark.createDataFrame([(lv, 0, c, t, text) for lv, c, t, text in reports],
                                "level string, cluster_level int, community string, tokens int, row string").repartition(5)
    return ctx, spark.createDataFrame(questions, "item_id long, text string")


@pytest.mark.parametrize("budget", [40, 150, 100000])
def test_equals_exhaustive_scoring(spark, budget):
    r = random.Random(budget)
    # words get rarer by their number; "the" and "of" stand in nearly every report
    def text(n):
        ws = [f"w{int(r.paretovariate(0.6)) % 400}" for _ in range(n)]
        return " ".join(ws + [w for w in ("the", "of") if r.random() < 0.9])
    reports = [("a" if i % 3 else "b", f"c{i:03d}", r.randrange(1, 12), text(r.randrange(0, 25))) for i in range(400)]
    reports += [("a", f"d{i:03d}", 5, "the same row of all") for i in range(60)]
    questions = [(i, text(r.randrange(1, 10))) for i in range(30)] + [(90, "the of"), (91, "nowhere"), (92, ""), (93, None), (94, "same all")]
    ctx, qs = _frames(spark, reports, questions)
    points = S.map_points(qs, ctx, budget)
    got = {}
    for x in S.global_reduce(points, budget).collect():
        got.setdefault((x.question_id, x.level), []).append((x.rn, x.community, x.impact, x.score))
    got = {k: [v[1:] for v in sorted(rows)] for k, rows in got.items()}
    expected = {k: _prefix(h, budget) for k, h in _scores(reports, questions).items()}
    assert got == {k: v for k, v in expected.items() if v}


def test_frequent_words_join_few_rows(spark):
    reports = [("a", f"c{i:04d}", 10, f"rare{i % 200} more{i}" + " the of and" * (i % 20 > 0)) for i in range(2000)]
    questions = [(i, f"the of and rare{i}") for i in range(20)]
    ctx, qs = _frames(spark, reports, questions)
    whole = ctx.withColumn("words", S.words("row"))
    bounded = S.bounded_words(qs, whole, 50)
    assert {r.w for r in bounded.where("impact > 0").collect()} >= {"the", "of", "and"}
    pairs = len([1 for _, t in questions for r in reports if set(t.split()) & set(r[3].split())])
    assert pairs > 20 * 1900 and S.listed(bounded, whole).count() == 20 * 10        # the lists of the rare words alone
    points = S.map_points(qs, ctx, 50).collect()
    assert all(p.community in {f"c{i:04d}" for i in range(p.question_id, 2000, 200)} for p in points)


def test_empty_tables(spark):
    ctx, qs = _frames(spark, [("a", "c", 1, "x")], [(1, "x")])
    assert S.map_points(qs.limit(0), ctx).collect() == []
    assert S.map_points(qs, ctx.limit(0)).collect() == []
