import random
import re

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import neardup as N


def shingles(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set()


def brute(rows):
    """Component (smallest id) per row; rows: (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    comp = {}
    for i, (d, _) in enumerate(rows):
        comp[find(i)] = min(comp.get(find(i), d), d)
    return sorted((d, len(s), comp[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(500)] + ["é", "ü1"]
    say = lambda n: [r.choice(vocabulary) for _ in range(n)]
    texts, passage = [], say(100)
    for _ in range(12):
        base = say(r.choice([3, 6, 12, 40, 80, 200]))
        texts.append(base)
        for _ in range(r.randrange(0, 12)):
            c = list(base)
            for _ in range(r.randrange(0, 3)):
                c[r.randrange(len(c))] = r.choice(vocabulary)
            texts.append(c)
    texts += [passage + say(60) for _ in range(40)]          # a shared passage, below the threshold
    hub = say(120)
    texts.append(hub)
    for k in range(60):                                        # linked through the hub alone
        c = list(hub)
        c[(2 * k) % 120] = f"x{k}"
        c[(2 * k + 60) % 120] = f"y{k}"
        texts.append(c)
    r.shuffle(texts)
    return [(k, r.choice([" ", "\n", "  "]).join(t)) for k, t in enumerate(texts)]


def got(df):
    return sorted((x.doc_id, x.n_shingles, x.component_id) for x in df.collect())


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed, monkeypatch):
    if seed:
        monkeypatch.setattr(N, "CENTRES", 16)
        monkeypatch.setattr(N, "SMALL_BUCKET", 2)
    rows = corpus(seed) + [(9000, None), (9001, ""), (9002, " \n"), (9003, "a b"), (9004, "A  b"), (9005, "x" * 9999)]
    docs = spark.createDataFrame([(*x, "c") for x in rows], "doc_id bigint, text string, node string").repartition(4)
    out = N.near_duplicates(docs)
    assert got(out) == brute(rows)
    assert all(x.kept == (x.doc_id == x.component_id) for x in out.collect())


def test_repeated_rows_and_pipeline(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(3, text), (1, text + " end"), (1, text + " end"), (7, None), (7, None), (8, "other words"), (None, "null id")]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id bigint, text string, kept int")
    out = N.keep_first(docs)
    assert out.columns == docs.columns
    assert sorted((x.doc_id or -1, x.text or "") for x in out.collect()) == sorted(
        [(-1, "null id"), (1, text + " end"), (7, ""), (7, ""), (8, "other words")])


def test_estimate_is_close():
    r = np.random.RandomState(1)
    for share in (0.2, 0.5, 0.85, 0.95):
        errors = []
        for _ in range(30):
            x = np.unique(r.randint(0, 2**63, 2000).astype(np.uint64) * np.uint64(2))
            k = int(len(x) * 2 * share / (1 + share))
            y = np.unique(np.concatenate([x[:k], r.randint(0, 2**63, len(x) - k).astype(np.uint64) * np.uint64(2)]))
            truth = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
            rx, ry = N.registers(np.sort(x))[None], N.registers(y)[None]
            errors.append(N.estimate(rx, ry, np.array([len(x)]), np.array([len(y)]))[0] - truth)
        assert abs(np.mean(errors)) < 0.03


def test_sets_of_texts():
    texts = ["", " ", "a b c", "A B C", "a b c d e f", "a b c d e"]
    sets = N.shingle_sets(pa.array(texts))
    assert [len(s) for s in sets] == [0, 0, 1, 1, 2, 1]
    assert sets[2].tolist() == sets[3].tolist() and sets[5][0] in sets[4]


def test_empty_table(spark):
    assert N.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def brute_at(rows, percent):
    """Components at a threshold: the smallest id of what pairs of ``percent`` or more connect."""
    sets, up = {d: shingles(t) for d, t in rows}, {d: d for d, _ in rows}

    def find(x):
        return x if up[x] == x else find(up[x])
    for a, b in ((a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]):
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {d: find(d) for d in sets}


def test_pipeline_stage_links_from_80_percent(spark):
    import corpus_pipeline
    r = random.Random(5)
    rows = []
    for k in range(0, 240, 4):
        base = [f"v{r.randrange(5000)}" for _ in range(100)]
        for j in range(4):                                     # 0.90, 0.81 and 0.73 to the first
            c = list(base)
            for p in range(j):
                c[20 * p + 5 * j + 9] = f"x{k}-{j}-{p}"
            rows.append((k + j, " ".join(c)))
    rows += [(1000 + d, t) for d, t in corpus(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    at_80, at_85 = brute_at(rows, 80), brute_at(rows, 85)
    assert at_80 != at_85
    kept = sorted(x.doc_id for x in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert kept == sorted(d for d, c in at_80.items() if d == c)
    kept = sorted(x.doc_id for x in N.keep_first(docs, percent=85).collect())
    assert kept == sorted(d for d, c in at_85.items() if d == c)


@pytest.mark.parametrize("percent", [70, 80, 85, 95])
def test_bands_miss_few_at_the_threshold(percent):
    band, count = N.bands(percent)
    assert band * count <= N.REGISTERS and (1 - (percent / 100) ** band) ** count <= 2e-5


def test_shared_and_null_ids_stay_apart(spark):
    say = lambda k: " ".join(f"{k}w{i}" for i in range(30))
    rows = [(None, say("a")), (None, say("b")), (None, say("b")), (1, say("c")), (1, say("d")), (1, say("d")),
            (2, say("e")), (2, say("e") + " end"), (3, say("a") + " end"), (None, say("f")), (None, say("f") + " end")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((x.doc_id or -1, x.text) for x in N.keep_first(docs).collect())
    for x in ("e", "f"):                                       # one of two texts that share an id and a component
        assert sum(t.startswith(f"{x}w") for _, t in got) == 1
    assert [g for g in got if g[1][0] not in "ef"] == [(-1, say("b")), (1, say("c")), (1, say("d")), (3, say("a") + " end")]


def test_small_and_large_buckets_share_a_round(spark, monkeypatch):
    """Full sets move once for all buckets at first, then once a round, and classes are numbers."""
    written = []
    keep = N.materialize

    def count(df, name):
        written.append((name, dict(df.dtypes)))
        return keep(df, name)
    monkeypatch.setattr(N, "materialize", count)
    docs = spark.createDataFrame(corpus(0), "doc_id bigint, text string").repartition(2)
    assert got(N.near_duplicates(docs)) == brute(corpus(0))
    names = [n for n, _ in written]
    assert names.count("links") == names.count("chosen") + 1
    assert {t["node"] for n, t in written if n in ("members", "left", "keys", "sets")} == {"bigint"}
    assert set(next(t for n, t in written if n == "sets")) == {"node", "shingles", "n_shingles", "registers"}
