import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from strata.llm import resample as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = WORD.findall(low)
    return len(ws), [" ".join(ws[i:i + n]) for n in range(1, longest + 1) for i in range(len(ws) - n + 1)]


def brute(docs, target, buckets, longest, percent, least):
    count = lambda texts: Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, longest)[1])
    s, t = count(x for _, x in docs), count(target)
    total_s, total_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for doc_id, text in docs:
        n, fs = features(text, longest)
        gains = [math.floor(1000 * math.log((t[b] + 1) * total_s / ((s[b] + 1) * total_t)))
                 for b in (zlib.crc32(f.encode()) % buckets for f in fs)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0]))
    for k, r in enumerate(fit[:percent * len(fit) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows))


def texts(seed, n=150):
    r = random.Random(seed)
    pool = [f"w{i}" for i in range(60)] + ["É", "straße", "Ünder-Way", "Foo,bar", "x\x00y", "日本"]
    say = lambda k: " ".join(r.choice(pool) for _ in range(k))
    rows = [(k, say(r.randrange(0, 60))) for k in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, " .,;\n"), (n + 3, say(5000)), (n + 4, rows[0][1])], [say(40) for _ in range(8)] + [None]


@pytest.mark.parametrize("longest,buckets", [(1, 10_000), (1, 37), (3, 500)])
def test_equals_brute_force(spark, longest, buckets):
    docs, target = texts(longest)
    frame = spark.createDataFrame([(*x, 1) for x in docs], "doc_id bigint, text string, rank int").repartition(5)
    goal = spark.createDataFrame([(x,) for x in target], "text string")
    got = R.resample(frame, goal, percent=30, buckets=buckets, max_words=longest).collect()
    assert sorted(map(tuple, got)) == brute(docs, target, buckets, longest, 30, 20)
    assert sum(r["rank"] is not None for r in got) > 20


def test_target_like_documents_come_first(spark):
    docs = [(k, " ".join(f"{'alpha' if k % 4 == 0 else 'beta'}{(k + i) % 9}" for i in range(40))) for k in range(200)]
    goal = spark.createDataFrame([(" ".join(f"alpha{i % 9}" for i in range(400)),)], "text string")
    got = R.resample(spark.createDataFrame(docs, "doc_id bigint, text string"), goal)
    drawn = [r.doc_id for r in got.where("rank IS NOT NULL").collect()]
    assert len(drawn) == 20 and sum(d % 4 == 0 for d in drawn) >= 18


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text)] * 12 + [(None, text)] * 8, "doc_id bigint, text string")
    goal = spark.createDataFrame([], "text string")
    got = R.resample(docs, goal).collect()
    assert len(got) == 20 and sorted(r["rank"] for r in got if r["rank"]) == [1, 2]
    assert R.resample(docs.limit(0), goal).collect() == []


def test_feature_hashes_are_those_of_the_joined_words():
    ws = [b"a", b"bc", b"d", b"e"]
    want = [zlib.crc32(b" ".join(ws[i:i + n])) for n in (1, 2, 3) for i in range(len(ws) - n + 1)]
    assert R.feature_hashes(ws, 3) == want and R.feature_hashes([], 3) == []
