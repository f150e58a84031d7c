import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from strata.llm import q_suffixes
from strata.llm import suffixes as S
from strata.llm.common import table


def brute(rows, length):
    """{doc_id: (bytes that stay, maximal removed runs, number of bytes)}, by counting every string."""
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(hashlib.md5(b[i:i + length]).digest() for _, b in raw for i in range(len(b) - length + 1))
    out = {}
    for d, b in raw:
        gone = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - length + 1):
            if seen[hashlib.md5(b[i:i + length]).digest()] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        cover = np.cumsum(gone)[:-1] > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], cover, [0]]))).reshape(-1, 2)
        out[d] = (bytes(x for x, c in zip(b, cover) if not c), [tuple(e) for e in edges.tolist()], len(b))
    return out


def corpus(seed, size=30):
    r = random.Random(seed)
    say = lambda n: "".join(r.choice("abcdefgh é") for _ in range(n))
    passages = [say(size), say(3 * size), say(size // 2), "x" * (2 * size)]
    rows = []
    for k in range(80):
        body = [say(r.randrange(0, 60)) for _ in range(4)]
        for _ in range(r.randrange(0, 3)):
            p = r.choice(passages)
            body.insert(r.randrange(len(body)), p[r.randrange(0, 5):])
        rows.append((k, "".join(body)))
    near = list(rows[3][1] or say(90))
    near[len(near) // 2] = "#"
    rows += [(80, None), (81, ""), (82, "ab" * 100), (83, rows[7][1]), (84, "".join(near)), (85, say(2000)), (86, passages[1] * 3)]
    return rows


def got(spark, rows, length, gram, **kw):
    docs = spark.createDataFrame([(*x, 1, "c") for x in rows], "doc_id bigint, text string, kept int, key string").repartition(5)
    out = S.remove_repeated_bytes(docs, length, gram, **kw)
    assert out.columns == ["doc_id", "text", "key", "kept", "removed", "n_bytes", "n_removed"]
    rows = out.collect()
    assert all(r.n_removed == sum(e - s for s, e in r.removed) == r.n_bytes - len(r.kept) for r in rows)
    return {r.doc_id: (bytes(r.kept), [tuple(s) for s in r.removed], r.n_bytes) for r in rows}


@pytest.mark.parametrize("length,gram,kw", [(20, 8, {}), (16, 4, {"pool": 3}), (25, 2, {"block": 64}), (20, 16, {"block": 33, "pool": 5})])
def test_equals_brute_force(spark, length, gram, kw):
    rows = corpus(length)
    want = brute(rows, length)
    assert got(spark, rows, length, gram, **kw) == want
    assert sum(bool(w[1]) for w in want.values()) > 30


def test_query_equals_brute_force_on_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    want = {d: (n, sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).hexdigest())
            for d, (kept, runs, n) in brute(rows, 200).items()}
    found = {r[0]: tuple(r)[1:] for r in q_suffixes.op12_suffix_dedup(spark, sf).collect()}
    assert found == want and any(x[1] for x in want.values())


def test_repeated_rows_null_ids_and_empty_tables(spark):
    r = random.Random(1)
    text = "".join(r.choice("abcdef") for _ in range(50))
    rows = [(1, text), (1, text), (None, "short"), (None, text + "!" + text[::-1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted((r.n_bytes, r.n_removed, bytes(r.kept).decode()) for r in S.remove_repeated_bytes(docs, 20, 8).collect())
    assert found == [(5, 0, "short"), (50, 50, ""), (50, 50, ""), (101, 50, "!" + text[::-1])]
    assert S.remove_repeated_bytes(docs.limit(0), 20, 8).collect() == []


def test_merged_transforms_give_sorted_suffixes_and_their_common_prefixes():
    r = np.random.default_rng(3)
    columns = r.integers(1, 4, (12, 40)).astype(np.uint16)
    columns[:, 20:30] = columns[:, :10]
    for c, order, common in S.merged_repeats(columns, 8):
        strings = [bytes(columns[c:, i].astype(np.uint8)) for i in order]
        assert strings == sorted(strings)
        for a, b, n in zip(strings, strings[1:], common[1:]):
            equal = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
            assert n == min(equal, 8)


def test_equal_strings_pick_equal_anchors():
    r = np.random.default_rng(1)
    text = r.integers(97, 101, 300).astype(np.uint8)
    data = np.concatenate([r.integers(97, 101, 77).astype(np.uint8), text, r.integers(97, 101, 50).astype(np.uint8), text])
    _, first, last, anchor, _ = S.stretches(data, np.array([0, len(data)]), 40, 8, 1 << 20)
    pick = np.repeat(anchor, last - first + 1) - np.arange(len(data) - 39)
    assert first[0] == 0 and (first[1:] == last[:-1] + 1).all() and last[-1] == len(data) - 40
    assert (pick[77:77 + 261] == pick[427:427 + 261]).all()
