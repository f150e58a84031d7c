import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import phrases as P


def brute(rows, longest, least, share, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                f[lang].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            score, k = min((1000000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for q, b in found.items())
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def corpus(seed, n=120):
    r = random.Random(seed)
    pool = [f"w{i}" for i in range(12)] + ["The", "É", "\x01a", "日本"]
    say = lambda k: "".join(r.choice(pool) + r.choice([" ", " ", "\t ", ". ", "\n", " \x0b", "  "]) for _ in range(k))
    rows = [(r.choice(["en", "de", None]), say(r.randrange(0, 40))) for _ in range(n)]
    return rows + [("en", "the hot pair " * 300), ("en", None), ("de", ""), ("fr", "x"), ("en", "the the the the")] + rows[:5]


@pytest.mark.parametrize("longest,least,budget,slots", [(3, 10, 10**6, 1 << 16), (3, 3, 60, 64), (2, 2, 25, 16), (4, 3, 40, 32)])
def test_equals_brute_force(spark, longest, least, budget, slots):
    rows = corpus(longest * least)
    docs = spark.createDataFrame([(*x, 1, "p") for x in rows], "lang string, text string, words int, phrase string").repartition(5)
    got = P.collocations(docs, longest, least, 50, 40, budget, slots).collect()
    assert sorted(map(tuple, got)) == brute(rows, longest, least, 50, 40)
    assert len(got) >= 3


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert P.collocations(docs).collect() == []


def test_groups_hold_their_budget_and_every_suffix_has_one():
    texts = [t or "" for _, t in corpus(1)]
    part = P.Partition(64)
    for depth in (1, 2):
        loads = np.zeros(64, np.int64)
        for s in P.suffixes(texts, "en", 3):
            open_ = part.route(s) < 0
            np.add.at(loads, (s.prefix_hash(depth)[open_] % np.uint64(64)).astype(int), s.counts[open_])
        if not part.extend(loads, 50, whole=depth == 2):
            break
    held = Counter()
    for s in P.suffixes(texts, "en", 3):
        for g, d in zip(part.route(s).tolist(), s.counts.tolist()):
            held[g] += d
    assert min(held) >= 0 and max(held) < len(part.depths)
    assert all(n <= 50 for g, n in held.items() if part.depths[g] < 3)


def test_blocks_of_a_long_text_lose_nothing():
    text = " ".join(random.Random(2).choice(["a", "b", "c.", "d"]) for _ in range(997))

    def all_counts(block):
        total = Counter()
        for s in P.suffixes([text], "en", 3, block):
            words = [None, *s.vocabulary.to_pylist()]
            for column, n in zip(s.codes.T.tolist(), s.counts.tolist()):
                total[tuple(words[c] for c in column)] += n
        return total

    assert all_counts(10**6) == all_counts(7) == all_counts(1)


def test_entries_round_trip():
    vocabulary = pa.array([b"a", b"\xff", b"c", b"d"], pa.binary())
    codes, counts = np.array([[1, 3, 4], [3, 0, 1], [0, 0, 4]]), np.array([5, 6, 7])
    words, back, n = P.unpack(P.pack(vocabulary, codes, counts))
    name = lambda v, c: [[None if not k else v[k - 1].as_py() for k in row] for row in c.tolist()]
    assert name(words, back) == name(vocabulary, codes) and n.tolist() == [5, 6, 7]
