import random
import re

import pytest

from strata.llm import decontaminate as D


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items):
    ws, hit, found = words(text), set(), set()
    for item_id, item in items:
        iw = words(item)
        n = min(13, len(iw))
        windows = {tuple(iw[s:s + n]) for s in range(len(iw) - n + 1)} if n else set()
        for s in range(len(ws) - n + 1 if n else 0):
            if tuple(ws[s:s + n]) in windows:
                hit |= set(range(s, s + n))
                found.add(str(item_id))
    return len(ws), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(ws)


def test_words():
    for t in ["", "Ab1 c_d É-x \u00a0y 漢字!", "A" * 5000]:
        assert [w.decode() for w in D.words(t)] == words(t)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    r = random.Random(seed)
    vocabulary = ["a", "b", "c", "dd", "ée", "F9"] if seed < 2 else [f"w{i}" for i in range(200)]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(k, say(r.choice([1, 3, 12, 13, 14, 40]))) for k in range(10)] + [(100, ""), (101, None), (102, "Zq zq.")]
    items += [(200, items[4][1])]
    docs = []
    for k in range(60):
        parts = [say(r.randrange(0, 60))]
        if k % 3 == 0:
            iw = r.choice(items[:10])[1].split()
            a = r.randrange(len(iw))
            parts += [" ".join(iw[a:a + r.randrange(1, 40)]), say(r.randrange(0, 40))]
        docs.append((k, "; ".join(parts).upper() if k % 7 == 0 else " ".join(parts)))
    docs += [(70, None), (71, ""), (5, docs[5][1]), (None, items[9][1]), (72, "Zq, ZQ"), (73, say(3000))]
    d = spark.createDataFrame([(*x, "c") for x in docs], "doc_id bigint, text string, term string").repartition(4)
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((repr(x.doc_id), x.n_words, x.n_hit, x["items"], x.contaminated) for x in D.contamination(d, b).collect())
    assert got == sorted((repr(i), *brute(t, items)) for i, t in docs)
    kept = sorted(repr(x.doc_id) for x in D.drop_contaminated(d, b).collect())
    assert kept == sorted(repr(i) for i, t in docs if not brute(t, items)[3])


def test_blocks_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "five six")], "doc_id bigint, text string")
    b = spark.createDataFrame([(1, "two three"), (2, "six"), (3, "seven")], "item_id bigint, text string")
    whole = D.contamination(docs, b).collect()
    monkeypatch.setattr(D, "BLOCK_WORDS", 1)
    assert sorted(map(str, D.contamination(docs, b).collect())) == sorted(map(str, whole))
    assert sorted(x["items"] for x in whole) == [["1"], ["2"]]


def brute_near(docs, items):
    """(doc_id, item_id) -> words of the smallest stretch, by all starts and ends."""
    count, out = {}, {}
    for _, t in docs:
        for w in words(t):
            count[w] = count.get(w, 0) + 1
    for item_id, item in items:
        iw = words(item)
        ranked = sorted((count[w], w.encode(), i) for i, w in enumerate(iw) if w in count)
        if not ranked:
            continue
        first = ranked[0]
        others = sorted({(n, w) for n, w, i in ranked if abs(i - first[2]) < 13 and w != first[1]})
        ranked = [first[1]] + [w for _, w in others]
        parts = [set(x) for x in (ranked[:3], ranked[3:6]) if len(x) > 1]
        for doc_id, t in docs:
            ws = [w.encode() for w in words(t)]
            sizes = [e - s for s in range(len(ws)) for e in range(s + 1, min(len(ws), s + 20) + 1)
                     if any(x <= set(ws[s:e]) for x in parts)]
            if sizes:
                out[doc_id, str(item_id)] = min(sizes)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_proximity_equals_brute_force(spark, seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12 if seed else 80)]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(k, say(r.choice([1, 2, 3, 13, 30])) + " unseen") for k in range(8)] + [(9, "same same"), (10, "")]
    docs = [(k, say(r.randrange(60))) for k in range(30)] + [(40, None), (41, "same x same")]
    d = spark.createDataFrame(docs + docs[:3], "doc_id bigint, text string").repartition(4)
    found = D.near_matches(d, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    got = {(x.doc_id, i): x.n_words for x in found for i in x.item_ids}
    seen = brute_near(docs, items)
    repeated = brute_near(docs + docs[:3], items)           # counts order the terms
    assert got == repeated and seen and all(x.end - x.start == x.n_words for x in found)


def test_proximity_match(spark):
    item = " ".join(f"w{i}" for i in range(13))
    changed, longer = item.replace("w6", "other"), item.replace("w1 ", "w1 more words here ")
    docs = spark.createDataFrame([(1, "x y " + changed), (2, longer), (3, "w0 " + "far " * 30 + "w1 " + "far " * 30 + "w2")],
                                 "doc_id bigint, text string")
    b = spark.createDataFrame([(7, item), (8, "w6 nowhere")], "item_id bigint, text string")
    got = {x.doc_id: (x.start, x.end, x.item_ids) for x in D.near_matches(docs, b).collect()}
    assert set(got) == {1, 2} and all(x[2] == ["7"] for x in got.values())
    rows = {x.doc_id: x for x in D.contamination(docs, b, with_near=True).collect()}
    assert [(rows[k].n_hit, rows[k].n_near, rows[k].contaminated) for k in (1, 2, 3)] == [
        (0, 1, False), (0, 1, False), (0, 0, False)]
    assert rows[1].near_words == got[1][1] - got[1][0] and rows[3].near_words is None


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert D.contamination(none, items).count() == 0
    some = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    no_items = spark.createDataFrame([], "item_id bigint, text string")
    assert [(x.n_words, x.n_hit) for x in D.contamination(some, no_items).collect()] == [(2, 0)]


def test_long_items_are_split_and_blocks_made_one_by_one(spark, monkeypatch):
    r = random.Random(4)
    items = [(k, " ".join(f"w{r.randrange(4000)}" for _ in range(n))) for k, n in enumerate([61, 33, 5, 100])]
    texts = [" ".join(i.split()[s:s + 14]) for _, i in items for s in range(0, 90, 3)]
    docs = spark.createDataFrame([(k, f"x {t} y") for k, t in enumerate(texts)], "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(D, "BLOCK_WORDS", 40)
    blocks = D.query_blocks(b)
    sizes = [sum(map(len, x.items)) for x in blocks]
    assert iter(blocks) is blocks and len(sizes) > 4 and max(sizes) <= 40
    got = {x.doc_id: (x.n_words, x.n_hit, x["items"], x.contaminated) for x in D.contamination(docs, b).collect()}
    assert got == {k: brute(f"x {t} y", items) for k, t in enumerate(texts)}
