import re

import numpy as np

from strata.llm import language as L

DOCS = "/root/testdata/sf0.001/documents.parquet"


def test_held_out_accuracy(spark):
    """Trained on documents, judged on pages, whose addresses name their language."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = L.identify(pages, spark.read.parquet(DOCS)).collect()
    truth = [re.search(r"/(en|fr|de|es)/", r.url).group(1) for r in rows]
    assert len(rows) == pages.count()
    assert np.mean([r.lang == t for r, t in zip(rows, truth)]) >= 0.97
    assert np.mean([r.text_lang == t for r, t in zip(rows, truth)]) >= 0.9
    assert all(0 < r.confidence <= 1 for r in rows)


def test_text_only_held_out(spark):
    rows = spark.read.parquet(DOCS).collect()
    cut = len(rows) // 2
    languages, table = L.train(spark.createDataFrame(rows[:cut]))
    held = [r for r in rows[cut:] if len(r.text) > 200]
    right = [languages[int(np.argmax(L.text_posterior(table, r.text)))] == r.lang for r in held]
    assert np.mean(right) >= 0.95


def test_evidence_fuses(spark):
    docs = spark.createDataFrame([("the cat and the dog " * 20, "en"), ("le chat et le chien " * 20, "fr")], "text string, lang string")
    fr = "<html lang='fr'><p>le chien et le chat</p></html>"
    pages = [(k, f"http://a.example.fr/{k}", fr) for k in range(40)]
    pages += [(100, "http://www.a.example.fr/x", "<html><p>12 34</p></html>"), (101, None, "<html lang=fr></html>"),
              (102, "http://[bad", None), (103, "http://b.example.en/", "<p>the dog and the cat</p>"), (None, None, None)]
    got = {r.page_id: r for r in L.identify(spark.createDataFrame(pages, "page_id bigint, url string, html string"), docs).collect()}
    assert got[0].lang == got[100].lang == got[101].lang == "fr" and got[103].lang == "en"
    assert got[100].host == "a.example.fr" and got[100].suffix == "fr" and got[102].lang == "fr"


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "u", "x")], "page_id bigint, url string, html string")
    docs = spark.createDataFrame([("a b c", "en")], "text string, lang string")
    assert L.identify(pages.limit(0), docs).count() == 0
    none = L.identify(pages, docs.limit(0))
    assert none.columns == L.identify(pages, docs).columns
    assert none.first().asDict() == {"page_id": 1, "url": "u", "lang": None, "confidence": None, "text_lang": None,
                                     "declared": None, "host": None, "suffix": None}


def test_equals_brute_force_fusion(spark):
    """The sums of other pages in plain loops, for repeated rows and clashing names too."""
    docs = spark.createDataFrame([("the cat and the dog " * 9, "en"), ("le chat et le chien " * 9, "fr")], "text string, lang string")
    hosts, bodies = ["a.example.fr", "b.example.fr", "c.example.en"], ["the dog and", "le chien et", "12", "cat le"]
    pages = [(k, f"http://{hosts[k % 3]}/{k}" if k % 5 else None,
              f"<html{' lang=' + 'fr en'.split()[k % 2] if k % 4 else ''}><p>{bodies[k * 7 % 4]}</p>", "clash") for k in range(30)]
    pages += pages[:4]
    got = L.identify(spark.createDataFrame(pages, "page_id bigint, url string, html string, host string"), docs).collect()
    names, table = L.train(docs)
    rows = []
    for page_id, url, html, _ in pages:
        host, suffix = L.address(url)
        m = re.search(r"lang=(\w+)", html)
        rows.append((page_id, L.text_posterior(table, re.sub("<[^>]*>", "", html)), host, suffix, m and m.group(1)))
    base = [(sum(r[1][i] for r in rows) + 1) / (len(rows) + 2) for i in range(2)]
    expected = []
    for k, (page_id, p, *keys) in enumerate(rows):
        scores = []
        for i in range(2):
            def mean(c, strength, prior):
                others = [r[1][i] for j, r in enumerate(rows) if j != k and keys[c] is not None and r[2 + c] == keys[c]]
                return (sum(others) + strength * prior) / (len(others) + strength)
            by_host = mean(0, L.HOST_STRENGTH, mean(1, L.SUFFIX_STRENGTH, base[i]))
            scores.append(p[i] * by_host * mean(2, L.MARKUP_STRENGTH, base[i]) / base[i])
        expected.append((page_id, names[int(np.argmax(scores))], round(max(scores) / sum(scores), 9)))
    assert sorted((r.page_id, r.lang, round(r.confidence, 9)) for r in got) == sorted(expected)


def test_trigrams_of_odd_texts():
    assert len(L.trigrams("")) == 0 and len(L.trigrams("1 2")) == 0
    assert len(L.trigrams("ab")) == 2 and len(L.trigrams("é" * 100000)) == 100000
