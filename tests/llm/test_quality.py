import random
import re

import pytest

from strata.llm import quality as Q


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {p for at in seen.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines),
            len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force():
    r = random.Random(3)
    texts = ["", None, " ", "\n\n", "a a a a a", "é x   y", "a b c a b c", "x" * 9999, "#*$%&|<>" * 3, "\x1c \x85"]
    texts += ["".join(r.choice("ab é\n\t#|") for _ in range(r.randrange(200))) for _ in range(300)]
    for t in texts:
        assert Q.text_counts(t or "") == brute(t), t


@pytest.mark.parametrize("n, hosts, fails, squares, mean", [(0, 0, 0, 0.0, 0.0), (100, 1, 50, 25.0, 0.5), (10, 2, 0, 0.0, 0.0)])
def test_prior_without_spread(n, hosts, fails, squares, mean):
    m, strength = Q.beta_prior(n, hosts, fails, squares)
    assert m == mean and strength >= 1


def test_prior_shrinks_small_hosts_more():
    m, s = Q.beta_prior(200, 3, 100, 90 * 90 / 100 + 10 * 10 / 99 + 0)
    assert 0 < m < 1 and (1 + m * s) / (1 + s) < (90 + m * s) / (100 + s)


def good(r, n=80):
    return " ".join(f"word{r.randrange(10**6)}" for _ in range(n))


def test_host_verdicts(spark):
    r = random.Random(4)
    rows = [(k, good(r), "good") for k in range(40)]
    rows += [(100 + k, good(r) + " ###" * 30, "bad") for k in range(40)]     # symbols fail on this host
    rows += [(200, good(r), "bad"), (201, good(r) + " ###" * 30, "good"), (202, good(r) + " ###" * 30, None),
             (203, None, "bad"), (204, "", None), (205, good(r) + " ###" * 30, "single"), (201, good(r) + " ###" * 30, "good")]
    docs = spark.createDataFrame([(*x, 7) for x in rows], "doc_id bigint, text string, source string, n_words int").repartition(4)
    got = {}
    for x in Q.judge(docs).collect():
        got.setdefault(x.doc_id, x)
    assert all(got[k].kept for k in range(40)) and not any(got[100 + k].kept for k in range(40))
    assert got[200].kept                    # breaks no rule: stays on a bad host
    assert got[201].kept and got[202].kept  # a good host, no host
    assert got[203].base_failed and not got[203].kept and got[204].base_failed
    out = Q.keep_good(docs)
    assert out.columns == docs.columns and {x.n_words for x in out.collect()} == {7}
    assert sorted(x.doc_id for x in out.collect()) == sorted(
        i for i, t, _ in rows if t and not (100 <= i < 140) and (got[i].kept))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert Q.judge(docs).count() == 0 and Q.keep_good(docs).count() == 0
