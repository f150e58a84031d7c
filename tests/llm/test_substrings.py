import random
import re

import pyarrow as pa
import pytest

from strata.llm import substrings as S


def pieces(text):
    """Units as (words, normalised), cut anew word by word with the library's word hashes."""
    import xxhash
    out = []
    for line in (text or "").split("\n"):
        ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in line))
        h = [xxhash.xxh3_64_intdigest(w.encode()) for w in ws]
        unit = []
        for i, w in enumerate(ws):
            unit.append(w)
            around = h[max(0, i - S.CONTEXT):i] + h[i + 1:i + 1 + S.CONTEXT]
            if len(around) == 2 * S.CONTEXT and i >= S.CONTEXT and h[i] < min(around):
                out.append(tuple(unit))
                unit = []
        if unit:
            out.append(tuple(unit))
    return out


def brute(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        us, again = pieces(text), set()
        for k, u in enumerate(us):
            if u in seen:
                again.add(k)
            seen.add(u)
        spans = S.removed_spans(text or "", [len(u) for u in us], again)
        kept = "".join(c for i, c in enumerate(text or "") if not any(a <= i < b for a, b in spans))
        out[doc_id] = (None if text is None else kept, [(a, b) for a, b in spans], len(us))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    r = random.Random(seed)
    say = lambda n: " ".join(r.choice([f"w{i}" for i in range(900)] + ["É", "Ab,"]) for _ in range(n))
    passages = [say(60) for _ in range(4)] + [say(5)]
    rows = []
    for k in range(60):
        parts = [say(r.randrange(0, 40)) for _ in range(3)]
        if k % 2:
            parts.insert(r.randrange(3), r.choice(passages).upper() if k % 5 == 0 else r.choice(passages))
        rows.append((k, r.choice([" ", "\n", " \n\n"]).join(parts)))
    rows += [(60, None), (61, ""), (62, " \n\n "), (63, rows[1][1]), (64, say(4000))]
    docs = spark.createDataFrame([(*x, "c") for x in rows], "doc_id bigint, text string, unit string").repartition(4)
    got = {x.doc_id: (x.text, [tuple(s) for s in x._spans], x._n_units)
           for x in S.remove_repeated_passages(docs).collect()}
    assert got == brute(rows)


def test_passages_go_wherever_they_stand(spark):
    r = random.Random(5)
    say = lambda n: " ".join(f"v{r.randrange(5000)}" for _ in range(n))
    passage = say(52)
    rows = [(k, f"{say(20 + k)} {passage} {say(30)}") for k in range(30)] + [(99, say(300))]
    got = {x.doc_id: x for x in S.remove_repeated_passages(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0].text == rows[0][1] and got[99].text == rows[-1][1]
    assert all(got[k]._n_removed_chars > 0 for k in range(1, 30))


def test_repeated_rows_and_empty_table(spark):
    line = " ".join(f"w{i}" for i in range(20))
    rows = [(1, line), (2, line + "\nnew"), (2, line + "\nnew"), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((x.doc_id or 0), x.text) for x in S.remove_repeated_passages(docs).collect())
    assert got == [(0, "x"), (1, line), (2, "new"), (2, "new")]
    assert S.remove_repeated_passages(docs.limit(0)).count() == 0


def test_units_of_texts():
    n, sizes, _ = S.units(pa.array(["", "a b\n\nc", " \n"]))
    assert n.tolist() == [0, 2, 0] and sizes.tolist() == [2, 1]
