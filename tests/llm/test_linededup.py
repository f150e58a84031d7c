import random

import pytest

from strata.llm import linededup as L

SPACES = " \t\n\x0b\x0c\r"


def brute(rows):
    """rows: (doc_id, text) with distinct ids, in order; the lines kept."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        if text is None:
            out[doc_id] = (None, 0, 0)
            continue
        lines = text.split("\n")
        at = [i for i, x in enumerate(lines) if x.strip(SPACES)]
        gone = set()
        for s in range(len(at) - L.RUN + 1):
            w = tuple(lines[i] for i in at[s:s + L.RUN])
            if w in seen:
                gone |= set(at[s:s + L.RUN])
            seen.add(w)
        out[doc_id] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(at), len(gone))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    r = random.Random(seed)
    pool = [f"line {i} é" for i in range(6 if seed else 60)] + ["", "  ", "\t"]
    rows = [(k, "\n".join(r.choice(pool) for _ in range(r.randrange(0, 30)))) for k in range(50)]
    rows += [(50, None), (51, ""), (52, rows[3][1]), (53, "\n".join(["same"] * 12)), (54, "a\nb\na\nb\na\nb\na"),
             (55, "\n".join(f"l{i}" for i in range(3000)))]
    docs = spark.createDataFrame([(*x, "c") for x in rows], "doc_id bigint, text string, unit string").repartition(5)
    got = {x.doc_id: (x.text, x._n_lines, x._n_removed) for x in L.remove_repeated_lines(docs).collect()}
    assert got == brute(rows)


def test_repeated_rows_and_columns(spark):
    rows = [(1, "a\nb\nc"), (2, "a\nb\nc\nd"), (2, "a\nb\nc\nd"), (3, "a\nb\nc"), (None, "x\ny\nz")]
    docs = spark.createDataFrame([(*x, 9, "s") for x in rows], "doc_id bigint, text string, n_chars bigint, h string")
    out = L.drop_repeated_lines(docs)
    assert out.columns == docs.columns
    got = sorted(((x.doc_id or 0), x.text, x.n_chars) for x in out.collect())
    assert got == [(0, "x\ny\nz", 9), (1, "a\nb\nc", 9), (2, "d", 1), (2, "d", 1)]


def test_empty_table(spark):
    assert L.remove_repeated_lines(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
