from pyspark.sql import functions as F

from strata.operators.chunks import token_chunks, word_chunks


def _docs(spark, counts):
    rows = [(i, " ".join(f"w{j}" for j in range(n)), "en") for i, n in enumerate(counts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_token_chunk_lengths(spark):
    docs = _docs(spark, [427, 406, 200, 201, 0])
    u = token_chunks(docs.withColumn("level", F.lit("general")))
    got = {}
    for r in u.collect():
        got.setdefault(r.doc_id, []).append((r.chunk_ix, r.n_tokens))
    assert [n for _, n in sorted(got[0])] == [300, 227, 27]
    assert [n for _, n in sorted(got[1])] == [300, 206, 6]
    assert [n for _, n in sorted(got[2])] == [200]
    assert [n for _, n in sorted(got[3])] == [201, 1]
    assert 4 not in got                      # empty document -> no unit


def test_token_chunk_coverage_and_overlap(spark):
    docs = _docs(spark, [1234])
    u = sorted(token_chunks(docs.withColumn("level", F.lit("general"))).collect(), key=lambda r: r.chunk_ix)
    words = [w for r in u for w in r.text.split(" ")]
    assert set(words) == {f"w{j}" for j in range(1234)}
    for a, b in zip(u, u[1:]):               # consecutive units overlap by 100 tokens
        assert a.text.split(" ")[200:] == b.text.split(" ")[:100] or a.n_tokens < 300


def test_word_chunk_starts(spark):
    docs = _docs(spark, [512, 513, 924, 925])
    rows = word_chunks(docs).collect()
    starts = {}
    for r in rows:
        starts.setdefault(r.doc_id, []).append((r.chunk_ix, r.document_text.split(" ")[0]))
    assert len(starts[0]) == 1
    assert [w for _, w in sorted(starts[1])] == ["w0", "w462"]
    assert [w for _, w in sorted(starts[2])] == ["w0", "w462"]
    assert [w for _, w in sorted(starts[3])] == ["w0", "w462", "w924"]


def test_word_chunk_short_text_keeps_raw_whitespace(spark):
    docs = spark.createDataFrame([(1, "a  b\n c", "en")], "doc_id long, text string, lang string")
    assert word_chunks(docs).collect()[0].document_text == "a  b\n c"
