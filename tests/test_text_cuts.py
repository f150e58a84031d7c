import re

from pyspark.sql import functions as F

from strata.functions.text import strip_ws
from strata.operators.extract import ENTITY_CANDIDATE_RE


def test_strip_takes_ascii_white_space_only(spark):
    texts = ["", " ", "\t\n a b \r\f", "a", " a  ", "\x0ba\x0b", "é  \n", None, " \U0001d400 x\t"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", strip_ws(F.col("t")).alias("s"))
    assert [r.s for r in df.orderBy("i").collect()] == [None if t is None else re.sub("^[ \t\n\r\f]+|[ \t\n\r\f]+$", "", t) for t in texts]
    # no pattern is tried at each character
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_candidates_are_whole_letter_runs(spark):
    texts = ["", "A", "Ab", "aBc Bcd", "xÀb Éa", "\U0001d400bc \U00010400ab x\U00010400ab", "3Ab _Cd ABC", "Ab\nCd,Ef", "́Ab", "aB"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = lambda p: [r.f for r in df.orderBy("i").select(F.regexp_extract_all("t", F.lit(p), 0).alias("f")).collect()]
    assert found(ENTITY_CANDIDATE_RE) == found(r"(?<!\p{L})\p{Lu}\p{L}++")
    # the letter before is looked at after the capital
    assert ENTITY_CANDIDATE_RE.startswith(r"(?=\p{Lu})")
