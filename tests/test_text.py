from pyspark.sql import functions as F

from strata.functions.text import html_to_text, strip_bom


def _html(spark, s):
    return spark.createDataFrame([(s,)], "h string").select(html_to_text(F.col("h")).alias("t")).first().t


def test_html_blocks_and_drops(spark):
    h = ("<html><head><title>Dragon</title><style>p{margin:0}</style><script>var x='</p>';</script></head>"
         "<body><!-- ad --><h1>Dragon</h1><p>Feed &amp; water<br>daily</p><div>  indented</div></body></html>")
    t = _html(spark, h)
    assert t.startswith("Dragon")
    assert "margin" not in t and "var x" not in t and "ad" not in t.split("\n")
    assert "Feed & water\ndaily" in t
    assert "\n  indented" in t


def test_html_blank_lines_collapse(spark):
    t = _html(spark, "<p>a</p>\n\n\n\n<p>b</p>")
    assert t == "a\n\nb"


def test_bom_strip(spark):
    df = spark.createDataFrame([("﻿hello",)], "s string")
    assert df.select(strip_bom(F.col("s")).alias("x")).first().x == "hello"
