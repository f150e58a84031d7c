"""Query of HTML extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import html
from strata.llm.common import table


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES = {"op10_html_extraction": op10_html_extraction}
ORACLES: dict[str, str] = {}
