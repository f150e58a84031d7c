"""Query of personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import pii
from strata.llm.common import table


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    # a second parameter of the lambda would be the element's index, so the kind is written into the SQL
    counts = [F.expr(f"size(filter(base, x -> x.kind_no = {k}))").cast("bigint").alias(f"n_{name}")
              for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.spelled("base"), 256).alias("base_sha256"),
                        pii.spelled("spans").alias("spans"))


QUERIES = {"op7_pii": op7_pii}
ORACLES: dict[str, str] = {}
