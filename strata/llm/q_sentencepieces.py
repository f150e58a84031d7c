"""Query of SentencePiece encoding and decoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import sentencepieces
from strata.llm.common import table

MODEL = "piece_bpe_32k.model"


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepieces.encode_documents(docs, public_tokenizers.path(MODEL)).select(
        "doc_id", "n_tokens", "ids_crc32", "parity", "lossless")


QUERIES = {"op9_sentencepiece": op9_sentencepiece}
ORACLES: dict[str, str] = {}
