"""Declared schemas: no table is read with inference."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BinaryType()
TS_NTZ = T.TimestampNTZType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


INPUT_TABLES = {
    "region": _st(("r_regionkey", I), ("r_name", S)),
    "nation": _st(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _st(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D), ("c_mktsegment", S)),
    "supplier": _st(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _st(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I), ("p_retailprice", D)),
    "orders": _st(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                  ("o_orderdate", TS_NTZ), ("o_orderpriority", S)),
    "lineitem": _st(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                    ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                    ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS_NTZ)),
    "events": _st(("event_id", L), ("ts", TS_NTZ), ("user_id", L), ("event_type", S), ("value", D), ("props", S)),
    "documents": _st(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "embeddings": _st(("vec_id", L), ("embedding", T.ArrayType(T.FloatType())), ("label", I)),
    "pages": _st(("page_id", L), ("url", S), ("html", S)),
    "benchmark": _st(("item_id", L), ("text", S)),
    "labels": _st(("doc_id", L), ("quality", I), ("toxic", I)),
    "conversations": _st(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
}

# Engine tables (the stage outputs of the indexing pipeline).
ARR_S = T.ArrayType(S)

TEXT_UNITS = _st(("id", S), ("doc_id", L), ("level", S), ("chunk_ix", I), ("text", S), ("n_tokens", I))
ENTITIES = _st(("level", S), ("id", S), ("title", S), ("type", S), ("description", S),
               ("text_unit_ids", ARR_S), ("n_units", L))
RELATIONSHIPS = _st(("level", S), ("id", S), ("source", S), ("target", S), ("description", S),
                    ("weight", D), ("text_unit_ids", ARR_S))
NODES = _st(("level", S), ("title", S), ("cluster_level", I), ("community", S), ("degree", L))
COMMUNITIES = _st(("level", S), ("community", S), ("cluster_level", I), ("parent", S),
                  ("entity_ids", ARR_S), ("relationship_ids", ARR_S), ("text_unit_ids", ARR_S), ("size", L))
FINDING = _st(("summary", S), ("explanation", S))
REPORT_JSON = _st(("title", S), ("summary", S), ("rating", D), ("rating_explanation", S),
                  ("findings", T.ArrayType(FINDING)))
CLAIMS = _st(("subject", S), ("object", S), ("type", S), ("status", S), ("start_ts", TS_NTZ),
             ("end_ts", TS_NTZ), ("description", S), ("source_text", S))
RAW_FILES = _st(("path", S), ("modificationTime", T.TimestampType()), ("length", L), ("content", B))
CLEARANCE = _st(("user_level", S), ("level", S))
RESPONSE_CACHE = _st(("result", S), ("input", S),
                     ("parameters", _st(("model", S), ("temperature", D), ("max_tokens", I))))
