"""Query registry: name -> (Spark callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from strata.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


_CTX_CACHE: dict = {}


class Ctx:
    """Per (session, input folder) index context.

    The indexing stages are built once per session and input folder and
    persisted as stage tables (reliable checkpoints); every query reads
    them, as the query side of the pipeline reads the persisted index.
    """

    spark: SparkSession
    sf_dir: str

    def __new__(cls, spark=None, sf_dir=None):
        from strata.session import _context
        sc = _context(spark)
        key = (sc.applicationId if sc is not None else id(spark), sf_dir)
        obj = _CTX_CACHE.get(key)
        if obj is None:
            obj = super().__new__(cls)
            _CTX_CACHE[key] = obj
        return obj

    def __init__(self, spark, sf_dir):
        if getattr(self, "_ready", False):
            return
        self.spark, self.sf_dir, self._ready = spark, sf_dir, True

    @cached_property
    def t(self) -> Tables:
        return Tables(self.spark, self.sf_dir)

    @cached_property
    def g(self):
        from strata.operators.graph import GraphIndex
        return GraphIndex(self.t.documents)

    @cached_property
    def assign(self) -> DataFrame:
        from strata.operators.communities import cluster_graph
        return cluster_graph(self.g.entity_stats, self.g.edges)

    @cached_property
    def nodes(self) -> DataFrame:
        """(level, title, cluster_level, community, parent, degree)."""
        return self.assign.join(self.g.degrees, ["level", "title"])

    @cached_property
    def reports(self) -> DataFrame:
        from strata.operators.reports import community_reports
        from strata.session import stored
        return stored(community_reports(self.nodes, self.g.ranked_relationships, self.g.entity_units), "reports")

    # query-side stages
    @property
    def questions(self) -> DataFrame:
        return self.t.benchmark

    @cached_property
    def gctx(self) -> DataFrame:
        from strata.operators import search as S
        return S.global_context(self.reports, self.assign)

    @cached_property
    def reduced(self) -> DataFrame:
        from strata.operators import search as S
        return S.global_reduce(S.map_points(self.questions, self.gctx))

    def match(self) -> DataFrame:
        """Question -> entity matches; a query-time result, rebuilt by every query that needs it and
        written out, so that its size is known: ten rows a question and tier are broadcast, not
        shuffled against the whole index."""
        from strata.operators import search as S
        from strata.session import stored
        return stored(S.entity_match(self.g.entities, self.questions), "matches")


def load_all() -> None:
    """Import every plan module so its queries register."""
    from strata.plans import (access_q, graph_q, ingest_q, reshape_q, search_q,  # noqa: F401
                              stream_q, vector_q)
