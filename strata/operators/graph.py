"""Graph tables: merged entities, merged relationships, degrees, ranks.

All keyed by ``(level, title)``: one graph per access tier, so a lower tier
never sees names that only occur in higher-tier documents.

Hub entities (one entity in a third of all units) are handled without
collecting their groups: merges are combinable aggregates (count, sum,
min_by), the description summary keeps only the first ``SUMMARY_CAP``
sorted distinct descriptions per entity through a ``dense_rank`` limit that
Spark plans as a partial, map-side ``WindowGroupLimit``, and entity <-> unit
links stay a normalised link table instead of an unbounded array column.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata import config as C
from strata.functions.text import token_count
from strata.operators import chunks, extract
from strata.session import stored


def given_texts(df: DataFrame, keys: list[str], text_col: str = "description") -> DataFrame:
    return df.select(*keys, text_col).where(F.col(text_col).isNotNull() & (F.col(text_col) != ""))


def distinct_texts(df: DataFrame, keys: list[str], text_col: str = "description") -> DataFrame:
    return given_texts(df, keys, text_col).distinct()


def sorted_summary(d: DataFrame, keys: list[str], text_col: str = "description",
                   cap: int = C.SUMMARY_CAP) -> DataFrame:
    """From texts per key: the distinct ones sorted and concatenated while the running
    token sum stays within ``cap`` (the first text is always kept).  Each text has >= 1
    token, so at most ``cap`` distinct texts per key go on; equal ones have one rank, so the
    limit is planned as a partial group limit and the texts are shuffled once, by key.
    -> (keys, texts, summary); texts: how many distinct ones there are, ``cap`` at most."""
    w = Window.partitionBy(*keys).orderBy(text_col)
    ranked = d.withColumn("rn", F.dense_rank().over(w)).where(F.col("rn") <= cap)
    ranked = ranked.groupBy(*keys, "rn").agg(F.first(text_col).alias(text_col)).withColumn("tok", token_count(F.col(text_col)))
    ranked = ranked.withColumn("cum", F.sum("tok").over(
        Window.partitionBy(*keys).orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("texts", F.max("rn").over(Window.partitionBy(*keys)))
    kept = ranked.where((F.col("cum") <= cap) | (F.col("rn") == 1))
    return (kept.groupBy(*keys)
            .agg(F.max("texts").alias("texts"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", text_col))),
                                          lambda s: s[text_col]), " ").alias("summary")))


def distinct_counts(df: DataFrame, keys: list[str], col: str, name: str) -> DataFrame:
    return df.select(*keys, col).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def _edge_id():
    return F.md5(F.concat_ws("|", "level", "source", "target")).alias("id")


@dataclass
class GraphIndex:
    """Lazily built, memoised stage DataFrames of one indexing run."""

    documents: DataFrame
    materialize: bool = True

    def _m(self, df: DataFrame) -> DataFrame:
        """Persist a reused stage table (Parquet in the shared checkpoint folder,
        compressed and read by column): later stages and queries read it instead of
        re-deriving it, and a lost executor never forces a re-extraction."""
        return stored(df, "stage") if self.materialize else df

    @cached_property
    def units(self) -> DataFrame:
        return self._m(chunks.text_units(self.documents))

    @cached_property
    def mentions(self) -> DataFrame:
        return self._m(extract.mentions(self.units))

    @cached_property
    def unit_entities(self) -> DataFrame:
        return extract.unit_entities(self.mentions)         # rows of the stored mentions

    @cached_property
    def unit_relationships(self) -> DataFrame:
        return extract.unit_relationships(self.mentions)

    @cached_property
    def entity_stats(self) -> DataFrame:
        """(level, id, title, type, n_docs, n_units): the entities without their texts, for the stages
        and queries that read none.  Counted by document first, so a hub's rows are summed twice and
        never meet in one task."""
        keys = ["level", "title"]
        # unit_entities has one row per (unit, title): unit count = row count
        by_doc = self.unit_entities.groupBy(*keys, "doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("type").alias("type"))
        agg = by_doc.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_units"), F.min("type").alias("type"))
        return self._m(agg.select("level", F.md5(F.concat_ws("|", *keys)).alias("id"), "title", "type", "n_docs", "n_units"))

    @cached_property
    def qualified(self) -> DataFrame:
        """(level, title, n_docs) of every entity; how often it recurs is a column, no filter."""
        return self.entity_stats.select("level", "title", "n_docs")

    @cached_property
    def entity_units(self) -> DataFrame:
        """Link table (level, title, unit_id, doc_id) of all entities."""
        return self.unit_entities.select("level", "title", "unit_id", "doc_id")

    @cached_property
    def entities(self) -> DataFrame:
        keys = ["level", "title"]
        ue = self.unit_entities
        d = given_texts(ue, keys)
        # texts are counted by 96 bits of hashes, which move instead of them
        hashed = d.select(*keys, F.xxhash64("description").alias("h"), F.hash("description").alias("i")).distinct()
        ndesc = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_descriptions"))
        base = self.entity_stats.join(ndesc, keys, "left").join(sorted_summary(d, keys), keys, "left").fillna(0, ["n_descriptions"])
        return self._m(base.select(
            "level", "id", "title", "type", F.coalesce("summary", F.lit("")).alias("description"),
            "n_docs", "n_units", "n_descriptions"))

    @cached_property
    def pair_rows(self) -> DataFrame:
        """Per-unit relationship rows."""
        return self.unit_relationships

    @cached_property
    def weights(self) -> DataFrame:
        """(level, source, target, weight, n_units): the edges without their texts."""
        # pair_rows has one row per (unit, pair): unit count = row count
        return self._m(self.pair_rows.groupBy("level", "source", "target").agg(
            F.sum("strength").cast("double").alias("weight"), F.count(F.lit(1)).alias("n_units")))

    @cached_property
    def edges(self) -> DataFrame:
        """(level, id, source, target, weight, n_units): merged edges, for what reads no texts or ranks."""
        return self.weights.select("level", _edge_id(), "source", "target", "weight", "n_units")

    @cached_property
    def degrees(self) -> DataFrame:
        """(level, title, degree): incident edges; isolated entities get 0."""
        r = self.weights
        ends = r.select("level", F.col("source").alias("title")).unionByName(
            r.select("level", F.col("target").alias("title")))
        d = ends.groupBy("level", "title").agg(F.count(F.lit(1)).alias("degree"))
        return self._m(self.qualified.select("level", "title").join(d, ["level", "title"], "left")
                       .select("level", "title", F.coalesce("degree", F.lit(0)).cast("long").alias("degree")))

    @cached_property
    def ranks(self) -> DataFrame:
        """Merged edges with rank = degree(source) + degree(target), without their texts."""
        d = self.degrees
        ds = d.select("level", F.col("title").alias("source"), F.col("degree").alias("d_s"))
        dt = d.select("level", F.col("title").alias("target"), F.col("degree").alias("d_t"))
        return self._m(self.weights.join(ds, ["level", "source"]).join(dt, ["level", "target"])
                       .withColumn("rank", (F.col("d_s") + F.col("d_t")).cast("long")).drop("d_s", "d_t"))

    @cached_property
    def ranked_edges(self) -> DataFrame:
        """(level, id, source, target, rank)."""
        return self.ranks.select("level", _edge_id(), "source", "target", "rank")

    @cached_property
    def _described(self) -> DataFrame:
        """``ranks`` with their description; the texts move once."""
        keys = ["level", "source", "target"]
        out = self.ranks.join(sorted_summary(given_texts(self.pair_rows, keys), keys), keys, "left")
        return self._m(out.select(
            "level", _edge_id(), "source", "target", F.coalesce("summary", F.lit("")).alias("description"),
            "weight", "n_units", "rank", F.coalesce(F.col("texts") > 1, F.lit(False)).alias("several")))

    @cached_property
    def ranked_relationships(self) -> DataFrame:
        return self._described.drop("several")

    @cached_property
    def relationships(self) -> DataFrame:
        return self.ranked_relationships.drop("rank")

    @cached_property
    def summarized_relationships(self) -> DataFrame:
        """The relationships whose description is put together from more than one text."""
        return self._described.where("several").drop("several", "rank")
