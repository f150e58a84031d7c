"""Community statistics, report context and extractive community reports.

Every per-community list is cut by a ``row_number() <= k`` limit before it
is collected, so even a giant (unsplittable) community only ever collects
k rows; Spark plans those limits as partial ``WindowGroupLimit`` operators
on the map side (``spark.sql.optimizer.windowGroupLimitThreshold``).
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata import config as C
from strata.functions.text import csv_field, token_count
from strata.session import stored

CKEYS = ["level", "cluster_level", "community"]
N_FINDINGS = 5


def numbered(assign: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``assign`` with ``h``, (level, cluster_level, community, h, size)): a number for each community,
    a hash of its keys that no two of them share, and its rows."""
    for seed in count():
        h = F.xxhash64(F.lit(seed), *CKEYS)
        names = stored(assign.groupBy(*CKEYS).agg(F.count(F.lit(1)).alias("size")).withColumn("h", h), "community-numbers")
        if names.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            return assign.withColumn("h", h), names


def known_communities(assign: DataFrame) -> DataFrame:
    return assign.where(F.col("cluster_level").isNotNull() & F.col("community").isNotNull())


def ordered_edges(rels: DataFrame) -> DataFrame:
    """``rels``, a read table, with ``e``, numbers that ascend by rank desc, id; written, as the bounds
    of the ranges are sampled anew, from all its columns, by every run of the plan."""
    order = [F.col("rank").desc(), F.col("id")]
    parts = int(rels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(rels.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("e", F.monotonically_increasing_id()),
                  "ordered-edges")


def _communities_of(assign: DataFrame, numbers: bool = False) -> DataFrame:
    """(level, title, at): the communities of each entity, one on each cluster level, in its row, so
    that an edge meets them once and not level by level; ``numbers``: as their numbers ``h``."""
    at = F.col("h") if numbers else F.struct("cluster_level", "community")
    return assign.groupBy("level", "title").agg(F.collect_list(at).alias("at"))


def _of(communities: DataFrame, end: str) -> DataFrame:
    return communities.select("level", F.col("title").alias(end), F.col("at").alias(f"at_{end}"))


def _in_communities(edges: DataFrame, communities, numbers: bool = False) -> DataFrame:
    """The edges by community of the array ``communities``; an outer generator, as an inner one has
    the array computed for a filter as well."""
    rows = edges.withColumn("_at", F.explode_outer(communities)).where(F.col("_at").isNotNull())
    found = [F.col("_at").alias("h")] if numbers else ["_at.cluster_level", "_at.community"]
    return rows.select("*", *found).drop("_at", "at_source", "at_target", "_h", "_i")


def internal_edges(assign: DataFrame, rels: DataFrame) -> DataFrame:
    """Edges whose two endpoints sit in the same community (per cluster level)."""
    return edges_inside(_communities_of(assign), rels)


def numbered_inside(communities: DataFrame, rels: DataFrame) -> DataFrame:
    """``edges_inside`` by the numbers ``h`` of communities (level, title, at): an array of numbers
    is searched by compiled code.  A number that stands n times at the target is met n times."""
    j = rels.join(_of(communities, "source"), ["level", "source"]).join(_of(communities, "target"), ["level", "target"])
    rows = j.withColumn("h", F.explode("at_source")).where(F.expr("array_contains(at_target, h)"))
    times = F.size("at_target") - F.size(F.expr("array_remove(at_target, h)"))
    return rows.withColumn("_n", F.explode(F.sequence(F.lit(1), times))).drop("_n", "at_source", "at_target")


def edges_inside(communities: DataFrame, rels: DataFrame) -> DataFrame:
    """The edges by community that both ends are in; ``communities`` (level, title, at).

    An edge takes 96 bits of hashes for each community of its source to its target, where the
    names are: the communities of two ends are compared, one edge at a time, by these."""
    h, i = (lambda x: F.xxhash64(x["cluster_level"], x["community"])), (lambda x: F.hash(x["cluster_level"], x["community"]))
    source = communities.select("level", F.col("title").alias("source"), F.transform("at", h).alias("_h"), F.transform("at", i).alias("_i"))
    target = communities.select("level", F.col("title").alias("target"), F.transform("at", lambda x: F.struct(
        x["cluster_level"].alias("cluster_level"), x["community"].alias("community"), h(x).alias("h"), i(x).alias("i"))).alias("at_target"))
    # hub endpoints: AQE splits one entity's edges over several reducers
    j = rels.join(source, ["level", "source"]).join(target, ["level", "target"])
    return _in_communities(j, F.expr("""flatten(transform(_h, (h, j) -> filter(at_target, y -> y.h = h AND y.i = _i[j]
        AND y.cluster_level IS NOT NULL AND y.community IS NOT NULL)))"""))


def touching_edges(assign: DataFrame, rels: DataFrame, numbers: bool = False) -> DataFrame:
    """Edges with at least one endpoint in the community: those of the source and those of
    the target, an internal edge counted once.  ``numbers``: by the number ``h`` of the community."""
    once = rels.dropDuplicates(["level", "id", "source", "target"])
    at = _communities_of(assign, numbers)
    j = once.join(_of(at, "source"), ["level", "source"], "left").join(_of(at, "target"), ["level", "target"], "left")
    none = F.array().cast(j.schema["at_source"].dataType)
    return _in_communities(j, F.array_union(F.coalesce("at_source", none), F.coalesce("at_target", none)), numbers)


def community_stats(assign: DataFrame, rels: DataFrame, entity_units: DataFrame) -> DataFrame:
    """Entities, internal edges and units by community."""
    assign, names = numbered(assign)
    at = _communities_of(known_communities(assign), numbers=True)
    return numbered_stats(names, at, numbered_inside(at, rels.select("level", "source", "target")), entity_units).drop("h")


def numbered_stats(names: DataFrame, at: DataFrame, inner: DataFrame, entity_units: DataFrame) -> DataFrame:
    """(keys, size, n_edges, n_units, h) of the communities ``names``; ``at`` are those of each
    entity and ``inner`` the internal edges, by numbers."""
    ne = inner.groupBy("h").agg(F.count(F.lit(1)).alias("n_edges"))
    # units are known by 96 bits of hashes, which move instead of the ids; a unit meets the communities
    # of its entities in one row (bounded: the entities of a unit)
    units = entity_units.select(
        "level", "title", F.xxhash64("unit_id").alias("u"), F.hash("unit_id").alias("v"))
    of_unit = units.join(at, ["level", "title"]).groupBy("u", "v").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"))
    nu = of_unit.select(F.explode_outer("at").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n_units"))
    return (names.join(ne, "h", "left").join(nu, "h", "left")
            .select("level", F.col("cluster_level").cast("int"), "community", "size",
                    F.coalesce("n_edges", F.lit(0)).cast("long").alias("n_edges"),
                    F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"), "h"))


def edge_csv(df: DataFrame) -> F.Column:
    return F.concat_ws(",", csv_field(F.col("id")), csv_field(F.col("source")),
                       csv_field(F.col("target")), csv_field(F.col("description")), F.col("rank").cast("string"))


def edge_tokens(rels: DataFrame) -> DataFrame:
    """The edges with the tokens of their CSV row in place of their texts; written once counted."""
    counted = rels.select("level", "id", "source", "target", "rank", token_count(edge_csv(rels)).alias("tokens"))
    return stored(counted, "edge-tokens")


def _within(touch: DataFrame, budget: int) -> DataFrame:
    """(h, e, tokens, rn, cum_tokens): each community's edges in order, while the running sum is within budget."""
    w = Window.partitionBy("h").orderBy("e")
    # every row has >= 1 token, so no more than `budget` rows can fit
    ranked = touch.select("h", "e", "tokens").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= budget)
    ranked = ranked.withColumn("cum_tokens", F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return ranked.where(F.col("cum_tokens") <= budget)


def community_context(assign: DataFrame, ranked_rels: DataFrame, budget: int = C.REPORT_BUDGET) -> DataFrame:
    """Report input edges per community: touching edges by rank desc, id;
    kept while the running token sum of their CSV rows stays within budget.
    -> (level, cluster_level, community, rn, id, source, target, tokens, cum_tokens)

    Edges and communities are numbers until they are kept."""
    assign, names = numbered(assign)
    edges = ordered_edges(edge_tokens(ranked_rels))
    kept = _within(touching_edges(assign, edges, numbers=True), budget)
    return kept.join(names, "h").join(edges.select("e", "id", "source", "target"), "e").select(
        "level", F.col("cluster_level").cast("int"), "community", F.col("rn").cast("int"), "id",
        "source", "target", F.col("tokens").cast("int"), F.col("cum_tokens").cast("long"))


def first_appearance(context: DataFrame, assign: DataFrame) -> DataFrame:
    """Members in order of first appearance in the kept, ranked edge list.  Communities are compared
    by 96 bits of hashes, which move instead of their names."""
    hashed = [F.xxhash64(*CKEYS).alias("h"), F.hash(*CKEYS).alias("i")]
    ends = known_communities(context).select(*hashed, "rn", F.explode(F.array("source", "target")).alias("title"))
    first = ends.groupBy("h", "i", "title").agg(F.min("rn").alias("first_rn"))
    members = known_communities(assign).where(F.col("level").isNotNull()).select("level", F.col("cluster_level").cast("int"), "community", "title")
    return members.select("*", *hashed).join(first, ["h", "i", "title"]).select(*CKEYS, "title", "first_rn")


def community_reports(nodes: DataFrame, ranked_rels: DataFrame, entity_units: DataFrame) -> DataFrame:
    """One extractive report per community.

    title = the two highest-degree members; findings = the 5 highest-rank
    internal edges; rating = 10 x internal edge density (0..10)."""
    assign, names = numbered(nodes.select("level", "title", "cluster_level", "community", "degree"))
    assign, names = known_communities(assign), known_communities(names).where(F.col("level").isNotNull())
    edges = ordered_edges(ranked_rels.select("level", "id", "source", "target", "rank"))
    at = stored(_communities_of(assign, numbers=True), "entity-communities")
    ie = stored(numbered_inside(at, edges.select("level", "source", "target", "e")).select("h", "e"), "inner-edges")
    stats = numbered_stats(names, at, ie, entity_units)
    wt = Window.partitionBy("h").orderBy(F.col("degree").desc(), F.col("title"))
    top = (assign.withColumn("r", F.row_number().over(wt)).where(F.col("r") <= 2)
           .groupBy("h").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "title"))),
                                                      lambda s: s["title"]), " & ").alias("name")))
    # the names and texts are joined to the few edges that are shown
    finds = (ie.withColumn("r", F.row_number().over(Window.partitionBy("h").orderBy("e"))).where(F.col("r") <= N_FINDINGS)
             .join(edges.select("e", "level", "id", "source", "target"), "e")
             .join(ranked_rels.select("level", "id", "description"), ["level", "id"]).groupBy("h").agg(F.transform(
                 F.array_sort(F.collect_list(F.struct("r", "source", "target", "description"))),
                 lambda s: F.struct(F.concat_ws(" - ", s["source"], s["target"]).alias("summary"),
                                    s["description"].alias("explanation"))).alias("findings")))
    density = F.col("n_edges") / F.greatest(F.lit(1.0), F.col("size") * (F.col("size") - 1) / 2.0)
    rep = (stats.join(top, "h").join(finds, "h", "left")
           .withColumn("findings", F.coalesce("findings", F.array().cast(
               "array<struct<summary:string,explanation:string>>")))
           .withColumn("rating", F.round(F.least(F.lit(10.0), 10.0 * density), 2))
           .withColumn("title", F.concat(F.lit("Community of "), F.col("name")))
           .withColumn("summary", F.concat(F.lit("Community of "), F.col("size").cast("string"),
                                           F.lit(" entities around "), F.col("name"), F.lit(".")))
           .withColumn("rating_explanation", F.concat(F.col("n_edges").cast("string"),
                                                      F.lit(" internal relationships among "),
                                                      F.col("size").cast("string"), F.lit(" entities."))))
    content = F.concat_ws("\n", F.concat(F.lit("# "), F.col("title")), F.col("summary"),
                          F.array_join(F.transform("findings", lambda f: F.concat_ws(": ", f["summary"], f["explanation"])), "\n"))
    return rep.select("level", "cluster_level", "community", "title", "summary", "rating", "rating_explanation",
                      "findings", "size", "n_edges", "n_units", content.alias("full_content"),
                      F.to_json(F.struct("title", "summary", "rating", "rating_explanation", "findings")).alias("json"))


def parse_report_json(df: DataFrame, col: str = "json") -> DataFrame:
    """Report JSON -> struct columns + ``valid``.  PERMISSIVE parsing: a
    malformed document lands in the corrupt-record column; a rating outside
    0..10 is also invalid (quarantine = ``valid = false``)."""
    from pyspark.sql import types as T
    from strata.schemas import REPORT_JSON
    # a new StructType: StructType.add would mutate the shared schema
    schema = T.StructType(REPORT_JSON.fields + [T.StructField("_corrupt", T.StringType())])
    p = df.withColumn("_j", F.from_json(col, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    valid = (F.col("_j._corrupt").isNull() & F.col("_j.title").isNotNull()
             & F.coalesce(F.col("_j.rating").between(0, 10), F.lit(False)))
    return p.select(*[c for c in df.columns if c != col], F.col("_j.title").alias("title"),
                    F.col("_j.summary").alias("summary"), F.col("_j.rating").alias("rating"),
                    F.col("_j.rating_explanation").alias("rating_explanation"),
                    F.col("_j.findings").alias("findings"), valid.alias("valid"))


GROUNDING_RE = "Entities \\(([^)]*)\\)"
SHOWN_REFS = 5


def shown_refs(members: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """(keys, ref): the text ``[Data: Entities (a, b, ...)]`` of each group, its first five ids
    in order and ``+more`` where it has others.  Only the text is cut: the members stay rows."""
    ranked = members.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(id_col)))
    first = (ranked.where(F.col("_r") <= SHOWN_REFS + 1)          # bounded: six rows a group
             .groupBy(*keys).agg(F.array_sort(F.collect_list(id_col)).alias("ids")))
    more = F.when(F.size("ids") > SHOWN_REFS, F.lit(", +more")).otherwise("")
    return first.select(*keys, F.concat(F.lit("[Data: Entities ("), F.array_join(F.slice("ids", 1, SHOWN_REFS), ", "),
                                        more, F.lit(")]")).alias("ref"))


def missing_refs(members: DataFrame, id_col: str, known_ids: DataFrame) -> DataFrame:
    """The rows of ``members`` whose id is none of ``known_ids``(id_col)."""
    return members.join(known_ids.select(id_col).distinct(), id_col, "left_anti")


def grounding_refs(df: DataFrame, text_col: str, known_ids: DataFrame, key: str) -> DataFrame:
    """``[Data: Entities (id, ...)]`` references -> (key, n_ids, too_many,
    n_missing): more than 5 ids and ids absent from ``known_ids(sid)`` flagged;
    ``+more`` is no id."""
    ids = F.split(F.regexp_extract(text_col, GROUNDING_RE, 1), ", ")
    parsed = df.select(key, F.filter(ids, lambda x: (x != "") & (x != "+more")).alias("ids"))
    missing = (parsed.select(key, F.explode("ids").alias("sid")).join(known_ids.select("sid").distinct(), "sid",
                                                                     "left_anti")
               .groupBy(key).agg(F.count(F.lit(1)).alias("n")))
    return (parsed.join(missing, key, "left")
            .select(key, F.size("ids").alias("n_ids"), (F.size("ids") > SHOWN_REFS).alias("too_many"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n_missing")))


def context_rollup(assign: DataFrame, ranked_rels: DataFrame, reports: DataFrame,
                   budget: int = C.REPORT_BUDGET) -> DataFrame:
    """Contexts of communities whose own edges overflow ``budget``, rebuilt from their children.

    From the deepest cluster level up: a community whose edges fit has them as its context,
    and one that was not split as many of them as fit.  Any other takes the contexts of its
    children, the largest first replaced by the child's report, as few as make the rest fit;
    where even all reports do not fit, the reports that do, in that order.  A child's context
    is the rebuilt one where it was rebuilt itself, so no context is above the budget on any
    level.  -> (level, cluster_level, community, child, as_report, rn, tokens, context_tokens)"""
    rels = ranked_rels
    with_h, names = numbered(assign)
    touch = stored(touching_edges(with_h, ordered_edges(edge_tokens(rels)), numbers=True).select("h", "e", "tokens"), "touching")
    own = touch.groupBy("h").agg(F.sum("tokens").alias("own"))
    cut = _within(touch, budget).groupBy("h").agg(F.max("cum_tokens").alias("kept"))
    own = names.join(own, "h", "left").join(cut, "h", "left").select(*CKEYS, "own", "kept")
    rep = reports.select("level", F.col("cluster_level").cast("int").alias("cluster_level"), "community",
                         token_count(F.col("full_content")).cast("long").alias("report"))
    up = assign.select("level", F.col("cluster_level").cast("int").alias("cluster_level"), "community", "parent").distinct()
    base = stored(up.join(own, CKEYS, "left").join(rep, CKEYS).fillna(0, ["own", "kept"]), "contexts")
    deepest = base.agg(F.max("cluster_level")).first()[0]
    found, below = None, None
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        here = base.where(F.col("cluster_level") == depth)
        if below is None:
            state = here.withColumn("context", F.col("kept"))
        else:
            w = Window.partitionBy("level", "parent").orderBy(F.col("context").desc(), F.col("child"))
            run = w.rowsBetween(Window.unboundedPreceding, 0)
            over = here.where(F.col("own") > budget).select("level", F.col("community").alias("parent"))
            mix = (below.select("level", "parent", F.col("community").alias("child"), "context", "report")
                   .join(over, ["level", "parent"])
                   .withColumns({"rn": F.row_number().over(w), "reports": F.sum("report").over(run),
                                 "rest": F.sum("context").over(Window.partitionBy("level", "parent")) - F.sum("context").over(run)}))
            # children replaced: as few as fit, all of them if none do
            fits = mix.groupBy("level", "parent").agg(
                F.sum("context").alias("whole"), F.min(F.when(F.col("reports") + F.col("rest") <= budget, F.col("rn"))).alias("least"))
            least = F.when(F.col("whole") <= budget, 0).otherwise(F.coalesce("least", F.lit(2**31 - 1)))
            part = (mix.join(fits.select("level", "parent", least.alias("replaced")), ["level", "parent"])
                    .withColumn("as_report", F.col("rn") <= F.col("replaced"))
                    .withColumn("tokens", F.when(F.col("as_report"), F.col("report")).otherwise(F.col("context")))
                    .where((F.col("replaced") < 2**31 - 1) | (F.col("reports") <= budget)))
            part = stored(part.select("level", F.lit(depth).alias("cluster_level"), F.col("parent").alias("community"), "child",
                                      "as_report", F.col("rn").cast("int").alias("rn"), "tokens"), "rollup")
            total = part.groupBy(*CKEYS).agg(F.sum("tokens").alias("context_tokens"))
            rows = part.join(total, CKEYS)
            found = rows if found is None else found.unionByName(rows)
            state = here.join(total, CKEYS, "left").withColumn("context", F.coalesce("context_tokens", "kept")).drop("context_tokens")
        below = stored(state, "contexts")
    if found is None:         # no communities, or none with a level below
        return base.where("false").select(*CKEYS, F.col("community").alias("child"), F.lit(True).alias("as_report"),
                                          F.lit(0).alias("rn"), F.col("own").alias("tokens"), F.col("own").alias("context_tokens"))
    return found
