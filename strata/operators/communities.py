"""Hierarchical communities by graph contraction.

Every entity starts as a community of its own; in each round every community
looks for the neighbour it gains most modularity with, pairs that choose each
other become one, those that chose a member of such a pair join it, and the
communities are contracted to weighted nodes: edges between two are summed,
edges inside are gone.  The rounds end when no pair gains any more.  A gain is
the same seen from both ends and equal gains go to the smaller ids, so the
choices hold no cycle but the pairs, and every round with a gain left
contracts at least one edge.

The rounds are the hierarchy, read from the last to the first: cluster level 0
is what the contraction ended with, and a community of more than
``MAX_CLUSTER_SIZE`` members has the parts it was last put together from as
its next level; the others have none.  Communities still too large that one
round made of single entities are the frontier: each is contracted again as a
graph of its own, with only its inner edges and their weights, until none is
left or those left become one again and so cannot be split.

Weights are whole numbers below 2^53, so sums are exact in any order.  A round
is a few joins on (tier, community) and combinable aggregates (sum, min of a
struct): a hub's edges are pre-aggregated before the shuffle and its join
partitions are split by AQE.  State is written out between rounds; edges
and communities shrink from round to round, and the entities are read again
only at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import config as C
from strata.operators.reports import edges_inside
from strata.session import stored


def group_edges(members: DataFrame, rels: DataFrame) -> DataFrame:
    """(level, c, d, w, m), c < d: edges with both ends in one group of ``members``
    (level, node, grp), and the weight m of all edges of the group."""
    s = members.select("level", F.col("node").alias("c"), "grp")
    t = members.select("level", F.col("node").alias("d"), F.col("grp").alias("_g"))
    ends = rels.select("level", F.least("source", "target").alias("c"), F.greatest("source", "target").alias("d"),
                       F.col("weight").alias("w")).where("c < d")
    inner = stored(ends.join(s, ["level", "c"]).join(t, ["level", "d"]).where("grp = _g")
                        .groupBy("level", "grp", "c", "d").agg(F.sum("w").alias("w")), "group-edges")
    return inner.join(inner.groupBy("level", "grp").agg(F.sum("w").alias("m")), ["level", "grp"]).drop("grp")


def moves(edges: DataFrame, strengths: DataFrame) -> DataFrame:
    """(level, node, root): communities that become part of ``root`` in this round.
    Two communities gain by being one if 2 m w > k_c k_d."""
    k = lambda c: strengths.select("level", F.col("label").alias(c), F.col("k").alias(f"k{c}"))
    gain = 2 * F.col("m") * F.col("w") - F.col("kc") * F.col("kd")
    gained = edges.join(k("c"), ["level", "c"]).join(k("d"), ["level", "d"]).withColumn("gain", gain).where("gain > 0")
    edge = F.struct((-F.col("gain")).alias("loss"), "c", "d")
    best = (gained.select("level", F.explode(F.array("c", "d")).alias("node"), edge.alias("edge"))
            .groupBy("level", "node").agg(F.min("edge").alias("edge"))
            .select("level", "node", F.col("edge.c").alias("c"), F.col("edge.d").alias("d")))
    # an edge that both of its ends chose; nothing else can be chosen twice
    pairs = best.groupBy("level", "c", "d").agg(F.count(F.lit(1)).alias("n")).where("n = 2")
    centres = pairs.select("level", F.explode(F.array("c", "d")).alias("other"), F.col("c").alias("root"))
    # the ends of a pair chose each other, so they meet their root here as well
    other = F.when(F.col("node") == F.col("c"), F.col("d")).otherwise(F.col("c"))
    return best.select("level", "node", other.alias("other")).join(centres, ["level", "other"]).select("level", "node", "root")


def contractions(members: DataFrame, rels: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """(communities by round, moves by round).  The communities of round 0 are the entities;
    each has (level, label, grp, base, k, n, parts): the weight of its edges, its entities, and
    how many communities of the round before it was put together from.  Moves are (level, node,
    root).  Only communities are rewritten from round to round, and there are ever fewer."""
    edges = stored(group_edges(members, rels), "edges")
    ends = edges.select("level", F.explode(F.array("c", "d")).alias("node"), "w").groupBy("level", "node").agg(F.sum("w").alias("k"))
    first = members.join(ends, ["level", "node"], "left").fillna(0.0, ["k"]).select(
        "level", F.col("node").alias("label"), "grp", "base", "k", F.lit(1).cast("bigint").alias("n"), F.lit(1).cast("bigint").alias("parts"))
    found, steps = [stored(first, "labels")], []
    while True:
        step = stored(moves(edges, found[-1]), "moves")
        if step.isEmpty():
            return found, steps
        steps.append(step)
        found.append(stored(
            raised(found[-1], step).groupBy("level", F.col("up").alias("label")).agg(
                F.max("grp").alias("grp"), F.max("base").alias("base"), F.sum("k").alias("k"), F.sum("n").alias("n"),
                F.count(F.lit(1)).alias("parts")), "labels"))
        new = lambda c: step.select("level", F.col("node").alias(c), F.col("root").alias(f"_{c}"))
        to = lambda c: F.coalesce(f"_{c}", c)
        edges = (edges.join(new("c"), ["level", "c"], "left").join(new("d"), ["level", "d"], "left")
                 .select("level", F.least(to("c"), to("d")).alias("c"), F.greatest(to("c"), to("d")).alias("d"), "w", "m")
                 .where("c < d").groupBy("level", "c", "d").agg(F.sum("w").alias("w"), F.max("m").alias("m")))
        edges = stored(edges, "edges")


def raised(labels: DataFrame, step: DataFrame, label: str = "label") -> DataFrame:
    """``labels`` with ``up``, the community that ``label`` is part of after the moves."""
    new = step.select("level", F.col("node").alias(label), F.col("root").alias("_root"))
    return labels.join(new, ["level", label], "left").withColumn("up", F.coalesce("_root", label)).drop("_root")


def contract(members: DataFrame, rels: DataFrame) -> tuple[DataFrame, int]:
    """(``members`` with r0, r1, ...: the community of each after that many rounds, the
    number of rounds)."""
    _, steps = contractions(members, rels)
    labels = members.withColumn("r0", F.col("node"))
    for r, step in enumerate(steps):
        labels = raised(labels, step, f"r{r}").withColumnRenamed("up", f"r{r + 1}")
    return labels, len(steps)


def hierarchy(members: DataFrame, found: list[DataFrame], steps: list[DataFrame], max_size: int) -> DataFrame:
    """(level, title, cluster_level, community, parent, size, finest) read from the rounds of
    one contraction of groups (level, node, grp, base); ``base`` is the cluster level
    of a group's parts, and ``finest`` marks the last row of an entity.

    From the last round down each community gets its chain, the communities of the hierarchy
    that it is in: its parent's, and itself if the parent was put together from several and
    the last of the chain is too large.  The entities are joined once, to the first round."""
    one = lambda label, n: F.array(F.struct(F.col(label).alias("label"), F.col(n).alias("n")))
    none = F.filter(one("label", "n"), lambda x: F.lit(False))
    top = found[-1]
    tops = top.groupBy("level", "grp").agg(F.count(F.lit(1)).alias("tops"))
    new = (F.col("base") == 0) | (F.col("tops") > 1) if steps else F.col("base") == 0
    chains = top.join(tops, ["level", "grp"]).select("level", "label", "parts", F.when(new, one("label", "n")).otherwise(none).alias("chain"))
    for r in range(len(steps) - 1, 0, -1):
        above = stored(chains, "chains").select("level", F.col("label").alias("up"), F.col("parts").alias("_parts"), "chain")
        added = (F.col("_parts") > 1) & (F.coalesce(F.get("chain", F.size("chain") - 1)["n"], F.lit(2**62)) > max_size)
        chains = raised(found[r], steps[r]).join(above, ["level", "up"]).select(
            "level", "label", "parts", F.when(added, F.concat("chain", one("label", "n"))).otherwise(F.col("chain")).alias("chain"))
    at = members.select("level", "node", "grp", "base", F.col("node").alias("label"))
    at = raised(at, steps[0]) if steps else at.withColumn("up", F.col("label"))
    held = at.drop("label").join(chains.select("level", F.col("label").alias("up"), "chain").where(F.size("chain") > 0), ["level", "up"])
    rows = held.select("level", "node", "grp", "base", F.size("chain").alias("last"), "chain", F.posexplode("chain").alias("i", "at"))
    cid = lambda depth, label: F.md5(F.concat_ws("|", "level", depth.cast("string"), label))
    depth, above = F.col("base") + F.col("i"), F.get("chain", F.col("i") - 1)["label"]
    return rows.select("level", F.col("node").alias("title"), depth.cast("int").alias("cluster_level"),
                       cid(depth, F.col("at.label")).alias("community"),
                       F.when(F.col("i") > 0, cid(depth - 1, above)).when(F.col("base") > 0, F.col("grp")).alias("parent"),
                       F.col("at.n").alias("size"), (F.col("i") == F.col("last") - 1).alias("finest"))


def cluster_graph(entities: DataFrame, rels: DataFrame, max_size: int = C.MAX_CLUSTER_SIZE) -> DataFrame:
    """-> (level, title, cluster_level, community, parent).  Level 0 holds every
    entity; a deeper level only the members of communities of the level above
    that had more than ``max_size`` of them and could be split.  Empty edge set
    -> every entity is its own community (never an error)."""
    members = entities.select("level", F.col("title").alias("node"), F.lit("").alias("grp"), F.lit(0).alias("base"))
    found = []
    while not found or not members.isEmpty():
        here = stored(hierarchy(members, *contractions(members, rels), max_size), "communities")
        found.append(here.select("level", "title", "cluster_level", "community", "parent"))
        members = here.where(F.col("finest") & (F.col("size") > max_size)).select(
            "level", F.col("title").alias("node"), F.col("community").alias("grp"), (F.col("cluster_level") + 1).alias("base"))
    res = found[0]
    for part in found[1:]:
        res = res.unionByName(part)
    return res


def modularity(assign: DataFrame, rels: DataFrame) -> DataFrame:
    """Weighted modularity per (level, cluster_level):
    Q = sum_c [ in_c / m - (tot_c / 2m)^2 ], in_c = internal edge weight,
    tot_c = total weighted degree of members, m = total edge weight.  At each
    cluster level an entity counts in its community there, or in the last one
    above it where that was not split."""
    m = rels.groupBy("level").agg(F.sum("weight").alias("m"))
    ends = rels.select("level", F.col("source").alias("title"), "weight").unionByName(
        rels.select("level", F.col("target").alias("title"), "weight"))
    strength = ends.groupBy("level", "title").agg(F.sum("weight").alias("k"))
    a = _carried(assign)
    tot = strength.join(a, ["level", "title"]).select("level", F.inline("at"), "k") \
        .groupBy("level", "cluster_level", "community").agg(F.sum("k").alias("tot"))
    inner = (edges_inside(a, rels.select("level", "source", "target", "weight"))
             .groupBy("level", "cluster_level", "community").agg(F.sum("weight").alias("inw")))
    per = tot.join(inner, ["level", "cluster_level", "community"], "left").join(m, ["level"])
    q = F.coalesce("inw", F.lit(0.0)) / F.col("m") - F.pow(F.col("tot") / (2 * F.col("m")), 2)
    return per.groupBy("level", "cluster_level").agg(F.sum(q).alias("modularity"),
                                                     F.count(F.lit(1)).alias("n_communities"))


def _carried(assign: DataFrame) -> DataFrame:
    """(level, title, at): an entity's community on every cluster level of its tier, (cluster_level,
    community): the one it has there, or else its deepest one."""
    a = assign.select("level", "title", F.col("cluster_level").cast("int").alias("cluster_level"), "community")
    last = a.groupBy("level").agg(F.max("cluster_level").alias("deepest"))          # one row a tier
    # bounded group: the cluster levels of one entity
    at = a.groupBy("level", "title").agg(F.collect_list(F.struct("cluster_level", "community")).alias("at"),
                                         F.max("cluster_level").alias("own"))
    carried = F.expr("""if(own < deepest, flatten(transform(sequence(own + 1, deepest), d -> transform(
        filter(at, x -> x.cluster_level = own), x -> named_struct('cluster_level', d, 'community', x.community)))), slice(at, 1, 0))""")
    return at.join(F.broadcast(last), "level").select("level", "title", F.concat("at", carried).alias("at"))


def carried_down(assign: DataFrame) -> DataFrame:
    """(level, title, cluster_level, community) with a row for each entity on every cluster
    level of its tier: its community there, or else its deepest one."""
    return _carried(assign).select("level", "title", F.inline("at"))
