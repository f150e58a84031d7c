"""Query-time context building: global (community reports) and local
(entity-centred) search, token budgets, tiers.

Every window is partitioned by a query key (question, tier, section) or by
an entity/community; budgets pre-cut with ``row_number() <= budget`` so no
group larger than the budget is ever sorted in one task after the shuffle.
Questions are the ``benchmark`` items; the question set is the only
broadcast input of the vector match and its size is checked there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata import config as C
from strata.functions.text import token_count
from strata.operators import vectors as V
from strata.operators.windows import budget_prefix

CKEYS = ["level", "cluster_level", "community"]


def finest_communities(assign: DataFrame, max_level: int = C.QUERY_COMMUNITY_LEVEL) -> DataFrame:
    """Per entity, the community at the deepest cluster level <= max_level."""
    n = assign.where(F.col("cluster_level") <= max_level)
    w = Window.partitionBy("level", "title").orderBy(F.col("cluster_level").desc())
    return n.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def reports_at_level(reports: DataFrame, assign: DataFrame, max_level: int = C.QUERY_COMMUNITY_LEVEL) -> DataFrame:
    fin = finest_communities(assign, max_level).select(*CKEYS).distinct()
    return reports.join(fin, CKEYS, "left_semi")


def occurrence_weight(reports: DataFrame) -> DataFrame:
    """n_units of the community divided by the largest n_units in its tier."""
    mx = reports.groupBy("level").agg(F.max("n_units").alias("_mx"))
    return (reports.join(mx, "level")
            .withColumn("occurrence_weight",
                        F.round(F.when(F.col("_mx") > 0, F.col("n_units") / F.col("_mx")).otherwise(0.0), 6))
            .drop("_mx"))


def shuffle_key(col: str, seed: str = C.SHUFFLE_SEED) -> F.Column:
    return F.md5(F.concat(F.col(col), F.lit(seed)))


def global_context(reports: DataFrame, assign: DataFrame, min_rank: float = C.MIN_COMMUNITY_RANK) -> DataFrame:
    """Report rows for the map stage: level <= 2, rank >= min, occurrence
    weight, seeded shuffle key (the order of a tier's rows), CSV row and tokens."""
    r = occurrence_weight(reports_at_level(reports, assign)).where(F.col("rating") >= min_rank)
    row = F.concat_ws("|", "community", "title",
                      F.format_string("%.6f", "occurrence_weight"), "full_content",
                      F.format_string("%.2f", "rating"))
    return (r.withColumn("shuffle_key", shuffle_key("community"))
            .withColumn("row", row).withColumn("tokens", token_count(F.col("row"))))


def words(col) -> F.Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(col), F.lit(V.EMBED_WORD_RE), 0))


def word_impacts(reports: DataFrame) -> DataFrame:
    """(level, w, impact, list_tokens): 1000 x the inverse document frequency of a word among a
    tier's report rows, floored; words of no weight (as good as every row has them) go."""
    n = reports.groupBy("level").agg(F.count(F.lit(1)).alias("n"))              # one row a tier
    df = (reports.select("level", "tokens", F.explode("words").alias("w")).groupBy("level", "w")
          .agg(F.count(F.lit(1)).alias("df"), F.sum("tokens").alias("list_tokens")))
    impact = F.floor(1000 * F.log((F.col("n") + 1) / F.col("df"))).cast("long")
    return df.join(F.broadcast(n), "level").select("level", "w", impact.alias("impact"), "list_tokens").where("impact > 0")


def question_words(questions: DataFrame, impacts: DataFrame) -> DataFrame:
    """(question_id, level, w, impact, rest, total, before): the weighted words of a question in
    a tier, with the impact of this and all lighter words, of all words, and the tokens of
    the report lists of heavier words.  Windows hold one question's words."""
    qw = questions.select(F.col("item_id").alias("question_id"), F.explode(words(F.col("text"))).alias("w")).join(impacts, "w")
    one = Window.partitionBy("question_id", "level")
    heavy = one.orderBy(F.col("impact").desc(), "w")
    return qw.withColumns({
        "rest": F.sum("impact").over(heavy.rowsBetween(0, Window.unboundedFollowing)),
        "total": F.sum("impact").over(one),
        "before": F.coalesce(F.sum("list_tokens").over(heavy.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    }).drop("list_tokens")


def score_floor(qwords: DataFrame, postings: DataFrame, budget: int) -> DataFrame:
    """(question_id, level, least): a score that more reports than fit the budget reach; no row
    where none is known.  Reports are scored by the heaviest words alone, as many as it takes
    for their lists to hold twice the budget: less than the whole score, so the floor holds."""
    seeds = qwords.where(F.col("before") < 2 * budget).select("question_id", "level", "w", "impact")
    found = (seeds.join(postings, ["level", "w"]).groupBy("question_id", "level", *CKEYS[1:], "tokens")
             .agg(F.sum("impact").alias("found")))
    # sums of a few impacts: few values a question, whatever the number of reports
    steps = found.groupBy("question_id", "level", "found").agg(F.sum("tokens").alias("tokens"))
    down = Window.partitionBy("question_id", "level").orderBy(F.col("found").desc())
    full = steps.withColumn("used", F.sum("tokens").over(down.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("used") > budget)
    return full.groupBy("question_id", "level").agg(F.max("found").alias("least"))


def bounded_words(questions: DataFrame, reports: DataFrame, budget: int) -> DataFrame:
    """``question_words`` with ``least``, the score floor of the question (0 where none is known)."""
    from strata.session import stored
    qwords = stored(question_words(questions, word_impacts(reports)), "question-words")
    postings = reports.select(*CKEYS, "tokens", F.explode("words").alias("w"))
    return qwords.join(score_floor(qwords, postings, budget), ["question_id", "level"], "left").fillna(0, ["least"])


def listed(bounded: DataFrame, reports: DataFrame) -> DataFrame:
    """(question_id, keys of the report, impact): the lists of the words that can find a candidate."""
    postings = reports.select(*CKEYS, F.explode("words").alias("w"))
    return bounded.where("rest >= least").select("question_id", "level", "w", "impact").join(postings, ["level", "w"])


def map_points(questions: DataFrame, ctx_rows: DataFrame, budget: int = C.SEARCH_BUDGET) -> DataFrame:
    """(question_id, keys of the report, tokens, impact, score): the summed impact of the words
    that question and report share, for all reports that can enter the budget, those of
    equal score with the last one included.

    An inverted index with upper bounds.  A report whose heaviest word of the question is w
    scores at most w's ``rest``; where that is below ``score_floor`` the word's list is not
    joined, so the frequent words find no candidates.  A candidate whose found words and all
    light words together stay below the floor goes; the light words of the others are looked
    up in the report's own words.  score is impact in percent of the question's, floored."""
    from strata.session import stored
    reports = stored(ctx_rows.select(*CKEYS, F.col("tokens").cast("long").alias("tokens"), words(F.col("row")).alias("words")), "report-words")
    bounded = stored(bounded_words(questions, reports, budget), "question-words")
    # bounded group: one question's words
    light = bounded.groupBy("question_id", "level").agg(
        F.max("total").alias("total"), F.max("least").alias("least"),
        F.coalesce(F.max(F.when(F.col("rest") < F.col("least"), F.col("rest"))), F.lit(0)).alias("light_sum"),
        F.collect_list(F.when(F.col("rest") < F.col("least"), F.struct("w", "impact"))).alias("light"))
    found = listed(bounded, reports).groupBy("question_id", *CKEYS).agg(F.sum("impact").alias("found"))
    near = found.join(light, ["question_id", "level"]).where(F.col("found") + F.col("light_sum") >= F.col("least"))
    here = F.aggregate(F.filter("light", lambda x: F.array_contains("words", x["w"])), F.lit(0).cast("long"),
                       lambda acc, x: acc + x["impact"])
    whole = near.join(reports, CKEYS).withColumn("impact", F.col("found") + here).where("impact >= least")
    return whole.select("question_id", *CKEYS, "tokens", "impact",
                        F.floor(100 * F.col("impact") / F.col("total")).cast("int").alias("score"))


def global_reduce(points: DataFrame, budget: int = C.SEARCH_BUDGET) -> DataFrame:
    """The best points of each (question, tier) up to the budget."""
    return budget_prefix(points, ["question_id", "level"], [F.col("impact").desc(), F.col("community")], "tokens", budget)


def batch_scores(reduced: DataFrame, batches: DataFrame) -> DataFrame:
    """(question_id, level, batch, n_points, tokens, score): the packed batches of report rows
    that give points to a question, with their best score; all others are passed over."""
    b = batches.select("level", "community", "batch")
    return reduced.join(b, ["level", "community"]).groupBy("question_id", "level", "batch").agg(
        F.count(F.lit(1)).alias("n_points"), F.sum("tokens").alias("tokens"), F.max("score").alias("score"))


# ------------------------------------------------------------------ local search

def entity_match(entities: DataFrame, questions: DataFrame, k: int = C.TOP_K_ENTITIES) -> DataFrame:
    """Per (question, tier): the k entities nearest to the question (cosine
    of hashed-TF embeddings of '"TITLE":description'); one pass over the
    entity vectors, grouped by tier inside the scoring kernel."""
    from strata.session import stored
    ents = entities.select(F.conv(F.substring("id", 1, 15), 16, 10).cast("long").alias("vec_id"), "level", "title",
                           F.concat(F.lit('"'), "title", F.lit('":'), "description").alias("merged"))
    ev = stored(V.embed_text(ents, "vec_id", "merged").join(ents.select("vec_id", "level"), "vec_id"), "entity-vectors")
    qv = V.embed_text(questions, "item_id", "text").select(F.col("item_id").alias("query_id"),
                                                           F.col("embedding").alias("vector"))
    hits = V.topk_cosine(ev, qv, k=k, group_col="level")
    return (hits.join(ents.select("vec_id", "level", "title"), ["vec_id", "level"])
            .select(F.col("query_id").alias("question_id"), "level", "title", "score", F.col("rk").cast("int")))


def local_relationships(matched: DataFrame, ranked_rels: DataFrame, k: int = C.TOP_K_RELATIONSHIPS) -> DataFrame:
    m = matched.select("question_id", "level", "title")
    src = ranked_rels.join(m.withColumnRenamed("title", "source"), ["level", "source"])
    tgt = ranked_rels.join(m.withColumnRenamed("title", "target"), ["level", "target"])
    touch = src.unionByName(tgt).groupBy("question_id", "level", "id", "source", "target", "rank", "weight") \
        .agg(F.count(F.lit(1)).alias("ends"))
    w = Window.partitionBy("question_id", "level").orderBy(
        F.col("ends").desc(), F.col("rank").desc(), F.col("id"))
    return (touch.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
            .withColumn("internal", F.col("ends") == 2))


def local_text_unit_rank(matched: DataFrame, entity_units: DataFrame, pair_rows: DataFrame) -> DataFrame:
    """Units of matched entities ordered by the best matched-entity rank,
    then by the number of matched relationships mentioned in the unit."""
    m = matched.select("question_id", "level", "title", "rk")
    units = (entity_units.join(m, ["level", "title"])
             .groupBy("question_id", "level", "unit_id").agg(F.min("rk").alias("entity_rk")))
    pr = pair_rows.select("level", "unit_id", "source", "target")
    rel = (pr.join(m.select("question_id", "level", F.col("title").alias("source")), ["level", "source"])
           .join(m.select("question_id", "level", F.col("title").alias("target")), ["question_id", "level", "target"])
           .groupBy("question_id", "level", "unit_id").agg(F.count(F.lit(1)).alias("n_rels")))
    u = units.join(rel, ["question_id", "level", "unit_id"], "left").fillna(0, ["n_rels"])
    return u


def local_context(matched, reports, assign, entity_units, pair_rows, units, ranked_rels, degrees,
                  budget: int = C.SEARCH_BUDGET) -> DataFrame:
    """Union of four budgeted sections per (question, tier)."""
    qk = ["question_id", "level"]
    # entities section
    ents = matched.join(degrees, ["level", "title"]).select(
        *qk, F.lit("entity").alias("section"), F.col("title").alias("item"),
        F.col("rk").alias("ord1"), F.lit(0).cast("long").alias("ord2"),
        token_count(F.concat_ws(",", "title", F.col("degree").cast("string"))).alias("tokens"))
    # relationships section
    rels = local_relationships(matched, ranked_rels).select(
        *qk, F.lit("relationship").alias("section"), F.col("id").alias("item"),
        F.col("rn").alias("ord1"), F.lit(0).cast("long").alias("ord2"),
        token_count(F.concat_ws(",", "source", "target", F.col("weight").cast("string"))).alias("tokens"))
    # reports section: communities holding matched entities
    fin = finest_communities(assign).select("level", "title", *CKEYS[1:])
    rc = (matched.join(fin, ["level", "title"]).groupBy(*qk, *CKEYS[1:]).agg(F.count(F.lit(1)).alias("n_matched"))
          .join(reports.select(*CKEYS, "rating", "full_content"), CKEYS))
    reps = rc.select(*qk, F.lit("report").alias("section"), F.col("community").alias("item"),
                     (-F.col("n_matched")).alias("ord1"), F.round(-F.col("rating") * 100).cast("long").alias("ord2"),
                     token_count(F.col("full_content")).alias("tokens"))
    # text units section
    tu = local_text_unit_rank(matched, entity_units, pair_rows).join(
        units.select(F.col("id").alias("unit_id"), "n_tokens"), "unit_id")
    tus = tu.select(*qk, F.lit("unit").alias("section"), F.col("unit_id").alias("item"),
                    F.col("entity_rk").alias("ord1"), (-F.col("n_rels")).cast("long").alias("ord2"),
                    F.col("n_tokens").alias("tokens"))
    budgets = {"report": int(budget * C.COMMUNITY_PROP), "unit": int(budget * C.TEXT_UNIT_PROP),
               "entity": int(budget * (1 - C.COMMUNITY_PROP - C.TEXT_UNIT_PROP)),
               "relationship": int(budget * (1 - C.COMMUNITY_PROP - C.TEXT_UNIT_PROP))}
    allrows = (ents.unionByName(rels).unionByName(reps).unionByName(tus)
               .withColumn("ord1", F.col("ord1").cast("long")).withColumn("tokens", F.col("tokens").cast("long")))
    allrows = allrows.withColumn("budget", F.element_at(F.create_map(*[
        x for k_, v in budgets.items() for x in (F.lit(k_), F.lit(v))]), F.col("section")))
    w = Window.partitionBy(*qk, "section").orderBy("ord1", "ord2", "item")
    r = allrows.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= F.lit(budget))
    r = r.withColumn("cum_tokens", F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return r.where(F.col("cum_tokens") <= F.col("budget")).select(
        *qk, "section", "item", F.col("rn").cast("int"), "tokens", "cum_tokens")


def answer_rows(reduced: DataFrame, reports: DataFrame, text: str = "full_content", budget: int = C.ANSWER_BUDGET) -> DataFrame:
    """Per (question, tier): the extractive answer, a paragraph of each reduced report, the best
    first: their column ``text``, whole ones while these fit the answer budget; the best report's
    always.  A paragraph has a token at least, so a group holds ``budget`` paragraphs at most."""
    found = reduced.select("question_id", *CKEYS, "rn").join(reports.select(*CKEYS, F.col(text).alias("text")), CKEYS)
    w = Window.partitionBy("question_id", "level").orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)
    kept = found.withColumn("cum", F.sum(token_count(F.col("text"))).over(w)).where((F.col("rn") == 1) | (F.col("cum") <= budget))
    paragraphs = F.transform(F.array_sort(F.collect_list(F.struct("rn", "text"))), lambda p: p["text"])
    return kept.groupBy("question_id", "level").agg(F.array_join(paragraphs, "\n\n").alias("answer"))


def answer_prompts(answers: DataFrame, questions: DataFrame, clearance: DataFrame) -> DataFrame:
    """``answers`` with the prompt of a user cleared for their tier: the numbered responses of
    all tiers that such a user sees, in tier order, and the question."""
    texts = questions.where(F.col("text").isNotNull()).select("item_id", "text").distinct()
    asked = tiered_answer(answers, texts, clearance).withColumnRenamed("user_level", "level")
    return answers.join(asked, ["question_id", "level"]).select("question_id", "level", "answer", "n_responses", "prompt")


def tiered_answer(answers: DataFrame, questions: DataFrame, clearance: DataFrame) -> DataFrame:
    """One prompt row per (user level, question): numbered responses of the
    visible tiers in tier order, then the question.  The clearance table is
    fixed and tiny (6 rows): broadcast."""
    tier_ord = F.when(F.col("level") == C.TIERS[0], 1).when(F.col("level") == C.TIERS[1], 2).otherwise(3)
    a = answers.join(F.broadcast(clearance), "level").withColumn("tord", tier_ord)
    # bounded group: at most 3 tiers per (user level, question)
    g = a.groupBy("user_level", "question_id").agg(
        F.array_sort(F.collect_list(F.struct("tord", "answer"))).alias("rs"))
    blocks = F.transform("rs", lambda r, i: F.concat(F.lit("Response "), (i + 1).cast("string"), F.lit(":\n"),
                                                     r["answer"], F.lit("\n\n")))
    g = g.join(questions.select(F.col("item_id").alias("question_id"), F.col("text").alias("q")), "question_id")
    prompt = F.concat(F.lit("Please synthesize the following responses to answer the question:\n\n"),
                      F.array_join(blocks, ""), F.lit("Question: "), F.col("q"), F.lit("Answer: "))
    return g.select("user_level", "question_id", F.size("rs").alias("n_responses"), prompt.alias("prompt"))
