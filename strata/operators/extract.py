"""Per-unit extraction and the structured-record formats.

The extraction step is a deterministic rule extractor (no Python): sentences
are cut with a regex, capitalised words become typed mentions, mentions of types outside the tier's list are dropped, and
consecutive mentions of two different entities inside one unit become a
relationship.  Pairing only *consecutive* mentions keeps the output linear
in the unit length: no all-pairs fan-out, whatever the entity frequency.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata import config as C
from strata.session import stored


def _tier_types_expr() -> str:
    cases = " ".join(
        f"WHEN '{tier}' THEN array({', '.join(repr(t) for t in types)})"
        for tier, types in C.TIER_TYPES.items())
    return f"CASE level {cases} ELSE array() END"


def _type_sql(x: str) -> str:
    whens = " ".join(f"WHEN {x} LIKE '{p}' THEN '{t}'" for p, t in C.TYPE_RULES)
    return f"CASE {whens} ELSE '{C.DEFAULT_TYPE}' END"


# Java-side equivalent of "a maximal letter run that fully matches
# ENTITY_WORD_RE": lookarounds pin both ends of the run, the one before it
# only where a capital stands.
ENTITY_CANDIDATE_RE = r"(?=\p{Lu})(?<!\p{L})\p{Lu}\p{L}++"


# Units of more characters are put in order by windows: arrays are searched element by element.
LONG_UNIT = 8000


def _listed(units: DataFrame, type_filter: bool) -> DataFrame:
    """Units with ``ss``, their sentences, and ``ms``, their mentions in text order as
    (title, type, sent_ix, w_ix)."""
    from strata.functions.text import entity_type, strip_ws
    cut = units.select(F.col("id").alias("unit_id"), "doc_id", "level",
                       F.regexp_extract_all("text", F.lit(C.SENTENCE_RE), 0).alias("sents"))
    words = F.transform("sents", lambda s, i: F.transform(
        F.regexp_extract_all(s, F.lit(ENTITY_CANDIDATE_RE), 0),
        lambda w, j: F.struct(F.upper(w).alias("title"), i.alias("sent_ix"), j.alias("w_ix"))))
    typed = F.transform(F.flatten(words), lambda m: F.struct(
        m["title"].alias("title"), entity_type(m["title"]).alias("type"), m["sent_ix"].alias("sent_ix"), m["w_ix"].alias("w_ix")))
    listed = cut.select("unit_id", "doc_id", "level", F.transform("sents", strip_ws).alias("ss"), typed.alias("ms"))
    if type_filter:
        listed = listed.withColumn("ms", F.expr(f"filter(ms, m -> array_contains({_tier_types_expr()}, m.type))"))
    return listed


def mentions(units: DataFrame, type_filter: bool = True) -> DataFrame:
    """units -> one row per type-filtered entity mention, in text order.

    Sentences and candidate words are arrays of the unit's row, so nothing is shuffled.
    Columns: unit_id, doc_id, level, pos, title, type, sent_ix, sentence; n_title, n_sent_ix,
    n_sentence of the next mention, from which consecutive pairs are read; first: no earlier
    mention of the unit has the title; strength: how often the unit has the pair that starts
    here, 0 where an earlier mention starts it too or there is none.  Units that share an id
    count as one; these and very long ones are put in order by windows."""
    repeated = stored(units.groupBy(F.col("id").alias("_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_id"),
                      "repeated-units")
    long = F.length("text") > LONG_UNIT
    if repeated.isEmpty():
        alone, rest = units.where(~long), units.where(long)
    else:
        same = units["id"] == repeated["_id"]
        alone = units.where(~long).join(repeated, same, "left_anti")
        rest = units.where(long).unionByName(units.where(~long).join(repeated, same, "left_semi"))
    return _from_arrays(_listed(alone, type_filter)).unionByName(_from_windows(_listed(rest, type_filter)))


def _from_arrays(listed: DataFrame) -> DataFrame:
    # titles are letters only, so a pair is one text.  The generator is an outer one, as an inner one
    # has its whole input computed for a filter on empty arrays as well
    pair = """transform(ms, (m, i) -> if(ms[i].title != get(ms, i + 1).title,
        concat(least(m.title, get(ms, i + 1).title), '|', greatest(m.title, get(ms, i + 1).title)), null))"""
    rows = listed.select("unit_id", "doc_id", "level", "ss", "ms", F.col("ms.title").alias("ts"), F.expr(pair).alias("ps")).select(
        "*", F.posexplode_outer("ms").alias("pos", "m")).where(F.col("pos").isNotNull())
    nxt, sentence = F.get("ms", F.col("pos") + 1), lambda m: F.get("ss", m["sent_ix"])
    p = F.get("ps", F.col("pos"))
    return rows.select(
        "unit_id", "doc_id", "level", "pos", "m.title", "m.type", "m.sent_ix", sentence(F.col("m")).alias("sentence"),
        nxt["title"].alias("n_title"), nxt["sent_ix"].alias("n_sent_ix"), sentence(nxt).alias("n_sentence"),
        (F.array_position("ts", F.col("m.title")) == F.col("pos") + 1).alias("first"),
        F.when(p.isNotNull() & (F.array_position("ps", p) == F.col("pos") + 1),
               F.size("ps") - F.size(F.array_remove("ps", p))).otherwise(0).cast("long").alias("strength"))


def _from_windows(listed: DataFrame) -> DataFrame:
    w = listed.select("unit_id", "doc_id", "level", "ss", F.explode_outer("ms").alias("m")).where(F.col("m").isNotNull()).select(
        "unit_id", "doc_id", "level", "m.*", F.get("ss", F.col("m.sent_ix")).alias("sentence"))
    win = Window.partitionBy("unit_id").orderBy("sent_ix", "w_ix")
    m = w.select("unit_id", "doc_id", "level", (F.row_number().over(win) - 1).alias("pos"), "title", "type",
                 "sent_ix", "sentence", F.lead("title").over(win).alias("n_title"),
                 F.lead("sent_ix").over(win).alias("n_sent_ix"), F.lead("sentence").over(win).alias("n_sentence"))
    unit = ["unit_id", "doc_id", "level"]
    pair = Window.partitionBy(*unit, F.least("title", "n_title"), F.greatest("title", "n_title"), F.col("title") != F.col("n_title"))
    first = F.row_number().over(Window.partitionBy(*unit, "title").orderBy("pos")) == 1
    starts = F.coalesce(F.col("title") != F.col("n_title"), F.lit(False)) & (F.row_number().over(pair.orderBy("pos")) == 1)
    return m.withColumn("first", first).withColumn(
        "strength", F.when(starts, F.count(F.lit(1)).over(pair)).otherwise(0).cast("long"))


def unit_entities(m: DataFrame) -> DataFrame:
    """One row per (unit, entity): type and the sentence of its first mention."""
    return m.where("first").select("level", "doc_id", "unit_id", "title", "type", F.col("sentence").alias("description"))


def unit_relationships(m: DataFrame) -> DataFrame:
    """Consecutive mentions of two different entities in one unit -> one row
    per (unit, unordered pair): strength = occurrences."""
    desc = F.when(F.col("sent_ix") == F.col("n_sent_ix"), F.col("sentence")) \
        .otherwise(F.concat_ws(" ", "sentence", "n_sentence"))
    return m.where("strength > 0").select(
        "level", "doc_id", "unit_id", F.least("title", "n_title").alias("source"), F.greatest("title", "n_title").alias("target"),
        "strength", desc.alias("description"))


# ----------------------------------------------------------------------------
# record strings (the model-output format) and their parser

def _clean(c) -> Column:
    """Delimiter-safe field text."""
    return F.regexp_replace(F.regexp_replace(c, "<\\|>|##|<\\|COMPLETE\\|>", " "), '"', "'")


def format_records(ue: DataFrame, ur: DataFrame) -> DataFrame:
    """Per unit: ``("entity"<|>T<|>TYPE<|>D)##("relationship"<|>S<|>T<|>D<|>W)<|COMPLETE|>``."""
    d = C.TUPLE_DELIM
    ent = ue.select("unit_id", F.lit(0).alias("kind_ord"), F.col("title").alias("k"),
                    F.concat(F.lit(f'("entity"{d}"'), "title", F.lit(f'"{d}"'), "type", F.lit(f'"{d}"'),
                             _clean(F.col("description")), F.lit('")')).alias("rec"))
    rel = ur.select("unit_id", F.lit(1).alias("kind_ord"), F.concat_ws("|", "source", "target").alias("k"),
                    F.concat(F.lit(f'("relationship"{d}"'), "source", F.lit(f'"{d}"'), "target", F.lit(f'"{d}"'),
                             _clean(F.col("description")), F.lit(f'"{d}'), F.col("strength").cast("string"),
                             F.lit(")")).alias("rec"))
    recs = ent.unionByName(rel)
    # bounded group: the records of one text unit
    return (recs.groupBy("unit_id")
            .agg(F.array_sort(F.collect_list(F.struct("kind_ord", "k", "rec"))).alias("rs"))
            .select("unit_id", F.concat(F.array_join(F.transform("rs", lambda r: r["rec"]), C.RECORD_DELIM),
                                        F.lit(C.COMPLETE)).alias("response")))


def parse_records(responses: DataFrame) -> DataFrame:
    """response string -> one row per record with kind, fields, validity.

    Strip the completion marker (also when glued to the last record), split
    on the record delimiter, strip parens and quotes, split on the tuple
    delimiter; 4 fields = entity, 5 = relationship with a numeric strength.
    Anything else is kept with ``valid = false`` (quarantine).
    """
    body = F.replace(F.col("response"), F.lit(C.COMPLETE), F.lit(""))
    recs = F.split(body, "##")
    r = responses.select("unit_id", F.posexplode(recs).alias("rec_ix", "raw"))
    r = r.withColumn("raw", F.regexp_replace("raw", "^[ \t\n\r\f(]+|[ \t\n\r\f)]+$", "")).where(F.col("raw") != "")
    fields = F.transform(F.split("raw", "<\\|>"), lambda f: F.regexp_replace(f, '^"|"$', ""))
    r = r.withColumn("f", fields).withColumn("n", F.size("f"))
    kind = F.lower(F.get("f", 0))
    strength = F.expr("try_cast(get(f, 4) AS DOUBLE)")
    valid = ((kind == "entity") & (F.col("n") == 4)) | \
            ((kind == "relationship") & (F.col("n") == 5) & strength.isNotNull())
    return r.select("unit_id", "rec_ix", kind.alias("kind"),
                    F.upper(F.get("f", 1)).alias("f1"), F.get("f", 2).alias("f2"), F.get("f", 3).alias("f3"),
                    F.when(kind == "relationship", strength).alias("strength"),
                    valid.alias("valid"), "raw")
