"""Personal data in texts: fixed rules plus candidates judged by boosted trees.

Generators of high recall propose spans, which may overlap: the rules' own matches, valid or
not, and spellings that the rules do not know (written-out e-mail signs and dots, IPs with
guarded dots, cards in other separators, phone numbers without a country code).  Valid matches
of the rules always stay.  The others are judged by gradient-boosted trees over format and
context, fitted on LABELLED, a small table of spellings in their context with FILLS fillings of
the digits; every HELD_OUT-th spelling is held out, and for each kind the lowest score is chosen
from which on PRECISION of the held-out candidates are personal data.  The label is that of the
table's row, so nothing that decides it is a feature by itself; what the generators propose in
a row beside its spelling, as another kind or in part, is labelled 0.  An added span overlaps no
rule's span; of added spans that overlap in a chain the best stays (then the earlier).

All work on the texts is DataFrame functions; offsets are code points.  Overlaps are found by
running ends and starts over the spans of a document in order, not by pairs.

Defined cases: a null text has no spans; repeated rows get the same result; very long
runs of digits or letters are scanned once (possessive patterns), and a text of nothing but
spans takes time in step with their number; an empty table gives an empty result; only doc_id
and text are read.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import materialize, same_document, text_key

FILLS = 40               # rows of the training table for each spelling in LABELLED
HELD_OUT = 4
PRECISION = 0.98
MIN_HELD_OUT = 30
KINDS = ("email", "ip", "card", "phone")

# The rules' patterns, scanned without backtracking where nothing follows; a match that
# could start inside a run starts at its head or where the last match ended.
RULES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_AT = r"(?:\x20?(?:\(at\)|\[at\]|\{at\}|<at>)\x20?|\x20at\x20)"
_DOT = r"(?:\x20?(?:\(dot\)|\[dot\]|\{dot\}|<dot>|\[\.\]|\(\.\))\x20?|\x20dot\x20|\.)"
_GUARDED = r"(?:\x20?(?:\[\.\]|\(\.\)|\{\.\}|\[dot\]|\(dot\))\x20?|\x20dot\x20|\x20\.\x20)"
OTHER_FORMS = {
    "email": rf"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++{_AT}[a-z0-9-]++(?:{_DOT}[a-z0-9-]++)++",
    "ip": rf"(?i)(?<![0-9.])[0-9]{{1,3}}+(?:{_GUARDED}[0-9]{{1,3}}+){{3}}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:(?:[._/]|\x20[._/-]\x20|\x20\x20)[0-9]{4}){2}(?:[._/]|\x20[._/-]\x20|\x20\x20)[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+.(A-Za-z/-])\(?[0-9]{2,5}\)?(?:[\x20./-]{1,3}[0-9]{2,8}){1,4}(?![0-9A-Za-z/]|[.-][0-9])",
}
OTHER_NEEDS = {"email": "at", "ip": "", "card": "", "phone": ""}
# The labelled table: kind, 1 for personal data, the text before the spelling, the spelling (# is a digit).
LABELLED = """
phone 1 |call me at |(###) ###-####
phone 1 |you can phone |### ### ####
phone 1 |Tel: |0## #######
phone 1 |Telefon |0###/######
phone 1 |mobile |0### ### ####
phone 1 |fax |###-###-####
phone 1 |tel. |0## ## ## ## ##
phone 1 |reach us, phone: |###.###.####
phone 1 |whatsapp me on |00## ### ######
phone 1 |Mobil: |01## #######
phone 1 |our office (|(0##) ### ####
phone 1 |and then he said |(###) ###-####
phone 1 |of the house |(###) ### ####
phone 1 |please ring |(0###) ######
phone 1 |call |### ####
phone 1 |phone number |0### ######
phone 0 |order |### #### ###
phone 0 |invoice no |###-###-####
phone 0 |on |20##-0#-1#
phone 0 |since |1#.0#.19##
phone 0 |ISBN |978-#-##-######
phone 0 |ref |##/####
phone 0 |article |### ### ###
phone 0 |ticket number |####-####
phone 0 |between |19##-20##
phone 0 |costs |## ###
phone 0 |a total of |### ###
phone 0 |part no |##-####-##
phone 0 |at |##.######
phone 0 |pages |###-###
phone 0 |version |##.##.####
phone 0 |the years |19## 20##
phone 0 |serial |#### #### ####
phone 0 |of |## ### ###
phone 0 |order number |(###) ###-####
phone 0 |in the ratio |##/##
email 1 |write to |joe## (at) example (dot) org
email 1 |mail |anna.b (at) mail.example.com
email 1 |contact: |info [at] firm [dot] de
email 1 |reach me, |j.doe# at example dot com
email 1 |Kontakt |max{at}verein{dot}de
email 1 |or |bob##[at]host.example.net
email 1 |e-mail: |p_smith(at)uni.example.edu
email 1 |send it to |team <at> site <dot> org
email 1 |and |sue (at) example (dot) co (dot) uk
email 1 |my address is |lee### at mail dot example dot org
email 1 |to |k.lang[at]amt[.]example[.]fr
email 1 |from |office (at) shop (dot) example
email 0 |we looked |back at home.Then
email 0 |they met |him at noon.They
email 0 |see |figure (at) left.Below
email 0 |prices |start at ##.##
email 0 |sold |two at #.##
email 0 |we stayed |there at night.Next
email 0 |it |stood at ##.#
email 0 |and |look at this.It
email 0 |he |arrived at five.He
email 0 |we |aim at ###.###
email 0 |rate |held at #.#
email 0 |she |was at work.She
ip 1 |host |10[.]##[.]#[.]1##
ip 1 |server |192[.]168[.]#[.]##
ip 1 |from |1##(.)##(.)1##(.)#
ip 1 |login from |1## dot ## dot 1## dot ##
ip 1 |seen |8#[.]1##[.]##[.]1##
ip 1 |blocked |2#{.}##{.}1##{.}##
ip 1 |the ip |1## . ## . 1## . #
ip 1 |and |1##[dot]1##[dot]#[dot]##
ip 0 |version |3##.#.#.#
ip 0 |release |#.#.##.3##
ip 0 |build |#.#.####.####
ip 0 |section |#.#.#.4##
ip 0 |see |##.##.##.5###
ip 0 |of |# . # . # . #
ip 0 |chapters |# . # . ## . ##
ip 0 |list |#.####.##.#
card 1 |card |4###.####.####.####
card 1 |visa |4### - #### - #### - ####
card 1 |pay by |5###/####/####/####
card 1 |Karte |4###  ####  ####  ####
card 1 |card number: |5###_####_####_####
card 1 |tarjeta |4###.####.####.####
card 1 |visa card |4### #### #### ####
card 1 |my card is |5###-####-####-####
card 0 |order |##############
card 0 |serial |#### #### #### ####
card 0 |the number |################
card 0 |token |##################
card 0 |years |19##/20##/20##/20##
card 0 |of |#### #### #### ####
card 0 |invoice |####.####.####.####
card 0 |in |####  ####  ####  ####
""".strip().split("\n")
# Words before a span, as classes.
_LABEL_WORDS = ("(order|invoice|item|part|serial|ref|reference|sku|isbn|article|ticket|version|page|pages|release|build|"
                "section|chapters|token)")
_IS_NUMBER = f"lower(c.left) rlike '(^|[^a-z]){_LABEL_WORDS}[^a-z0-9]*((no|nr|number|id)[^a-z0-9]*)?$'"
_IS_PHONE = "lower(c.left) rlike '(tel|phone|fon|call|mobil|fax|whatsapp)'"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_DIGITS = "regexp_replace(m, '[^0-9]', '')"
VALID = {
    "email": "true",
    "ip": rf"m rlike '^{_PART}(?:\\.{_PART}){{3}}$'",
    "card": f"length({_DIGITS}) BETWEEN 12 AND 19 AND luhn_check({_DIGITS})",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
}
FEATURES = ("kind_no", "size", "digits", "groups", "longest_group", "letters", "dots", "hyphens", "spaces", "brackets",
            "distinct_digits", "guards", "words", "capitals", "left_class", "right_class", "left_word")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _running(lengths: str) -> str:
    """SQL for the sums of an int array before each of its blocks of 256, so that a place in a
    long array is one of these and at most 255 lengths."""
    blocks = (f"transform(sequence(0, cast(size({lengths}) / 256 AS int)), b -> "
              f"aggregate(slice({lengths}, b * 256 + 1, 256), 0, (a, x) -> a + x))")
    return f"aggregate({blocks}, array(0), (a, t) -> array_append(a, element_at(a, -1) + t))"


def _matches(pattern: str, needs: str) -> str:
    """SQL for at most one (matches, texts around them, lengths of both) of a pattern in ``text``."""
    p = _quoted(pattern)
    guard = f"instr(lower(text), '{needs}') > 0" if needs else "text rlike '[0-9]'"
    return f"""
      transform(if({guard}, array(named_struct('m', regexp_extract_all(text, {p}, 0), 'g', split(text, {p}, -1))), array()),
        q -> named_struct('m', q.m, 'g', q.g,
                          'l', zip_with(transform(slice(q.g, 1, size(q.m)), x -> length(x)),
                                        transform(q.m, x -> length(x)), (x, y) -> x + y)))"""


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, found): per row the candidates as an array of (kind_no, start, end, valid,
    m, left, right), in text order by generator; the texts of valid ones are left out."""
    rows = docs.select("doc_id", text_key().alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    generators = [(k, RULES[k], NEEDS[k], VALID[k]) for k in KINDS]
    generators += [(k, p, OTHER_NEEDS[k], "false") for k, p in OTHER_FORMS.items()]
    parts = rows.select("doc_id", "text_hash", *[
        F.expr(_matches(g[1], g[2])).alias(f"p{i}") for i, g in enumerate(generators)])
    sums = parts.select("doc_id", "text_hash", *[F.expr(f"""
        transform(p{i}, q -> named_struct('m', q.m, 'g', q.g, 'l', q.l, 'b', {_running('q.l')}))""").alias(f"p{i}")
        for i in range(len(generators))])
    found = []
    for i, (kind, _, _, valid) in enumerate(generators):
        before = "element_at(q.b, cast(i / 256 AS int) + 1) + " \
                 "aggregate(slice(q.l, cast(i / 256 AS int) * 256 + 1, i % 256), 0, (a, x) -> a + x)"
        found.append(f"""flatten(transform(p{i}, q -> transform(q.m, (m, i) -> named_struct(
            'kind_no', {KINDS.index(kind)}, 'm', m, 'start', {before} + length(q.g[i]), 'valid', {valid},
            'left', right(q.g[i], 24), 'right', left(q.g[i + 1], 1)))))""")
    spans = sums.select("doc_id", "text_hash", F.expr(f"concat({', '.join(found)})").alias("found"))
    return spans.withColumn("found", F.expr("""transform(found, c -> named_struct(
        'kind_no', c.kind_no, 'start', c.start, 'end', c.start + length(c.m), 'valid', c.valid,
        'm', if(c.valid, '', c.m), 'left', if(c.valid, '', c.left), 'right', if(c.valid, '', c.right)))"""))


def unsettled(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind_no, start, end, features...): candidates that overlap no valid match."""
    rows = found.where("exists(found, c -> NOT c.valid)").select(
        "doc_id", "text_hash", F.explode("found").alias("c")).distinct().select("doc_id", "text_hash", "c")
    same = Window.partitionBy("doc_id", "text_hash")
    upto = (Window.unboundedPreceding, Window.currentRow)
    # a valid match that starts no later and has not ended, or starts later but before the end
    rows = rows.withColumn("_end", F.max(F.expr("if(c.valid, c.end, null)")).over(
        same.orderBy(F.col("c.start")).rangeBetween(*upto)))
    rows = rows.withColumn("_start", F.min(F.expr("if(c.valid, c.start, null)")).over(
        same.orderBy(F.col("c.start").desc()).rangeBetween(*upto)))
    rows = rows.where("NOT c.valid AND coalesce(_end <= c.start, true) AND coalesce(_start >= c.end, true)")
    return rows.select("doc_id", "text_hash", F.expr(_FEATURE_SQL).alias("f"), "c.m").select("doc_id", "text_hash", "f.*")


def _char_class(c: str) -> str:
    return (f"CASE WHEN {c} = '' OR {c} rlike '^[\\\\x20\\\\x09-\\\\x0D]' THEN 0 WHEN {c} rlike '^[0-9]' THEN 3 "
            f"WHEN {c} rlike '^\\\\p{{L}}' THEN 2 ELSE 1 END")


# Spellings are brought to one form before they are measured.
_PLAIN = (r"regexp_replace(regexp_replace(regexp_replace(c.m, "
          r"'(?i)\\x20?[\\(\\[{<]at[\\)\\]}>]\\x20?|\\x20at\\x20', '@'), "
          r"'(?i)\\x20?[\\(\\[{<](dot|\\.)[\\)\\]}>]\\x20?|\\x20(dot|\\.)\\x20', '.'), '^\\+[0-9]{1,3}[\\x20.-]?', '')")
_FEATURE_SQL = f"""named_struct(
  'kind_no', c.kind_no, 'start', c.start, 'end', c.end,
  'size', cast(length({_PLAIN}) AS double),
  'digits', cast(length(regexp_replace({_PLAIN}, '[^0-9]', '')) AS double),
  'groups', cast(size(split({_PLAIN}, '[^0-9]+')) AS double),
  'longest_group', cast(array_max(transform(split({_PLAIN}, '[^0-9]+'), x -> length(x))) AS double),
  'letters', cast(length(regexp_replace({_PLAIN}, '[^A-Za-z]', '')) AS double),
  'dots', cast(length(regexp_replace({_PLAIN}, '[^.]', '')) AS double),
  'hyphens', cast(length(regexp_replace({_PLAIN}, '[^-]', '')) AS double),
  'spaces', cast(length(regexp_replace({_PLAIN}, '[^\\\\x20]', '')) AS double),
  'brackets', cast(length(regexp_replace({_PLAIN}, '[^()]', '')) AS double),
  'distinct_digits', cast(size(array_distinct(split(regexp_replace({_PLAIN}, '[^0-9]', ''), ''))) AS double),
  'guards', cast(length(regexp_replace(c.m, '[^\\\\[\\\\](){{}}<>]', '')) AS double),
  'words', cast(size(split(c.m, '(?i) dot ')) AS double),
  'capitals', cast(length(regexp_replace(c.m, '[^A-Z]', '')) AS double),
  'left_class', cast({_char_class("right(c.left, 1)")} AS double),
  'right_class', cast({_char_class("c.right")} AS double),
  'left_word', cast(CASE
     WHEN {_IS_NUMBER} THEN 5
     WHEN {_IS_PHONE} THEN 1
     WHEN lower(c.left) rlike '(card|visa|pay|karte|tarjeta|carte)' THEN 2
     WHEN lower(c.left) rlike '(mail|contact|kontakt)' THEN 3
     WHEN lower(c.left) rlike '(\\\\bip\\\\b|host|server|login)' THEN 4 ELSE 0 END AS double))"""


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        rows.withColumn("kind_no", F.col("kind_no").cast("double")))


def labelled_table(spark: SparkSession) -> DataFrame:
    """(doc_id, text, kind_no, start, end, label, held): LABELLED with its digits filled in FILLS ways by hash."""
    values = []
    for n, line in enumerate(LABELLED):
        head, left, spelling = line.split("|")
        kind, label = head.split()
        values.append(f"({n}, {KINDS.index(kind)}, {label}.0D, {_quoted(left)}, {_quoted(spelling)})")
    digits = "cast(pmod(xxhash64(n, k, i), 10) AS string)"
    return spark.sql(f"""
        SELECT n * {FILLS} + k AS doc_id, kind_no, label, n % {HELD_OUT} = {HELD_OUT - 1} AS held, length(l) AS start,
               length(l) + length(s) AS end, concat(l, array_join(transform(
                 split(s, ''), (c, i) -> if(c = '#', {digits}, c)), ''), ' please') AS text
        FROM VALUES {', '.join(values)} AS t(n, kind_no, label, l, s), (SELECT explode(sequence(0, {FILLS - 1})) AS k)""")


@lru_cache(maxsize=4)
def train(spark: SparkSession) -> tuple[GBTClassificationModel, list[float]]:
    """The trees and, per kind, the score from which candidates are taken (above 1: none)."""
    table = materialize(labelled_table(spark).coalesce(1), "pii-table")
    spans = unsettled(candidates(table))
    marked = F.broadcast(table.drop("text").withColumnsRenamed({"kind_no": "_kind", "start": "_start", "end": "_end"}))
    is_it = (F.col("kind_no") == F.col("_kind")) & (F.col("start") == F.col("_start")) & (F.col("end") == F.col("_end"))
    sample = spans.join(marked, "doc_id").withColumn("label", F.when(is_it, F.col("label")).otherwise(0.0))
    sample = materialize(sample.coalesce(1), "pii-train")          # FILLS rows a spelling, and what else is proposed there
    model = GBTClassifier(maxIter=10, maxDepth=4, seed=1, labelCol="label").fit(_vectors(sample.where("NOT held")))
    bins = _scored(model, sample.where("held")).groupBy("kind_no", F.floor(F.col("score") * 100).alias("bin")).agg(
        F.sum("label").alias("valid"), F.count(F.lit(1)).alias("n")).collect()       # 100 bins a kind
    return model, [threshold([(b["bin"], b["valid"], b["n"]) for b in bins if b["kind_no"] == k])
                   for k in range(len(KINDS))]


def threshold(bins: list[tuple[int, float, int]]) -> float:
    """Lowest score at which the bins from there up hold PRECISION valid candidates."""
    best, valid, n = 2.0, 0.0, 0
    for b, v, c in sorted(bins, reverse=True):
        valid, n = valid + v, n + c
        if n >= MIN_HELD_OUT and valid >= PRECISION * n:
            best = b / 100
    return best


def _scored(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return model.transform(_vectors(rows)).withColumn("score", vector_to_array("probability")[1])


def judged(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind_no, start, end, score): candidates that the trees take, overlaps settled."""
    model, thresholds = train(found.sparkSession)
    least = F.element_at(F.array(*[F.lit(t) for t in thresholds]), F.col("kind_no").cast("int") + 1)
    taken = _scored(model, unsettled(found)).where(F.col("score") >= least).select(
        "doc_id", "text_hash", F.col("kind_no").cast("int").alias("kind_no"), "start", "end", "score")
    same = Window.partitionBy("doc_id", "text_hash").orderBy("start", "end", "kind_no")
    before = F.max("end").over(same.rowsBetween(Window.unboundedPreceding, -1))
    chains = taken.withColumn("_new", F.when(F.col("start") < before, 0).otherwise(1)).withColumn(
        "_chain", F.sum("_new").over(same.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    best = Window.partitionBy("doc_id", "text_hash", "_chain").orderBy(F.col("score").desc(), "start", "end", "kind_no")
    return chains.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_new", "_chain", "_rank")


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, spans) per row of ``docs``: arrays of (start, kind_no, end)."""
    found = materialize(candidates(docs), "pii")
    base = F.array_sort(F.transform(F.filter("found", lambda c: c["valid"]), lambda c: F.struct(
        c["start"].alias("start"), c["kind_no"].alias("kind_no"), c["end"].alias("end"))))
    rows = found.select("doc_id", "text_hash", base.alias("base"))
    added = judged(found).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "kind_no", "end")).alias("more"))
    added = materialize(added, "pii-added")
    joined = rows.join(added, same_document(rows, added), "left")
    return joined.select(rows["doc_id"], rows["text_hash"], "base", F.when(
        F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more"))).alias("spans"))


def spelled(column: str):
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(column, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind_no"] + 1), x["start"], x["end"])))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets (overlaps by the first)."""
    spans = find(docs).select("doc_id", "text_hash", "spans").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    joined = rows.join(spans.hint("merge"), rows["row.doc_id"].eqNullSafe(spans["doc_id"])
                       & (F.xxhash64(rows["row.text"]) == spans["text_hash"]), "left")
    names = "array('" + "','".join(KINDS) + "')"
    text = F.when(F.size("spans") > 0, F.expr(f"""
        aggregate(spans, named_struct('t', '', 'at', 0), (a, x) -> if(x.start < a.at, a, named_struct(
            't', concat(a.t, substring(row.text, a.at + 1, x.start - a.at), '[', element_at({names}, x.kind_no + 1), ']'),
            'at', x.end)), a -> concat(a.t, substring(row.text, a.at + 1)))""")).otherwise(F.col("row.text"))
    return joined.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
