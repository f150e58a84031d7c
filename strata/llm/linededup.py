"""Removal of repeated runs of lines, found by winnowing.

Units are the lines with a word, hashed.  In each window of RUN consecutive units the
smallest hash (the last of equal ones) is selected, so every run of RUN units or more
that occurs twice has a selected fingerprint in common.  Fingerprints that occur once
go; the windows around the others are matched by a 128-bit hash of their RUN units,
and the match extends both ways as the neighbouring windows match too.  Of equal
windows the earliest by (doc_id, hash of the text, line) stays; the lines of all later
ones go, so a maximal repeated run goes whole and each line keeps a first copy.

Everything is DataFrame functions.  Keys met often are counted and minimised with
partial aggregates and written, then joined as one row per key against many, which
Spark splits when skewed.

Defined cases: a null text stays null, an empty one empty; blank lines are never
removed and do not interrupt a run; documents of fewer than RUN lines stay as they are;
repeated rows (same doc_id and text) get the same result; runs that overlap themselves
leave their first period; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize, text_key

RUN = 3
LINE_WITH_WORD = r"[^\\x20\\x09-\\x0D]"

_LINES = r"split(text, '\n', -1)"


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fingerprint, windows): a row per selected unit of a document,
    with the windows that select it as (unit, h1, h2)."""
    units = docs.select("doc_id", text_key().alias("text_hash"), "text").selectExpr(
        "doc_id", "text_hash",
        f"transform(filter({_LINES}, l -> l rlike '{LINE_WITH_WORD}'), l -> xxhash64(l)) AS h")
    windows = units.selectExpr("doc_id", "text_hash", "h", f"""
        transform(if(size(h) >= {RUN}, sequence(0, size(h) - {RUN}), array()), s -> named_struct(
          'unit', s,
          'h1', xxhash64(slice(h, s + 1, {RUN})),
          'h2', xxhash64(1, slice(h, s + 1, {RUN})),
          'at', s + {RUN} - cast(array_position(reverse(slice(h, s + 1, {RUN})),
                                                array_min(slice(h, s + 1, {RUN}))) AS int))) AS w""")
    selected = windows.selectExpr("doc_id", "text_hash", """
        explode(transform(array_distinct(transform(w, x -> x.at)), a -> named_struct(
          'fingerprint', h[a],
          'windows', transform(filter(slice(w, greatest(a - %d, 0) + 1, %d), x -> x.at = a),
                               x -> named_struct('unit', x.unit, 'h1', x.h1, 'h2', x.h2))))) AS f""" % (RUN - 1, RUN))
    return selected.select("doc_id", "text_hash", "f.fingerprint", "f.windows")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, units): first units of all windows with an earlier equal."""
    found = materialize(fingerprints(docs), "fingerprints")
    often = materialize(found.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                        .select("fingerprint"), "often")
    windows = found.join(often, "fingerprint", "left_semi").select(
        "doc_id", "text_hash", F.explode("windows").alias("w")).select("doc_id", "text_hash", "w.*")
    windows = materialize(windows, "windows")
    place = F.struct("doc_id", "text_hash", "unit")
    first = materialize(windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                        .where("NOT (first <=> last)").select("h1", "h2", "first"), "first")
    later = windows.join(first, ["h1", "h2"]).where(place > F.col("first"))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set("unit").alias("units"))


def remove_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` without later repeated runs, plus _n_lines (lines with a
    word before) and _n_removed."""
    gone = materialize(repeated_windows(docs), "repeated")
    keyed = docs.withColumn("_text_hash", text_key())
    gone = gone.select(F.col("doc_id").alias("_gone_id"), F.col("text_hash").alias("_gone_hash"),
                       F.col("units").alias("_units")).hint("merge")   # it grows with the documents
    joined = keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["_gone_id"])
                        & (keyed["_text_hash"] == gone["_gone_hash"]), "left")
    lines = joined.withColumn("_lines", F.expr(_LINES))
    placed = lines.withColumn("_at", F.expr(f"""
        filter(transform(_lines, (l, i) -> if(l rlike '{LINE_WITH_WORD}', i, null)), i -> i is not null)"""))
    placed = placed.withColumn("_cut", F.expr(f"""
        array_distinct(flatten(transform(_units, u -> slice(_at, u + 1, {RUN}))))"""))
    kept = placed.withColumn("text", F.expr(r"""
        CASE WHEN _units IS NULL THEN text ELSE array_join(
          transform(array_except(sequence(0, size(_lines) - 1), _cut), i -> _lines[i]), '\n') END"""))
    return kept.withColumns({
        "_n_lines": F.coalesce(F.size("_at"), F.lit(0)).cast("bigint"),
        "_n_removed": F.when(F.col("_units").isNull(), 0).otherwise(F.size("_cut")).cast("bigint"),
    }).drop("_text_hash", "_gone_id", "_gone_hash", "_units", "_lines", "_at", "_cut")


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with shortened texts (and ``n_chars`` to match, where there is one);
    documents that lost all their lines go."""
    out = remove_repeated_lines(docs).where("_n_removed = 0 OR _n_removed < _n_lines")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_n_removed") > 0, F.length("text").cast("bigint"))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
