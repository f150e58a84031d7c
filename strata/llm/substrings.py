"""Removal of repeated passages by hashing normalised units.

A unit is a line, or a piece of a long line: long lines are cut after words whose
hash is the smallest among CONTEXT words on either side, so that a passage is cut the
same way wherever in a line it stands.  Units are lower-cased (A-Z), their white space
made single, and hashed.  Digests are grouped globally; the occurrence ranked first by
(doc_id, hash of the text, unit) stays.  Repeated units that follow one another form a
run; runs of MIN_WORDS words or more are removed, and the spans removed are kept as
offsets (code points) into the original text.

Defined cases: null texts stay null, blank lines are no units and stay; repeated rows
get the same result; shorter repeats stay, however often; an empty table gives an empty
result; other columns are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from strata.llm.common import materialize, text_key
from strata.llm.units import slices

CONTEXT = 4
MIN_WORDS = 12

_ODD = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(r"[^ \t\n\x0b\x0c\r]+")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units per text, words per unit, digest per unit); no text is null."""
    lines = pc.split_pattern(texts, "\n")
    owner = np.repeat(np.arange(len(texts)), np.diff(lines.offsets.to_numpy()))
    flat = pc.ascii_trim_whitespace(pc.ascii_lower(lines.flatten()))
    filled = pc.not_equal(flat, "")
    owner = owner[filled.to_numpy(zero_copy_only=False)]
    lists = pc.ascii_split_whitespace(flat.filter(filled))
    counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    if not len(counts):
        return np.zeros(len(texts), np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    coded = lists.flatten().dictionary_encode()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8")) for w in coded.dictionary.to_pylist()),
                         np.uint64, len(coded.dictionary))
    word = hashes[coded.indices.to_numpy()]
    ends = np.cumsum(counts)
    before = np.arange(len(word)) - np.repeat(ends - counts, counts)     # words of the line before
    after = np.repeat(counts, counts) - before - 1
    cut = (before >= CONTEXT) & (after >= CONTEXT)
    places = np.flatnonzero(cut)
    for d in range(1, CONTEXT + 1):
        places = places[(word[places] < word[places - d]) & (word[places] < word[places + d])]
    starts = np.union1d(ends - counts, places + 1)
    sizes = np.diff(np.append(starts, len(word)))
    order = (np.arange(len(word)) - np.repeat(starts, sizes) + 1).astype(np.uint64)
    digests = _mix(np.add.reduceat(_mix(word + order * _ODD), starts) + sizes.astype(np.uint64))
    line = np.searchsorted(ends, starts, side="right")
    return np.bincount(owner[line], minlength=len(texts)), sizes, digests


def _unit_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, unit, digest): a row per unit."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for texts in slices(batch.column(2)):
                n, _, digests = units(texts)
                at = pa.array(np.repeat(np.arange(row, row + len(texts)), n))
                unit = np.arange(len(digests)) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(unit.astype(np.int32)),
                     pa.array(digests.view(np.int64))], names=["doc_id", "text_hash", "unit", "digest"])
                row += len(texts)

    return docs.select("doc_id", text_key().alias("text_hash"), "text").mapInArrow(
        rows, "doc_id bigint, text_hash bigint, unit int, digest bigint")


def repeated_units(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, units): the units with an equal one ranked before."""
    found = materialize(_unit_rows(docs), "units")
    place = F.struct("doc_id", "text_hash", "unit")
    first = materialize(found.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                        .where("NOT (first <=> last)").select("digest", "first"), "first")
    later = found.join(first, "digest").where(place > F.col("first"))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set("unit").alias("units"))


def removed_spans(text: str, sizes: list[int], repeated: set[int]) -> list[tuple[int, int]]:
    """Spans of runs of repeated units of MIN_WORDS words or more, with the blanks after
    them, and with the line end where a whole line goes."""
    spans, word = [], 0
    words = [m.span() for m in _WORD.finditer(text)]
    run = None
    for k, n in enumerate([*sizes, 0]):
        if k in repeated and k < len(sizes):
            run = word if run is None else run
        elif run is not None:
            if word - run >= MIN_WORDS:
                a, b = words[run][0], words[word - 1][1]
                while b < len(text) and text[b] in " \t":
                    b += 1
                if (a == 0 or text[a - 1] == "\n") and text[b:b + 1] == "\n":
                    b += 1
                spans.append((a, b))
            run = None
        word += n
    return spans


_SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
_REMOVAL = StructType([StructField("text", StringType()), StructField("spans", ArrayType(_SPAN)),
                       StructField("n_units", LongType()), StructField("n_removed_chars", LongType())])


@F.arrow_udf(_REMOVAL)
def _remove(texts: pa.Array, repeated: pa.Array) -> pa.Array:
    out, row = [], 0
    for run in slices(texts):
        n, sizes, _ = units(run)
        ends = np.cumsum(n)
        for k, text in enumerate(run.to_pylist()):
            gone = repeated[row].as_py()
            spans = removed_spans(text, sizes[ends[k] - n[k]:ends[k]].tolist(), set(gone)) if gone else []
            kept, at = [], 0
            for a, b in spans:
                kept.append(text[at:a])
                at = b
            kept.append(text[at:])
            whole = None if not texts[row].is_valid else "".join(kept)
            out.append({"text": whole, "spans": [{"start": a, "end": b} for a, b in spans], "n_units": int(n[k]),
                        "n_removed_chars": sum(b - a for a, b in spans)})
            row += 1
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    return pa.array(out, pa.struct([("text", pa.string()), ("spans", pa.list_(span)), ("n_units", pa.int64()),
                                    ("n_removed_chars", pa.int64())]))


def remove_repeated_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` without later repeats, plus _spans, _n_units, _n_removed_chars."""
    gone = materialize(repeated_units(docs), "repeated").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("units").alias("_units"))
    gone = gone.hint("merge")                   # it grows with the documents
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_hash"]), "left")
    done = joined.withColumn("_r", _remove("text", "_units"))
    return done.withColumns({"text": F.col("_r.text"), "_spans": F.col("_r.spans"), "_n_units": F.col("_r.n_units"),
                             "_n_removed_chars": F.col("_r.n_removed_chars")}).drop("_r", "_id", "_hash", "_units")
