"""Near-duplicate documents by HyperMinHash.

Every text becomes the set of its distinct 5-word shingles (64-bit hashes).  Texts
with equal sets form a class, and only classes are compared, by a number (the 128-bit
digest of the set tells them apart and finds their rows again at the end):

1. Sketch: the hash range is cut into REGISTERS parts; a register holds, for the
   smallest hash of its part, the count of leading zeros and MANTISSA bits after them.
   Empty registers borrow from others in a fixed random order.
2. Bands of registers are hashed to buckets.  In each bucket the member that meets
   most others is the centre, and the others are paired with it alone.
3. Pairs whose sizes and collision-corrected Jaccard estimate allow the threshold are
   confirmed on the full sets; confirmed links give components.
4. Buckets whose members are not all in one component go on.  Members of small ones are
   paired across components.  Members of large ones are compared by the rarest shingles
   of their full sets instead, in order of frequency: where sets reach the threshold, one
   of the first n - ceil(t n) + 1 shingles of the larger is among the first
   m - ceil(2 t m / (1 + t)) + 1 of the smaller (t is the threshold).  So texts that only share a common passage
   no longer meet, and no pair is lost.  CENTRES members of each such shingle, from its
   smallest components, are paired with the members of other components, settled and left
   out, until nothing is left to compare.  No step makes more than CENTRES rows a member.

The threshold is the least Jaccard similarity in percent; it sets the bands, the bounds
on sizes and estimates, and the prefixes.

Defined cases: null and wordless texts have an empty set, are linked with nothing and
keep their own id; with fewer than 5 words the whole sequence is the one shingle;
repeated rows are one class (a null id counts after all others); an empty table gives
an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from strata.llm import common
from strata.llm.common import text_key
from strata.llm.units import slices

SHINGLE = 5
MIN_PERCENT = 85
REGISTERS = 144
MISSED = 2e-5           # share of pairs at the threshold that may meet in no band
MANTISSA = 10
SIGMAS = 5              # estimates this far below the threshold are still confirmed
SMALL_BUCKET = 8        # members up to which a bucket's pairs are listed
CENTRES = 64
BATCH_ROWS = 1000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BORROW = np.random.RandomState(7).rand(REGISTERS, REGISTERS).argsort(axis=1)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Rows hold texts or two full sets: BATCH_ROWS of them go to a worker at once."""
    return common.materialize(df, name, arrow_rows=BATCH_ROWS)


def bands(percent: int) -> tuple[int, int]:
    """(registers a band, bands): the widest bands by which at most MISSED of the pairs at
    ``percent`` are missed, single registers where none does."""
    for band in range(12, 1, -1):
        if (1 - (percent / 100) ** band) ** (REGISTERS // band) <= MISSED:
            return band, REGISTERS // band
    return 1, REGISTERS


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text (no nulls)."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    lists = pc.ascii_split_whitespace(trimmed)
    coded = lists.flatten().dictionary_encode()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8")) for w in coded.dictionary.to_pylist()),
                         np.uint64, len(coded.dictionary))
    words = hashes[coded.indices.to_numpy()]
    ends = lists.offsets.to_numpy()
    rolled = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        rolled = rolled * _ODD + words[k:len(words) - SHINGLE + 1 + k]
    rolled = _mix(rolled + np.uint64(SHINGLE))
    blank = pc.equal(trimmed, "").to_pylist()
    sets = []
    for k in range(len(texts)):
        a, b = ends[k], ends[k + 1]
        if blank[k]:
            sets.append(np.zeros(0, np.uint64))
        elif b - a >= SHINGLE:
            sets.append(np.unique(rolled[a:b - SHINGLE + 1]))
        else:
            whole = np.zeros(1, np.uint64)
            for w in words[a:b]:
                whole = whole * _ODD + w
            sets.append(_mix(whole + np.uint64(b - a)))
    return sets


def registers(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (uint16) of a sorted non-empty set."""
    spread = (shingles >> np.uint64(32)) * np.uint64(REGISTERS)
    part = (spread >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(part, prepend=-1))
    low = (spread[first] & np.uint64(0xFFFFFFFF)).astype(np.float64) + 0.5
    mantissa, exponent = np.frexp(low)                       # low = mantissa * 2^exponent, mantissa in [0.5, 1)
    zeros = np.minimum(32 - exponent, 31)
    held = (zeros << MANTISSA) + ((mantissa * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    out = np.full(REGISTERS, -1, np.int64)
    out[part[first]] = held
    if len(first) < REGISTERS:
        empty = np.flatnonzero(out < 0)
        order = _BORROW[empty]
        out[empty] = out[order[np.arange(len(empty)), (out[order] >= 0).argmax(axis=1)]]
    return out.astype("<u2")


def chance_collision(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of two sets of n and m other elements agree by chance:
    over the leading-zero classes, cell width times the density of both minima."""
    a, b = n / REGISTERS, m / REGISTERS
    zeros = np.arange(32)[:, None]
    upper, lower = 2.0 ** -zeros, 2.0 ** -(zeros + 1)
    both = a + b
    cell = 2.0 ** -(zeros + 1 + MANTISSA)
    return np.minimum(0.5, (cell * a * b / both * (np.exp(-both * lower) - np.exp(-both * upper))).sum(axis=0))


def estimate(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers, corrected for chance collisions."""
    agree = (left == right).mean(axis=1)
    c = chance_collision(n, m)
    return np.clip((agree - c) / (1 - c), 0, 1)


@F.arrow_udf(DoubleType())
def _estimate(left: pa.Array, right: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
    rows = [np.frombuffer(b"".join(x.to_pylist()), "<u2").reshape(-1, REGISTERS) for x in (left, right)]
    sizes = [x.to_numpy(zero_copy_only=False).astype(float) for x in (n, m)]
    return pa.array(estimate(*rows, *sizes))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, digest, registers) per row; digest is a 128-bit one of
    the set, null with the registers for empty sets."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for texts in slices(batch.column(2)):
                sets = shingle_sets(texts)
                digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                regs = [registers(s).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(texts)), batch.column(1).slice(row, len(texts)),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(regs, pa.binary())],
                    names=["doc_id", "text_hash", "n_shingles", "digest", "registers"])
                row += len(texts)

    return docs.select("doc_id", text_key().alias("text_hash"), "text").mapInArrow(
        sketch, "doc_id bigint, text_hash bigint, n_shingles bigint, digest binary, registers binary")


def _full_sets(docs: DataFrame, wanted: DataFrame, repeated: bool) -> DataFrame:
    """(node, shingles, n_shingles, registers) of the wanted (node, doc_id, text_hash) rows, from
    the texts; ``repeated`` tells that rows of ``docs`` may be equal in both."""
    keys = wanted.select("node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).hint("merge")
    texts = docs.select("doc_id", text_key().alias("text_hash"), "text")
    found = texts.join(keys, texts["doc_id"].eqNullSafe(keys["_id"]) & (texts["text_hash"] == keys["_hash"])).select(
        "node", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for texts in slices(batch.column(1)):
                sets = shingle_sets(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(texts)),
                     pa.ListArray.from_arrays(np.cumsum([0, *map(len, sets)]).astype(np.int32),
                                              np.concatenate(sets).view(np.int64)),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([registers(s).tobytes() for s in sets], pa.binary())],
                    names=["node", "shingles", "n_shingles", "registers"])
                row += len(texts)

    sets = found.mapInArrow(build, "node bigint, shingles array<bigint>, n_shingles bigint, registers binary")
    return sets.dropDuplicates(["node"]) if repeated else sets


@F.arrow_udf(LongType())
def _shared(left: pa.Array, right: pa.Array) -> pa.Array:
    """Size of the intersection of two sorted sets."""
    (x, i), (y, j) = ((s.values.to_numpy(zero_copy_only=False), s.offsets.to_numpy()) for s in (left, right))
    return pa.array([len(np.intersect1d(x[a:b], y[c:d], assume_unique=True))
                     for a, b, c, d in zip(i[:-1], i[1:], j[:-1], j[1:])], pa.int64())


def confirm(pairs: DataFrame, sets: DataFrame, percent: int, many: bool = False) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets reach ``percent``.  ``many``: the pairs grow
    with the documents, so they are joined by shuffles whatever their number here.  Otherwise
    either side finds its sets by itself: few pairs are sent to all sets, which stay in place."""
    join = (lambda df: df.hint("merge")) if many else (lambda df: df)

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("registers").alias(f"r{name}"),
                           F.col("n_shingles").alias(f"n{name}"))

    def full(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("shingles").alias(f"s{name}"))

    least = percent / 100
    n, m = F.col("na"), F.col("nb")
    close = pairs.join(join(side("a")), "a").join(join(side("b")), "b").where(
        100 * F.least(n, m) >= percent * F.greatest(n, m))
    slack = SIGMAS * F.sqrt(F.lit(least * (1 - least)) / F.least(n, m, F.lit(REGISTERS)))
    close = close.where(_estimate("ra", "rb", "na", "nb") >= least - slack).select("a", "b", "na", "nb")
    close = materialize(close, "pairs")
    if many:
        both = close.join(join(full("a")), "a").join(join(full("b")), "b")
    else:
        both = close.join(full("a"), "a").join(close.select("a", "b").join(full("b"), "b"), ["a", "b"])
    shared = both.select("a", "b", "na", "nb", _shared("sa", "sb").alias("s"))
    return materialize(shared.where(100 * F.col("s") >= percent * (n + m - F.col("s"))).select("a", "b"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links reach, by rounds of taking the
    smallest label of the neighbours and then the label of that label."""
    both = links.select("a", "b").union(links.select("b", "a"))
    labels = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("component")), "labels").select(
        F.col("a").alias("node"), "component")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(
            F.min("component").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("mid"))
        over = labels.select(F.col("node").alias("mid"), F.col("component").alias("jump"))
        labels = materialize(step.join(over, "mid").select(
            "node", "old", F.least("mid", "jump").alias("component")), "labels")
        if labels.where("old != component").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component")


def band_keys(nodes: DataFrame, percent: int) -> DataFrame:
    """(node, key) for every band of every class."""
    band, count = bands(percent)
    size = 2 * band
    return nodes.select("node", F.explode(F.expr(
        f"transform(sequence(0, {count - 1}), b -> xxhash64(b, substring(registers, {size} * b + 1, {size})))")
    ).alias("key"))


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (key, node, weight) with their component, in buckets that have several."""
    known = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = materialize(known.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("members"))
        .where("lo != hi").select("key", "members"), "mixed")
    return known.join(mixed, "key")


def _rarest_shingles(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, node, weight, n, v, first): the shingles of each node's set among which one is shared with
    every set that reaches the threshold, in order of their frequency in these sets.
    Shingles of one set alone count for the order but are no key; v of the n are in
    others too, ``rest`` from this one on.  ``first`` marks those that count for the smaller set."""
    tokens = materialize(sets.join(nodes, "node").select(
        "node", "weight", F.size("shingles").alias("n"), F.explode("shingles").alias("key")), "shingles")
    common = materialize(tokens.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "frequencies")
    tokens = tokens.join(common, "key")
    by_node = Window.partitionBy("node")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.col("v"))
    ranked = tokens.withColumn("v", F.count(F.lit(1)).over(by_node)).withColumn("prefix", prefix).withColumn(
        "rank", F.row_number().over(by_node.orderBy("df", "key")))
    first = F.col("v") - F.ceil(F.col("n") * (2 * percent) / (100 + percent)) + 1
    keys = materialize(ranked.where("rank <= prefix").select(
        "key", "node", "weight", "n", "v", (F.col("v") - F.col("rank") + 1).alias("rest"),
        (F.col("rank") <= first).alias("first")), "keys")
    # members that reach the threshold with no other of their bucket, whatever it is
    bounds = keys.groupBy("key").agg(F.min("n").alias("n_least"), F.max("v").alias("v_most"),
                                     F.min(F.when(F.col("first"), F.col("n"))).alias("first_least"))
    return keys.join(materialize(bounds, "bounds"), "key").where(
        _may_reach("n", "v", "n_least", "v_most", percent) & (F.col("first") | (F.col("first_least") <= F.col("n")))).drop(
        "n_least", "v_most", "first_least")


def _may_reach(n: str, v: str, m: str, w: str, percent: int):
    """Whether sets of n and m shingles, v and w of them shared with any set, can reach ``percent``."""
    return (100 + percent) * F.least(v, w) >= percent * (F.col(n) + F.col(m))


def near_duplicates(docs: DataFrame, percent: int = MIN_PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash) per row of ``docs``; texts of
    similarity ``percent`` or more are linked."""
    component = F.when(F.col("n_shingles") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id"))
    return (_grouped(docs, percent).withColumn("component_id", component)
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select("doc_id", "n_shingles", "component_id", "kept", "text_hash"))


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, first) per row of ``docs``; ``first`` is the smallest
    (doc_id is null, doc_id, text_hash) of the row's component, null without words."""
    rows = materialize(sketches(docs), "sketches")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    classes = materialize(rows.where("n_shingles > 0").groupBy("digest").agg(
        F.min(first).alias("first"), F.first("registers").alias("registers"))
        .select(F.monotonically_increasing_id().alias("node"), "digest", "first.doc_id", "first.text_hash", "registers"), "classes")

    banded = band_keys(classes, percent)
    shared = materialize(banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    met = banded.join(shared.hint("merge"), "key").select("key", "node", "n")           # it grows with the documents
    weight = F.sum("n").over(Window.partitionBy("node"))                                # bounded: the bands of a class
    members = materialize(met.select("key", "node", weight.alias("weight")), "members")
    repeated = not rows.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty()
    sets = materialize(_full_sets(docs, classes.join(members, "node", "left_semi"), repeated), "sets")

    centre = members.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("c")).select(
        "key", F.col("c.node").alias("a"))
    links = confirm(members.join(centre, "key").where("a != node").select("a", F.col("node").alias("b")).distinct(),
                    sets, percent, many=True)
    labels = components(links)

    left = materialize(_unsettled(members, labels), "left")
    small = left.where(F.col("members") <= SMALL_BUCKET).select("key", "node", "component")
    listed = small.alias("x").join(small.alias("y"), "key").where(
        "x.node < y.node AND x.component != y.component").selectExpr("x.node AS a", "y.node AS b")
    large = materialize(left.where(F.col("members") > SMALL_BUCKET).select("node", "weight").distinct(), "large")
    left = materialize(_unsettled(_rarest_shingles(large, sets, percent), labels), "left")
    while listed is not None or not left.isEmpty():
        # the largest component of a bucket comes last: without the others nothing is left.
        # A pair is made where this may be its first shingle in common: then the overlap is
        # at most what follows in either set, and the smaller set has it among its first.
        share = left.groupBy("key", "component").agg(F.count(F.lit(1)).alias("share"))
        rank = F.row_number().over(Window.partitionBy("key").orderBy("share", F.desc("weight"), "node"))
        chosen = materialize(left.join(share, ["key", "component"]).withColumn("rank", rank).where(F.col("rank") <= CENTRES).select(
            "key", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("rest").alias("ra"),
            F.col("first").alias("fa")), "chosen")
        smaller_first = F.when(F.struct("n", "node") < F.struct("na", "a"), F.col("first")).otherwise(F.col("fa"))
        pairs = left.join(chosen, "key").where(
            (F.col("ca") != F.col("component")) & smaller_first & _may_reach("n", "rest", "na", "ra", percent))
        pairs = pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
        if listed is not None:      # the pairs of small buckets are confirmed with the first of large ones
            pairs, listed = pairs.union(listed), None
        new = confirm(pairs.distinct(), sets, percent)
        if not new.isEmpty():
            links = links.union(new)
            labels = components(links)
        rest = left.join(chosen.select("key", F.col("a").alias("node")), ["key", "node"], "left_anti")
        left = materialize(_unsettled(rest.select("key", "node", "weight", "n", "v", "rest", "first"), labels), "left")

    named = classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = materialize(named.select("digest", first.alias("first"), "component"), "named")
    smallest = named.groupBy("component").agg(F.min("first").alias("first"))
    firsts = materialize(named.select("digest", "component").join(smallest, "component").select("digest", "first"), "firsts")
    return rows.drop("registers").join(firsts.withColumnRenamed("digest", "_digest"), F.col("digest") == F.col("_digest"),
                                       "left").select("doc_id", "text_hash", "n_shingles", "first")


def keep_first(docs: DataFrame, percent: int = MIN_PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates; rows without words stay.

    Of repeated rows (equal doc_id and text) one stays."""
    grouped = materialize(_grouped(docs, percent), "grouped")
    kept = (F.col("n_shingles") == 0) | (F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
                                         & (F.col("text_hash") == F.col("first.text_hash")))
    gone = grouped.where(~kept).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    gone = materialize(gone.distinct(), "gone").hint("merge")     # it grows with the documents
    left = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_hash"]),
                     "left_anti")
    twice = grouped.where(kept & (F.col("n_shingles") > 0)).groupBy("doc_id", "text_hash").count().where("count > 1")
    if twice.isEmpty():
        return left
    has_words = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return left.where(has_words).dropDuplicates(["doc_id", "text"]).unionByName(left.where(~has_words))
