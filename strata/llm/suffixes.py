"""Removal of repeated byte strings by merged Burrows-Wheeler transforms.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else as well.
The suffixes are never sorted as wholes, nor all together:

1. Stretches.  Each string of ``length`` bytes picks an anchor inside it, the last least
   one of its hashed grams; strings with one anchor stand side by side and form a
   stretch.  Equal strings pick equal anchors at equal distance, so they stand in
   stretches of one key (the hash of the anchor's gram), lined up at the anchor.
2. Shards.  A key found once is done with, and where all stretches of a key are the same
   they are repeats as they stand.  Of the others, those that are the same as a whole are
   one from here on, with a count.  The different stretches of a key form a shard of a pool, several if they are many.
3. Merge.  The transforms of all stretches of a pool are merged by refining their
   interleave: from the last column to the first, the order of the suffixes one byte
   further left is the order so far, dealt stably by the byte before each suffix.  The
   common prefix of neighbours grows with it: one more than the least of those between
   them before if the bytes are equal, else nothing.  No suffix is compared or sorted anew.
4. Intervals.  Neighbours with ``length`` bytes or more in common are repeats.  Where a
   key has several shards, each shard hands on one string of every interval by its
   digest (128 bits), and those found in two shards are repeats as well.

Memory: a scan holds BLOCK bytes of texts at eight bytes each, a pool POOL stretches of
less than twice ``length`` bytes; a group of copies is a count.  A document's repeats are
collected by document.

Defined cases: null and empty texts, and texts shorter than ``length``, keep all bytes (a
null text has none); a very long text is cut into blocks that overlap by ``length`` - 1
bytes; ties between anchors go to the later one; repeated rows are repeats of each other;
rows equal in doc_id and text get one result; an empty table gives an empty result; other
columns are carried along, except for those named as the results, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from strata.llm.common import materialize, text_key
from strata.llm.units import slices

LENGTH = 200
GRAM = 32                  # bytes of an anchor, a power of two
BLOCK = 1 << 20            # bytes of a text handled at a time
POOL = 32_768              # stretches of a pool

_PLACE = np.uint64((1 << 22) - 1)         # a place in a block, in the lower bits of a hash
_BASE = 0x9E3779B97F4A7C15
_KEY = ["key", "x1", "x2"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64))


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place on."""
    h, size, base = _BYTE[data], 1, _BASE
    while size < gram:
        h = h[:-size] * np.uint64(base) + h[size:]
        size, base = 2 * size, base * base % (1 << 64)
    return _mix(h)


def _least(v: np.ndarray, width: int) -> np.ndarray:
    """Least of the ``width`` values from each place on."""
    size = 1
    while 2 * size <= width:
        v, size = np.minimum(v[:-size], v[size:]), 2 * size
    return np.minimum(v[:len(v) - (width - size)], v[width - size:]) if size < width else v


def stretches(data: np.ndarray, bounds: np.ndarray, length: int, gram: int, block: int):
    """(text, first, last, anchor, key) of the stretches of the texts that ``bounds`` cuts
    ``data`` into: ``first`` to ``last`` are the starts of its strings, all places in
    ``data``; the key is the hash of the anchor's gram."""
    out = []
    for at in range(0, len(data), block):
        part = data[at:at + block + length - 1]
        if len(part) < length:
            break
        h = _grams(part, gram)
        place = np.arange(len(h), dtype=np.uint64)
        least = _least((h & ~_PLACE) | (_PLACE - place), length - gram + 1)
        anchor = (_PLACE - (least & _PLACE)).astype(np.int64)
        edge = np.zeros(len(anchor) + 1, np.int64)          # starts of strings inside one text
        np.add.at(edge, np.clip(bounds[:-1] - at, 0, len(anchor)), 1)
        np.add.at(edge, np.clip(np.maximum(bounds[1:] - length + 1, bounds[:-1]) - at, 0, len(anchor)), -1)
        inside = np.cumsum(edge[:-1]) > 0
        first = inside.copy()
        first[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
        last = inside.copy()
        last[:-1] &= ~inside[1:] | (anchor[1:] != anchor[:-1])
        a, b = np.flatnonzero(first), np.flatnonzero(last)
        out.append((a + at, b + at, anchor[a] + at, h[anchor[a]]))
    if not out:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    first, last, anchor, key = (np.concatenate(x) for x in zip(*out))
    return np.searchsorted(bounds, first, side="right") - 1, first, last, anchor, key


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, their bounds); no text is null."""
    raw = pa.concat_arrays([texts.cast(pa.binary())])
    bounds = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + len(raw) + 1].astype(np.int64)
    data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def _digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128-bit digests of parts of ``data``, two numbers each."""
    raw = memoryview(data)
    joined = b"".join(xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist()))
    return np.frombuffer(joined, "<i8").reshape(-1, 2)


def stretch_rows(docs: DataFrame, length: int, gram: int, block: int) -> DataFrame:
    """A row per stretch: its document, the starts of its strings, its anchor (bytes from the
    start of the text), its key and the digest (x1, x2) of all its bytes."""
    names = ["doc_id", "text_hash", "first", "last", "anchor", *_KEY]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for texts in slices(batch.column(2)):
                data, bounds = _flat(texts)
                text, first, last, anchor, key = stretches(data, bounds, length, gram, block)
                x = _digests(data, first, last + length)
                at, start = pa.array(text + row), bounds[text]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at),
                     *(pa.array(v - start) for v in (first, last, anchor)), pa.array(key.view(np.int64)),
                     pa.array(x[:, 0]), pa.array(x[:, 1])], names=names)
                row += len(texts)

    return docs.select("doc_id", text_key().alias("text_hash"), "text").mapInArrow(
        rows, ", ".join(f"{n} bigint" for n in names))


def merged_repeats(columns: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """From the last column to the first: (column, order of the suffixes that start there,
    ``length`` or the common prefix of each with the one before it, whichever is less).

    ``columns`` has a row per column of the lined-up stretches, with 0 where a stretch has
    no byte and the byte + 1 elsewhere."""
    n = columns.shape[1]
    order, common = np.arange(n), np.zeros(n, np.uint16)
    for c in range(len(columns) - 1, -1, -1):
        byte = columns[c, order]
        deal = np.argsort(byte, kind="stable")
        tables = [common]                # least of the 1, 2, 4, ... values from each place on
        while 2 << (len(tables) - 1) <= n:
            half = 1 << (len(tables) - 1)
            tables.append(np.minimum(tables[-1][:-half], tables[-1][half:]))
        low, high = deal[:-1] + 1, deal[1:] + 1
        same = np.flatnonzero((byte[deal[1:]] == byte[deal[:-1]]) & (byte[deal[1:]] > 0))
        low, high = low[same], high[same]
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        least = np.zeros(len(same), np.uint16)
        for k in np.unique(level).tolist():
            of = np.flatnonzero(level == k)
            least[of] = np.minimum(tables[k][low[of]], tables[k][high[of] - (1 << k)])
        common = np.zeros(n, np.uint16)
        common[same + 1] = np.minimum(least + 1, length)
        order = order[deal]
        yield c, order, common


def pool_repeats(pool: list[dict], length: int, gram: int) -> Iterator[tuple]:
    """Rows (key, x1, x2, low, high, w1, w2) of a pool of different stretches: distances from
    string to anchor whose strings are repeats, and, for shards of a key that has more, one
    string of each interval with its digest (w1, w2) at the distance low = high."""
    before = length - gram                                   # columns before the anchor
    columns = np.zeros((before + length, len(pool)), np.uint16)
    for i, r in enumerate(pool):
        text = np.frombuffer(r["text"], np.uint8)
        columns[before - r["high"]:before - r["high"] + len(text), i] = text.astype(np.uint16) + 1
    low, high = (np.array([r[c] for r in pool]) for c in ("low", "high"))
    many = np.array([r["shards"] > 1 for r in pool])
    found = np.zeros((before + 1, len(pool)), bool)
    for c, order, common in merged_repeats(columns, length):
        far = before - c
        if far < 0:
            continue
        equal = common >= length
        again = equal.copy()
        again[:-1] |= equal[1:]
        found[far, order[again]] = True
        for i in order[~equal & many[order]].tolist():       # the first of each interval
            if low[i] <= far <= high[i]:
                start = high[i] - far
                w = _digests(np.frombuffer(pool[i]["text"], np.uint8), np.array([start]), np.array([start + length]))[0]
                yield *(pool[i][k] for k in _KEY), far, far, int(w[0]), int(w[1])
    for i, r in enumerate(pool):
        if r["n"] > 1:                                       # a repeat as a whole
            continue
        hit = np.flatnonzero(np.diff(np.concatenate([[0], found[low[i]:high[i] + 1, i], [0]])))
        for a, b in hit.reshape(-1, 2).tolist():
            yield *(r[k] for k in _KEY), int(low[i]) + a, int(low[i]) + b - 1, None, None


_PART = ("key bigint, shard bigint, x1 bigint, x2 bigint, n bigint, shards bigint, low bigint, high bigint, "
         "text binary")


def _parts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows of _PART: the bytes of the stretches asked for of each text."""
    names = [x.split()[0] for x in _PART.split(", ")]
    for batch in batches:
        for text, wanted in zip(batch.column(0).cast(pa.binary()), batch.column(1)):
            data, w = text.as_py(), wanted.values.flatten()
            key, x1, x2, n, shards, first, last, anchor = (x.to_numpy() for x in w)
            part = [data[a:b] for a, b in zip(first.tolist(), (last + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, (key, x1 % shards, x1, x2, n, shards, anchor - last, anchor - first)), pa.array(part, pa.binary())],
                names=names)


def repeated_stretches(docs: DataFrame, found: DataFrame, length: int, gram: int, pool: int) -> DataFrame:
    """(key, x1, x2, low, high): strings of the stretches ``found`` that are repeats, by
    their distance to the anchor; ``found`` has the keys of different stretches only."""
    place = F.struct("doc_id", "text_hash", "first", "last", "anchor")
    kinds = materialize(found.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("at")), "stretch-kinds")
    whole = kinds.where("n > 1").select(*_KEY, (F.col("at.anchor") - F.col("at.last")).alias("low"),
                                        (F.col("at.anchor") - F.col("at.first")).alias("high"))
    shards = kinds.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(pool)).alias("shards"))
    mixed = kinds.join(shards, "key")
    wanted = mixed.groupBy(F.col("at.doc_id").alias("_id"), F.col("at.text_hash").alias("_hash")).agg(
        F.collect_list(F.struct(*_KEY, "n", "shards", "at.first", "at.last", "at.anchor")).alias("_wanted"))
    texts = docs.select("doc_id", text_key().alias("text_hash"), "text")
    asked = texts.join(wanted.hint("merge"), texts["doc_id"].eqNullSafe(F.col("_id")) & (texts["text_hash"] == F.col("_hash")))
    parts = (asked.select("text", "_wanted").mapInArrow(lambda batches: _parts(batches, length), _PART)
             .repartition("key", "shard").sortWithinPartitions("key", "shard", "x1", "x2"))

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(of: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in pool_repeats(of, length, gram)], schema)

        schema = pa.schema([(n, pa.int64()) for n in [*_KEY, "low", "high", "w1", "w2"]])
        held, shard, last = [], 0, None
        for batch in batches:
            for r in batch.to_pylist():
                if (r["key"], r["x1"], r["x2"]) == last:      # from rows equal in doc_id and text
                    continue
                if held and (r["key"], r["shard"]) != (held[-1]["key"], held[-1]["shard"]):
                    shard = len(held)
                if shard and len(held) >= pool:               # whole shards, as many as fit
                    yield rows(held[:shard])
                    held, shard = held[shard:], 0
                held.append(r)
                last = r["key"], r["x1"], r["x2"]
        if held:
            yield rows(held)

    merged = materialize(parts.mapInArrow(refine, ", ".join(f"{n} bigint" for n in [*_KEY, "low", "high", "w1", "w2"])), "merged")
    window = ["key", "low", "w1", "w2"]
    handed = merged.where("w1 IS NOT NULL")
    across = handed.join(handed.groupBy(*window).count().where("count > 1").drop("count"), window)
    found_in = ["low", "high"]
    return (whole.unionByName(merged.where("w1 IS NULL").select(*_KEY, *found_in))
            .unionByName(across.select(*_KEY, *found_in)))


_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
_REMOVAL = StructType([StructField("kept", BinaryType()), StructField("removed", ArrayType(_SPAN)),
                       StructField("n_bytes", LongType()), StructField("n_removed", LongType())])


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by ``spans``."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


@F.arrow_udf(_REMOVAL)
def _cut(texts: pa.Array, repeats: pa.Array) -> pa.Array:
    out = []
    for text, spans in zip(pc.fill_null(texts, "").cast(pa.binary()), repeats):
        data, runs = text.as_py(), union([(s["start"], s["end"]) for s in spans.as_py() or []])
        ends = [0, *(x for run in runs for x in run), len(data)]
        out.append({"kept": b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2])),
                    "removed": [{"start": a, "end": b} for a, b in runs], "n_bytes": len(data),
                    "n_removed": sum(b - a for a, b in runs)})
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.array(out, pa.struct([("kept", pa.binary()), ("removed", pa.list_(span)), ("n_bytes", pa.int64()), ("n_removed", pa.int64())]))


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK, pool: int = POOL) -> DataFrame:
    """``docs`` with ``kept`` (the bytes that stay, in order), ``removed`` (maximal runs, as
    offsets in bytes), ``n_bytes`` and ``n_removed``."""
    found = materialize(stretch_rows(docs, length, gram, block), "stretches")
    ends = [f(x).alias(f"{f.__name__}_{x}") for x in ("x1", "x2") for f in (F.min, F.max)]
    keys = (found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *ends).where("n > 1")
            .select("key", F.expr("min_x1 = max_x1 AND min_x2 = max_x2").alias("copies")))
    keys = materialize(keys, "keys")            # a table of its own, so that a hot key's join can be split
    shared = materialize(found.join(keys.hint("merge"), "key"), "shared-stretches")
    mixed = shared.where("NOT copies").drop("copies")
    again = repeated_stretches(docs, mixed, length, gram, pool).withColumnRenamed("low", "_low")
    spans = (shared.where("copies").select("doc_id", "text_hash", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
             .unionByName(mixed.join(again.hint("merge"), _KEY).select(
                 "doc_id", "text_hash", (F.col("anchor") - F.col("high")).alias("start"),
                 (F.col("anchor") - F.col("_low") + length).alias("end")))
             .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
             .agg(F.collect_list(F.struct("start", "end")).alias("_spans")))
    rows = docs.select("doc_id", text_key().alias("text_hash"), "text", F.struct(*docs.columns).alias("_row"))
    joined = rows.join(spans.hint("merge"), rows["doc_id"].eqNullSafe(spans["_id"]) & (rows["text_hash"] == spans["_hash"]), "left")
    done = joined.select("_row", _cut("text", "_spans").alias("_cut"))
    own = [c for c in docs.columns if c not in _REMOVAL.names]
    return done.select(*(F.col("_row")[c].alias(c) for c in own), "_cut.*")
