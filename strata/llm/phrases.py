"""Phrase collocations by vertical partitioning of the corpus' word suffixes.

The suffixes of a piece of text are its words from each word on, cut to ``max_words``
words.  Their prefixes are partitioned vertically by a memory budget: first words are
hashed to slots, the suffixes of each slot are counted, slots that fit are packed into
groups of ``budget`` suffixes at most, and a slot that does not fit is extended by the
next word and counted anew, down to whole suffixes.  A scan then deals every suffix to
its group (equal ones of a scanned slice as one entry with a count) and each group
builds its subtree of truncated suffixes alone, sorted by word codes; the count of a
phrase is the sum of the leaves below its node.  Nodes above the prefix that a group was
dealt by have leaves in several groups; their sums are added up by Spark.

Memory: a scan holds a slice of the texts (units.SLICE_CHARS characters, or one longer
text) and ``SLOTS`` counts; a group holds ``budget`` suffixes, whatever words are
frequent, since equal suffixes of a slice are one entry and a slot of whole suffixes is
spread over as many groups as its count asks for.  The driver holds ``SLOTS`` counts for
each word of depth.

Defined cases: null and empty texts have no words; a null lang counts as ``und``; a very
long text is cut into blocks of BLOCK_WORDS words that look ahead over their end, so no
suffix is lost; ties in score go to the larger count, then to the smaller phrase in
UTF-8 byte order; repeated rows count as often as they stand; an empty table gives no
phrases; only ``lang`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialize
from strata.llm.units import slices

SLOTS = 1 << 16
BUDGET = 1_000_000         # suffixes of a group
BLOCK_WORDS = 1_000_000    # words of a text handled at a time
MAX_WORDS = 3
MIN_COUNT = 10
SHARE = 50                 # percent of a phrase's occurrences inside one longer phrase
TOP = 2000

_MIX = np.uint64(0x9E3779B97F4A7C15)

#: A-Z lower-cased, the separators of pieces as _END, tabs as spaces.
_FOLD = bytes(255 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_END = b"\xff"              # no byte of UTF-8


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


@dataclass
class Suffixes:
    """Distinct truncated suffixes of a block of words: ``codes`` has a row for each depth
    (0: the piece has ended), ``vocabulary`` the word of each code from 1 on."""

    vocabulary: pa.Array
    codes: np.ndarray
    counts: np.ndarray
    hashes: np.ndarray = field(default=None)

    def prefix_hash(self, depth: int) -> np.ndarray:
        """A hash of the first ``depth`` words of each suffix."""
        h = np.zeros(self.codes.shape[1], np.uint64)
        for row in self.codes[:depth]:
            h = _mix(h + self.hashes[row] + _MIX)
        return h


def distinct_rows(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first column of each distinct one, index of each column's distinct one), columns in
    order of their codes; codes are below ``size``."""
    index, firsts = codes[0].astype(np.int64), None
    for row in codes[1:]:
        _, firsts, index = np.unique(index * size + row, return_index=True, return_inverse=True)
    if firsts is None:
        _, firsts, index = np.unique(index, return_index=True, return_inverse=True)
    return firsts, index


def suffixes(texts: list[str], lang: str, max_words: int, block: int = BLOCK_WORDS) -> Iterator[Suffixes]:
    """The truncated suffixes of all pieces of ``texts``, counted by block."""
    tokens = "\n".join(texts).encode("utf-8").translate(_FOLD).replace(_END, b" %b " % _END).split()
    seed = zlib.crc32(lang.encode("utf-8"))
    for a in range(0, len(tokens), block):
        starts = min(block, len(tokens) - a)
        coded = pa.array(tokens[a:a + block + max_words], pa.binary()).dictionary_encode()
        vocabulary = coded.dictionary
        words = vocabulary.to_pylist()
        end = words.index(_END) + 1 if _END in words else 0
        code = np.append(coded.indices.to_numpy().astype(np.int64) + 1, np.zeros(max_words, np.int64))
        code[code == end] = 0
        rows, alive = [], np.ones(starts, bool)
        for d in range(max_words):
            row = np.where(alive, code[d:d + starts], 0)
            alive = row > 0
            rows.append(row)
        codes = np.stack(rows)[:, rows[0] > 0]
        if not codes.shape[1]:
            continue
        firsts, index = distinct_rows(codes, len(words) + 1)
        hashes = np.zeros(len(words) + 1, np.uint64)
        hashes[1:] = np.fromiter((zlib.crc32(w, seed) for w in words), np.uint64, len(words))
        yield Suffixes(vocabulary, codes[:, firsts], np.bincount(index), hashes)


@dataclass
class Partition:
    """Vertical partition: ``groups[d]`` gives, by slot of the first d + 1 words, the group
    of the slot, or -1 where the slot is extended; ``spread`` the first group and the number
    of groups of a slot of whole suffixes that is spread over several."""

    slots: int
    groups: list[np.ndarray] = field(default_factory=list)
    depths: list[int] = field(default_factory=list)          # words that decide a group, by group
    spread: tuple[np.ndarray, np.ndarray] | None = None

    def route(self, s: Suffixes) -> np.ndarray:
        """Group of each suffix; -1 where its slot is still to be extended."""
        group = np.full(s.codes.shape[1], -1, np.int64)
        for d, table in enumerate(self.groups):
            open_ = np.flatnonzero(group < 0)
            if len(open_):
                slot = (s.prefix_hash(d + 1)[open_] % np.uint64(self.slots)).astype(np.int64)
                group[open_] = table[slot]
        open_ = np.flatnonzero(group < 0)
        if self.spread is not None and len(open_):
            first, n = self.spread
            h = s.prefix_hash(len(s.codes))[open_]
            slot = (s.prefix_hash(len(self.groups))[open_] % np.uint64(self.slots)).astype(np.int64)
            group[open_] = first[slot] + (_mix(h + _MIX) % n[slot].astype(np.uint64)).astype(np.int64)
        return group

    def extend(self, loads: np.ndarray, budget: int, whole: bool) -> bool:
        """Packs the slots that fit into groups; true if some do not.  ``whole``: the slots
        are of whole suffixes but the last word, so those that do not fit are spread."""
        table, group, room = np.full(self.slots, -1, np.int64), len(self.depths) - 1, 0
        depth = len(self.groups) + 1
        for slot in np.argsort(-loads, kind="stable"):
            if loads[slot] > budget or not loads[slot]:
                continue
            if loads[slot] > room:
                group, room = group + 1, budget
                self.depths.append(depth)
            room -= int(loads[slot])
            table[slot] = group
        self.groups.append(table)
        over = np.flatnonzero(loads > budget)
        if whole and len(over):
            n = np.zeros(self.slots, np.int64)
            n[over] = -(-loads[over] // budget)
            first = np.cumsum(n) - n + len(self.depths)
            self.depths += [depth + 1] * int(n.sum())
            self.spread = first, np.maximum(n, 1)
        return bool(len(over)) and not whole


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
    """(lang, texts) of a batch, slice by slice."""
    langs = pc.fill_null(batch.column(0), "und")
    at = 0
    for texts in slices(batch.column(1)):
        part = langs.slice(at, len(texts))
        for lang in pc.unique(part).to_pylist():
            yield lang, texts.filter(pc.equal(part, lang)).to_pylist()
        at += len(texts)


def vertical_partition(docs: DataFrame, max_words: int, budget: int = BUDGET, slots: int = SLOTS) -> Partition:
    """Counts the suffixes of each slot, a scan for each word that prefixes are extended by."""
    partition = Partition(slots)
    for depth in range(1, max_words):
        def count(batches: Iterator[pa.RecordBatch], depth=depth) -> Iterator[pa.RecordBatch]:
            total = np.zeros(slots, np.int64)
            for batch in batches:
                for lang, texts in _by_lang(batch):
                    for s in suffixes(texts, lang, max_words):
                        open_ = partition.route(s) < 0
                        slot = (s.prefix_hash(depth)[open_] % np.uint64(slots)).astype(np.int64)
                        total += np.bincount(slot, s.counts[open_], slots).astype(np.int64)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "n"])

        rows = (docs.select("lang", "text").mapInArrow(count, "slot bigint, n bigint")
                .groupBy("slot").agg(F.sum("n").alias("n")).collect())       # ``slots`` rows at most
        loads = np.zeros(slots, np.int64)
        for r in rows:
            loads[r["slot"]] = r["n"]
        if not partition.extend(loads, budget, whole=depth == max_words - 1):
            break
    return partition


def pack(vocabulary: pa.Array, codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Suffixes as compressed bytes, with the words that they use."""
    used, recoded = np.unique(codes, return_inverse=True)
    used, shift = (used[1:], 0) if len(used) and used[0] == 0 else (used, 1)
    words = b"\n".join(vocabulary.take(pa.array(used - 1)).to_pylist())
    body = np.vstack([recoded.reshape(codes.shape) + shift, counts[None, :]]).astype("<u4")
    head = np.array([len(words), *body.shape], "<u4")
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + words + body.tobytes())


def unpack(packed: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n, rows, columns = np.frombuffer(raw, "<u4", 3).tolist()
    words = pa.array(raw[12:12 + n].split(b"\n"), pa.binary())
    body = np.frombuffer(raw, "<u4", rows * columns, 12 + n).reshape(rows, columns).astype(np.int64)
    return words, body[:-1], body[-1]


def subtree(entries: list[bytes], depth: int, least: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(words, phrases, counts) of the nodes of a group's subtree by level, the root's with
    no words.  The suffixes are sorted by word codes; a node's count is the sum of the
    leaves below it.  Nodes of ``depth`` words or more are whole in the group: those below
    ``least`` are left out."""
    parts = [unpack(e) for e in entries]
    coded = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
    vocabulary, place = coded.dictionary, coded.indices.to_numpy().astype(np.int64) + 1
    at, columns = 0, []
    for words, codes, _ in parts:
        columns.append(np.concatenate([[0], place[at:at + len(words)]])[codes])
        at += len(words)
    codes, counts = np.concatenate(columns, axis=1), np.concatenate([p[2] for p in parts])
    yield 0, pa.array([b""], pa.binary()), np.array([counts.sum()])
    at, node, text = np.arange(len(counts)), np.zeros(len(counts), np.int64), None
    for level, row in enumerate(codes, start=1):
        row = row[at]
        _, firsts, inner = np.unique(node * (len(vocabulary) + 1) + row, return_index=True, return_inverse=True)
        total = np.zeros(len(firsts), np.int64)
        np.add.at(total, inner, counts[at])
        last = row[firsts]
        own = vocabulary.take(pa.array(np.maximum(last, 1) - 1))
        text = own if level == 1 else pc.binary_join_element_wise(text.take(pa.array(node[firsts])), own, b" ")
        keep = (last > 0) & ((total >= least) | (level < depth))
        if not keep.any():
            return
        yield level, text.filter(pa.array(keep)), total[keep]
        on = keep[inner]             # below the other nodes there is nothing to report
        at, node = at[on], inner[on]


def phrase_counts(docs: DataFrame, max_words: int = MAX_WORDS, least: int = MIN_COUNT, budget: int = BUDGET,
                  slots: int = SLOTS) -> DataFrame:
    """(lang, words, phrase, f) of all phrases of 1 to ``max_words`` words found ``least``
    times or more, and with words = 0 the number of word occurrences of each lang."""
    partition = vertical_partition(docs, max_words, budget, slots)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in _by_lang(batch):
                for s in suffixes(texts, lang, max_words):
                    group = partition.route(s)
                    order = np.argsort(group, kind="stable")
                    ends = np.flatnonzero(np.append(np.diff(group[order]), 1)) + 1
                    entries = [pack(s.vocabulary, s.codes[:, part], s.counts[part])
                               for part in np.split(order, ends[:-1])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(group[order[ends - 1]]), pa.array([lang] * len(entries)), pa.array(entries, pa.binary())],
                        names=["part", "lang", "entry"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)))
        for (group, lang), entries in groupby(rows, key=lambda r: r[:2]):
            for level, phrases, counts in subtree([e.as_py() for _, _, e in entries], partition.depths[group], least):
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n), pa.array(np.full(n, level, np.int32)), phrases.cast(pa.string()), pa.array(counts)],
                    names=["lang", "words", "phrase", "f"])

    dealt = (docs.select("lang", "text").mapInArrow(deal, "part bigint, lang string, entry binary")
             .repartition("part").sortWithinPartitions("part", "lang"))
    nodes = dealt.mapInArrow(build, "lang string, words int, phrase string, f bigint")
    return nodes.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("words") == 0))


def _join_words(ws, start, length):
    return F.array_join(F.slice(ws, start, length), " ")


def scores(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of each phrase of two words or more, by its
    lowest-scoring cut; exact in decimals of 38 digits."""
    grams = counts.where("words > 0").select("lang", "phrase", "f")
    ws = F.split("phrase", " ")
    cuts = (counts.where("words > 1").withColumnRenamed("f", "a")
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .withColumns({"first": _join_words(ws, F.lit(1), F.col("k")),
                          "rest": _join_words(ws, F.col("k") + 1, F.col("words") - F.col("k"))}))
    both = (cuts.join(grams.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
            .join(grams.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    exact = {c: f"CAST({c} AS DECIMAL(19, 0))" for c in "alr"}
    score = F.expr(f"1000000BD * ({exact['a']} * {exact['a']}) div ({exact['l']} * {exact['r']})")
    best = both.withColumn("score", score).groupBy("lang", "phrase", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, least: int = MIN_COUNT, share: int = SHARE, top: int = TOP,
                 budget: int = BUDGET, slots: int = SLOTS) -> DataFrame:
    """The first ``top`` phrases of each lang as (lang, rank, phrase, a, l, r, n, score),
    without those of which ``share`` percent or more stand in one longer phrase."""
    counts = materialize(phrase_counts(docs, max_words, least, budget, slots), "phrases")
    ws = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: _join_words(ws, i, n))))
    longer = (counts.where("words > 2").select("lang", "f", F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = (scores(counts).join(longer, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))).drop("longer"))
    # the first ``top`` of a lang are among the first of its parts
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    first = (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
             .where(F.col("rank") <= top))
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))      # one row a lang
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
