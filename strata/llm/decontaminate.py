"""Benchmark decontamination with a positional inverted index.

1. Count, over all documents, the terms that occur in benchmark items.
2. For every window of an item (13 consecutive words, or the whole of a shorter
   item) take its two rarest terms; windows with a term that no document has are
   settled: they occur nowhere.
3. Store the index: (term, document, positions) for the terms taken, and one
   length row per document.
4. Join postings with the windows on the rarest term, shift positions to where the
   window would start, and intersect with the shifted postings of the second term.
5. What is left is compared word by word with the documents, which gives the exact
   phrase hits.
6. Proximity: of an item, its rarest term that documents have and the rarest ones that stand
   less than WINDOW words from it in the item, NEAR_PARTS parts of NEAR_TERMS terms each (two
   at least).  Where a document has all terms of a part within NEAR_WORDS words, the smallest
   stretch that covers them is a proximity match, whatever stands between them.  The parts
   share no term, so a word changed in one leaves the other.
   Proximity matches are reported beside the exact ones and do not make a verdict.

The benchmark is the stated query set.  It is taken in blocks of at most
``BLOCK_WORDS`` words, one after the other, so what the driver and each task hold of it
is bounded; longer items are split with an overlap of WINDOW - 1 words.  With more words
there are more blocks, and all documents are read for each.

Defined cases: null text has no words; items without words match nothing; equal
items are looked up once and all their ids reported; repeated rows of documents are
reported row by row; a document is told from others by (doc_id, hash of its text);
an empty table gives an empty result or no hits; only doc_id/item_id and text are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialize, same_document, small_batches, text_key

WINDOW = 13
NEAR_TERMS = 3
NEAR_PARTS = 2
NEAR_WORDS = 20
BLOCK_WORDS = 500_000
MAX_BROADCAST_ROWS = 500_000   # counted before; larger tables are joined by sort and merge
HIT_SHARE = 20           # contaminated: 20 * n_hit >= n_words

_WORD_BYTES = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_TO_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters, digits and characters beyond ASCII, as UTF-8."""
    return text.encode("utf-8").translate(_TO_WORDS).split() if text else []


class QueryBlock:
    """Distinct items of one block: words, their item ids, and the windows."""

    def __init__(self, items: dict[tuple[bytes, ...], list]):
        self.items = list(items)
        self.ids = list(items.values())
        self.terms = sorted({w for item in self.items for w in item})

    def windows(self) -> Iterator[tuple[int, int, int]]:
        """(item, start, length)."""
        for k, item in enumerate(self.items):
            n = min(WINDOW, len(item))
            for s in range(len(item) - n + 1):
                yield k, s, n

    def anchors(self, counts: dict[bytes, int]) -> list[tuple[int, bytes, int, bytes, int]]:
        """(item, rarest term, its offset, second term, its offset), one per distinct pair
        of places in an item; windows with an absent term are left out.  The second is the
        rarest at another offset; a window of one word pairs its word with itself."""
        found = set()
        for k, s, n in self.windows():
            item = self.items[k]
            if any(not counts.get(w) for w in item[s:s + n]):
                continue
            order = sorted(range(s, s + n), key=lambda i: (counts[item[i]], item[i], i))
            a, b = order[0], order[min(1, n - 1)]
            found.add((k, item[a], a, item[b], b))
        return sorted(found)


    def near_terms(self, counts: dict[bytes, int]) -> list[tuple[int, int, int, int, bytes]]:
        """(item, part, terms of the part, slot, term) of the terms that proximity matches hold."""
        out = []
        for k, item in enumerate(self.items):
            present = [i for i, w in enumerate(item) if counts.get(w)]
            if not present:
                continue
            at = min(present, key=lambda i: (counts[item[i]], item[i], i))
            around = {w for w in item[max(0, at - WINDOW + 1):at + WINDOW] if counts.get(w)} - {item[at]}
            ranked = [item[at], *sorted(around, key=lambda w: (counts[w], w))]
            for part in range(NEAR_PARTS):
                terms = ranked[part * NEAR_TERMS:(part + 1) * NEAR_TERMS]
                if len(terms) > 1:
                    out += [(k, part, len(terms), slot, w) for slot, w in enumerate(terms)]
        return out


def pieces(item: tuple[bytes, ...]) -> Iterator[tuple[bytes, ...]]:
    """``item``, or parts of it of at most BLOCK_WORDS words (WINDOW at least) that hold all its windows."""
    most = max(BLOCK_WORDS, WINDOW)
    if len(item) <= most:
        yield item
        return
    for s in range(0, len(item) - WINDOW + 1, most - WINDOW + 1):
        yield item[s:s + most]


def query_blocks(benchmark: DataFrame) -> Iterator[QueryBlock]:
    """The benchmark in blocks of at most BLOCK_WORDS words, each made when it is asked for."""
    items, size = {}, 0
    rows = benchmark.select("item_id", "text").orderBy("item_id", "text")
    for r in rows.toLocalIterator():
        whole = tuple(words(r["text"]))
        for w in pieces(whole) if whole else ():
            if size + len(w) > BLOCK_WORDS and items:
                yield QueryBlock(items)
                items, size = {}, 0
            if w not in items:
                size += len(w)
            ids = items.setdefault(w, [])
            if r["item_id"] not in ids[-1:]:
                ids.append(r["item_id"])
    if items:
        yield QueryBlock(items)


def term_counts(docs: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """How often each of ``terms`` occurs in all documents (one row per term at most)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = dict.fromkeys(terms, 0)
        for batch in batches:
            for t in batch.column(0):
                for w in words(t.as_py()):
                    if w in seen:
                        seen[w] += 1
        found = {w: n for w, n in seen.items() if n}
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())],
                                         names=["term", "n"])

    counted = docs.select("text").mapInArrow(count, "term binary, n bigint")
    return {bytes(r["term"]): r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def build_index(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Stored postings of ``terms``: (doc_id, text_hash, n_words, term, positions).

    The row of a document without a term carries its length, one per input row."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = set(terms)
        for batch in small_batches(batches):
            rows, lengths, found, places = [], [], [], []
            for k, t in enumerate(batch.column(2)):
                ws = words(t.as_py())
                rows.append(k)
                lengths.append(len(ws))
                found.append(None)
                places.append(None)
                postings = defaultdict(list)
                for p, w in enumerate(ws):
                    if w in wanted:
                        postings[w].append(p)
                for w, ps in postings.items():
                    rows.append(k)
                    lengths.append(None)
                    found.append(w)
                    places.append(ps)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(lengths, pa.int64()),
                 pa.array(found, pa.binary()), pa.array(places, pa.list_(pa.int32()))],
                names=["doc_id", "text_hash", "n_words", "term", "positions"])

    indexed = docs.select("doc_id", text_key().alias("text_hash"), "text").mapInArrow(
        index, "doc_id bigint, text_hash bigint, n_words bigint, term binary, positions array<int>")
    return materialize(indexed, "postings")


def candidates(index: DataFrame, anchors: list[tuple[int, bytes, int, bytes, int]]) -> DataFrame:
    """(doc_id, text_hash, item, at): places where an item would start so that the two
    rarest terms of one of its windows fall on their positions.

    Both sides of the intersection carry their own shift; documents of the rarest
    term are few, and a hot document set is only as long as its real occurrences."""
    spark = index.sparkSession
    schema = "pair int, item int, term binary, shift int"
    first = spark.createDataFrame([(n, k, a, i) for n, (k, a, i, _, _) in enumerate(anchors)], schema)
    second = spark.createDataFrame([(n, k, b, j) for n, (k, _, _, b, j) in enumerate(anchors)], schema)
    postings = index.where(F.col("term").isNotNull())

    def shifted(side: DataFrame) -> DataFrame:
        return (postings.join(F.broadcast(side), "term")
                .select("doc_id", "text_hash", "pair", "item", F.explode("positions").alias("p"), "shift")
                .select("doc_id", "text_hash", "pair", "item", (F.col("p") - F.col("shift")).alias("at")))

    a, b = shifted(first).alias("a"), shifted(second).alias("b")
    same = (F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_hash") == F.col("b.text_hash"))
            & (F.col("a.pair") == F.col("b.pair")) & (F.col("a.at") == F.col("b.at")))
    return a.join(b, same, "left_semi").select("doc_id", "text_hash", "item", "at").distinct()


def near(index: DataFrame, terms: list[tuple[int, int, int, int, bytes]]) -> DataFrame:
    """(doc_id, text_hash, item, n_words, start, end): per document and item the smallest (then
    first) stretch of at most NEAR_WORDS words with all terms of a part of the item's.

    Documents without one of the terms go by one grouping, before positions are looked at;
    then one pass over the positions in order keeps the last place of each term."""
    side = index.sparkSession.createDataFrame(terms, "item int, part int, n_terms int, slot int, term binary")
    key = ("doc_id", "text_hash", "item", "part")
    postings = index.where(F.col("term").isNotNull()).join(F.broadcast(side), "term")
    whole = postings.groupBy(*key, "n_terms").agg(F.collect_set(F.struct("slot", "positions")).alias("lists")).where(
        "size(lists) = n_terms")
    places = whole.select(*key, "n_terms", F.explode("lists").alias("l")).select(
        *key, "n_terms", "l.slot", F.explode("l.positions").alias("p"))
    upto = Window.partitionBy(*key).orderBy("p", "slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = [F.max(F.when(F.col("slot") == s, F.col("p"))).over(upto) for s in range(NEAR_TERMS)]
    seen = places.select(*key, "n_terms", "p", F.array(*last).alias("last")).withColumn("first", F.array_min("last"))
    covers = seen.where("size(array_compact(last)) = n_terms").withColumn("n", F.col("p") - F.col("first") + 1)
    return covers.where(F.col("n") <= NEAR_WORDS).groupBy(*key[:3]).agg(F.min(F.struct(
        F.col("n").alias("n_words"), F.col("first").alias("start"), (F.col("p") + 1).alias("end"))).alias("s")).select(*key[:3], "s.*")


def aligned(ws: list[bytes], item: tuple[bytes, ...], at: int) -> tuple[int, list[tuple[int, int]]]:
    """(item words found at their places, stretches [start, end) of ``ws`` inside whole windows)."""
    need, same, stretches, run = min(WINDOW, len(item)), 0, [], 0
    for i in range(max(0, -at), min(len(item), len(ws) - at) + 1):
        if i < len(item) and at + i < len(ws) and ws[at + i] == item[i]:
            same += 1
            run += 1
            continue
        if run >= need:
            stretches.append((at + i - run, at + i))
        run = 0
    return same, stretches


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df.hint("merge")


MATCHES = ("doc_id bigint, text_hash bigint, item int, at int, n_aligned int, "
           "stretches array<struct<start:int,end:int>>")


def verify(docs: DataFrame, found: DataFrame, block: QueryBlock) -> DataFrame:
    """Compare documents and items at every candidate place (rows of MATCHES).

    A row without stretches is a candidate only: its two rarest terms stand as in the
    item, n_aligned words in all, but no whole window does."""
    found = materialize(found, "candidates")
    places = found.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("item", "at")).alias("places"))
    places = _sized(places, found.count())
    texts = docs.select("doc_id", text_key().alias("text_hash"), "text")
    both = texts.join(places, same_document(texts, places)).select(
        places["doc_id"], places["text_hash"], "text", "places")
    items = block.items

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            row, item, at, n, spans = [], [], [], [], []
            for k in range(batch.num_rows):
                ws = words(batch.column(2)[k].as_py())
                for place in batch.column(3)[k].as_py():
                    same, stretches = aligned(ws, items[place["item"]], place["at"])
                    row.append(k)
                    item.append(place["item"])
                    at.append(place["at"])
                    n.append(same)
                    spans.append([{"start": a, "end": b} for a, b in stretches])
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(item, pa.int32()),
                 pa.array(at, pa.int32()), pa.array(n, pa.int32()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                names=["doc_id", "text_hash", "item", "at", "n_aligned", "stretches"])

    return both.mapInArrow(compare, MATCHES).dropDuplicates(["doc_id", "text_hash", "item", "at"])


def find_matches(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matches, lengths): compared candidates with the ids of their items as
    strings, and one (doc_id, text_hash, n_words) row per row of ``docs``.  Matches of a
    block are written before the next is taken; of a split item, ``at`` is its part's."""
    return _search(docs, benchmark, False)[::2]


def near_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Proximity matches: the rows of ``near`` with the ids of their items as strings."""
    return _search(docs, benchmark, True)[1]


def _search(docs: DataFrame, benchmark: DataFrame, with_near: bool) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(matches, proximity matches where asked for, lengths)."""
    spark = docs.sparkSession
    lengths = matches = close = None
    blocks = query_blocks(benchmark)
    for block in chain([next(blocks, QueryBlock({}))], blocks):
        counts = term_counts(docs, block.terms) if block.terms else {}
        anchors, terms = block.anchors(counts), block.near_terms(counts) if with_near else []
        index = build_index(docs, sorted({t for _, a, _, b, _ in anchors for t in (a, b)} | {t[-1] for t in terms}))
        if lengths is None:
            lengths = index.where(F.col("term").isNull()).select("doc_id", "text_hash", "n_words")
        ids = spark.createDataFrame([(k, [str(i) for i in x if i is not None]) for k, x in enumerate(block.ids)],
                                    "item int, item_ids array<string>")
        found = candidates(index, anchors)
        part = materialize(verify(docs, found, block).join(F.broadcast(ids), "item"), "matches")
        matches = part if matches is None else matches.unionByName(part)
        if with_near:
            part = materialize(near(index, terms).join(F.broadcast(ids), "item"), "near")
            close = part if close is None else close.unionByName(part)
    return matches, close, lengths


def contamination(docs: DataFrame, benchmark: DataFrame, with_near: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, n_hit, items (ids as sorted strings),
    contaminated; ``with_near`` also n_near (items with a proximity match) and near_words (words
    of the smallest such stretch, null without)."""
    matches, close, lengths = _search(docs, benchmark, with_near)
    hits = matches.where(F.size("stretches") > 0).groupBy("doc_id", "text_hash").agg(
        F.size(F.array_distinct(F.flatten(F.transform(
            F.flatten(F.collect_list("stretches")), lambda s: F.sequence(s["start"], s["end"] - 1))))).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("items"))
    joined = _with(lengths, hits, "hits")
    extra = []
    if with_near:
        joined = _with(joined, close.groupBy("doc_id", "text_hash").agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("n_near"),
            F.min("n_words").alias("near_words")), "near-by-document")
        extra = [F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                 F.col("near_words").cast("bigint").alias("near_words")]
    out = joined.select(
        "doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), *extra)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words")))


def _with(rows: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """``rows`` with the columns found for their documents, if any."""
    found = materialize(found, name)
    found = _sized(found, found.count())
    joined = rows.join(found, same_document(rows, found), "left")
    return joined.select(*[rows[c] for c in rows.columns],
                         *[found[c] for c in found.columns if c not in ("doc_id", "text_hash")])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without its contaminated rows."""
    bad = contamination(docs, benchmark).where("contaminated").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    bad = materialize(bad, "contaminated")
    bad = _sized(bad, bad.count())
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_hash"]), "left_anti")
