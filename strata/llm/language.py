"""Language of web pages by fusing evidence.

Text: naive Bayes over hashed character trigrams, counted over all labelled documents,
with the log-likelihood tempered to its root length, as neighbouring trigrams are not
independent.  Markup: how often each declared language goes with each text language,
over all pages, smoothed.  Address: a prior by host, smoothed towards its suffix, which
is smoothed towards all pages; all three are grouped sums of the text evidence from
which a page's own share is taken out again.  The posterior is their product.

Host and suffix sums are combined before the shuffle; a host with a third of all pages is
one row.  Counted first, host sums are broadcast up to MAX_BROADCAST_HOSTS, joined by
sort and merge beyond.

Defined cases: a page without text, markup or address is judged by what is left, at last
by the prior of all pages; of equal posteriors the first language by name is taken; without
labelled documents there are no languages: ``lang``,
``confidence`` and ``text_lang`` are null; repeated rows are pages of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from strata.llm.common import materialize
from strata.llm.html import blocks

BUCKETS = 1 << 15
HOST_STRENGTH, SUFFIX_STRENGTH, MARKUP_STRENGTH = 5.0, 20.0, 20.0
MAX_BROADCAST_HOSTS = 500_000

_LETTER = np.array([chr(c) if chr(c).isalpha() else " " for c in range(128)]).view(np.uint32)
_DECLARED = re.compile(r"<html\b[^>]*?\b(?:xml:)?lang\s*=\s*[\"']?([A-Za-z]{2,3})(?![A-Za-z])", re.I)


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-cased letters, other ASCII as single spaces."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(codes < 128, _LETTER[np.minimum(codes, 127)], codes)
    codes = codes[np.append(True, (codes[1:] != 32) | (codes[:-1] != 32))].astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    mixed = codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1] * np.uint64(0x85EBCA77) + codes[2:] * np.uint64(0xC2B2AE3D)
    mixed ^= mixed >> np.uint64(15)
    return (mixed % np.uint64(BUCKETS)).astype(np.int64)


def train(documents: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log-probability by language and trigram) from all labelled documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                grams = trigrams(text.as_py())
                sums.setdefault(lang.as_py(), np.zeros(BUCKETS, np.int64))
                sums[lang.as_py()] += np.bincount(grams, minlength=BUCKETS)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(n[at])],
                                             names=["lang", "bucket", "n"])

    labelled = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    counts = labelled.mapInArrow(count, "lang string, bucket bigint, n bigint")
    rows = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).groupBy("lang").agg(
        F.collect_list(F.struct("bucket", "n")).alias("c")).orderBy("lang").collect()   # BUCKETS entries a language
    table = np.full((len(rows), BUCKETS), 0.5)
    for k, r in enumerate(rows):
        for bucket, n in r["c"]:
            table[k, bucket] += n
    return [r["lang"] for r in rows], np.log(table / table.sum(axis=1, keepdims=True))


def text_posterior(table: np.ndarray, text: str) -> np.ndarray:
    """Probability of each language by the text alone (equal without letters)."""
    grams = trigrams(text)
    if not len(grams) or not len(table):
        return np.full(len(table), 1 / max(1, len(table)))
    score = table[:, grams].mean(axis=1) * np.sqrt(len(grams))
    p = np.exp(score - score.max())
    return p / p.sum()


def page_text(page: str | None) -> str:
    """Text outside boilerplate, or all text where there is no other."""
    found = blocks(page) if page else []
    return " ".join([b["text"] for b in found if not b["boilerplate"]] or [b["text"] for b in found])


def address(url: str | None) -> tuple[str | None, str | None]:
    """(host, suffix): the host without www, the last label of it."""
    try:
        host = urlsplit(url or "").hostname
    except ValueError:
        host = None
    if not host:
        return None, None
    host = host.removeprefix("www.")
    return host, host.rpartition(".")[2]


_EVIDENCE = StructType([StructField("text_p", ArrayType(DoubleType())), StructField("declared", StringType()),
                        StructField("host", StringType()), StructField("suffix", StringType())])


def evidence(pages: DataFrame, table: np.ndarray) -> DataFrame:
    """``pages`` plus text_p (probability by language from the text), declared, host, suffix."""
    shared = pages.sparkSession.sparkContext.broadcast(table)     # languages x BUCKETS

    @F.arrow_udf(_EVIDENCE)
    def read(html: pa.Array, url: pa.Array) -> pa.Array:
        p, declared, hosts = [], [], []
        for page, link in zip(html.to_pylist(), url.to_pylist()):
            p.append(text_posterior(shared.value, page_text(page)))
            m = _DECLARED.search(page or "")
            declared.append(m.group(1).lower() if m else None)
            hosts.append(address(link))
        return pa.StructArray.from_arrays(
            [pa.array(p, pa.list_(pa.float64())), pa.array(declared, pa.string()),
             pa.array([h for h, _ in hosts], pa.string()), pa.array([s for _, s in hosts], pa.string())],
            names=_EVIDENCE.names)

    out = pages.withColumn("_e", read("html", "url"))
    return out.withColumns({c: F.col(f"_e.{c}") for c in _EVIDENCE.names}).drop("_e")


def identify(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(page_id, url, lang, confidence, text_lang, declared, host, suffix) per page."""
    languages, table = train(documents)
    n = len(languages)
    if not n:
        seen = evidence(pages.select("page_id", "url", "html"), table)
        return seen.select("page_id", "url", F.lit(None).cast("string").alias("lang"),
                           F.lit(None).cast("double").alias("confidence"),
                           F.lit(None).cast("string").alias("text_lang"), "declared", "host", "suffix")
    seen = materialize(evidence(pages.select("page_id", "url", "html"), table).drop("html"), "evidence")
    sums = [F.sum(F.col("text_p")[i]) for i in range(n)]
    total = seen.agg(F.array(*[F.coalesce(s, F.lit(0.0)) for s in sums]).alias("s"), F.count(F.lit(1)).alias("n")).first()
    base = [(total["s"][i] + 1) / (total["n"] + n) for i in range(n)]

    def grouped(key: str) -> DataFrame:
        return materialize(seen.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_{key}")).agg(
            F.array(*sums).alias(f"{key}_sums"), F.count(F.lit(1)).alias(f"{key}_n")), key)

    out = seen
    for key in ("host", "suffix", "declared"):
        side = grouped(key)
        side = F.broadcast(side) if side.count() <= MAX_BROADCAST_HOSTS else side.hint("merge")
        out = out.join(side, out[key] == side[f"_{key}"], "left").drop(f"_{key}")

    def others(key: str, i: int):
        """The group's sum for language i without the page itself, and its size."""
        return (F.coalesce(F.greatest(F.col(f"{key}_sums")[i] - F.col("text_p")[i], F.lit(0.0)), F.lit(0.0)),
                F.coalesce(F.col(f"{key}_n") - 1, F.lit(0)))

    scores = []
    for i in range(n):
        s, s_n = others("suffix", i)
        by_suffix = (s + SUFFIX_STRENGTH * base[i]) / (s_n + SUFFIX_STRENGTH)
        h, h_n = others("host", i)
        by_host = (h + HOST_STRENGTH * by_suffix) / (h_n + HOST_STRENGTH)
        d, d_n = others("declared", i)
        by_markup = (d + MARKUP_STRENGTH * base[i]) / (d_n + MARKUP_STRENGTH) / base[i]    # lift over the base rate
        scores.append(F.log(F.greatest(F.col("text_p")[i], F.lit(1e-300))) + F.log(by_host) + F.log(by_markup))
    out = out.withColumn("_s", F.array(*scores)).withColumn("_top", F.array_max("_s"))
    names = F.array(*[F.lit(x) for x in languages])
    return out.select(
        "page_id", "url",
        F.element_at(names, F.array_position("_s", F.col("_top")).cast("int")).alias("lang"),
        (F.lit(1.0) / F.aggregate("_s", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_top")))).alias("confidence"),
        F.element_at(names, F.array_position("text_p", F.array_max("text_p")).cast("int")).alias("text_lang"),
        "declared", "host", "suffix")
