"""Quality rules with host verdicts.

Document rules are counted in one Arrow pass per text.  Rule failures are then
aggregated by host (``source``), each host's failure rate is shrunk with a beta
prior estimated from all hosts, and the host verdicts are joined back to the
documents.  A bad host removes those of its documents that themselves break
a rule the host is bad at; documents that break no rule stay, whatever the host.

Defined cases: a null or empty text has no words and fails the base rule; a null
host is no host (its documents are judged by the base rule only); repeated rows
are judged row by row; an empty table gives an empty result; other columns of the
input are carried along, and a column with the name of a computed one is replaced.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.llm.common import materialize

MIN_WORDS = 50               # base rule: fewer words fail
MAX_REPEAT_PERCENT = 50      # base rule: more words than this in repeated 3-word windows fail
MAX_SYMBOLS_PER_10_WORDS = 1
MAX_DUP_LINE_PERCENT = 30
MEAN_WORD_CHARS = (3, 10)
MAX_HOST_RATE = 0.5          # a host whose shrunk failure rate is above is bad at that rule
MAX_BROADCAST_HOSTS = 1_000_000   # counted before; with more hosts the join is shuffled

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
HOST_RULES = ("base", "symbols", "dup_lines", "word_length")
DOCUMENT_RULES = HOST_RULES[1:]


def repeated_words(words: list[bytes]) -> int:
    """Words covered by 3-word windows that occur at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen, twice = set(), set()
    for w in windows:
        (twice if w in seen else seen).add(w)
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if w in twice:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def text_counts(text: str) -> tuple[int, ...]:
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [s for s in text.split("\n") if s.strip(SPACES)]
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeated_words(words))


@F.arrow_udf(StructType([StructField(c, LongType()) for c in COUNTS]))
def _counts(texts: pa.Array) -> pa.Array:
    rows = [text_counts(t.as_py() or "") for t in texts]
    columns = zip(*rows) if rows else [()] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(COUNTS))


def with_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the counts and one boolean ``fails_<rule>`` per host rule."""
    d = docs.withColumn("_counts", _counts(text))
    d = d.withColumns({c: F.col(f"_counts.{c}") for c in COUNTS}).drop("_counts")
    n, chars = F.col("n_words"), F.col("word_chars")
    lo, hi = MEAN_WORD_CHARS
    return d.withColumns({
        "fails_base": (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n),
        "fails_symbols": 10 * F.col("n_symbols") > MAX_SYMBOLS_PER_10_WORDS * n,
        "fails_dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
        "fails_word_length": (chars < lo * n) | (chars > hi * n)})


def host_verdicts(ruled: DataFrame) -> DataFrame:
    """(source, n_docs, rate_<rule>, bad_<rule>): one row per host.

    The beta prior of a rule is fitted by moments over all hosts: its mean is the
    overall rate m, its strength the one at which binomial and between-host
    variance add up to what is seen.  Without spread between hosts the prior is
    as strong as all documents together."""
    hosts = ruled.where(F.col("source").isNotNull()).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(F.col(f"fails_{r}").cast("bigint")).alias(r) for r in HOST_RULES])
    n = F.col("n_docs")
    sums = hosts.agg(F.sum(n).alias("n"), F.count(F.lit(1)).alias("h"),
                     *[F.sum(r).alias(r) for r in HOST_RULES],
                     *[F.sum(F.col(r) * F.col(r) / n).alias(f"sq_{r}") for r in HOST_RULES]).first()
    rates, bad = {}, {}
    for r in HOST_RULES:
        mean, strength = beta_prior(sums["n"] or 0, sums["h"], sums[r] or 0, sums[f"sq_{r}"] or 0.0)
        rates[f"rate_{r}"] = (F.col(r) + F.lit(mean * strength)) / (n + F.lit(strength))
        bad[f"bad_{r}"] = F.col(f"rate_{r}") > MAX_HOST_RATE
    return hosts.withColumns(rates).withColumns(bad).drop(*HOST_RULES)


def beta_prior(n: int, hosts: int, fails: int, sum_squares: float) -> tuple[float, float]:
    """(mean, strength) from documents, hosts, failures and sum(fails^2 / docs) over hosts."""
    if not n:
        return 0.0, 1.0
    m = fails / n
    within = m * (1 - m)
    between = sum_squares / n - m * m - within * hosts / n
    if within <= 0 or between <= within / n:
        return m, float(n)
    return m, max(1.0, min(float(n), within / between - 1))


def judge(docs: DataFrame, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` without ``drop`` plus counts, ``base_failed``, ``host_bad`` and ``kept``.

    The ruled documents are written once; both the host rates and the verdicts
    read them from there.  The host table is counted: up to MAX_BROADCAST_HOSTS rows
    it is broadcast, beyond that Spark joins by shuffle and splits skewed hosts."""
    ruled = materialize(with_rules(docs, text).drop(*drop), "quality")
    hosts = materialize(host_verdicts(ruled), "hosts").select(
        F.col("source").alias("_host"), *[f"bad_{r}" for r in HOST_RULES])
    if hosts.count() <= MAX_BROADCAST_HOSTS:
        hosts = F.broadcast(hosts)
    out = ruled.join(hosts, ruled["source"] == hosts["_host"], "left")
    host_bad = F.lit(False)
    for r in DOCUMENT_RULES:
        host_bad = host_bad | (F.col(f"fails_{r}") & (F.col(f"bad_{r}") | F.col("bad_base")))
    return (out.withColumn("host_bad", F.coalesce(host_bad, F.lit(False)))
               .withColumn("base_failed", F.col("fails_base"))
               .withColumn("kept", ~F.col("base_failed") & ~F.col("host_bad")))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with the columns of ``docs``."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "source")
    return judge(rows, "_row.text").where("kept").select("_row.*")
