"""Window-shaped operators that must not funnel into one partition.

* ``numbered_totals``: a dense 1..N numbering in a total order with running
  sums, done as a range-partitioned sort, written once, + numbers and sums
  inside each partition + offsets of the partitions (one row per partition:
  bounded, broadcast-safe).  ``global_row_number`` is the numbering alone.
* ``count_batches``: batches of a fixed number of rows, from that numbering.
* ``greedy_pack``: reset-on-overflow token packing, exact over each group
  whatever its size: prefix sums give each row the row that opens the next
  batch if it opens one, and the openers are found by following these links
  with pointer doubling, in as many rounds as the number of batches has bits.
* ``budget_prefix``: keep rows while a running token sum stays within a
  budget; pre-cut with ``row_number() <= budget`` (each row has >= 1 token),
  which Spark plans as a partial WindowGroupLimit before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata import config as C
from strata.session import cut_lineage, stored


def global_row_number(df: DataFrame, order: list[Column], name: str = "row_id", parts: int | None = None) -> DataFrame:
    """1-based row number over the whole frame in ``order`` (must be a total
    order), without a single-partition window."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # range bounds are sampled anew by every run of the plan: the partition and the
    # number in it (upper and lower bits of the id) are fixed once, before counting
    numbered = cut_lineage(ranged.withColumn("_id", F.monotonically_increasing_id()))
    local = (numbered.withColumn("_pid", F.shiftright("_id", 33))
             .withColumn("_local", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_id"))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.withColumn("_off", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1))).select("_pid", F.coalesce("_off", F.lit(0)).alias("_off"))
    # one row per partition: bounded by the partition count
    return (local.join(F.broadcast(offs), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_pid", "_local", "_off"))


def budget_prefix(df: DataFrame, part: list[str], order: list[Column], tokens_col: str, budget: int,
                  rn: str = "rn", cum: str = "cum_tokens") -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    r = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= budget)
    r = r.withColumn(cum, F.sum(tokens_col).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return r.where(F.col(cum) <= budget)


def numbered_totals(df: DataFrame, order: list[Column], sums: dict[str, str], name: str = "row_id") -> DataFrame:
    """``df`` with a dense 1-based number in ``order`` (a total order) and, for each entry
    (column: running) of ``sums``, the sum of the column up to and with the row."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # range bounds are sampled anew by every run of the plan: fixed once before counting
    fixed = stored(ranged.withColumn("_id", F.monotonically_increasing_id()), "ranged").withColumn("_pid", F.shiftright("_id", 33))
    inside = Window.partitionBy("_pid").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    local = fixed.withColumns({name: F.row_number().over(Window.partitionBy("_pid").orderBy("_id")).cast("long"),
                               **{to: F.sum(c).over(inside) for c, to in sums.items()}})
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)      # one row a partition
    offsets = fixed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), *(F.sum(c).alias(f"_{to}") for c, to in sums.items()))
    offsets = offsets.select("_pid", *(F.coalesce(F.sum(x).over(before), F.lit(0)).alias(x) for x in ["_n", *(f"_{to}" for to in sums.values())]))
    whole = local.join(F.broadcast(offsets), "_pid")
    return (whole.withColumns({name: F.col(name) + F.col("_n"), **{to: F.col(to) + F.col(f"_{to}") for to in sums.values()}})
            .drop("_id", "_pid", "_n", *(f"_{to}" for to in sums.values())))


def count_batches(df: DataFrame, id_col: str, size: int = C.EMBED_BATCH_SIZE, part: tuple[str, ...] = ()) -> DataFrame:
    """batch = floor((row_number - 1) / size) within ``part`` by id.

    The row number inside a group is a global number (range-partitioned
    sort) minus the group's first number (a combinable min), so a large
    group is never numbered by one task."""
    if not part:
        return count_batches(df.withColumn("_all", F.lit(0)), id_col, size, ("_all",)).drop("_all")
    n = global_row_number(df, [F.col(k) for k in part] + [F.col(id_col)], "_g")
    first = n.groupBy(*part).agg(F.min("_g").alias("_g0"))
    n = n.join(first, list(part))
    return n.withColumn("batch", F.floor((F.col("_g") - F.col("_g0")) / size).cast("int")).drop("_g", "_g0")


def next_openers(rows: DataFrame, part: list[str], budget: int) -> DataFrame:
    """(part, at, to): the row that opens the next batch if row ``at`` opens one; none after
    the last batch.  ``rows`` is (part, at, tokens, total), total the sum up to the row.

    A batch from row i holds rows while their total is at most total(i - 1) + budget, the
    bound of i.  The row that a bound falls into (total - tokens <= bound < total) opens the
    next.  Rows and bounds meet by equal intervals of the mean number of tokens, so that a
    row is in as many intervals as it has tokens by the mean, and two more at most."""
    mean = rows.groupBy(*part).agg(F.greatest(F.lit(1), F.ceil(F.avg("tokens"))).alias("width"))
    d = rows.join(mean, part)
    low = F.col("total") - F.col("tokens")
    spans = (d.where("tokens > 0").select(*part, F.col("at").alias("_at"), low.alias("_low"), F.col("total").alias("_high"), F.explode(F.sequence(
        F.floor(low / F.col("width")), F.floor((F.col("total") - 1) / F.col("width")))).alias("slot")))
    bounds = d.select(*part, "at", (low + budget).alias("bound"), F.floor((low + budget) / F.col("width")).alias("slot"))
    met = bounds.join(spans, [*part, "slot"]).where((F.col("_low") <= F.col("bound")) & (F.col("bound") < F.col("_high")))
    return met.select(*part, "at", F.greatest(F.col("_at"), F.col("at") + 1).alias("to"))


def follow(links: DataFrame, part: list[str]) -> DataFrame:
    """(part, at): the rows reached from row 1 of each group over ``links`` (part, at, to),
    by doubling the links' reach in each round."""
    first = links.select(*part).distinct().withColumn("at", F.lit(1).cast("long"))
    reached, jump = stored(first, "openers"), stored(links, "links")
    while not jump.isEmpty():
        more = reached.join(jump, [*part, "at"]).select(*part, F.col("to").alias("at"))
        reached = stored(reached.unionByName(more), "openers")
        ahead = jump.select(*part, F.col("at").alias("to"), F.col("to").alias("_to"))
        jump = stored(jump.join(ahead, [*part, "to"]).select(*part, "at", F.col("_to").alias("to")), "links")
    return reached


def greedy_pack(df: DataFrame, part: list[str], order_col: str, tokens_col: str, budget: int, id_col: str) -> DataFrame:
    """Greedy packing: walk rows by (``order_col``, ``id_col``) inside each ``part`` group,
    start a new batch when the next row would overflow the budget; a row above the budget has
    a batch of its own.  -> (part, id, batch from 0, batch_tokens).  Tokens are 0 or more; the
    ids are told apart inside a group."""
    if not part:
        return greedy_pack(df.withColumn("_all", F.lit(0)), ["_all"], order_col, tokens_col, budget, id_col).drop("_all")
    own = df.select(*part, id_col, F.col(order_col).alias("_order"), F.col(tokens_col).cast("long").alias("tokens"))
    total = stored(numbered_totals(own, [F.col(k) for k in part] + [F.col("_order"), F.col(id_col)], {"tokens": "total"}, "at"), "totals")
    start = total.groupBy(*part).agg((F.min("at") - 1).alias("_at0"), F.min(F.col("total") - F.col("tokens")).alias("_t0"))
    rows = total.join(start, part).withColumns({"at": F.col("at") - F.col("_at0"), "total": F.col("total") - F.col("_t0")}).drop("_at0", "_t0")
    rows = stored(rows, "pack-rows")
    openers = follow(next_openers(rows.select(*part, "at", "tokens", "total"), part, budget), part).withColumn("_open", F.lit(1))
    marked = rows.join(openers, [*part, "at"], "left").withColumn("_open", F.coalesce(F.when(F.col("at") == 1, 1), F.col("_open"), F.lit(0)))
    counted = numbered_totals(marked.select(*part, id_col, "at", "tokens", "_open"), [F.col(k) for k in part] + [F.col("at")],
                              {"_open": "_batch"}, "_row")
    first = counted.groupBy(*part).agg(F.min("_batch").alias("_b0"))
    counted = counted.join(first, part).withColumn("batch", (F.col("_batch") - F.col("_b0")).cast("int"))
    sizes = counted.groupBy(*part, "batch").agg(F.sum("tokens").alias("batch_tokens"))
    return counted.join(sizes, [*part, "batch"]).select(*part, id_col, "batch", "batch_tokens")


def salted_join(big: DataFrame, small: DataFrame, on: list[str], salt_cols: list[str],
                buckets: int | None = None, how: str = "inner") -> DataFrame:
    """Equi-join where one key of ``big`` may hold a large share of its rows (a hub
    entity); ``small`` has one or few rows per key.  A plain join, whose hot partitions the
    adaptive execution splits at run time; with ``buckets``, ``big`` rows get a salt from a
    hash of ``salt_cols`` and ``small`` is sent once per salt, so that it moves ``buckets``
    times.  Results are identical to ``big.join(small, on, how)``."""
    if not buckets:
        return big.join(small, on, how)
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_cols), F.lit(buckets)))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return b.join(s, on + ["_salt"], how).drop("_salt")
