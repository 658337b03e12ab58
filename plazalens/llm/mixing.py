"""Mixing sources to target weights by subset-sum budget fitting.

Every source has a budget of words. Whole passes over the source are taken first; what is left of the budget is filled from the
counts of documents by exact length: an even share of every length, then bounded-knapsack dynamic programming for the remainder.
Within a length the documents are picked by a seeded hash.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalens.llm.common import need, parked

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 42
# The remainder that dynamic programming fills, in times of the longest usable document; larger ones are first cut down
DP_LENGTHS = 2


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` (0..) by code point of ``source``, null last: sorted by range, numbered per range, shifted by the
    counts of the ranges before, so that no task sees all of them."""
    # UTF-8 order is code-point order; null goes last
    ordered = sources.repartitionByRange(F.col("source").isNull(), "source").withColumn("_part", F.spark_partition_id())
    ordered = parked(ordered, "sources")
    counts = ordered.groupBy("_part").count().toPandas().sort_values("_part")  # a row for each partition
    before, total = [], 0
    for part, n in zip(counts["_part"], counts["count"]):
        before.append((int(part), total))
        total += int(n)
    offsets = sources.sparkSession.createDataFrame(before or [(0, 0)], "_part int, _before long")
    in_part = Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())
    out = ordered.withColumn("rank", F.row_number().over(in_part) - 1).join(F.broadcast(offsets), "_part")
    return out.withColumn("rank", F.col("rank") + F.col("_before")).drop("_part", "_before")


def targets(sources: DataFrame, share: float = 1.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: ``share`` of all words by weight (``weights`` repeat along the rank),
    at most MAX_REPEATS times the source's size; what is cut is shared again by weight until no source is above.

    The level ``v`` with sum(min(cap, v * weight)) = total is found by passes over the sources: each one fixes the sources that
    the level puts above their cap, as the definition does. No words at all give targets of 0.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = ranked(sources).withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
    rows = rows.withColumn("cap", F.lit(float(MAX_REPEATS)) * F.col("source_size"))
    total = rows.agg(F.sum("source_size")).first()[0]
    level, capped = 0.0, -1
    while total:
        is_capped = F.lit(capped >= 0) & (F.col("cap") <= F.col("weight") * level)
        fixed, free, n = rows.agg(
            F.sum(F.when(is_capped, F.col("cap")).otherwise(0.0)),
            F.sum(F.when(is_capped, 0.0).otherwise(F.col("weight"))),
            F.count(F.when(is_capped, 1)),
        ).first()
        if n == capped or not free:
            break
        level, capped = (share * total - fixed) / free, n
    return rows.withColumn("target", F.least(F.col("cap"), F.col("weight") * level)).drop("rank", "weight", "cap")


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: float) -> np.ndarray:
    """How many documents of each length to take, so that their words come as near to ``budget`` as the counts allow.

    An even share of every length leaves a remainder of a few documents a length. Long documents cut it down to DP_LENGTHS times
    the longest one that may still fit, and dynamic programming over the counts left picks the nearest sum.
    """
    usable = lengths > 0
    take = np.zeros(len(lengths), np.int64)
    size = float((lengths * counts).sum())
    if budget <= 0 or size == 0:
        return take
    if budget >= size:
        return np.where(usable, counts, 0)
    take[usable] = np.floor(counts[usable] * (budget / size)).astype(np.int64)
    rest = budget - float((lengths * take).sum())
    order = np.argsort(-lengths)
    order = order[usable[order]]
    for i in order:  # longest first, one round, while more than the programming's range remains
        spare, longest = counts[i] - take[i], lengths[order[0]]
        if rest <= DP_LENGTHS * longest:
            break
        more = min(int(spare), max(0, int((rest - longest) // lengths[i])))
        take[i] += more
        rest -= more * float(lengths[i])
    return take + _knapsack(lengths, np.where(usable, counts - take, 0), rest)


def _knapsack(lengths: np.ndarray, counts: np.ndarray, rest: float) -> np.ndarray:
    """Bounded knapsack: reachable sums as the bits of one integer; each step remembers what it made reachable first."""
    take = np.zeros(len(lengths), np.int64)
    goal = round(rest)
    if goal <= 0:
        return take
    bound = goal + int(lengths.max(initial=0))  # the nearest sum may lie above
    keep = (1 << (bound + 1)) - 1
    reach, steps = 1, []
    for i in np.argsort(lengths):
        length, left, bundle = int(lengths[i]), int(min(counts[i], bound // max(1, lengths[i]))), 1
        while left > 0:  # counts in bundles of 1, 2, 4, ...
            n = min(bundle, left)
            new = (reach << (n * length)) & keep & ~reach
            if new:
                steps.append((new, i, n, n * length))
                reach |= new
            left -= n
            bundle *= 2
        if reach >> goal & 1:
            break
    below = (reach & ((1 << (goal + 1)) - 1)).bit_length() - 1
    above = reach >> (goal + 1)
    nearest = below
    if above:
        up = goal + 1 + ((above & -above).bit_length() - 1)
        nearest = up if up - rest < rest - below else below
    for new, i, n, words in reversed(steps):
        if new >> nearest & 1:
            take[i] += n
            nearest -= words
    return take


def _plans(keys, pdf: pd.DataFrame) -> pd.DataFrame:
    size, target = float(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    passes = min(MAX_REPEATS, int(target // size)) if size else 0
    lengths, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    picked = fit_counts(lengths, counts, target - passes * size) if passes < MAX_REPEATS else np.zeros(len(pdf), np.int64)
    return pdf[["source", "size", "n"]].assign(passes=passes, picked=picked)


def picks(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` with boolean ``extra``: of the ``n`` rows of each (source, size), the ``picked`` ones least by seeded hash.

    A group is cut into about sqrt(n) buckets by hash. Counts of the buckets tell which are in, which are out and which one holds the
    border; only that one is ranked. So a length that a third of all rows share never meets in one task.
    """
    unit = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("digest")), F.lit(1 << 40).cast("long"))
    buckets = F.ceil(F.sqrt(F.col("n").cast("double"))).cast("long")
    rows = rows.withColumn("_u", unit).withColumn("_b", (F.col("_u") * 1.0 / (1 << 40) * buckets).cast("long"))
    partly = rows.where("picked > 0 and picked < n")
    group = ["source", "size"]
    counted = partly.groupBy(*group, "_b").agg(F.count("*").alias("_c"), F.first("picked").alias("_picked"))
    in_order = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("_room", F.col("_picked") - F.coalesce(F.sum("_c").over(in_order), F.lit(0)))
    counted = counted.select(F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("_b").alias("_at"), "_c", "_room")
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("_b") == F.col("_at"))
    joined = partly.join(counted, same)
    at_border = (F.col("_room") > 0) & (F.col("_room") < F.col("_c"))
    order = Window.partitionBy(*group, "_b").orderBy("_u", "digest", "doc_id", "row")
    inside = joined.where(at_border).withColumn("extra", F.row_number().over(order) <= F.col("_room"))
    outside = joined.where(~at_border).withColumn("extra", F.col("_room") > 0)
    whole = rows.where("picked = 0 or picked = n").withColumn("extra", F.col("picked") > 0)
    names = [*[c for c in rows.columns if c not in ("_u", "_b")], "extra"]
    return whole.select(*names).unionByName(inside.select(*names)).unionByName(outside.select(*names))


def mix(docs: DataFrame, size: Column, share: float = 1.0, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """row, doc_id, source, size, source_size, target, repeats of every row of ``docs`` (doc_id, source, text).

    ``repeats`` says how often the mix takes the document, 0 to MAX_REPEATS. Null sources are a source of their own; documents
    without words have size 0 and repeats of 0; repeated rows count each by itself; an empty table gives an empty result. ``row``
    numbers the input's rows. Reruns agree, as picks follow hashes of id and text.
    """
    narrow = need(docs, "doc_id", "source", "text").select(
        "doc_id", "source", size.alias("size"), F.xxhash64("text").alias("digest"), F.monotonically_increasing_id().alias("row")
    )
    narrow = parked(narrow, "sizes")
    goals = parked(targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), share, weights), "targets")
    lengths = narrow.groupBy("source", "size").agg(F.count("*").alias("n"))
    goal = goals.withColumnRenamed("source", "_s")
    lengths = lengths.join(goal, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # a group holds the distinct lengths of one source: bounded by the longest text, not by the rows
    schema = "source string, size long, n long, passes long, picked long"
    plan = parked(lengths.groupBy("source").applyInPandas(_plans, schema), "plan")
    plan = plan.join(goal, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    plan = plan.withColumnsRenamed({"source": "_s", "size": "_z"})
    rows = narrow.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))).drop("_s", "_z")
    chosen = picks(parked(rows, "sized"), seed)
    repeats = F.when(F.col("size") == 0, 0).otherwise(F.col("passes") + F.col("extra").cast("long")).cast("long")
    return chosen.select("row", "doc_id", "source", "size", "source_size", "target", repeats.alias("repeats"))
