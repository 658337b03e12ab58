"""Shards of near equal size: sampled splitters cut the key space into ranges, ranges that came out too full are cut again.

A record's key is a hash of its text, then of its id, so copies of a text lie side by side and shards are a mix of all sources. Splitters
are quantiles of a sample that is drawn by size. Ranges only bound what one task sorts: sizes and rows of the ranges are counted exactly
and every record gets its exact place, so shards don't depend on what was drawn.
"""

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plazalens.llm.common import need, parked

DRAWS = 32  # sampled keys a range
RANGE_ROWS = 1 << 20  # rows a range is to hold
MAX_RANGES = 4096  # bounds what the driver sees: DRAWS keys a range
OVERFULL = 2  # times a range's share of bytes or of rows
ROUNDS = 3  # of cutting overfull ranges
# Copies of a text that make up to this share of a shard stay in one shard
GROUP_SHARE = 25


def _hash60(text: Column) -> Column:
    """60 bits of a digest, as SQL engines agree on them; -1 for null."""
    return F.coalesce(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(-1))


def _drawn(rows: DataFrame, chance: Column) -> list[tuple]:
    """Keys with the number of times they were drawn, ``chance`` on average: whole part for sure, the rest by a hash of the key."""
    toss = F.pmod(F.xxhash64("_k1", "_k2", "_salt", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    times = F.floor(chance + toss).cast("long")
    return [tuple(r) for r in rows.select("_k1", "_k2", "_salt", times.alias("times")).where("times > 0").collect()]


def _quantiles(drawn: list[tuple], parts: int) -> list[tuple]:
    """Keys at which ``parts`` ranges of equal draws begin, the first left out."""
    drawn = sorted(drawn)
    if not drawn:
        return []
    reached = np.cumsum([d[3] for d in drawn])
    at = np.searchsorted(reached, reached[-1] * np.arange(1, parts) / parts)
    return [drawn[i][:3] for i in np.unique(at)]


def _range_of(splitters: list[tuple]):
    """The number of splitters up to a key."""
    first = np.array([s[0] for s in splitters], np.int64)

    @F.pandas_udf("int")
    def place(k1: pd.Series, k2: pd.Series, salt: pd.Series) -> pd.Series:
        low, high = np.searchsorted(first, k1, "left"), np.searchsorted(first, k1, "right")
        for i in np.flatnonzero(low < high):
            low[i] = bisect_right(splitters, (k1[i], k2[i], salt[i]), low[i], high[i])
        return pd.Series(low)

    return place("_k1", "_k2", "_salt")


def _counted(rows: DataFrame, splitters: list[tuple]) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """Rows with their range, and bytes and rows by range."""
    rows = rows.withColumn("_range", _range_of(splitters) if splitters else F.lit(0))
    sums = rows.groupBy("_range").agg(F.sum("size"), F.count("*")).collect()
    return rows, {r[0]: (r[1], r[2]) for r in sums}


def _in_ranges(rows: DataFrame, size: int, count: int, least: int) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """Rows in ranges that follow the order of keys; none holds far more than its share, unless one record does."""
    n = min(MAX_RANGES, max(least, -(-count // RANGE_ROWS)))
    splitters = _quantiles(_drawn(rows, F.col("size") * (n * DRAWS / size)), n)
    for _ in range(ROUNDS):
        ranged, held = _counted(rows, splitters)
        full = {k: max(b * n / size, c * n / count) for k, (b, c) in held.items() if c > 1 and max(b * n / size, c * n / count) > OVERFULL}
        if not full:
            break
        # drawn by size and by rows alike, as either may have filled the range
        facts = [(k, *held[k], int(np.ceil(f)) * DRAWS) for k, f in full.items()]
        facts = rows.sparkSession.createDataFrame(facts, "_range int, b long, c long, draws long")
        found = ranged.join(F.broadcast(facts), "_range")  # at most MAX_RANGES rows
        drawn = _drawn(found, F.col("draws") * (F.col("size") / F.col("b") + 1 / F.col("c")) / 2)
        pieces: dict[int, list[tuple]] = {}
        for d in drawn:
            pieces.setdefault(bisect_right(splitters, d[:3]), []).append(d)
        new = {s for k, own in pieces.items() for s in _quantiles(own, int(np.ceil(full[k])))}
        if new <= set(splitters):
            break
        splitters = sorted(new | set(splitters))
    return _counted(rows, splitters)


def _placed(rows: DataFrame, held: dict[int, tuple[int, int]]) -> DataFrame:
    """Adds ``_start``, the bytes before the record in the whole order, and ``_pos``, the records before it."""
    before, at, above = [], 0, 0
    for k in sorted(held):
        before.append((k, at, above))
        at, above = at + held[k][0], above + held[k][1]
    offsets = rows.sparkSession.createDataFrame(before, "_range int, _bytes long, _rows long")
    order = Window.partitionBy("_range").orderBy("_k1", "_k2", "doc_id", "_salt")
    rows = rows.withColumn("_within", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    rows = rows.withColumn("_nth", F.row_number().over(order) - 1).join(F.broadcast(offsets), "_range")
    return rows.withColumn("_start", F.col("_bytes") + F.col("_within")).withColumn("_pos", F.col("_rows") + F.col("_nth"))


def _cuts(rows: DataFrame, size: int, n_shards: int) -> list[int]:
    """Bytes before each shard but the first. A group of copies that a border falls into goes whole to the side that holds its middle,
    so does a record of a group too large for that."""
    within = F.array(*[F.lit(size * k) for k in range(1, n_shards)])
    met = F.exists(within, lambda b: (F.col("_start") * n_shards <= b) & (b < (F.col("_start") + F.col("size")) * n_shards))
    found = {r["_start"]: (r["size"], r["_k1"]) for r in rows.where(met).select("_start", "size", "_k1").collect()}  # one a border
    keys = list({k for _, k in found.values()})
    groups = rows.where(F.col("_k1").isin(keys)).groupBy("_k1").agg(F.min("_start"), F.sum("size")).collect()
    groups = {r[0]: (r[1], r[2]) for r in groups}
    cuts = []
    for k in range(1, n_shards):
        start = max(s for s in found if s * n_shards <= size * k)
        length, key = found[start]
        if groups[key][1] * GROUP_SHARE * n_shards <= size:
            start, length = groups[key]
        before_middle = 2 * size * k < n_shards * (2 * start + length)
        cuts.append(start if before_middle else start + length)
    return cuts


def shards(docs: DataFrame, n_shards: int = 8, *carried: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the columns ``carried``, of every row.

    Size is the text's UTF-8 bytes plus 1; a null text has no bytes, its checksum is that of none. Shards hold near equal sizes (law
    ``bytes``): off by half a record or half a group of copies at each border. Copies stay in one shard unless they are larger than a
    GROUP_SHAREth of one. Slots count a shard's rows from 0 by hash of text and id; rows alike in both take theirs in any order.
    ``grown_shard`` is null, as the law says nothing on a further shard. Null ids are ids like others. A record larger than a shard may
    leave one empty; an empty table gives no rows. Other columns of the input are not read; a carried one may not be named like a result's.
    """
    if n_shards < 1:
        raise ValueError("at least one shard")
    spark = docs.sparkSession
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    rows = need(docs, "doc_id", "text", *[c for c in carried if c not in ("doc_id", "text")]).select(
        "doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), _hash60(F.col("text")).alias("_k1"),
        _hash60(F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("-"))).alias("_k2"),
        F.monotonically_increasing_id().alias("_salt"), *[F.col(f"`{c}`") for c in carried if c != "doc_id"],
    )
    rows = parked(rows, "shard-rows")
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    shown = ["doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard")]
    shown += [F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *[F.col(f"`{c}`") for c in carried if c != "doc_id"]]
    if not count:
        return rows.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0)).select(*shown)
    keys = rows.select("doc_id", "size", "_k1", "_k2", "_salt")
    ranged, held = _in_ranges(keys, total, count, 4 * n_shards)
    placed = parked(_placed(ranged, held).select("size", "_k1", "_salt", "_start", "_pos"), "shard-places")
    cuts = F.array(*[F.lit(c).cast("long") for c in _cuts(placed, total, n_shards)])
    placed = placed.withColumn("shard", F.size(F.filter(cuts, lambda c: c <= F.col("_start"))))
    first = placed.groupBy("shard").agg(F.min("_pos").alias("_first"))
    placed = placed.join(F.broadcast(first), "shard")  # a row a shard
    placed = placed.select("_salt", "shard", (F.col("_pos") - F.col("_first")).alias("slot"))
    return rows.join(placed, "_salt").select(*shown)


def write_shards(docs: DataFrame, path: str, n_shards: int = 8, files: int | None = None) -> None:
    """All columns of ``docs`` as Parquet, a folder ``shard=k`` a shard, rows of a file in the order of slots; ``files`` in all, else as many as Spark finds fit."""
    row = docs.select("doc_id", "text", F.struct("*").alias("row"))
    found = shards(row, n_shards, "row").select("shard", "slot", "row")
    dealt = found.repartitionByRange(files, "shard", "slot") if files else found.repartitionByRange("shard", "slot")
    flat = dealt.sortWithinPartitions("shard", "slot").select(F.col("shard").alias("_shard"), "row.*")
    flat.withColumnRenamed("_shard", "shard").write.partitionBy("shard").parquet(path)
