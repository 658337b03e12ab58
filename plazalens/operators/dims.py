"""Joining facts with dimensions, with a checked size before anything is broadcast or written into a plan."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.functions.text import computed_once

# A dimension up to LITERAL_ROWS goes into the plan as a hash set; up to BROADCAST_ROWS (a few short columns each)
# it is broadcast; beyond that it is shuffled, with the facts of one key spread over SALTS tasks, or over fewer where the copies of the
# dimension would be more than COPIES rows: those of a hot key are then left to Spark's skew handling.
LITERAL_ROWS = 5_000
BROADCAST_ROWS = 200_000
SALTS = 32
COPIES = SALTS * BROADCAST_ROWS
# Keys of a row that meet a broadcast dimension in place; rows with more keys take the joins on the row
SLOTS = 6


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; stops counting one past the bound."""
    return df.limit(rows + 1).count() <= rows


def small_rows(df: DataFrame, rows: int = LITERAL_ROWS) -> list | None:
    """All rows when there are at most ``rows`` of them, else None."""
    found = df.limit(rows + 1).collect()
    return found if len(found) <= rows else None


def never_broadcast(side: DataFrame) -> DataFrame:
    """``side`` of a join that is to be shuffled, whatever Spark takes the sizes for.

    Spark goes by file sizes and column widths: neither the rows that an array gives nor deflated text count there, so that millions of rows
    can pass for a few megabytes, which the driver would have to gather.
    """
    return side.hint("merge")


def left_join_dimension(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    spread_by: Column | None = None,
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``facts`` joined with ``dim`` on ``key``: broadcast when small enough, else shuffled.

    ``spread_by`` names a fact column with many values per key (a post id). With it, the shuffled join salts: a key
    that holds a third of the facts runs in ``SALTS`` tasks, at the price of ``SALTS`` copies of the dimension; a dimension of more than
    ``BROADCAST_ROWS`` rows is copied less often, so that the copies don't outgrow the facts.
    """
    if at_most(dim, broadcast_rows):
        return facts.join(F.broadcast(dim), key, how)
    salts = min(SALTS, COPIES // max(1, dim.count())) if spread_by is not None else 1
    if salts <= 1:
        return facts.join(never_broadcast(dim), key, how)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(never_broadcast(copies), [key, "_salt"], how).drop("_salt")


def _lookup_in_place(keyed: DataFrame, dim: DataFrame, dim_key: str, dim_value: str, out: str) -> DataFrame:
    """Adds ``out`` to rows with at most SLOTS ``_keys``: one broadcast, met by each place of the array, so that no row moves."""
    hits = []
    for i in range(SLOTS):
        key, value = F.col(f"_key_{i}"), F.col(f"_value_{i}")
        told = dim.select(F.col(dim_key).alias(f"_key_{i}"), F.col(dim_value).alias(f"_value_{i}"))
        keyed = keyed.join(F.broadcast(told), F.get("_keys", F.lit(i)) == key, "left")
        hits.append(F.when(key.isNotNull(), F.struct(key.alias(dim_key), value.alias(dim_value))))
    found = keyed.withColumn("_hits", F.array_compact(F.array(*hits))).drop(*[f"{c}_{i}" for c in ("_key", "_value") for i in range(SLOTS)])
    return found.withColumn(out, F.when(F.size("_hits") > 0, F.map_from_entries("_hits"))).drop("_hits", "_keys")


def attach_lookup(
    df: DataFrame,
    row_key: str,
    keys: Column,
    dim: DataFrame,
    dim_key: str,
    dim_value: str,
    out: str,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Adds a map column ``out`` from each of the row's ``keys`` found in ``dim`` to its value.

    The route for dimensions too large for a plan literal. ``dim_key`` must be unique in ``dim``. Rows of up to SLOTS keys stay where they
    are if the dimension can be broadcast. Of the others only (row key, key) pairs travel to the dimension, and they are made distinct
    first, so repeated copies of a row do not pile up.
    A row whose ``row_key`` is null is known by its keys instead, which give the same map to every row that has them.
    """
    own = F.filter(F.array_distinct(keys), lambda k: k.isNotNull())
    if not at_most(dim, broadcast_rows):
        return _lookup_joined(df, row_key, own, dim, dim_key, dim_value, out, broadcast_rows)
    keyed = df.withColumn("_keys", own)
    # the flag is kept from moving below the columns that it is made of, which the rows that stay would compute twice
    few = keyed.withColumn("_few", computed_once(F.coalesce(F.size("_keys") <= SLOTS, F.lit(True)))).where("_few").drop("_few")
    many = keyed.where(F.size("_keys") > SLOTS).drop("_keys")
    rest = _lookup_joined(many, row_key, own, dim, dim_key, dim_value, out, broadcast_rows)
    return _lookup_in_place(few, dim, dim_key, dim_value, out).unionByName(rest)


def _lookup_joined(
    df: DataFrame, row_key: str, own: Column, dim: DataFrame, dim_key: str, dim_value: str, out: str, broadcast_rows: int
) -> DataFrame:
    # rows with neither find nothing; numbers keep them from meeting in one task
    apart = F.concat(F.lit("n"), F.monotonically_increasing_id().cast("string"))
    by_keys = F.when(F.size(own) > 0, F.concat(F.lit("k"), F.sha2(F.to_json(F.array_sort(own)), 256))).otherwise(apart)
    keyed = df.withColumn("_row", F.coalesce(F.concat(F.lit("i"), F.col(row_key).cast("string")), by_keys))
    pairs = keyed.select("_row", F.explode(own).alias(dim_key)).distinct()
    hits = left_join_dimension(
        pairs, dim.select(dim_key, dim_value), dim_key, F.col("_row"), "inner", broadcast_rows
    )
    per_row = hits.groupBy("_row").agg(F.map_from_entries(F.collect_set(F.struct(dim_key, dim_value))).alias(out))
    return keyed.join(per_row, "_row", "left").drop("_row")
