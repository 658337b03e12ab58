"""URL filters: domain rules first, then a list of canonical URLs behind a blocked Bloom filter."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import LOWER, UPPER, need

BITS_PER_KEY = 12
WORDS = 8  # of 64 bits in a block, one bit of each is set by a key
MAX_FILTER_BYTES = 64 << 20  # a larger filter is not broadcast
ROW_BYTES = 8 * (WORDS + 1)
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without a closing slash, query without tracking parameters, no fragment."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, "(^|&)(utm_[a-z]+|ref)=[^&]*", ""), "^&", "")
    site = F.regexp_replace(host_of(url), "^www[.]", "")
    return F.concat(site, F.regexp_replace(path_of(url), "/$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, host, path) that fits, null where none does. Rules are parameters."""
    name = verdict = F.lit(None).cast("string")
    for said, domain, prefix in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        name, verdict = F.when(fits, domain + prefix).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks).cast("long"))


def _masks(key: Column) -> list[Column]:
    bits = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("long")
    shifts = [F.shiftrightunsigned(bits, 6 * j).bitwiseAND(F.lit(63).cast("long")).cast("int") for j in range(WORDS)]
    return [F.call_function("shiftleft", one, s) for s in shifts]


def bloom_filter(keys: DataFrame, n_keys: int) -> tuple[DataFrame, int]:
    """Rows (block, w0..w7) of a blocked Bloom filter over column ``key``, built by bitwise-or; and its number of blocks."""
    n_blocks = max(1, math.ceil(n_keys * BITS_PER_KEY / (64 * WORDS)))
    bits = keys.select(_block(F.col("key"), n_blocks).alias("block"), *[m.alias(f"w{j}") for j, m in enumerate(_masks(F.col("key")))])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{j}").alias(f"w{j}") for j in range(WORDS)]), n_blocks


def listed(rows: DataFrame, key: str, listing: DataFrame, listing_key: str) -> DataFrame:
    """``rows`` with boolean ``is_listed``: whether ``key`` is among ``listing_key``.

    The filter's size follows the list and is checked before it is broadcast; beyond the bound it is joined by block. Keys
    that pass go through an exact join, so false positives fall away; keys that don't pass never meet the list. Null keys and
    an empty list are not listed. A key that very many rows share sits on the side that adaptive execution splits.
    """
    key_is = F.col(f"`{key}`")
    keys = listing.select(F.col(f"`{listing_key}`").alias("key")).where("key is not null").distinct()
    n_keys = keys.count()
    if n_keys == 0:
        return rows.withColumn("is_listed", F.lit(False))
    bloom, n_blocks = bloom_filter(keys, n_keys)
    if n_blocks * ROW_BYTES <= MAX_FILTER_BYTES:
        bloom = F.broadcast(bloom)
    probed = rows.withColumn("_block", _block(key_is, n_blocks)).join(
        bloom.select(F.col("block").alias("_block"), *[F.col(f"w{j}").alias(f"_w{j}") for j in range(WORDS)]), "_block", "left"
    )
    passes = F.lit(True)
    for j, mask in enumerate(_masks(key_is)):
        passes = passes & (F.col(f"_w{j}").bitwiseAND(mask) == mask)
    probed = probed.withColumn("_passes", F.coalesce(passes, F.lit(False)) & key_is.isNotNull())
    columns = [F.col(f"`{c}`") for c in rows.columns]
    known = keys.select(F.col("key").alias("_known"))
    hits = probed.where("_passes").join(known, key_is == F.col("_known"), "left")
    return hits.select(*columns, F.col("_known").isNotNull().alias("is_listed")).unionByName(
        probed.where("not _passes").select(*columns, F.lit(False).alias("is_listed"))
    )


def passing(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` may be among column ``key`` of ``keys``: all that are, and a few others. Nulls never pass.

    The filter is broadcast up to its checked size; a list beyond that gives all rows back, for the exact join that follows.
    """
    n_keys = keys.count()
    if n_keys == 0:
        return rows.where(F.lit(False))
    bloom, n_blocks = bloom_filter(keys, n_keys)
    if n_blocks * ROW_BYTES > MAX_FILTER_BYTES:
        return rows
    probe = bloom.select(F.col("block").alias("_block"), *[F.col(f"w{j}").alias(f"_w{j}") for j in range(WORDS)])
    passes = F.lit(True)
    for j, mask in enumerate(_masks(F.col(key))):
        passes = passes & (F.col(f"_w{j}").bitwiseAND(mask) == mask)
    probed = rows.withColumn("_block", _block(F.col(key), n_blocks)).join(F.broadcast(probe), "_block")
    return probed.where(passes).select(*rows.columns)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], block_list: DataFrame) -> DataFrame:
    """page_id, url, host, path, canonical, rule, is_listed, verdict of every row of ``pages`` (page_id, url).

    The longest fitting rule decides; without one a URL on ``block_list`` (column url) is blocked and any other allowed. A
    null URL, or one without ``://``, has empty host and path, fits no rule and is allowed. Repeated rows stay; an empty table
    gives an empty result.
    """
    url = F.col("url")
    rows = need(pages, "page_id", "url").withColumns({"host": host_of(url), "path": path_of(url), "canonical": canonical(url)})
    rule, said = matching_rule(F.col("host"), F.col("path"), rules)
    blocked = block_list.where(F.col("url").contains("://")).select(canonical(F.col("url")).alias("canonical"))
    rows = listed(rows, "canonical", blocked, "canonical")
    method = F.when(F.col("is_listed"), "block").otherwise("allow")
    return rows.withColumns({"rule": rule, "verdict": F.coalesce(said, method)})
