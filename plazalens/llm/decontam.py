"""Benchmark decontamination by winnowing: the least gram hash of every window of grams is a fingerprint of item and document alike.

A shared span of WINDOW words holds a whole window of grams on both sides and so shares a fingerprint. Fingerprints find the
documents; there every gram of an item found again lies on a diagonal (document place minus item place), and neighbouring grams of a
diagonal are extended to the spans that hold a window. Words and grams are compared by 64-bit hashes.
"""

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import ascii_lower, need, parked
from plazalens.llm.urls import passing

WINDOW = 10  # words of an item in a row that make a document word a hit
GRAM = 5
GRAMS = WINDOW - GRAM + 1  # to a window of grams
# Bytes that are no part of a word, in lower case or not
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 1 << 20  # fingerprints of a benchmark beyond this are joined by shuffle; a row is 32 bytes at most
NO_ITEMS = hashlib.sha256(b"").hexdigest()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _places(n: Column, at_least: int) -> Column:
    """0 to n - at_least, nothing if that is below 0."""
    return F.when(n >= at_least, F.sequence(F.lit(0), n - at_least)).otherwise(F.array().cast("array<int>"))


def _grams(hashes: Column, size: int) -> Column:
    return F.transform(
        _places(F.size(hashes), size), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(size)])
    )


def _grams_of(size: int) -> Callable[[Column], Column]:
    return lambda hashes: _grams(hashes, size)


def _winnowed(hashes: Column) -> Column:
    def least(grams):
        starts = _places(F.size(grams), GRAMS)
        return F.transform(starts, lambda i: F.least(*[F.get(grams, i + j) for j in range(GRAMS)]))

    return let(_grams(hashes, GRAM), least)


def fingerprints(word_array: Column, short: list[int]) -> Column:
    """Distinct fingerprints: winnowed grams, and all grams of the lengths that ``short`` items have."""

    def of(hashes):
        return F.array_distinct(F.concat(_winnowed(hashes), *[_grams(hashes, n) for n in short]))

    return let(F.transform(word_array, lambda w: F.xxhash64(w)), of)


def _anchors(items: DataFrame, n_words: Column, short: list[int]) -> DataFrame:
    """n (words of the item), item_id, item (its words' hash, as ids may repeat), place, fp: all grams of long items, the one gram of
    short ones."""
    hashed = F.transform("words", lambda w: F.xxhash64(w))
    grams = F.when(n_words >= WINDOW, let(hashed, _grams_of(GRAM)))
    for n in short:
        grams = grams.when(n_words == n, let(hashed, _grams_of(n)))
    return items.select(n_words.alias("n"), "item_id", F.xxhash64("words").alias("item"), F.posexplode(grams).alias("place", "fp"))


def _runs(at: Column) -> Column:
    """Spans of words (start, stop) that the runs of neighbouring grams at the sorted places ``at`` cover."""
    starts = F.filter(at, lambda x, i: (i == 0) | (F.get(at, i - 1) < x - 1))
    lasts = F.filter(at, lambda x, i: (i == F.size(at) - 1) | (F.get(at, i + 1) > x + 1))
    return F.zip_with(starts, lasts, lambda a, b: F.struct(a.alias("start"), (b + GRAM).alias("stop")))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """key, item_id, start, stop: spans of words of the text with md5 ``key`` in which ``benchmark`` (item_id, text) occurs.

    The result is one for each distinct text, so copies cost nothing. Null texts have no words; an item without words never occurs.
    An item of null id is found like any other, its hits have a null item_id.
    """
    items = need(benchmark, "item_id", "text").select("item_id", words(F.col("text")).alias("words"))
    items = parked(items.where(F.size("words") > 0).distinct(), "items")
    n_words = F.size("words")
    short = sorted(r[0] for r in items.select(n_words).where(n_words < WINDOW).distinct().collect())  # 9 values at most
    item_prints = items.select(F.explode(fingerprints(F.col("words"), short)).alias("fp")).distinct()
    anchors = parked(_anchors(items, n_words, short), "anchors")
    n_anchors = anchors.count()

    text = need(docs, "text").where("text is not null")
    key = F.md5("text").alias("key")
    prints = text.select(key, F.explode(fingerprints(words(F.col("text")), short)).alias("fp"))
    keys = parked(prints.join(_bounded(item_prints, n_anchors), "fp", "left_semi").select("key").distinct(), "contaminated")
    # texts that may hold an item, one of each
    texts = passing(text.withColumn("key", F.md5("text")), "key", keys).groupBy("key").agg(F.first("text").alias("text"))
    texts = parked(texts.join(keys, "key", "left_semi").select("key", words(F.col("text")).alias("words")), "suspects")

    own = F.transform("words", lambda w: F.xxhash64(w))
    long, brief = anchors.where(f"n >= {WINDOW}").drop("n"), anchors.where(f"n < {WINDOW}").drop("place")
    places = texts.select("key", F.posexplode(let(own, _grams_of(GRAM))).alias("at", "fp"))
    met = places.join(_bounded(long, n_anchors), "fp")
    # a group is one item laid along one text: no more places than the item has grams
    diagonals = met.groupBy("key", "item_id", "item", (F.col("at") - F.col("place")).alias("shift")).agg(F.sort_array(F.collect_set("at")).alias("at"))
    found = diagonals.select("key", "item_id", F.explode(_runs(F.col("at"))).alias("s")).where(f"s.stop - s.start >= {WINDOW}")
    found = found.select("key", "item_id", "s.start", "s.stop")
    for n in short:
        places = texts.select("key", F.lit(n).alias("n"), F.posexplode(let(own, _grams_of(n))).alias("at", "fp"))
        whole = places.join(_bounded(brief, n_anchors), ["fp", "n"])
        found = found.unionByName(whole.select("key", "item_id", F.col("at").alias("start"), (F.col("at") + n).alias("stop")))
    return parked(found, "hits")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *keep: str) -> DataFrame:
    """``keep``, n_words, n_hit, items (sorted as strings) of every row of ``docs`` (text).

    Items of null id count in n_hit and have no name in items. Null and empty texts have no words and no hits; repeated rows repeat; an empty benchmark hits nothing; an empty table gives an
    empty result. Only suspect texts are looked at twice.
    """
    found = hits(docs, benchmark)
    covered = found.select("key", F.explode(F.sequence(F.col("start"), F.col("stop") - 1)).alias("at")).distinct()
    covered = covered.groupBy("key").agg(F.count("*").alias("n_hit"))
    names = found.select("key", F.col("item_id").cast("string").alias("item")).distinct()
    names = names.groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("items"))  # of one text; null ids are left out
    result = parked(covered.join(names, "key"), "hit-texts")
    columns = list(dict.fromkeys(keep))
    rows = need(docs, *dict.fromkeys([*columns, "text"]))
    n_words = F.size(F.array_remove(F.split("text", NOT_WORD), "")).cast("long")
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(columns)]
    # rows without text keep apart from the join, their null keys would meet in one task
    blank = rows.where("text is null").select(*kept, F.lit(0).cast("long").alias("n_words"))
    rows = rows.where("text is not null").select(*kept, n_words.alias("n_words"), F.md5("text").alias("key"))
    joined = rows.join(result, "key", "left").unionByName(blank, allowMissingColumns=True)
    return joined.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(columns)], "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
