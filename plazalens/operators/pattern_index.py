"""Pattern lists of any length: an index says which patterns a text may match, and only those are tried on it.

A pattern is filed under strings one of which each of its matches contains, the rarest ones among the patterns. A text meets a pattern if
it holds such a string. Patterns without one are filed under the empty string and meet every text.
"""

import json
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.functions.find import find_all, first_hit, first_match, first_names, fuzzy_find_all, hits_of, keyword_hits, names_of, rescan
from plazalens.functions.patterns import cut_pattern, has_fuzzy_syntax, java_pattern, needed_strings, start_sensitive
from plazalens.functions.text import let
from plazalens.operators.dims import left_join_dimension, small_rows
from plazalens.session import shared_dir

# Lists up to this length are written into the plan, longer ones are indexed; the hits are the same
PLAN_PATTERNS = 500
KEY_LENGTHS = (6, 4, 2, 1)
# Indexes up to this many entries go to every task, which finds their keys where the texts are; more meet the texts by a join
HELD_ENTRIES = 5000
FIELDS = ("ord", "copy", "list", "pattern", "name", "java", "cut", "sensitive", "fuzzy")


def _described(pattern: Column) -> Column:
    @F.pandas_udf("keys array<array<string>>, java string, cut string, sensitive boolean, fuzzy boolean")
    def describe(patterns: pd.Series) -> pd.DataFrame:
        def keys(needed: str) -> list[str]:
            size = next((n for n in KEY_LENGTHS if n <= len(needed)), 0)
            return sorted({needed[i:i + size] for i in range(len(needed) - size + 1)})

        rows = []
        for p in patterns:
            if p.replace(" ", "").isalnum():
                # a plain word needs itself, and no parser
                rows.append(([keys(p)], java_pattern(p), java_pattern(p), False, False))
                continue
            cut, fuzzy = cut_pattern(p), has_fuzzy_syntax(p)
            rows.append((
                [keys(s) for s in needed_strings(p)], java_pattern(p), None if cut is None or fuzzy else java_pattern(cut),
                start_sensitive(p), fuzzy,
            ))
        return pd.DataFrame(rows, columns=["keys", "java", "cut", "sensitive", "fuzzy"])

    return describe(pattern)


@dataclass
class PatternIndex:
    entries: DataFrame  # _key, list, ord, copy, pattern, name, java, cut, sensitive, fuzzy
    lengths: list[int]  # of the keys
    in_scan: bool  # no pattern needs the Arrow route
    held: list | None  # the entries in order, each with all its keys, if they are few


def pattern_index(patterns: DataFrame) -> PatternIndex:
    """Index of ``patterns`` (list, ord, pattern, name), written to the shared folder. Null patterns are left out, repeated rows stay."""
    rows = patterns.where("pattern is not null").groupBy("list", "ord", "pattern", "name").agg(F.count("*").alias("_n"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).drop("_n")
    # parsing is dear for what a pattern weighs, so it is dealt by tasks, not by bytes
    distinct = rows.select("pattern").distinct().repartition(patterns.sparkSession.sparkContext.defaultParallelism)
    told = distinct.withColumn("_told", _described(F.col("pattern"))).select("pattern", "_told.*")
    parts = told.select("pattern", F.posexplode("keys").alias("_part", "_keys"))
    parts = parts.select("pattern", "_part", F.explode("_keys").alias("_key"))
    used = parts.groupBy("_key").agg(F.count("*").alias("_used"))
    rarest = parts.join(used, "_key").groupBy("pattern", "_part").agg(F.min_by("_key", F.struct("_used", "_key")).alias("_key"))
    filed = rarest.select("pattern", "_key").distinct().join(told.drop("keys"), "pattern").join(rows, "pattern")
    folder = f"{shared_dir(patterns.sparkSession)}/patterns-{uuid.uuid4().hex}"
    filed.select("_key", "list", "ord", "copy", "pattern", "name", "java", "cut", "sensitive", "fuzzy").write.parquet(folder)
    entries = patterns.sparkSession.read.parquet(folder)
    facts = entries.agg(
        F.collect_set(F.length("_key")).alias("lengths"),
        F.coalesce(F.bool_and(F.col("cut").isNotNull() | ~F.col("sensitive") & ~F.col("fuzzy")), F.lit(True)).alias("in_scan"),
    ).first()
    several = entries.groupBy(*FIELDS).agg(F.collect_set("_key").alias("_keys"))
    held = small_rows(several.orderBy(*[F.col(f).asc_nulls_first() for f in FIELDS]), HELD_ENTRIES)
    return PatternIndex(entries, sorted(facts.lengths), facts.in_scan, held)


class KeyFinder:
    """Which of the ``keys`` (bytes) stand in which of many texts laid end to end: windows of up to WIDE bytes are numbers, and a table
    of bits leaves few of them to look up. The rest of a longer key is compared where its first bytes stand."""

    WIDE, BITS, PIECE = 8, 20, 1 << 20
    MIX = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: list[bytes]):
        self.keys, self.groups = keys, []
        for long in (False, True):
            for size in sorted({min(len(k), self.WIDE) for k in keys if k and (len(k) > self.WIDE) == long}):
                of = [i for i, k in enumerate(keys) if min(len(k), self.WIDE) == size and (len(k) > self.WIDE) == long]
                codes = np.array([int.from_bytes(keys[i][:size], "little") for i in of], np.uint64)
                order = np.argsort(codes, kind="stable")
                table = np.zeros(1 << self.BITS, bool)
                table[self._slot(codes)] = True
                self.groups.append((size, long, codes[order], np.array(of)[order], table))

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes * self.MIX) >> np.uint64(64 - self.BITS)

    def find(self, texts: list[bytes]) -> list[set[int]]:
        """Numbers of the keys in each text; an empty key is in none."""
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        data = b"".join([*texts, bytes(self.WIDE)])
        found: list[set[int]] = [set() for _ in texts]
        for start in range(0, len(data) - self.WIDE, self.PIECE):
            windows = np.ndarray(min(self.PIECE, len(data) - self.WIDE - start), "<u8", data, start, (1,)).copy()
            for size, long, codes, numbers, table in self.groups:
                now = windows & np.uint64((1 << 8 * size) - 1)
                at = np.flatnonzero(table[self._slot(now)])
                first, after = (np.searchsorted(codes, now[at], side) for side in ("left", "right"))
                at, first, after = (a[after > first] for a in (at, first, after))
                place = at + start
                row = np.searchsorted(ends, place, "right")
                if not long:
                    inside = place + size <= ends[row]
                    for pair in np.unique(row[inside] * len(codes) + first[inside]).tolist():
                        found[pair // len(codes)].add(int(numbers[pair % len(codes)]))
                    continue
                for r, p, i, j in zip(row.tolist(), place.tolist(), first.tolist(), after.tolist()):
                    end = int(ends[r])
                    found[r].update(int(n) for n in numbers[i:j] if p + len(self.keys[n]) <= end and data.startswith(self.keys[n], p))
        return found


def _held_candidates(text: Column, held: list, kind: str) -> Column:
    """The entries of ``held`` that may match ``text``, found in an Arrow worker: no text is moved, only their numbers come back."""
    filed: dict[bytes, list[int]] = {}
    for i, entry in enumerate(held):
        for key in entry["_keys"]:
            filed.setdefault(key.encode(), []).append(i)
    always, keys = filed.pop(b"", []), list(filed)
    lists = [filed[k] for k in keys]

    @F.pandas_udf("array<int>")
    def numbers(texts: pd.Series) -> pd.Series:
        finder = KeyFinder(keys)
        known = [t for t in texts if t is not None]
        sets = iter(finder.find(known))
        return pd.Series([None if t is None else sorted({*always, *(i for k in next(sets) for i in lists[k])}) for t in texts], dtype=object)

    entries = F.from_json(F.lit(json.dumps([{f: e[f] for f in FIELDS} for e in held])), kind)
    return F.transform(numbers(text.cast("binary")), lambda i: F.get(entries, i))


def _keys_in(text: Column, lengths: list[int]) -> Column:
    def of(chars: Column, size: int) -> Column:
        last = F.size(chars) - size
        here = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.concat(*[F.get(chars, i + j) for j in range(size)]))
        return F.when(last >= 0, here).otherwise(F.array().cast("array<string>"))

    def all_keys(chars: Column) -> Column:
        return F.concat(*[of(chars, n) if n else F.array(F.lit("")) for n in lengths])

    return F.array_distinct(let(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), all_keys))


def attach_candidates(df: DataFrame, text: Column, index: PatternIndex, out: str, held: bool = True, **join) -> DataFrame:
    """Adds ``out``: the entries of ``index`` that may match ``text``, by ``ord``; empty where there is none or the text is null.

    An index of up to HELD_ENTRIES entries goes to the texts, unless ``held`` is unset. Else equal texts are one before they meet the
    index, and only (hash of the text, key) pairs travel to it. Those are joined by broadcast if the index is small, else with salted
    keys; a text that many rows share is split by the join's skew handling. The candidates are the same.
    """
    types = dict(index.entries.dtypes)
    kind = "array<struct<" + ",".join(f"`{f}`:{types[f]}" for f in FIELDS) + ">>"
    none = F.array().cast(kind)
    if not index.lengths:
        return df.withColumn(out, none)
    if held and index.held is not None:
        return df.withColumn(out, F.coalesce(_held_candidates(text, index.held, kind), none))
    own = F.sha2(text, 256)
    texts = df.select(own.alias("_text_key"), text.alias("_text")).where("_text is not null")
    texts = texts.groupBy("_text_key").agg(F.first("_text").alias("_text"))
    pairs = texts.select("_text_key", F.explode(_keys_in(F.col("_text"), index.lengths)).alias("_key"))
    met = left_join_dimension(pairs, index.entries, "_key", F.col("_text_key"), "inner", **join)
    found = met.groupBy("_text_key").agg(F.array_sort(F.collect_set(F.struct(*FIELDS))).alias(out))
    # rows without a text find nothing; numbers keep them from meeting in one task
    apart = F.concat(F.lit("n"), F.monotonically_increasing_id().cast("string"))
    keyed = df.withColumn("_text_key", F.coalesce(own, apart))
    return keyed.join(found, "_text_key", "left").drop("_text_key").withColumn(out, F.coalesce(out, none))


class PlanSearch:
    """Search with lists that are written into the plan: joined patterns by list, and the entries that give names."""

    def __init__(self, joined: dict[str, str], entries: list[tuple[str, str]]):
        self.joined, self.entries = joined, entries

    def first(self, name: str, c: Column) -> Column:
        return first_hit(c, self.joined[name])

    def all(self, name: str, c: Column, mode: str = "auto") -> Column:
        return find_all(c, self.joined[name], mode)

    def fuzzy(self, name: str, c: Column) -> Column:
        return fuzzy_find_all(c, self.joined[name])

    def names(self, words: Column) -> Column:
        return first_names(words, self.entries)


class CandidateSearch:
    """The same with each row's own candidates, found for the lower-cased text that is searched."""

    def __init__(self, column: str, in_scan: bool):
        self.column, self.in_scan = column, in_scan

    def _of(self, name: str) -> Column:
        return F.filter(self.column, lambda p: p["list"] == name)

    def _joined(self, name: str, field: str) -> Column:
        return F.array_join(F.transform(self._of(name), lambda p: p[field]), "|")

    def first(self, name: str, c: Column) -> Column:
        return first_match(F.lower(c), self._joined(name, "java"))

    def all(self, name: str, c: Column, mode: str = "auto") -> Column:
        if mode == "native" and not self.in_scan:
            raise ValueError("some patterns have no native form")
        low, patterns = F.lower(c), self._of(name)
        cut = F.exists(patterns, lambda p: p["sensitive"])
        joined = F.when(cut, self._joined(name, "cut")).otherwise(self._joined(name, "java"))
        scanned = F.filter(F.regexp_extract_all(low, joined, F.lit(0)), lambda hit: hit != "")
        if mode == "rescan":
            return rescan(low, self._joined(name, "pattern"))
        if self.in_scan:
            return scanned
        by_hand = cut & F.exists(patterns, lambda p: p["cut"].isNull())
        return F.when(by_hand, rescan(F.when(by_hand, low), self._joined(name, "pattern"))).otherwise(scanned)

    def fuzzy(self, name: str, c: Column) -> Column:
        if self.in_scan:
            return self.all(name, c)
        near = F.exists(self._of(name), lambda p: p["fuzzy"])
        apart = rescan(F.when(near, F.lower(c)), self._joined(name, "pattern"), fuzzy=True)
        return F.when(near, apart).otherwise(self.all(name, F.when(~near, c)))

    def names(self, words: Column) -> Column:
        return names_of(words, self._of("entries"))


def attach_keywords(df: DataFrame, text: str, keywords: DataFrame, out: str = "keywords", plan_patterns: int = PLAN_PATTERNS) -> DataFrame:
    """Adds ``out``: the first match in column ``text`` of each of the ``keywords`` (word, ord), in order; lists of any length."""
    words = keywords.where(F.col("word").isNotNull()).select("ord", "word")
    rows = small_rows(words, plan_patterns)
    if rows is not None:
        return df.withColumn(out, keyword_hits(F.col(text), [r.word for r in sorted(rows, key=lambda r: (r.ord is not None, r.ord))]))
    index = pattern_index(words.select(F.lit("").alias("list"), "ord", F.col("word").alias("pattern"), F.lit("").alias("name")))
    found = attach_candidates(df, F.col(text), index, "_candidates")
    return found.withColumn(out, hits_of(F.col(text), F.col("_candidates"))).drop("_candidates")
