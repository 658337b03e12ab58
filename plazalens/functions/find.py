"""Pattern search over text columns."""

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from plazalens.functions.patterns import cut_pattern, has_fuzzy_syntax, java_pattern, start_sensitive

_NO_HITS = "array()"


def first_hit(c: Column, pattern: str) -> Column:
    """First match of ``pattern`` in the lower-cased text, empty string when there is none."""
    if not pattern:
        return F.when(c.isNotNull(), F.lit(""))
    return F.regexp_extract(F.lower(c), java_pattern(pattern), 0)


def find_all(c: Column, pattern: str, mode: str = "auto") -> Column:
    """All matches in the lower-cased text, each search starting on the text left after the last match.

    ``native`` runs ``regexp_extract_all``. A pattern that looks at what precedes it (a boundary, a start anchor, a look-behind) is
    rewritten for it, so that it sees the end of the last match as the start of the text. ``rescan`` cuts literally, in an Arrow worker;
    ``auto`` takes it only for patterns that can't be rewritten. Empty matches are not hits in any mode.
    """
    if mode not in ("auto", "native", "rescan"):
        raise ValueError("mode must be 'auto', 'native' or 'rescan'")
    if not pattern:
        return F.when(c.isNotNull(), F.expr(_NO_HITS).cast("array<string>"))
    scanned = cut_pattern(pattern) if start_sensitive(pattern) else pattern
    if mode == "native" and scanned is None:
        raise ValueError(f"no native form of {pattern!r}")
    if mode != "rescan" and scanned is not None:
        found = F.regexp_extract_all(F.lower(c), F.lit(java_pattern(scanned)), F.lit(0))
        return F.filter(found, lambda hit: hit != "")
    return rescan(F.lower(c), F.lit(pattern))


def rescan(c: Column, pattern: Column, fuzzy: bool = False) -> Column:
    """Hits of each row's own ``pattern``, the text cut behind each hit in an Arrow worker. With ``fuzzy`` patterns may be approximate;
    the first hit that needs more than one edit of a kind ends the search."""

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series, patterns: pd.Series) -> pd.Series:
        import re
        from functools import lru_cache

        import regex

        compiled = lru_cache(maxsize=1000)(regex.compile if fuzzy else re.compile)

        def hits(text, pattern):
            if text is None:
                return None
            out = []
            search = compiled(pattern).search
            while text:
                m = search(text)
                if m is None or fuzzy and max(m.fuzzy_counts) > 1:
                    break
                if m.group(0):
                    out.append(m.group(0))
                    text = text[m.end():]
                else:
                    text = text[m.end() + 1:]
            return out

        return pd.Series([hits(t, p) for t, p in zip(texts, patterns)], dtype=object)

    return cut(c, pattern)


def fuzzy_find_all(c: Column, pattern: str) -> Column:
    """Like :func:`find_all`, with approximate patterns; the first hit that needs more than one edit of a kind ends it.

    A pattern without approximate syntax is exact and takes the exact route.
    """
    if not pattern or not has_fuzzy_syntax(pattern):
        return find_all(c, pattern)
    return rescan(F.lower(c), F.lit(pattern), fuzzy=True)


def remove_hits(c: Column, hits: Column) -> Column:
    """The text without the found strings, taken out in one left-to-right pass."""
    # a repeated alternative never matches, it only costs: long texts hold the same hit hundreds of times
    quoted = F.transform(F.array_distinct(hits), lambda h: F.concat(F.lit("\\Q"), h, F.lit("\\E")))
    # no hits make an empty pattern, which changes nothing
    return F.regexp_replace(c, F.array_join(quoted, "|"), F.lit(""))


# Above this many entries a branch for each would bloat the plan and its generated code; the list becomes one value of the plan.
MAX_BRANCHES = 500


def _as_value(entries: list[tuple[str, str | None]]) -> Column:
    rows = [{"java": java_pattern(pattern), "name": name} for pattern, name in entries]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<java:string,name:string>>")


def matches(c: Column, java: Column) -> Column:
    """Whether ``c`` holds a match of a pattern that is a column itself."""
    return F.call_function("rlike", c, java)


def first_match(c: Column, java: Column) -> Column:
    return F.call_function("regexp_extract", c, java, F.lit(0))


def hits_of(c: Column, entries: Column) -> Column:
    """The first match in ``c`` of each of the ``entries`` (an array with ``java``) that has one."""
    return F.transform(F.filter(entries, lambda e: matches(c, e["java"])), lambda e: first_match(c, e["java"]))


def names_of(words: Column, entries: Column) -> Column:
    """``name`` of the first of the ``entries`` (an array with ``java`` and ``name``) that matches each word."""
    named = F.transform(words, lambda w: F.get(F.filter(entries, lambda e: matches(w, e["java"])), F.lit(0))["name"])
    return F.array_compact(named)


def keyword_hits(c: Column, words: list[str]) -> Column:
    """For each keyword pattern, in order, its first match in ``c``; none in a null text."""
    if not words:
        return F.when(c.isNotNull(), F.expr(_NO_HITS).cast("array<string>"))
    if len(words) > MAX_BRANCHES:
        return hits_of(c, _as_value([(w, None) for w in words]))
    return F.array_compact(F.array(*[_one_keyword(c, w) for w in words]))


def _one_keyword(c: Column, word: str) -> Column:
    if word.replace(" ", "").isalnum():
        # a plain word needs no regex engine
        return F.when(F.contains(c, F.lit(word)), F.lit(word))
    p = java_pattern(word)
    return F.when(c.rlike(p), F.regexp_extract(c, p, 0))


def first_names(words: Column, entries: list[tuple[str, str]]) -> Column:
    """Name of the first dictionary entry matching each word, in word order; words without a match drop out."""
    if not entries:
        return F.when(words.isNotNull(), F.expr(_NO_HITS).cast("array<string>"))
    if len(entries) > MAX_BRANCHES:
        return names_of(words, _as_value(entries))

    def name_of(w: Column) -> Column:
        chain = F.when(w.rlike(java_pattern(entries[0][0])), F.lit(entries[0][1]))
        for pattern, name in entries[1:]:
            chain = chain.when(w.rlike(java_pattern(pattern)), F.lit(name))
        return chain

    return F.array_compact(F.transform(words, name_of))
