"""Patterns that look back: one scan in the JVM against cutting the text after each hit."""

import random
import re

import pytest
from pyspark.sql import functions as F

from plazalens.functions import find
from plazalens.functions.patterns import cut_pattern

PATTERNS = [
    r"\ban\w|th|^de", r"\ba", r"a\b", r"\Ba+", r"^a|b", r"\Aab", r"(?<=a)b", r"(?<!a)b", r"(?<=ab)a|b", r"(?<!ab)c|a", r"(?<=[ab]\s)a",
    r"(?<![\s.,])@a", r"(?<=a|b)c", r"\b\w+\b", r"(?P<x>a|b)(?P=x)\b", r"^(?:a|b)\b|c", r"a{2,3}\b", r"(?:\bab|\Bba)c?", r"[^\s]\b\s", r"(?<!\()\ba",
    r"(?<=\x61)b", r"(?<!^)a|\bb", r"(?<=a{2})b",
]
REFUSED = [r"\b", r"^", r"(?i)\ba", r"(?m)^a", r"(a)?(?(1)b|c)\b", r"(?#x)\ba", r"\ba*", r"a)\b", r"(?<=a+)b"]


def texts():
    r = random.Random(1)
    fixed = [None, "", "a", "deandeand thand", "ab ab", "@a.@a", "aaab aab", "bandana and", "de\nde", "áb áa ñ_a", "abcabc", "a" * 50]
    return [*fixed, *["".join(r.choice("aabbc @.,\n_é") for _ in range(r.randint(1, 40))) for _ in range(150)]]


def searched(pattern, text):
    out, left = [], (text or "").lower()
    while left:
        m = re.search(pattern, left)
        if not m:
            break
        out.append(m.group(0))
        left = left[m.end():]
    return None if text is None else out


def test_one_scan_finds_the_same(spark):
    df = spark.createDataFrame([(t,) for t in texts()], "t string")
    found = df.select("t", *[find.find_all(F.col("t"), p, "native").alias(f"p{i}") for i, p in enumerate(PATTERNS)])
    assert "Arrow" not in found._jdf.queryExecution().toString()
    for r in found.collect():
        for i, p in enumerate(PATTERNS):
            assert r[f"p{i}"] == searched(p, r["t"]), (p, r["t"])


@pytest.mark.parametrize("pattern", REFUSED)
def test_refused(pattern):
    assert cut_pattern(pattern) is None
    with pytest.raises(ValueError, match="no native form"):
        find.find_all(None, pattern, "native")


def test_a_refused_pattern_still_finds(spark):
    df = spark.createDataFrame([("Ab ab AB",), (None,)], "t string")
    assert [r[0] for r in df.select(find.find_all(F.col("t"), r"(?i)\bAB")).collect()] == [["ab", "ab", "ab"], None]
