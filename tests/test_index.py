"""Pattern lists and group tokens of any length give what plain Python gives."""

import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from plazalens.functions.handles import HandleGroups, replace_handles
from plazalens.functions.patterns import needed_strings
from plazalens.operators import insults, pattern_index
from plazalens.operators.dictionary import compile_dictionary, index_dictionary
from plazalens.operators.seeds import with_group_tokens


def test_needed_strings():
    assert needed_strings(r"\bcanalla(?:s|da)?\b") == ["canalla"]
    assert needed_strings("(?:gato|perros) x+") == ["gato", "perros"]
    assert needed_strings("[ab]c?") == ["a", "b"]
    assert needed_strings("(?:ab)+") == ["ab"] and needed_strings("(ñandú){2}") == ["ñandú"]
    for nothing in ("a*", r"\w+", "(?i)abc", "x|", "(?:hola){e<=1}", "(", "", "[^a]"):
        assert needed_strings(nothing) == [""], nothing


def word(k: int) -> str:
    return "".join("bcdfglmnprstvz"[k // 14 ** i % 14] + "aeiou"[(k + i) % 5] for i in range(5))


@pytest.mark.parametrize("n", [400, 600, 200_000])
def test_keywords_of_any_number(spark, n):
    rare = [r"\bmal\w+", "a|b", r"ñ[aá]$", "", "x*", "mal", "😀.", "mal"]
    listed = [*(word(k) for k in range(n)), *rare]
    words = spark.createDataFrame(pd.DataFrame({"word": listed, "ord": range(len(listed))}))
    rng = random.Random(3)
    texts = [" ".join(word(rng.randrange(2 * n)) for _ in range(12)) for _ in range(6)] + ["maldad peñá", "", None, "😀😀x mal", "maldad peñá"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumn("_key", F.lit("clash"))
    got = {r.id: r.keywords for r in pattern_index.attach_keywords(df, "text", words).collect()}
    assert len(got) == len(texts) and got[8] == []
    plain = [w for w in listed[:n]]
    for i, t in enumerate(texts):
        if t is not None:
            literal = [w for w in plain if w in t]
            want = literal + [m.group(0) for m in (re.search(p, t) for p in rare) if m]
            assert got[i] == want, (i, t)


DICT = [
    (0, "tonto", "FS", "F", "n-tonto"), (1, r"\bmalo\b", "MS", "M", "n-malo"), (2, "tonto util", "Exclude", None, "e"),
    (3, r"(?:bob[oa])+", "FP", "F", "n-bobo"), (4, "tonto", "IS", None, "late"), (5, r"(?:canalla){e<=1}", "Exclude", None, "near"),
    (6, r"^zafi[oa]", "US", "F", "n-zafio"), (7, "o b", "IP", None, "n-seam"), (8, None, "FS", "F", "none"),
]
SCHEMA = "ord bigint, regex3 string, target string, gender string, orig_name string"


def test_dictionary_by_index(spark):
    rows = spark.createDataFrame(DICT, SCHEMA)
    texts = ["que tonto y Tonto", "tonto util bobo", "malo tonto malos", "zafio zafia zafio", "bobobobo", "tonttonto utilo", "canala bobo canalla", "o malobo",
             "", None, "x" * 3000 + " tonto"] * 2
    posts = [(i, t, 1 if i % 7 else 0, ["x"] if i % 3 == 0 else []) for i, t in enumerate(texts)]
    df = spark.createDataFrame(posts, "id int, text_clean string, abuse int, m_seed array<string>")
    short, indexed = compile_dictionary(rows), index_dictionary(rows)
    assert not indexed.index.in_scan and type(compile_dictionary(rows, 3)) is type(indexed)
    for search in (insults.extract_insults, insults.with_insult_names):
        a, b = (sorted(map(str, search(df, d).collect())) for d in (short, indexed))
        assert a == b and len(a) > 3
    exact = rows.where("ord not in (5, 6)")
    a, b = (sorted(map(str, insults.extract_male_insults(df, d).collect())) for d in (compile_dictionary(exact), index_dictionary(exact)))
    assert a == b and a
    assert insults.extract_insults(df, index_dictionary(rows.where("false"))).count() == 0


def test_long_dictionary(spark):
    n = 200_000
    words = spark.createDataFrame(pd.DataFrame({"ord": range(n), "regex3": [word(k) for k in range(n)]}))
    listed = words.select("*", F.lit("FS").alias("target"), F.lit("F").alias("gender"), F.concat(F.lit("n"), "ord").alias("orig_name"))
    df = spark.createDataFrame([(1, f"y {word(7)} o {word(199_999)}", 1, [])], "id int, text_clean string, abuse int, m_seed array<string>")
    assert [r.insults_name for r in insults.extract_insults(df, compile_dictionary(listed)).collect()] == [["n7", "n199999"]]


def test_tokens_of_any_number(spark):
    tokens = ["may", "or", "x@y", "y", "mayor", "a.b", "USER"]
    seeds = [(f"Seed{i}", t, i) for i, t in enumerate(tokens)] + [("seed1", "y", 50), (None, "z", 51), ("seedz", None, 52)]
    df_seeds = spark.createDataFrame(seeds, "screen_name string, token string, ord long")
    texts = ["@seed0or @seed0 or @Seed1, xy @seed9", "may@seed1", "(@seed5) a.b acb x@y", None, "", "@seed4 @seed6 @seedz", "@seed0 or @seed0"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    groups = {t: [s for s, u, _ in seeds if u == t] for t in tokens}
    found = HandleGroups(groups)
    want = [r[0] for r in df.orderBy("id").select(replace_handles(F.col("text"), found.tokens, found.token_of)).collect()]
    for plan_tokens in (500, 0):
        got = with_group_tokens(df, "text", df_seeds, "out", plan_tokens=plan_tokens).orderBy("id").collect()
        assert [r.out for r in got] == want
    many = spark.range(20_000).select(
        F.concat(F.lit("h"), F.col("id").cast("string")).alias("screen_name"), F.concat(F.lit("tok"), F.col("id").cast("string"), F.lit("q")).alias("token"),
        F.col("id").alias("ord"),
    )
    one = spark.createDataFrame([(1, "@h19999 tok5q @nobody")], "id int, text string")
    assert with_group_tokens(one, "text", many, "out").first().out == "@tok19999q @tok5q @USER"


def test_few_entries_move_no_text(spark):
    """An index that tasks can hold finds the candidates that the joins find, without a shuffle of the texts."""
    listed = ["a", "mal", r"\bmalo", "x|y", "ñandú", "😀😀x", "w*", "zz zz", "canalla(?:s|da)?", "árbol é", "mal"]
    rows = [("l", i if i != 4 else None, p, None if i % 3 else f"n{i}") for i, p in enumerate(listed)] + [("l", 1, "mal", None)]
    index = pattern_index.pattern_index(spark.createDataFrame(rows, "list string, ord bigint, pattern string, name string"))
    rng = random.Random(5)
    texts = ["", None, "😀😀x", "😀", "zz z", "zz zz", "un árbol é", "árbol e", "ma", "l canallas", "x" * (1 << 20) + "ñandú", "ñand", "ú"]
    texts += ["".join(rng.choice("malox ñú😀zé") for _ in range(rng.randrange(40))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    near = pattern_index.attach_candidates(df, F.col("text"), index, "found")
    far = pattern_index.attach_candidates(df, F.col("text"), index, "found", held=False)
    a, b = ({r.id: r.found for r in d.select("id", "found").collect()} for d in (near, far))
    assert a == b and a[1] == [] and len(a[10]) > len(a[0]) > 0 and near.schema["found"].dataType == far.schema["found"].dataType
    assert "Exchange" not in near._jdf.queryExecution().executedPlan().toString()
    finder = pattern_index.KeyFinder(["ab".encode(), "abcdefghij".encode(), "abcdefghik".encode(), "b".encode()])
    assert finder.find([b"xab", b"abcdefghi", b"j abcdefghij", b"", b"a", b"b"]) == [{0, 3}, {0, 3}, {0, 1, 3}, set(), set(), {3}]
