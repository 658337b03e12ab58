"""Text functions against plain statements of their rules."""

import html
import random
import re
import string
import unicodedata

import pytest
from pyspark.sql import functions as F

from plazalens.functions import find, handles, text
from plazalens.functions.patterns import has_fuzzy_syntax, java_pattern, start_sensitive


def bare(t):
    return "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn")


def cleaned(t):
    t = re.sub(r"@\S+", "", t.lower())
    t = "".join(" " if c in string.punctuation else c for c in t)
    t = " ".join(t.split())
    return re.sub(r"([a-z])\1+", r"\1", bare("".join(c for c in t if c not in string.digits)))


def odd_texts():
    rng = random.Random(7)
    pool = "aábBññ@# .,;:!?()-=[]\n\t 　\x1c\x85 09한글가ÅǄﬁ́ßİΣς😀_&/ཱིো@seed1 @Seed2,http"
    return ["", " ", "@", "@@", "a@b", " @x y", "@seed1@seed2 @seed1. x@seed1 @SEED2"] + [
        "".join(rng.choice(pool) for _ in range(rng.randint(1, 60))) for _ in range(400)
    ]


def run(spark, texts, make):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", make(F.col("t")).alias("r"))
    return [r.r for r in df.orderBy("i").collect()]


def test_accents_and_cleaning(spark):
    texts = odd_texts()
    assert run(spark, texts, text.strip_accents) == [bare(t) for t in texts]
    assert run(spark, texts, text.clean_text) == [cleaned(t) for t in texts]
    assert run(spark, texts, text.hashtags) == [re.findall(r"#\S+", t) for t in texts]


@pytest.mark.parametrize("entities", ["html5", "xml"])
def test_model_text(spark, entities):
    texts = odd_texts() + ["&amp;lt; &lt;b&gt; x", "see https://a.b/c?d now\nnext\ttab"]
    if entities == "html5":
        texts += ["caf&eacute; &notit; &#233; &#x41; &amp"]

    def rule(t):
        t = html.unescape(t) if entities == "html5" else t.replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&")
        t = re.sub(r"http\S+", "[URL]", t).replace("\n", " ").replace("\t", " ")
        joined = " ".join("@" + e.strip() for e in t.split("@") if e)
        return (joined if t.startswith("@") else joined[1:]).strip()

    assert run(spark, texts, lambda c: text.clean_model_text(c, entities)) == [rule(t) for t in texts]


def cut_hits(t, p):
    t, out = t.lower(), []
    while t:
        m = re.search(p, t)
        if m is None:
            break
        if m.group(0):
            out.append(m.group(0))
            t = t[m.end():]
        else:
            t = t[m.end() + 1:]
    return out


@pytest.mark.parametrize("pattern", [r"\ba", "ab|a+", "(?<=b)a", "^a", "x*", "[^a-z]+", "b(?!a)"])
def test_find_all_is_search_and_cut(spark, pattern):
    texts = ["aaa", "AbaBa a ab", "", "xx axx", "a1 b2 ba"]
    assert run(spark, texts, lambda c: find.find_all(c, pattern)) == [cut_hits(t, pattern) for t in texts]
    assert run(spark, texts, lambda c: find.find_all(c, pattern, "rescan")) == [cut_hits(t, pattern) for t in texts]


def test_empty_pattern_and_fuzzy(spark):
    assert run(spark, ["abc"], lambda c: find.find_all(c, "")) == [[]]
    assert run(spark, ["helo wrld", "hxllo"], lambda c: find.fuzzy_find_all(c, "(?:hello){e<=1}")) == [["helo"], ["hxllo"]]
    assert has_fuzzy_syntax("(?:a){e<=1}") and not has_fuzzy_syntax("a{2,3}")


def test_patterns():
    assert start_sensitive(r"\ba") and not start_sensitive("[^a]b")
    assert java_pattern("[[a]&&]").endswith(r"[\[a]&&]")
    assert java_pattern(r"(?P<x>a)(?P=x)\Z").endswith(r"(?<x>a)\k<x>\z")


def test_long_lists_are_a_value_of_the_plan(spark, monkeypatch):
    entries, words = [("ab+", "one"), ("a", "two")], ["ab", "zz", "a"]
    texts = ["abb", "xa", "q"]
    short = run(spark, texts, lambda c: find.first_names(F.array(c), entries)), run(spark, texts, lambda c: find.keyword_hits(c, words))
    monkeypatch.setattr(find, "MAX_BRANCHES", 1)
    long = run(spark, texts, lambda c: find.first_names(F.array(c), entries)), run(spark, texts, lambda c: find.keyword_hits(c, words))
    assert short == long == ([["one"], ["two"], []], [["ab", "a"], ["a"], []])


def test_handles(spark):
    groups = {"mayor": ["seed1"], "press": ["Seed2", "seed1"]}
    edge = r"[\s.,;:!?()\-=\[\]]"

    def rule(t):
        for token, names in groups.items():
            t = re.sub("|".join(rf"(?<!(?!{edge})[\s\S])@{n}(?!(?!{edge})[\s\S])" for n in names), token, t, flags=re.I)
        t = re.sub(r"@\S+", "USER", t)
        for token in (*groups, "USER"):
            t = t.replace(token, "@" + token)
        return t

    texts = odd_texts() + ["mayor @SEED1, @seed2!@seed1 (@seed1) x@seed1 @seed1@ @seed12"]
    found = handles.HandleGroups(groups)
    assert run(spark, texts, lambda c: handles.replace_handles(c, found.tokens, found.token_of)) == [rule(t) for t in texts]
    got = run(spark, ["@Seed1 @seed2. @other x"], lambda c: handles.matched_handles(c, found.tokens, found.token_of))[0]
    assert (got.mayor, got.press, got.USER) == (["@Seed1"], ["@seed2"], ["@other"])


def test_word_model(spark, monkeypatch):
    from math import log

    from plazalens.operators import dims, word_model

    rows = [("bad Bad dog", 1), ("bad cat", 1), ("good dog", 0), ("good\tgood cat", 0), ("nice", 0), (None, 0), ("odd", None), ("odd", 7)]
    model = word_model.fit_word_model(spark.createDataFrame(rows, "text string, label int"))
    n1, n0 = {"bad": 3, "dog": 1, "cat": 1}, {"good": 3, "dog": 1, "cat": 1, "nice": 1}
    want = {w: round(1e6 * (log((n1.get(w, 0) + 1) / (5 + 5)) - log((n0.get(w, 0) + 1) / (6 + 5)))) for w in {*n1, *n0}}
    assert {r["word"]: r["weight"] for r in model.weights.collect()} == want and model.prior == round(1e6 * log(2 / 4))
    texts = [(1, "BAD dog"), (2, "good bad"), (3, "never seen"), (4, None), (5, ""), (None, "BAD dog"), (1, "BAD dog")]
    posts = spark.createDataFrame(texts, "id long, text string")
    score = lambda t: sum(want.get(w, 0) for w in t.lower().split()) + model.prior
    expected = sorted(((i, t, None if t is None else int(score(t) > 0)) for i, t in texts), key=str)
    for rows_broadcast in (dims.BROADCAST_ROWS, 0):
        monkeypatch.setattr(word_model, "left_join_dimension", lambda *a, **k: dims.left_join_dimension(*a, **k, broadcast_rows=rows_broadcast))
        assert sorted(map(tuple, word_model.classify_words(posts, model).collect()), key=str) == expected
    alone = word_model.fit_word_model(spark.createDataFrame(rows[:2], "text string, label int"))
    assert {r["abuse"] for r in word_model.classify_words(posts, alone).collect()} == {0, None}


@pytest.mark.parametrize("common_words, moved", [(0, 4), (3, 4), (4, 1)])
def test_common_words_stay_with_their_text(spark, monkeypatch, common_words, moved):
    """However many words are common, the classes are the same; only the others are rows of the join, and a text has one for all common ones."""
    from plazalens.operators import dims, word_model

    rows = [("bad bad bad dog", 1), ("bad cat", 1), ("good dog", 0), ("good cat", 0), ("nice", 0)]
    model = word_model.fit_word_model(spark.createDataFrame(rows, "text string, label int"))
    met = []

    def join(facts, dim, *more, **named):
        met.append(facts.where("n > 0").count())
        return dims.left_join_dimension(facts, dim, *more, **named, broadcast_rows=0)

    monkeypatch.setattr(word_model, "left_join_dimension", join)
    posts = spark.createDataFrame([(1, "bad bad good dog cat dog"), (2, "bad bad good dog cat dog")], "id long, text string")
    weight = {r["word"]: r["weight"] for r in model.weights.collect()}
    score = 2 * weight["bad"] + weight["good"] + 2 * weight["dog"] + weight["cat"] + model.prior
    found = word_model.classify_words(posts, model, common_words=common_words)
    assert {r["abuse"] for r in found.collect()} == {int(score > 0)} and met == [moved]
    alone = spark.createDataFrame([(1, "bad"), (2, "good"), (3, "nice nice"), (4, " unseen "), (5, "  "), (6, None)], "id long, text string")
    got = {r["id"]: r["abuse"] for r in word_model.classify_words(alone, model, common_words=common_words).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: None}
