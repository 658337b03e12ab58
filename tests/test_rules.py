"""Posts, joins, summaries, sinks and streams on small fixtures."""

import gzip
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plazalens.operators import capture, classify, dedup, dims, flatten, insults, seeds, summaries
from plazalens.operators.dictionary import compile_dictionary, pattern_map, without_category
from plazalens.plans import hour_load, hourly, stand_in
from plazalens.plans.dimensions import load_dimensions
from plazalens.schemas import SEEDS, SUMMARIES, TIDY
from plazalens.sinks import jdbc, tables
from plazalens.sources import dimensions, posts as post_source
from plazalens.streaming import hourly as stream_hourly

CREATED = "Wed Oct 26 14:03:59 +0000 2022"


def post(id_, user, text, mentions=(), **more):
    return {
        "id": id_, "id_str": str(id_), "user": {"id": user, "screen_name": f"u{user}"}, "text": text, "lang": "es",
        "entities": {"user_mentions": [{"screen_name": m} for m in mentions]}, "created_at": CREATED, "place": None,
        "in_reply_to_user_id": None, "in_reply_to_screen_name": None, "in_reply_to_status_id": None, **more,
    }


REPLIED = {"in_reply_to_user_id": 10, "in_reply_to_screen_name": "ana", "in_reply_to_status_id": 5}
QUOTE = {"quoted_status": {"user": {"id": 77, "screen_name": "q"}, "text": "said", "full_text": "no"}}
POSTS = [
    post(2**53 + 1, 1, "hola\n@Ana tonto", ["Ana", "u1", "Ana"]),
    post(2, 2, "sin seed", **REPLIED),
    post(3, 3, "RT", ["zed"], retweeted_status=post(30, 4, "dos\nlineas @LUIS", ["LUIS", "u3"], **REPLIED)),
    post(4, 4, "cita", ["ana"], **QUOTE),
    post(5, 5, "x", retweeted_status=post(50, 6, "y", **REPLIED, **QUOTE)),
    post(6, 6, "corto", extended_tweet={"full_text": "largo #Uno, tonto @ana", "entities": {"user_mentions": [{"screen_name": "ana"}]}}),
    post(7, 7, "nada", []),
]


@pytest.fixture
def seed_list(spark):
    rows = [
        ("10", "ana", "Ana", None, "F", "mayor", " ana ", "A", 1, 2, 0),
        ("11", "luis", "Luis", None, "M", "press", "luis", "L", 1, 2, 1),
        (None, "#eva", "Eva", None, "F", "press", "eva", "E", 1, 2, 2),
    ]
    return spark.createDataFrame(rows, SEEDS)


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    lines = [json.dumps(p) for p in POSTS]
    (folder / "output-26-10-2022-14.jsonl").write_text("\n".join(lines[:4] + ["", '{"id": 1, oops', *lines[4:]]) + "\n")
    with gzip.open(folder / "output-26-10-2022-13.jsonl.gz", "wt") as f:
        f.write(json.dumps(post(99, 9, "viejo")) + "\n")
    return str(folder)


@pytest.mark.parametrize("literal_rows", [100, 0])
def test_flatten(spark, raw, seed_list, literal_rows):
    read = post_source.read_posts(spark, raw)
    assert [r.line for r in post_source.bad_lines(read).collect()] == ['{"id": 1, oops']
    assert post_source.good_posts(read).count() == 7
    tidy = flatten.flatten_posts(post_source.good_posts(read), seed_list, literal_rows=literal_rows)
    assert tidy.columns == TIDY.names and [f.dataType for f in tidy.schema] == [f.dataType for f in TIDY]
    got = {r.id: r for r in tidy.collect()}
    assert len(got) == 7
    first = got[f"id_{2**53 + 1}"]
    assert (first.text, first.mentions, first.f_seed, first.tweet_type, first.valid) == (
        "hola@Ana tonto", ["Ana"], ["Ana"], "standalone", True
    )
    assert str(first.datetime) == "2022-10-26 14:03:59"
    assert (got["id_2"].tweet_type, got["id_2"].in_reply_to_user_id, got["id_2"].valid) == ("reply", "id_10", True)
    rt = got["id_3"]
    assert (rt.text, rt.mentions, rt.m_seed, rt.tweet_type, rt.in_reply_to_status_id, rt.rt_from_id) == (
        "dos\nlineas @LUIS", ["LUIS"], ["LUIS"], "reply", "id_5", "id_30"
    )
    assert (got["id_4"].tweet_type, got["id_4"].qt_from_screen_name, got["id_4"].qt_status) == ("quote", "q", "said")
    assert got["id_5"].tweet_type == "reply_with_quote"
    assert (got["id_6"].text, got["id_6"].hashtags) == ("largo #Uno, tonto @ana", ["#Uno,"])
    assert got["id_7"].valid is None
    assert post_source.read_posts(spark, raw, archived=True).where(F.col("id") == "99").count() == 1
    empty = flatten.flatten_posts(post_source.good_posts(read).limit(0), seed_list)
    assert empty.count() == 0 and empty.columns == TIDY.names


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_summaries_with_hot_keys(spark, monkeypatch, broadcast_rows):
    """A post and a seed that hold most rows, duplicates everywhere, against the chain of joins row by row."""
    monkeypatch.setattr(summaries, "left_join_dimension", lambda *a, **k: dims.left_join_dimension(*a, **k, broadcast_rows=broadcast_rows))
    posts = [(i, f"2022-01-01 0{i % 3}:10:00", i % 4, None if i % 3 else 1) for i in range(40)]
    men = [(0, "hot")] * 50 + [(i, "hot") for i in range(40)] + [(i, f"m{i % 5}") for i in range(40)]
    seed = [("hot", 1), ("m0", 1), ("m1", 2), ("m1", 3), ("m2", None)]
    ab = [(i, i % 2) for i in range(35)] + [(0, 1)]
    ins = [(0, "x")] * 20 + [(i, "y") for i in range(0, 30, 3)]
    tag = [(0, "#a")] * 7 + [(i, "#b") for i in range(40)]

    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    p = frame(posts, "id int, ts string, user_id int, rt int").withColumn("ts", F.to_timestamp_ntz("ts"))
    m, s = frame(men, "id int, mention string"), frame(seed, "mention string, influencer_id int")
    a, i, h = frame(ab, "id int, abuse int"), frame(ins, "id int, insult string"), frame(tag, "id int, hashtag string")

    fanned = [(b, f, n) for b, f in ab for n in ([n for j, n in ins if j == b] or [None])]
    want, insult_want, tag_want = {}, Counter(), Counter()
    for pid, ts, _, rt in posts:
        for who in [w for j, name in men if j == pid for n2, w in seed if n2 == name and w is not None]:
            key = (ts[11:13], who)
            row = want.setdefault(key, [0] * 6)
            for _, flag, name in [f for f in fanned if f[0] == pid] or [(pid, None, None)]:
                hit = flag == 1
                row[0] += 1
                row[1] += hit
                row[2 if rt is None else 3] += 1
                row[4 if rt is None else 5] += hit
                if name:
                    insult_want[key + (name,)] += 1
            tag_want.update(key + (t,) for j, t in tag if j == pid)
    got = summaries.mentions_abuse_summary(p, m, s, a, i).collect()
    assert {(f"{r.Hour:%H}", r.influencer_id): list(r[2:]) for r in got} == want
    got = summaries.insults_summary(p, m, s, a, i).collect()
    assert {(f"{r.Hour:%H}", r.influencer_id, r.Insults): r.N_abuse for r in got} == insult_want
    got = summaries.hashtags_summary(p, m, s, h).collect()
    assert {(f"{r.Hour:%H}", r.influencer_id, r.Hashtag): r.N_hashtags for r in got} == tag_want


def test_salted_join_keeps_every_row(spark):
    facts = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    dim = spark.createDataFrame([("hot", 1), ("7", 2), ("7", 3)], "k string, v int")
    plain = facts.join(dim, "k", "left")
    salted = dims.left_join_dimension(facts, dim, "k", F.col("id"), broadcast_rows=0)
    assert salted.exceptAll(plain).count() == plain.exceptAll(salted).count() == 0


def test_long_dimensions_are_never_broadcast(spark, tmp_path, monkeypatch):
    """However small Spark takes the sides for: here both are a few bytes, which it would broadcast."""

    def broadcasts(df):
        df.collect()
        return "Broadcast" in df._jdf.queryExecution().executedPlan().toString()

    facts, dim = spark.range(30).withColumn("k", F.col("id") % 5), spark.range(4).select(F.col("id").alias("k"), F.col("id").alias("v"))
    for spread, how in ((F.col("id"), "left"), (F.col("id"), "inner"), (None, "left"), (None, "inner")):
        joined = dims.left_join_dimension(facts, dim, "k", spread, how, broadcast_rows=3)
        assert not broadcasts(joined) and joined.count() == (30 if how == "left" else 24)
        assert broadcasts(dims.left_join_dimension(facts, dim, "k", spread, how, broadcast_rows=4))

    plain = facts.join(dim, "k", "left")
    for copies, salts in ((1000, dims.SALTS), (8, 2), (7, 1), (0, 1)):
        monkeypatch.setattr(dims, "COPIES", copies)
        joined = dims.left_join_dimension(facts, dim, "k", F.col("id"), broadcast_rows=0)
        copied = [n for n in joined._jdf.queryExecution().analyzed().toString().splitlines() if "explode" in n]
        assert len(copied) == (salts > 1) and all(f"sequence(0, {salts - 1}," in n for n in copied)
        assert joined.exceptAll(plain).count() == plain.exceptAll(joined).count() == 0

    spark.range(6).selectExpr("id p_partkey", "'t' || id p_type", "'b' || id p_brand").write.parquet(f"{tmp_path}/part.parquet")
    items = "id l_orderkey, id % 6 l_partkey, 'R' l_returnflag, 30.0 l_quantity"
    spark.range(9).selectExpr(*items.split(", ")).write.parquet(f"{tmp_path}/lineitem.parquet")
    for parts, held in ((6, True), (5, False)):
        monkeypatch.setattr(stand_in, "HELD_PARTS", parts)
        for name in ("ins", "hsh"):
            view = stand_in.view(spark, str(tmp_path), name)
            assert broadcasts(view) == held and view.count() == 9


def test_dedup_keeps_one_copy(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5), (None, 7), (None, 7)], "id string, n int")
    rows = sorted(map(tuple, dedup.drop_repeated_posts(df).collect()), key=str)
    assert rows == sorted([("a", 1), ("b", 5), (None, 7), (None, 7)], key=str)


def test_classifier_failure_leaves_the_rows(spark):
    def load():
        def score(texts):
            if "bad" in texts:
                raise RuntimeError("no")
            return [[0.1, 0.9] if "x" in t else [0.9, 0.1] for t in texts]

        return score

    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "bad")], "id int, replaced_text string").coalesce(1)
    rows = {r.id: r for r in classify.classify_posts(df, load, batch=1).collect()}
    assert [rows[i].abuse for i in (1, 2, 3)] == [1, 0, None] and "RuntimeError" in rows[3].abuse_error


def test_seed_pages_and_handles(spark, seed_list):
    long = spark.range(1000).select(F.col("id").alias("ord"), F.when(F.col("id") % 10 > 0, F.col("id").cast("string")).alias("user_id"))
    pages = {r.user_id: r.page_no for r in seeds.seed_pages(long, "user_id", stride=64).collect()}
    kept = [str(i) for i in range(1000) if i % 10]
    assert pages == {u: n // 400 for n, u in enumerate(kept)}
    words = spark.createDataFrame([("paz", 1)], "word string, ord bigint")
    assert {r.word for r in seeds.tracking_words(seed_list, words).collect()} == {"@ana", "@luis", "paz"}
    seen = spark.createDataFrame([("10", "AnaNueva", "2022-01-02"), ("10", "Ana", "2022-01-01")], "user_id string, screen_name string, datetime string")
    latest = seeds.latest_handles(seen.withColumn("datetime", F.to_timestamp_ntz("datetime")))
    new = {r.user_id: r for r in seeds.apply_handle_changes(seed_list, latest).collect()}
    assert (new["10"].screen_name, new["10"].screen_name_orig) == ("ananueva", "AnaNueva") and new["11"].screen_name == "luis"


DICT = [(0, "tonto", "FS", "F", "n-tonto"), (1, "malo", "MS", "M", "n-malo"), (2, "tonto util", "Exclude", None, "e")]


@pytest.fixture
def dictionary(spark):
    return spark.createDataFrame(DICT, "ord bigint, regex3 string, target string, gender string, orig_name string")


def test_insults(spark, dictionary):
    twice = dictionary.unionAll(dictionary.where("ord = 0").withColumn("ord", F.lit(9).cast("bigint")).withColumn("orig_name", F.lit("late")))
    assert [tuple(r) for r in pattern_map(twice).collect()] == [("tonto", 0, "late", "FS")]
    rows = [(1, "que tonto y tonto", 1, []), (2, "tonto util", 1, []), (3, "tonto", 0, []), (4, "malo", 1, []), (5, "malo tonto", 1, ["x"])]
    df = spark.createDataFrame(rows, "id int, text_clean string, abuse int, m_seed array<string>")
    compiled = compile_dictionary(dictionary)
    got = {r.id: r.insults_name for r in insults.extract_insults(df, compiled).collect()}
    assert got == {1: ["n-tonto", "n-tonto"], 5: ["n-tonto"]}
    marked = {r.id: r.insults_name for r in insults.with_insult_names(df, compiled).collect()}
    assert marked == {1: ["n-tonto", "n-tonto"], 2: None, 3: None, 4: None, 5: ["n-tonto"]}
    cats = spark.createDataFrame([("a", None), ("b", "Criticas al ejercicio de su profesión")], "Insulto string, `Categoría` string")
    assert [r.Insulto for r in without_category(cats).collect()] == ["a"]


def test_sources_and_sinks(spark, tmp_path, seed_list):
    (tmp_path / "seeds.csv").write_text("screen_name,user_id,Genero\nana,10,F\nluis,,M\n")
    read = dimensions.read_seeds(spark, str(tmp_path / "seeds.csv")).orderBy("ord").collect()
    assert [(r.user_id, r.screen_name, r.Tipo) for r in read] == [("10", "ana", None), (None, "luis", None)]
    cats = spark.createDataFrame([("a", "b", None, "c")], "Insulto string, Insulto_gendered string, `Categoría` string, `Subcategoría` string")
    for _ in range(2):
        load_dimensions(seed_list, cats, str(tmp_path / "dims"))
    assert spark.read.parquet(str(tmp_path / "dims/metadata")).count() == 3
    assert spark.read.parquet(str(tmp_path / "dims/insult_to_group")).count() == 1
    tables.write_csv(cats, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().Insulto == "a"
    text_types = jdbc.for_jdbc(spark.createDataFrame([(["k"], True)], "keywords array<string>, valid boolean"))
    assert tuple(text_types.first()) == ('["k"]', "true") and jdbc.jdbc_options("raw_data", "jdbc:x:")["batchsize"] == "5000"
    flat = spark.createDataFrame([(1, "t", 2)], "id int, text string, author_id int").withColumn("created_at", F.lit("2022-01-01 10:00:00").cast("timestamp"))
    assert capture.flatten_flat(flat).first().created_at == "2022-01-01T10:00:00+00:00"


def test_hourly_stream_is_idempotent(spark, raw, tmp_path, seed_list, dictionary):
    cats = spark.createDataFrame([("n-tonto", None, "c", "sub")], "Insulto string, Insulto_gendered string, `Categoría` string, `Subcategoría` string")
    plan = hourly.Dimensions(seed_list, dictionary, cats)

    def classifier(df):
        return df.withColumn("abuse", F.contains("text_clean", F.lit("tonto")).cast("int"))

    out, archive = str(tmp_path / "out"), str(tmp_path / "archive")
    for checkpoint in ("a", "a", "b"):  # first run, nothing new, and a replay of everything
        feed = post_source.stream_posts(spark, raw, archive_dir=archive, source="source_file")
        stream_hourly.run_incremental(spark, feed, plan, classifier, out, str(tmp_path / checkpoint)).awaitTermination()
    got = {t: hour_load.read_hours(spark, out, t).select(*s.names) for t, s in SUMMARIES.items()}
    assert got["raw_data"].count() == 7
    mention = [tuple(r)[1:] for r in got["mentions_and_abuse_summary"].collect()]
    # the id table spells the seed in lower case: the mention spelled "Ana" has no id and is not counted
    assert mention == [("id_10", 2, 1, 2, 0, 1, 0)]
    assert [(r.Insults, r.N_abuse) for r in got["insults_summary"].collect()] == [("n-tonto", 1)]
    assert [(r[2], r.N_abuse) for r in got["subc_summary"].collect()] == [("sub", 1)]
    assert [(r.Hashtag, r.N_hashtags) for r in got["hashtags_summary"].collect()] == [("#Uno,", 1)]
    assert {r.user_id for r in got["users_abuse_summary"].collect()} == {f"id_{n}" for n in (1, 4, 6)}

    def broken(df):
        raise RuntimeError("model missing")

    feed = post_source.stream_posts(spark, raw)
    stream_hourly.run_incremental(spark, feed, plan, broken, str(tmp_path / "out2"), str(tmp_path / "c"), keep_going=True).awaitTermination()
    assert "model missing" in spark.read.parquet(str(tmp_path / "out2/failures")).first().exception


@pytest.mark.parametrize("literal_rows", [100, 0])
def test_posts_without_id_find_their_seeds(spark, literal_rows):
    schema = "id string, handles array<string>, account string"
    rows = [(None, ["Ana"], "id_7"), (None, ["bob"], "id_10"), (None, [], None), (None, None, "id_11"), ("1", ["ana"], None), (None, ["Ana"], "id_7")]
    listed = spark.createDataFrame([(10, "ana", "F"), (11, "bob", "M")], "user_id long, screen_name string, Genero string")
    df, test = seeds.seed_tests(spark.createDataFrame(rows, schema), listed, F.col("handles"), F.col("account"), literal_rows)
    handle = F.get("handles", F.lit(0))
    found = df.select("id", test.is_female(handle), test.is_male(handle), test.is_seed_id(F.col("account"))).collect()
    expected = [(None, True, False, False), (None, False, True, True), (None, None, None, None), (None, None, None, True), ("1", True, False, None), (None, True, False, False)]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_lookups_stay_where_the_rows_are(spark):
    """Rows of any number of keys: few are looked up in place, many by joins on the row, with one result and no shuffle of the first."""
    handles = [f"h{i}" for i in range(0, 40, 2)]
    dim = spark.createDataFrame([(h, i) for i, h in enumerate(handles)], "k string, v int")
    r = random.Random(3)
    rows = [(None if n % 9 == 0 else str(n % 50), [r.choice([None, *(f"h{i}" for i in range(40))]) for _ in range(n % 12)]) for n in range(200)]
    df = spark.createDataFrame([*rows, ("x", None), (None, None), (None, [None])], "id string, keys array<string>")
    # an id stands for one row
    df = df.withColumn("id", F.when(F.col("id").isNotNull(), F.concat("id", F.lit("-"), F.monotonically_increasing_id().cast("string"))))
    said = {h: i for i, h in enumerate(handles)}
    for some in (dims.BROADCAST_ROWS, 0):
        found = dims.attach_lookup(df, "id", F.col("keys"), dim, "k", "v", "m", broadcast_rows=some)
        assert found.columns == ["id", "keys", "m"] and found.count() == 203
        for row in found.collect():
            assert (row["m"] or {}) == {k: said[k] for k in row["keys"] or [] if k in said}
    short = df.where(F.size("keys") <= dims.SLOTS)
    placed = dims._lookup_in_place(short.withColumn("_keys", F.array_distinct(F.array_compact("keys"))), dim, "k", "v", "m")
    assert "hashpartitioning" not in placed._jdf.queryExecution().executedPlan().toString()
