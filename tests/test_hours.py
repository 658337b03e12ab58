"""Hour tables: several batches, posts captured twice, crashes, fresh checkpoints, late posts."""

import json
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from plazalens.plans import hour_load, hourly
from plazalens.schemas import SEEDS, SUMMARIES
from plazalens.sinks import hours
from plazalens.sources import posts as post_source
from plazalens.streaming import handles, hourly as stream_hourly, late



def raw_post(id_, user, handle, hour, text):
    return {
        "id": id_, "user": {"id": user, "screen_name": f"u{user}"}, "text": text, "lang": "es", "place": None,
        "entities": {"user_mentions": [{"screen_name": handle}] if handle else []},
        "created_at": f"Wed Oct 26 {hour:02}:03:59 +0000 2022" if hour is not None else None,
        "in_reply_to_user_id": None, "in_reply_to_screen_name": None, "in_reply_to_status_id": None,
    }


@pytest.fixture
def dims(spark):
    seeds = [("10", "ana", "Ana", None, "F", "mayor", " ana ", "A", 1, 2, 0), ("12", "eva", "Eva", None, "F", "press", "eva", "E", 1, 2, 1)]
    insults = [(0, "tont[oa]", "FS", "F", "n-tonto"), (1, "bobo", "FS", "F", "n-bobo")]
    cats = [("n-tonto", None, "c", "sub"), ("n-bobo", None, "c", "sub2")]
    return hourly.Dimensions(
        spark.createDataFrame(seeds, SEEDS),
        spark.createDataFrame(insults, "ord bigint, regex3 string, target string, gender string, orig_name string"),
        spark.createDataFrame(cats, "Insulto string, Insulto_gendered string, `Categoría` string, `Subcategoría` string"),
    )


def classifier(df):
    return df.withColumn("abuse", F.contains("text_clean", F.lit("tonto")).cast("int"))


def made_posts(n=60):
    r = random.Random(4)
    posts = [
        raw_post(100 + i, r.randint(1, 5), r.choice(["ana", "eva", "zed"]), r.randint(8, 12), r.choice(["hola", "tonto #A", "bobo tonto #B #A", "x #A"]))
        for i in range(n)
    ]
    return [*posts, raw_post(None, 1, "ana", 9, "tonto"), raw_post(None, 1, "ana", 9, "tonto"), raw_post(999, 2, "eva", None, "tonto")]


def expected(posts):
    """The five summaries by plain Python; a post counts once per id, without one each counts."""
    once = list({(p["id"] if p["id"] is not None else f"row {i}"): p for i, p in enumerate(posts)}.values())
    out = defaultdict(Counter)
    for p in once:
        if not p["entities"]["user_mentions"] or p["created_at"] is None:
            continue
        seed = {"ana": "id_10", "eva": "id_12"}.get(p["entities"]["user_mentions"][0]["screen_name"])
        if not seed:
            continue
        hour, abuse = p["created_at"][11:13], "tonto" in p["text"]
        names = [n for n, w in (("n-bobo", "bobo"), ("n-tonto", "tonto")) if w in p["text"]] if abuse else []
        fan = max(1, len(names))
        out["mentions_and_abuse_summary"][hour, seed, "m"] += fan
        out["mentions_and_abuse_summary"][hour, seed, "a"] += fan * abuse
        for n in names:
            out["insults_summary"][hour, seed, n] += 1
            out["subc_summary"][hour, seed, {"n-tonto": "sub", "n-bobo": "sub2"}[n]] += 1
        for tag in [w for w in p["text"].split() if w[0] == "#"]:
            out["hashtags_summary"][hour, seed, tag] += 1
        out["users_abuse_summary"][hour, f"id_{p['user']['id']}", "n"] += 1
        out["users_abuse_summary"][hour, f"id_{p['user']['id']}", "a"] += fan * abuse
    return out


def held(spark, root):
    out = defaultdict(Counter)
    for table in hour_load.MERGED:
        rows = hour_load.read_hours(spark, root, table).collect()
        keys = [tuple(r[k] for k in hour_load.MERGED[table]) for r in rows]
        assert len(set(keys)) == len(keys), "a row a key"
        for r in rows:
            hour = f"{r['Hour'].hour:02}"
            if table == "mentions_and_abuse_summary":
                out[table][hour, r[1], "m"], out[table][hour, r[1], "a"] = r["N_mentions"], r["N_abuse"]
            elif table == "users_abuse_summary":
                out[table][hour, r[1], "n"], out[table][hour, r[1], "a"] = r["N_user"], r["N_user_abuse"]
            else:
                out[table][hour, r[1], r[2]] = r[3]
    return out


def write_file(folder, name, posts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(p) + "\n" for p in posts))


def run(spark, folder, dims, out, checkpoint, files=None, **options):
    feed = post_source.stream_posts(spark, str(folder), max_files_per_trigger=files, source="source_file")
    stream_hourly.run_incremental(spark, feed, dims, classifier, out, checkpoint, **options).awaitTermination()


def test_batches_repeats_and_a_fresh_checkpoint(spark, tmp_path, dims):
    posts = made_posts()
    again = [p for p in posts[:30:3] if p["id"]]
    parts = [posts[:20] + again[:2], posts[20:45] + again, again, posts[45:]]
    for i, part in enumerate(parts):
        write_file(tmp_path / "raw", f"output-{i}.jsonl", part)
    out = str(tmp_path / "out")
    run(spark, tmp_path / "raw", dims, out, str(tmp_path / "c1"), files=1)
    assert hours.HourStore(spark, out).last() == 3
    want = expected(posts)
    assert held(spark, out) == want
    # everything again by a checkpoint that knows nothing, and one new file with an old post and a new one
    new = raw_post(5000, 3, "ana", 9, "tonto #Z")
    write_file(tmp_path / "raw", "output-9.jsonl", [posts[0], new])
    run(spark, tmp_path / "raw", dims, out, str(tmp_path / "c2"))
    assert held(spark, out) == expected([*posts, new])
    assert hours.HourStore(spark, out).last() == 4
    raw = hour_load.read_hours(spark, out, "raw_data")
    assert raw.columns == SUMMARIES["raw_data"].names and raw.count() == len(posts) + 1
    sources = hours.HourStore(spark, out).read(hours.SOURCES, hours.SOURCE_SCHEMA, merged=False)
    assert sorted(r["posts"] for r in sources.collect()) == sorted([*map(len, parts), 2])


@pytest.mark.parametrize("fails_at", ["hashtags_summary", "commits"])
def test_a_crash_shows_nowhere(spark, tmp_path, dims, monkeypatch, fails_at):
    posts = made_posts(24)
    write_file(tmp_path / "raw", "output-1.jsonl", posts[:12])
    out = str(tmp_path / "out")
    run(spark, tmp_path / "raw", dims, out, str(tmp_path / "c"))
    write_file(tmp_path / "raw", "output-2.jsonl", posts[8:])
    append, commit = hours.Change.append, hours.Change.commit

    def broken_append(self, table, rows):
        written = append(self, table, rows)
        if table == fails_at:
            raise RuntimeError("lost after writing")
        return written

    def broken_commit(self):
        raise RuntimeError("lost before the commit")

    monkeypatch.setattr(hours.Change, "append", broken_append)
    if fails_at == "commits":
        monkeypatch.setattr(hours.Change, "commit", broken_commit)
    run(spark, tmp_path / "raw", dims, out, str(tmp_path / "c"), keep_going=True)
    assert held(spark, out) == expected(posts[:12])
    assert "lost" in spark.read.parquet(f"{out}/failures").first()["exception"]
    monkeypatch.setattr(hours.Change, "append", append)
    monkeypatch.setattr(hours.Change, "commit", commit)
    run(spark, tmp_path / "raw", dims, out, str(tmp_path / "fresh"))
    assert held(spark, out) == expected(posts)


def test_a_second_writer_fails(spark, tmp_path):
    store = hours.HourStore(spark, str(tmp_path))
    one, two = store.change(), store.change()
    one.commit()
    with pytest.raises(Exception, match="(?i)exist"):
        two.commit()
    assert store.last() == 0


@pytest.mark.parametrize("bits", [1 << 23, 1 << 15])
def test_seen_ids(spark, tmp_path, monkeypatch, bits):
    """Filters that let too much through change nothing; ids are known by hour; posts without id stay."""
    monkeypatch.setattr(hours, "FILTER_BITS", bits)
    store = hours.HourStore(spark, str(tmp_path))
    rows = lambda ids, hour: spark.createDataFrame([(None if i is None else str(i), hour) for i in ids], "id string, period string")
    assert hours.unseen(store, rows([1, 2, None], "h1"), ["h1"]).count() == 3
    for ids, hour in ((range(3000), "h1"), (range(2000, 2500), "h2"), (range(4000, 4400), "h1")):
        change = store.change()
        hours.remember(change, rows([*ids, None], hour), [hour])
        change.commit()
    batch = rows([*range(2900, 4100), None, None], "h1").unionAll(rows([2100, 2600], "h2")).unionAll(rows([1], "h3"))
    left = hours.unseen(store, batch, hours.periods_of(batch))
    assert left.columns == ["id", "period"]
    found = Counter((r["period"], r["id"]) for r in left.collect())
    assert found == Counter([("h1", str(i)) for i in range(3000, 4000)] + [("h1", None)] * 2 + [("h2", "2600"), ("h3", "1")])
    maybe = hours.maybe_seen(store, batch.where("id is not null"), hours.periods_of(batch)).count()
    assert maybe >= 201 and (maybe < 220 or bits == 1 << 15)


def test_posts_are_written_once_before_they_are_counted(spark, tmp_path):
    """Repeats within a batch and across batches, copies in two periods: known by the kept copy's period, and no table of the deduplicated
    posts is written on the way."""
    influencers = spark.createDataFrame([("ana", "ana")], "mention string, influencer_id string")
    schema = "id string, ts timestamp, is_rt boolean, abuse int, f_seed array<string>, insults_name array<string>, source string"
    batches = [[("1", 3), ("1", 3), (None, 3), (None, 3)], [("1", 3), ("2", 4), ("2", 5), ("2", 4), (None, 3)], [("2", 5), ("3", 5)]]
    for n, batch in enumerate(batches):
        rows = [(i, f"2022-10-26 {h:02}:30:00", False, 0, ["ana"], None, f"b{n}") for i, h in batch]
        texts = spark.createDataFrame(rows, schema.replace("timestamp", "string"))
        late.count_batch(texts.withColumn("ts", F.col("ts").cast("timestamp")), influencers, str(tmp_path))
    counts = {r["Hour"].hour: r["N_mentions"] for r in late.hour_counts(spark, str(tmp_path)).collect()}
    assert counts == {3: 4, 4: 1, 5: 2}
    assert not (tmp_path / "scratch" / "once").exists()


def test_untouched_hours_are_not_rewritten(spark, tmp_path):
    store = hours.HourStore(spark, str(tmp_path))
    for rows in ([("a", 1, "h1"), ("b", 2, "h2")], [("a", 5, "h1"), ("c", 1, "h1")]):
        change = store.change()
        change.merge("t", spark.createDataFrame(rows, "k string, n long, period string"), ["k"], sorted({r[2] for r in rows}))
        change.commit()
    schema = spark.createDataFrame([], "k string, n long").schema
    assert sorted(map(tuple, store.read("t", schema).collect())) == [("a", 6, "h1"), ("b", 2, "h2"), ("c", 1, "h1")]
    assert sorted(map(tuple, store.live("t", True).collect())) == [("h1", 1), ("h2", 0)]


def test_an_empty_store(spark, tmp_path):
    store = hours.HourStore(spark, str(tmp_path / "nothing"))
    assert store.last() == -1 and store.read("t", SUMMARIES["subc_summary"]).isEmpty()
    assert hour_load.read_hours(spark, str(tmp_path / "nothing"), "raw_data").columns == SUMMARIES["raw_data"].names


# ---------------------------------------------------------------- posts in any order


def facts(n=80):
    """id, hour, seed, abuse, names, retweet"""
    r = random.Random(8)
    rows = [(str(i), r.randint(0, 20), r.choice(["ana", "eva", "zed"]), r.randint(0, 1), r.randint(0, 2), r.random() < 0.3) for i in range(n)]
    return [*rows, (None, 3, "ana", 1, 0, False), (None, 3, "ana", 1, 0, False), ("x", None, "ana", 1, 1, False)]


def as_frame(spark, rows):
    data = [(i, f"2022-10-26 {h:02}:30:00" if h is not None else None, rt, a, [s], ["n"] * k or None) for i, h, s, a, k, rt in rows]
    df = spark.createDataFrame(data, "id string, t string, is_rt boolean, abuse int, f_seed array<string>, insults_name array<string>")
    return df.withColumn("ts", F.col("t").cast("timestamp")).drop("t")


def counted(rows):
    out = defaultdict(lambda: [0, 0, 0, 0])
    for _, h, s, a, k, rt in rows:
        if h is not None and s != "zed":
            fan, row = max(1, k), out[h, s]
            row[0] += fan
            row[1] += fan * a
            row[2] += fan * (not rt)
            row[3] += fan * a * (not rt)
    return {k: tuple(v) for k, v in out.items()}


def test_posts_in_any_order(spark, tmp_path):
    rows = facts()
    random.Random(2).shuffle(rows)
    influencers = spark.createDataFrame([("ana", "ana"), ("eva", "eva"), ("zed", None)], "mention string, influencer_id string")
    parts = [rows[:25], rows[25:40], rows[40:60], rows[60:]]
    out, newest, late_want = str(tmp_path / "out"), None, Counter()
    for part in parts:
        # each batch holds posts of the one before again
        repeated = [r for r in rows[: rows.index(part[0])][-5:] if r[0] is not None]
        as_frame(spark, part + repeated).write.mode("append").parquet(str(tmp_path / "in"))
        feed = spark.readStream.schema(as_frame(spark, []).schema).parquet(str(tmp_path / "in"))
        late.run_hour_counts(feed, influencers, out, str(tmp_path / "c")).awaitTermination()
        if newest is not None:
            late_want.update(r[1] for r in part if r[1] is not None and r[1] + 1 <= newest + 0.5 - 1)
        newest = max([r[1] for r in part if r[1] is not None] + ([newest] if newest is not None else []))
    read = lambda **o: {(r["Hour"].hour, r["influencer_id"]): (r["N_mentions"], r["N_abuse"], r["N_mentions_orig"], r["N_abuse_orig"])
                        for r in late.hour_counts(spark, out, **o).collect()}
    want = counted(rows)
    assert read() == want
    assert read(closed_only=True) == {k: v for k, v in want.items() if k[0] + 1 <= newest - 0.5}
    assert {r["Hour"].hour: r["posts"] for r in late.late_posts(spark, out).collect()} == dict(late_want)
    # a repeated batch and a fresh checkpoint; posts without an id are known by their batch only
    batch = as_frame(spark, [(None, 5, "eva", 0, 0, False)]).withColumn("source", F.lit("c#77"))
    for n in (1, None):
        assert (late.count_batch(batch, influencers, out) is None) == (n is None)
    named = as_frame(spark, [r for r in rows if r[0]]).withColumn("source", F.lit("other"))
    late.count_batch(named, influencers, out)
    assert read() == counted([*rows, (None, 5, "eva", 0, 0, False)])


def test_a_bad_file_fails_alone(spark, tmp_path, dims):
    posts = made_posts(40)
    parts = [posts[:10], posts[10:20], [raw_post(7000, 1, "ana", 9, "poison tonto")], posts[20:]]
    for i, part in enumerate(parts):
        write_file(tmp_path / "raw", f"output-{i}.jsonl", part)
    out, bad = str(tmp_path / "out"), "poison"

    def picky(df):
        refuse = F.when(F.contains("text_clean", F.lit(bad)), F.raise_error(F.lit("no such text"))).otherwise(F.contains("text_clean", F.lit("tonto")))
        return df.withColumn("abuse", refuse.cast("int"))

    def once(checkpoint, classify):
        feed = post_source.stream_posts(spark, str(tmp_path / "raw"), source="source_file")
        stream_hourly.run_incremental(spark, feed, dims, classify, out, str(tmp_path / checkpoint), apart=True).awaitTermination()

    once("c1", picky)
    assert held(spark, out) == expected([p for part in (0, 1, 3) for p in parts[part]])
    failures = spark.read.parquet(f"{out}/failures").collect()
    assert len(failures) == 1 and "output-2.jsonl" in str(failures[0])
    # mended, it is taken by a later run, and the others aren't taken again
    once("c2", classifier)
    assert held(spark, out) == expected([p for part in parts for p in part])
    # where nothing can be loaded, the batch fails

    def broken(df):
        raise RuntimeError("no model")

    files = spark.createDataFrame([("a",), ("b",), ("c",)], "source_file string")
    with pytest.raises(RuntimeError, match="no model"):
        stream_hourly.load_apart(broken, files, "source_file", lambda name, e: None)


def test_versions_of_the_seed_list(spark, tmp_path, dims):
    folder = str(tmp_path / "seeds")
    handles.start_seeds(dims.seeds, folder)
    rows = [("10", "AnaDos", "2022-10-01 10:00:00"), ("99", "other", "2022-10-01 10:00:00"), (None, "x", "2022-10-01 10:00:00"), ("12", "eva", "2022-10-01 10:00:00")]
    later = [("10", "AnaTres", "2022-10-02 10:00:00"), ("10", "AnaCero", "2022-09-01 10:00:00")]
    schema = "user_id string, screen_name string, datetime timestamp_ntz"

    def arrive(name, some):
        df = spark.createDataFrame(some, "user_id string, screen_name string, datetime string").withColumn("datetime", F.to_timestamp_ntz("datetime"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / name))

    def track(checkpoint):
        feed = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "*"))
        handles.track_handles(spark, feed, folder, str(tmp_path / checkpoint)).awaitTermination()
        return {r.user_id: r.screen_name for r in handles.read_seeds(spark, folder).collect()}

    arrive("a", rows)
    assert track("c1") == {"10": "anados", "12": "eva"}
    version = hours.HourStore(spark, folder).last()
    arrive("b", later)
    assert track("c1") == {"10": "anatres", "12": "eva"}
    # a fresh checkpoint that is given all posts again writes no version and undoes nothing
    assert track("c2") == {"10": "anatres", "12": "eva"} and hours.HourStore(spark, folder).last() == version + 1
    handles.start_seeds(dims.seeds, folder)
    spans = sorted((r.user_id, r.screen_name, str(r.valid_from), str(r.valid_to)) for r in handles.handle_history(spark, folder).collect())
    assert spans == [
        ("10", "ana", "None", "2022-10-01 10:00:00"), ("10", "anados", "2022-10-01 10:00:00", "2022-10-02 10:00:00"),
        ("10", "anatres", "2022-10-02 10:00:00", "None"), ("12", "eva", "None", "None"),
    ]
    assert handles.read_seeds(spark, folder).columns == dims.seeds.columns
