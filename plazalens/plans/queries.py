"""The registered queries: every operator over the stand-in tables, whole tables and whole texts."""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from plazalens.functions import find, handles, scores, text, times
from plazalens.operators import bridges, capture, classify, dedup, dictionary, dims, flatten, insults, pattern_index, seeds, summaries, word_model
from plazalens.plans import hour_load, hourly, stand_in
from plazalens.schemas import FLAT_POST, SUMMARIES
from plazalens.session import shared_dir
from plazalens.sinks import hours, tables
from plazalens.sources import dimensions, files, posts as post_source
from plazalens.streaming import capture as stream_capture_stage
from plazalens.streaming import handles as stream_handle_stage
from plazalens.streaming import hourly as stream_hourly
from plazalens.streaming import late

# Parameters of the checks
SEPARATOR = "|"
KEYWORDS = [("no", 1), ("colec+ion", 2), ("bob", 3), ("viva", 4)]
WORD_PATTERN = "eau[a-z]{2,4}|tion[ae]|sch(?:en|er)|ment"
ANCHORED_PATTERN = r"\ban\w|th|^de"
FUZZY_PATTERN = "(?:thereof){e<=1}"
INSULTS = [
    (0, "eau[a-z]{2,4}", "FS", "F", "n-eau"),
    (1, "tion[ae]", "FP", "F", "n-tion"),
    (2, "sch(?:en|er)", "US", "F", "n-sch"),
    (3, "hed[a-z]", "IS", "F", "n-hed"),
    (4, "ment", "IP", None, "n-ment"),
    (5, "por", "MP", "M", "n-por"),
    (6, "der", "MS", "M", "n-der"),
    (7, "thand", "Exclude", None, "n-thand"),
    (8, "von [a-z]+", "Exclude", None, "n-von"),
    (9, "eau[a-z]{2,4}", "FP", "F", "n-eau-late"),
]
POST_INSULTS = [
    (0, "tonti?n", "FS", "F", "n-tontin"),
    (1, "bobo", "US", "F", "n-bobo"),
    (2, "tonton", "FP", "F", "n-tonton"),
    (3, "low", "MS", "M", "n-low"),
    (4, "tonton +high", "Exclude", None, "n-high"),
]
FOLLOWED = [str(n) for n in range(1000, 1040)]
TRACKED = ["@Seed7", "@Seed11", "tont[oó]n"]
MALFORMED_EVERY = 17
SEED_FILES = 5
# Batches of the streamed queries, and which posts a later batch captures again
LOADS, CAPTURED_AGAIN, BATCHES = 3, 7, 5
# The stand-in posts are spread over years, a post or so an hour
UNIT = "year"


def _insult_rows(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, "ord bigint, regex3 string, target string, gender string, orig_name string")


def _keywords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KEYWORDS, "word string, ord bigint")


def plain(df: DataFrame) -> DataFrame:
    """Arrays as joined text, which compares the same way everywhere."""
    return df.select(
        *[
            (F.array_join(f"`{f.name}`", SEPARATOR) if isinstance(f.dataType, ArrayType) else F.col(f"`{f.name}`")).alias(
                f.name
            )
            for f in df.schema.fields
        ]
    )


# ---------------------------------------------------------------- summaries over relational tables


def _views(spark, sf, *names) -> list[DataFrame]:
    return [stand_in.view(spark, sf, n) for n in names]


def mentions_abuse_summary(spark, sf):
    return summaries.mentions_abuse_summary(*_views(spark, sf, "tw", "men", "seed", "ab", "ins"))


def mentions_abuse_distinct(spark, sf):
    return summaries.mentions_abuse_distinct(*_views(spark, sf, "tw", "men", "seed", "ab"))


def hashtags_summary(spark, sf):
    return summaries.hashtags_summary(*_views(spark, sf, "tw", "men", "seed", "hsh"))


def insults_summary(spark, sf):
    return summaries.insults_summary(*_views(spark, sf, "tw", "men", "seed", "ab", "ins"))


def subcategory_summary(spark, sf):
    return summaries.subcategory_summary(insults_summary(spark, sf), stand_in.view(spark, sf, "cat"))


def users_abuse_summary(spark, sf):
    return summaries.users_abuse_summary(*_views(spark, sf, "tw", "ab", "ins"))


def abuse_insults(spark, sf):
    return bridges.abuse_with_insults(*_views(spark, sf, "ab", "ins"))


def author_abuse(spark, sf):
    tw, ab, ins = _views(spark, sf, "tw", "ab", "ins")
    authors = tw.select("id", "user_id", F.col("rt").alias("rt_from_user_id"))
    return bridges.author_abuse(bridges.abuse_with_insults(ab, ins), authors)


# ---------------------------------------------------------------- posts


def _posts(spark, sf) -> DataFrame:
    return post_source.good_posts(stand_in.posts(spark, sf))


def _tidy(spark, sf, tracked: bool = True, **options) -> DataFrame:
    keywords = _keywords(spark) if tracked else None
    return flatten.flatten_posts(_posts(spark, sf), stand_in.seeds(spark, sf), keywords, **options)


def _tidy_columns(*columns: str) -> Callable:
    return lambda spark, sf: plain(_tidy(spark, sf).select(*columns))


def tidy_posts(spark, sf):
    return plain(_tidy(spark, sf))


def tidy_posts_joined(spark, sf):
    """The same table by the route for seed lists too long for a plan."""
    return plain(_tidy(spark, sf, literal_rows=0))


def seed_target(spark, sf):
    return _tidy(spark, sf, tracked=False).select("id", "valid")


def only_female_posts(spark, sf):
    return plain(_tidy(spark, sf, only_female=True).select("id", "f_seed", "directed_at_f"))


def raw_projection(spark, sf):
    return plain(flatten.raw_projection(_tidy(spark, sf), tracking=True))


def raw_projection_untracked(spark, sf):
    return plain(flatten.raw_projection(_tidy(spark, sf, tracked=False)))


def directed_posts(spark, sf):
    return plain(flatten.narrow(flatten.directed_at(flatten.valid_posts(_tidy(spark, sf)))))


def post_counts(spark, sf):
    return flatten.post_counts(_tidy(spark, sf))


def bridge_mentions(spark, sf):
    pairs = bridges.mention_pairs(_tidy(spark, sf))
    return bridges.mention_bridge(pairs, seeds.influencers(stand_in.seeds(spark, sf))).drop("rt_from_user_id")


def bridge_hashtags(spark, sf):
    return bridges.hashtag_pairs(_tidy(spark, sf))


def author_rows(spark, sf):
    return bridges.author_rows(_tidy(spark, sf))


def dedup_posts(spark, sf):
    tidy = _tidy(spark, sf).select("id", "user_id", "tweet_type")
    return dedup.drop_repeated_posts(tidy.unionAll(tidy).unionAll(tidy.where(F.col("tweet_type") == "reply")))


def quarantine(spark, sf):
    """Lines cut in the middle, one in every few, kept apart from the posts."""
    lines = stand_in.post_lines(spark, sf)
    broken = F.when(F.col("key") % MALFORMED_EVERY == 0, F.concat(F.lit("{\"id\": "), F.col("key"), F.lit(", oops")))
    mixed = lines.select(F.coalesce(broken, "line").alias("line"))
    return post_source.bad_lines(post_source.parse_lines(mixed, "line"))


def capture_filter(spark, sf):
    kept = capture.capture_filter(_posts(spark, sf), FOLLOWED, TRACKED, flatten.post_text())
    return kept.select("id")


def capture_enrich(spark, sf):
    return capture.enrich_capture(_posts(spark, sf)).select("id", "id_num", "date", "datetime")


def created_at_parse(spark, sf):
    return _posts(spark, sf).select("id", times.parse_created_at(F.col("created_at")).alias("ts"))


def hour_trunc(spark, sf):
    (events,) = stand_in.load(spark, sf, "events")
    return events.select("event_id", times.hour_of(F.col("ts")).alias("hour"))


def v2_flatten(spark, sf):
    """Events as the flat feed, written to JSON text and read with its schema."""
    (events,) = stand_in.load(spark, sf, "events")
    feed = events.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("text"), F.col("user_id").alias("author_id"),
        F.col("ts").alias("created_at"),
    )
    lines = capture.flatten_flat(feed).select(F.to_json(F.struct("*")).alias("line"))
    return post_source.good_posts(post_source.parse_lines(lines, "line", FLAT_POST))


def capture_filter_flat(spark, sf):
    kept = capture.capture_filter_flat(v2_flatten(spark, sf), [str(n) for n in range(10, 20)], ["err", "sign.p"])
    return kept.select("id", "author_id", "text")


def file_hours(spark, sf):
    (events,) = stand_in.load(spark, sf, "events")
    named = events.select(
        F.concat(F.lit("output-"), F.date_format("ts", "dd-MM-yyyy-HH"), F.lit(".jsonl")).alias("file_name")
    ).distinct()
    now = F.lit("2024-02-01 00:30:00").cast("timestamp_ntz")
    return files.older_than(files.with_file_hour(named, now=now), 1.0)


# ---------------------------------------------------------------- text


def _texts(spark, sf) -> DataFrame:
    return stand_in.view(spark, sf, "txt")


def _documents(spark, sf) -> DataFrame:
    return stand_in.spread(stand_in.load(spark, sf, "documents")[0], "doc_id").select(F.col("doc_id").alias("id"), "text")


def _text_column(make: Callable[[Column], Column], name: str, source=_texts) -> Callable:
    return lambda spark, sf: plain(source(spark, sf).select("id", make(F.col("text")).alias(name)))


def _cleaned(spark, sf) -> DataFrame:
    return _documents(spark, sf).select("id", text.clean_text(F.col("text")).alias("text"))


def clean_html_text(spark, sf):
    (pages,) = stand_in.load(spark, sf, "pages")
    pages = stand_in.spread(pages, "page_id")
    return pages.select(F.col("page_id").alias("id"), text.clean_model_text(F.col("html")).alias("cleaned"))


def remove_hits(spark, sf):
    found = _cleaned(spark, sf).withColumn("hits", find.find_all(F.col("text"), WORD_PATTERN))
    return found.select("id", find.remove_hits(F.col("text"), F.col("hits")).alias("filtered"))


def _handled(spark, sf, make, **options) -> DataFrame:
    cleaned = _texts(spark, sf).select("id", text.clean_model_text(F.col("text"), "xml").alias("cleaned"))
    groups = seeds.as_tokens(stand_in.seeds(spark, sf))
    marked, tokens, token_of = seeds.handle_groups(cleaned, F.col("cleaned"), groups, **options)
    return plain(marked.select("id", make(F.col("cleaned"), tokens, token_of)))


def token_map(spark, sf):
    return _handled(spark, sf, lambda c, t, f: handles.replace_handles(c, t, f).alias("replaced"))


def token_map_joined(spark, sf):
    return _handled(spark, sf, lambda c, t, f: handles.replace_handles(c, t, f).alias("replaced"), literal_rows=3)


def mention_tokens(spark, sf):
    matched = _handled(spark, sf, lambda c, t, f: handles.matched_handles(c, t, f).alias("matched"))
    return plain(matched.select("id", "matched.*"))


def first_match(spark, sf):
    compiled = dictionary.compile_dictionary(_insult_rows(spark, INSULTS))
    words = find.find_all(F.col("text"), compiled.insults_fiu)
    return plain(_cleaned(spark, sf).select("id", find.first_names(words, compiled.entries).alias("names")))


def token_map_indexed(spark, sf):
    """The tokens by way of an index, as for any number of them."""
    cleaned = _texts(spark, sf).select("id", text.clean_model_text(F.col("text"), "xml").alias("cleaned"))
    groups = seeds.as_tokens(stand_in.seeds(spark, sf))
    return plain(seeds.with_group_tokens(cleaned, "cleaned", groups, "replaced", plan_tokens=0).select("id", "replaced"))


def document_keywords_indexed(spark, sf):
    """The keywords by way of an index, as for lists of any length."""
    words = spark.createDataFrame(KEYWORDS, "word string, ord bigint")
    return plain(pattern_index.attach_keywords(_cleaned(spark, sf), "text", words, plan_patterns=0).select("id", "keywords"))


def document_keywords(spark, sf):
    words = [w for (w, _) in KEYWORDS]
    return plain(_cleaned(spark, sf).select("id", find.keyword_hits(F.col("text"), words).alias("keywords")))


def _abusive_documents(spark, sf) -> DataFrame:
    m_seed = F.when(F.col("id") % 2 == 1, F.array(F.lit("x"))).otherwise(F.expr("array()").cast("array<string>"))
    return _cleaned(spark, sf).select(
        "id", F.col("text").alias("text_clean"), m_seed.alias("m_seed"),
        F.when(F.col("id") % 3 < 2, 1).otherwise(0).alias("abuse"),
    )


def _insult_dictionary(spark) -> dictionary.Dictionary:
    return dictionary.compile_dictionary(_insult_rows(spark, INSULTS))


def extract_insults(spark, sf):
    found = insults.extract_insults(_abusive_documents(spark, sf), _insult_dictionary(spark))
    return plain(
        found.select("id", "insults_search", "not_f", "text_filtered", "female_insults", "fiu_insults", "insults_name")
    )


def extract_insults_indexed(spark, sf):
    """The same by way of an index, as for dictionaries of any length."""
    found = insults.extract_insults(_abusive_documents(spark, sf), dictionary.index_dictionary(_insult_rows(spark, INSULTS)))
    return plain(
        found.select("id", "insults_search", "not_f", "text_filtered", "female_insults", "fiu_insults", "insults_name")
    )


def extract_male_insults(spark, sf):
    found = insults.extract_male_insults(_abusive_documents(spark, sf), _insult_dictionary(spark))
    return plain(found.select("id", "insults_search", "not_m", "text_filtered", "male_insults"))


def bridge_insults(spark, sf):
    found = insults.extract_insults(_abusive_documents(spark, sf), _insult_dictionary(spark))
    return bridges.insult_pairs(found)


# ---------------------------------------------------------------- dictionary and seeds


def dictionary_lists(spark, sf):
    return dictionary.pattern_lists(stand_in.view(spark, sf, "dict"))


def dictionary_map(spark, sf):
    (part,) = stand_in.load(spark, sf, "part")
    target = F.element_at(F.array(*map(F.lit, [*dictionary.NAMED_TARGETS, "MS", "Exclude"])), (F.col("p_size") % 8 + 1).cast("int"))
    rows = part.select(
        F.lower("p_brand").alias("regex3"), F.col("p_partkey").alias("ord"), target.alias("target"),
        F.concat_ws("/", "p_name", "p_type").alias("orig_name"),
    )
    return dictionary.pattern_map(rows)


def not_in_null_safe(spark, sf):
    return dictionary.without_category(stand_in.view(spark, sf, "cat"))


def category_table(spark, sf):
    return tables.category_table(stand_in.view(spark, sf, "cat"))


def seed_metadata(spark, sf):
    return tables.seed_table(stand_in.seeds(spark, sf))


def seed_files(spark, sf):
    """The seed list as several CSV files without an order column, read back in the order of files and rows."""
    folder = f"{shared_dir(spark)}/seed-files-{uuid.uuid4().hex}"
    ordered = stand_in.seeds(spark, sf).repartitionByRange(SEED_FILES, "ord").sortWithinPartitions("ord")
    tables.write_csv(ordered.select("screen_name", "user_id", "Tipo", "followers_count"), folder)
    return dimensions.read_seeds(spark, folder).select("user_id", "screen_name", "Tipo", "followers_count", "ord")


def distinct_tokens(spark, sf):
    return seeds.as_tokens(stand_in.seeds(spark, sf)).select("token").distinct()


def _accounts(spark, sf) -> DataFrame:
    """Customers as a long seed list."""
    (customer,) = stand_in.load(spark, sf, "customer")
    return customer.select(
        F.when(F.col("c_custkey") % 13 != 0, F.col("c_custkey").cast("string")).alias("user_id"),
        F.col("c_custkey").alias("ord"), F.col("c_name").alias("screen_name"),
    )


def seed_pages(spark, sf):
    return seeds.seed_pages(_accounts(spark, sf), "user_id", stride=1000)


def handle_pages(spark, sf):
    return seeds.seed_pages(_accounts(spark, sf), "screen_name", page=400)


def tracking_words(spark, sf):
    (benchmark,) = stand_in.load(spark, sf, "benchmark")
    words = benchmark.select(F.explode(F.split("text", " ")).alias("word")).where("word <> ''").distinct()
    return seeds.tracking_words(stand_in.seeds(spark, sf), words)


def handle_map(spark, sf):
    (orders,) = stand_in.load(spark, sf, "orders")
    rows = orders.select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("ord"),
        F.concat(F.lit("@"), "o_orderpriority").alias("screen_name"),
    )
    return seeds.handle_of_account(rows)


def seed_upsert(spark, sf):
    """Handle changes read off the orders: some seed suppliers, as customers, post under another name."""
    (orders,) = stand_in.load(spark, sf, "orders")
    accounts = orders.select(
        (F.col("o_custkey") + 1000).cast("string").alias("user_id"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Neo"), "o_custkey"))
        .otherwise(F.concat(F.lit("Seed"), "o_custkey")).alias("screen_name"),
        (F.col("o_orderdate") + F.expr("make_interval(0,0,0,0,0,0,o_orderkey % 86400)")).alias("datetime"),
    )
    changed = seeds.apply_handle_changes(stand_in.seeds(spark, sf), seeds.latest_handles(accounts))
    return changed.select("user_id", "screen_name", "screen_name_orig", "updated", "ord")


# ---------------------------------------------------------------- classification


def argmax_class(spark, sf):
    (embeddings,) = stand_in.load(spark, sf, "embeddings")
    return embeddings.select("vec_id", scores.argmax_class(F.col("embedding")).alias("class"))


def classify_default(spark, sf):
    documents, labels = stand_in.load(spark, sf, "documents", "labels")
    labelled = documents.join(labels, "doc_id").select("text", F.col("toxic").cast("double").alias("label"))
    model = classify.fit_default_model(labelled)
    cleaned = _texts(spark, sf).select("id", text.clean_model_text(F.col("text"), "xml").alias("text"))
    return classify.classify_with_model(cleaned, model).select("id", "abuse")


def classify_words(spark, sf):
    """The word model, fitted and applied on the same cleaned text."""
    (labels,) = stand_in.load(spark, sf, "labels")
    cleaned = stand_in.settle(_texts(spark, sf).select("id", text.clean_model_text(F.col("text"), "xml").alias("text")), "cleaned")
    labels = labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    # few labels go to the texts, which then needn't move
    labelled = cleaned.join(F.broadcast(labels) if dims.at_most(labels, dims.BROADCAST_ROWS) else labels, "id")
    return word_model.classify_words(cleaned, word_model.fit_word_model(labelled)).select("id", "abuse")


def classify_posts(spark, sf):
    """A scorer brought by the caller, on whole texts: it scores by text length, so that SQL can follow."""

    def load_scorer():
        return lambda texts: [[len(t) % 7, len(t) % 5, len(t) % 3] for t in texts]

    return classify.classify_posts(_documents(spark, sf), load_scorer, "text").select("id", "abuse")


# ---------------------------------------------------------------- streams


def _post_facts(spark, sf) -> DataFrame:
    """The relational posts with their arrays."""
    tw, men, ab, ins = _views(spark, sf, "tw", "men", "ab", "ins")
    names = ins.groupBy("id").agg(F.collect_list("insult").alias("insults_name"))
    seeds_of = men.groupBy("id").agg(F.collect_set(F.col("mention").cast("string")).alias("f_seed"))
    return (
        tw.join(ab, "id").join(seeds_of, "id", "left").join(names, "id", "left")
        .select("id", F.col("ts").cast("timestamp").alias("ts"), F.col("rt").isNotNull().alias("is_rt"), "abuse",
                F.coalesce("f_seed", F.array().cast("array<string>")).alias("f_seed"), "insults_name")
    )


def _streamed_posts(spark, sf) -> DataFrame:
    """The posts, every one written twice, as a stream of files."""
    rows = _post_facts(spark, sf)
    folder = f"{shared_dir(spark)}/posts-{uuid.uuid4().hex}"
    rows.unionAll(rows).write.parquet(folder)
    return spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)


def _run(spark, start: Callable) -> str:
    """Starts a stream into a fresh folder, waits until the available input is done, returns the folder."""
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    query = start(f"{folder}/out", f"{folder}/checkpoint")
    query.awaitTermination()
    return f"{folder}/out"


def stream_summary(spark, sf):
    """Hours closed by the watermark, each given out once, repeated posts dropped."""
    seed = stand_in.view(spark, sf, "seed").select(F.col("mention").cast("string").alias("mention"), "influencer_id")
    counted = stream_hourly.stream_mentions_abuse(_streamed_posts(spark, sf), seed)
    return spark.read.parquet(_run(spark, lambda out, cp: stream_hourly.append_table(counted, out, cp)))


def stream_dedup(spark, sf):
    once = dedup.drop_repeated_within(_streamed_posts(spark, sf)).select("id", "abuse")
    return spark.read.parquet(_run(spark, lambda out, cp: stream_hourly.append_table(once, out, cp)))


def stream_capture(spark, sf):
    """Captured posts as the raw store keeps them, read back."""
    feed = post_source.stream_posts(spark, stand_in.raw_folder(spark, sf))
    captured = stream_capture_stage.capture_posts(feed, FOLLOWED, TRACKED)
    out = _run(spark, lambda out, cp: stream_capture_stage.store_raw(captured, out, cp, compression="gzip"))
    stored = post_source.read_posts(spark, out, archived=True)
    return post_source.good_posts(stored).select("id", "id_num", "date", "datetime")


def stream_handles(spark, sf):
    """Seed list after the handles seen in a stream of posts, which a fresh checkpoint then reads again."""
    feed = stream_capture_stage.follow_handles(post_source.stream_posts(spark, stand_in.raw_folder(spark, sf)))
    seed_list = stand_in.seeds(spark, sf).withColumn("user_id", F.col("ord").cast("string"))

    def start(out, checkpoint):
        stream_handle_stage.start_seeds(seed_list, out)
        stream_handle_stage.track_handles(spark, feed, out, checkpoint).awaitTermination()
        return stream_handle_stage.track_handles(spark, feed, out, f"{checkpoint}-fresh")

    changed = stream_handle_stage.read_seeds(spark, _run(spark, start))
    return changed.select("user_id", "screen_name", "screen_name_orig", "updated", "ord")


def stream_hourly_run(spark, sf):
    """The whole hourly run as a stream of raw files; the mention table it leaves."""
    feed = post_source.stream_posts(spark, stand_in.raw_folder(spark, sf))
    dims = _dimensions(spark, sf)
    out = _run(spark, lambda out, cp: stream_hourly.run_incremental(spark, feed, dims, _mark_abuse, out, cp, unit=UNIT))
    return hour_load.read_hours(spark, out, "mentions_and_abuse_summary")


# Runs over a feed that arrives in parts, posts captured again in later ones; several queries look at what one run has left
_runs: dict[tuple, str] = {}


def _once(name: str) -> Callable:
    """The folder that a run filled, filled once per application and input."""

    def wrap(fill: Callable) -> Callable:
        def folder(spark, sf) -> str:
            key = (name, spark.sparkContext.applicationId, sf)
            if key not in _runs:
                path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
                fill(spark, sf, path)
                _runs[key] = path
            return f"{_runs[key]}/out"

        return folder

    return wrap


@_once("hour-load")
def _hour_load(spark, sf, path):
    """Three batches of raw files, then a fresh checkpoint that is given all of them again."""
    posts, key = stand_in.post_rows(spark, sf), F.col("id")
    for part in range(LOADS):
        stand_in.write_raw(posts.where((key % LOADS == part) | (key % CAPTURED_AGAIN == part)), f"{path}/raw")
        for checkpoint in ["checkpoint", "fresh"][: 2 if part == LOADS - 1 else 1]:
            feed = post_source.stream_posts(spark, f"{path}/raw", source="source_file")
            run = stream_hourly.run_incremental(spark, feed, _dimensions(spark, sf), _mark_abuse, f"{path}/out", f"{path}/{checkpoint}", unit=UNIT)
            run.awaitTermination()


@_once("late-load")
def _late_load(spark, sf, path):
    """Posts of all hours in each of several batches, each post in two of them."""
    seed = stand_in.view(spark, sf, "seed").select(F.col("mention").cast("string").alias("mention"), "influencer_id")
    rows, key = stand_in.settle(_post_facts(spark, sf), "facts"), F.col("id")
    for part in range(BATCHES):
        rows.where((key % BATCHES == part) | ((key + 1) % BATCHES == part)).write.mode("append").parquet(f"{path}/in")
        feed = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
        late.run_hour_counts(feed, seed, f"{path}/out", f"{path}/checkpoint", unit=UNIT).awaitTermination()


def _loaded(table: str) -> Callable:
    return lambda spark, sf: hour_load.read_hours(spark, _hour_load(spark, sf), table)


def stream_hourly_raw(spark, sf):
    raw = hour_load.read_hours(spark, _hour_load(spark, sf), "raw_data")
    return plain(raw.select("id", "datetime", "user_id", "keywords", "valid"))


def stream_sources(spark, sf):
    """Posts read from all files and commits that read them; the fresh checkpoint adds none."""
    sources = hours.HourStore(spark, _hour_load(spark, sf)).read(hours.SOURCES, hours.SOURCE_SCHEMA, merged=False)
    last = hours.HourStore(spark, _hour_load(spark, sf)).last()
    return sources.agg(F.sum("posts").alias("posts"), F.lit(last + 1).cast("bigint").alias("commits"))


def stream_summary_late(spark, sf):
    counts = late.hour_counts(spark, _late_load(spark, sf))
    return counts.withColumn("influencer_id", F.col("influencer_id").cast("bigint"))


def stream_summary_closed(spark, sf):
    counts = late.hour_counts(spark, _late_load(spark, sf), closed_only=True)
    return counts.withColumn("influencer_id", F.col("influencer_id").cast("bigint"))


def stream_late_posts(spark, sf):
    return late.late_posts(spark, _late_load(spark, sf))


def stream_dedup_batches(spark, sf):
    """The index of seen ids after batches that share posts."""
    index = hours.HourStore(spark, _late_load(spark, sf)).read(hours.IDS, hours.ID_SCHEMA, merged=False)
    return index.select(F.col("id").cast("bigint").alias("id"), "period")


# ---------------------------------------------------------------- the hourly run on posts


def _dimensions(spark, sf) -> hourly.Dimensions:
    categories = spark.createDataFrame(
        [("n-tontin", None, "c", "sub-1"), ("n-bobo", None, "c", "sub-2"), ("n-tonton", None, "c", "sub-1")],
        "Insulto string, Insulto_gendered string, `Categoría` string, `Subcategoría` string",
    )
    return hourly.Dimensions(stand_in.seeds(spark, sf), _insult_rows(spark, POST_INSULTS), categories, _keywords(spark))


def _mark_abuse(posts: DataFrame) -> DataFrame:
    marked = F.col("text_clean").contains("bobo") | F.col("text_clean").contains("tonton")
    return posts.withColumn("abuse", marked.cast("int"))


def _enriched(spark, sf) -> DataFrame:
    # the text for the model is checked by token_map; the scorer used here reads text_clean
    tidy = stand_in.settle(_tidy(spark, sf), "tidy")
    targeted = flatten.directed_at(flatten.valid_posts(tidy))
    dims = _dimensions(spark, sf)
    return insults.with_insult_names(_mark_abuse(targeted), dictionary.compile_dictionary(dims.insults))


def enriched_posts(spark, sf):
    return plain(_enriched(spark, sf).select("id", "datetime", "user_id", "f_seed", "hashtags", "abuse", "insults_name"))


def model_text(spark, sf):
    targeted = flatten.directed_at(flatten.valid_posts(_tidy(spark, sf)))
    return hourly.model_text(targeted, stand_in.seeds(spark, sf), "xml").select("id", "replaced_text")


def _hourly(table: str) -> Callable:
    def run(spark, sf):
        enriched = stand_in.settle(_enriched(spark, sf), "enriched")
        return hourly.summaries(enriched, _dimensions(spark, sf))[table].select(*SUMMARIES[table].names)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        mentions_abuse_summary, mentions_abuse_distinct, hashtags_summary, insults_summary, subcategory_summary,
        users_abuse_summary, abuse_insults, author_abuse, bridge_mentions, bridge_hashtags, bridge_insults, author_rows,
        tidy_posts, tidy_posts_joined, seed_target, only_female_posts, raw_projection, raw_projection_untracked,
        directed_posts, post_counts, dedup_posts, quarantine, capture_filter, capture_filter_flat, capture_enrich,
        created_at_parse, hour_trunc, v2_flatten, file_hours, clean_html_text, remove_hits, token_map,
        token_map_joined, token_map_indexed, mention_tokens, first_match, document_keywords, document_keywords_indexed, extract_insults,
        extract_insults_indexed, extract_male_insults,
        dictionary_lists, dictionary_map, not_in_null_safe, category_table, seed_metadata, seed_files, distinct_tokens,
        seed_pages, handle_pages, tracking_words, handle_map, seed_upsert, argmax_class, classify_default,
        classify_words, classify_posts, enriched_posts, model_text, stream_summary, stream_dedup, stream_capture, stream_handles,
        stream_hourly_run, stream_hourly_raw, stream_sources, stream_summary_late, stream_summary_closed, stream_late_posts,
        stream_dedup_batches,
    )
} | {
    "tweet_type": _tidy_columns("id", "tweet_type"),
    "reply_fallback": _tidy_columns("id", "in_reply_to_screen_name", "in_reply_to_user_id", "in_reply_to_status_id"),
    "retweet_override": _tidy_columns(
        "id", "text", "mentions", "rt_from_screen_name", "rt_from_user_id", "rt_from_id"
    ),
    "quote_fields": _tidy_columns("id", "qt_from_screen_name", "qt_status"),
    "directed_flags": _tidy_columns("id", "f_seed", "m_seed", "directed_at_f", "directed_at_m"),
    "keyword_hits": _tidy_columns("id", "text_clean", "keywords"),
    "valid_flag": _tidy_columns("id", "valid"),
    "strip_accents": _text_column(text.strip_accents, "stripped"),
    "clean_text": _text_column(text.clean_text, "cleaned"),
    "clean_model_text": _text_column(lambda c: text.clean_model_text(c, "xml"), "cleaned"),
    "hashtags": _text_column(text.hashtags, "hashtags"),
    "find_all": _text_column(lambda c: find.find_all(c, WORD_PATTERN), "hits", _cleaned),
    "find_all_rescan": _text_column(lambda c: find.find_all(c, ANCHORED_PATTERN), "hits", _cleaned),
    "fuzzy_hits": _text_column(lambda c: find.fuzzy_find_all(c, FUZZY_PATTERN), "hits", _cleaned),
    "first_hit": _text_column(lambda c: find.first_hit(c, WORD_PATTERN), "hit", _cleaned),
    "hourly_mentions": _hourly("mentions_and_abuse_summary"),
    "hourly_hashtags": _hourly("hashtags_summary"),
    "hourly_insults": _hourly("insults_summary"),
    "hourly_subcategories": _hourly("subc_summary"),
    "hourly_users": _hourly("users_abuse_summary"),
    "stream_hourly_batches": _loaded("mentions_and_abuse_summary"),
    "stream_hourly_hashtags": _loaded("hashtags_summary"),
    "stream_hourly_insults": _loaded("insults_summary"),
    "stream_hourly_subcategories": _loaded("subc_summary"),
    "stream_hourly_users": _loaded("users_abuse_summary"),
}
