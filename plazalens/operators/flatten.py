"""Nested posts to the fixed tidy table: one projection over the raw row, plus seed lookups."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.functions.text import clean_text, computed_once, hashtags
from plazalens.functions.times import parse_created_at
from plazalens.operators.dims import LITERAL_ROWS
from plazalens.operators.pattern_index import attach_keywords
from plazalens.operators.seeds import prefixed, seed_tests
from plazalens.schemas import TIDY

def _path(parent: str, field: str) -> Column:
    return F.col(f"{parent}.{field}" if parent else field)


def full_text(parent: str = "") -> Column:
    """Extended text if the post has an extended part, else the short form, else the other spelling of it."""
    extended = _path(parent, "extended_tweet")
    short = F.coalesce(_path(parent, "text"), _path(parent, "full_text"))
    return F.when(extended.isNotNull(), extended["full_text"]).otherwise(short)


def mentioned(parent: str, author: Column) -> Column:
    """Distinct handles the post mentions, its author left out, sorted for a stable result."""
    extended = _path(parent, "extended_tweet")
    entities = F.when(extended.isNotNull(), extended["entities"]).otherwise(_path(parent, "entities"))
    names = entities["user_mentions"]["screen_name"]
    return F.sort_array(F.array_distinct(F.filter(names, lambda n: n != author)))


def is_retweet() -> Column:
    return F.col("retweeted_status").isNotNull()


def post_text() -> Column:
    """A retweet shows the text it repeats, line breaks kept; an own text loses them."""
    own = F.replace(full_text(), F.lit("\n"), F.lit(""))
    return F.when(is_retweet(), full_text("retweeted_status")).otherwise(own)


def post_mentions() -> Column:
    author = F.col("user.screen_name")
    return F.coalesce(
        F.when(is_retweet(), mentioned("retweeted_status", author)).otherwise(mentioned("", author)),
        F.expr("array()").cast("array<string>"),
    )


def _reply(field: str) -> Column:
    # all three reply fields move to the repeated post together, decided by the user id
    switch = F.col("in_reply_to_user_id").isNull() & is_retweet()
    return F.when(switch, F.col(f"retweeted_status.{field}")).otherwise(F.col(field))


def _quote(pick) -> Column:
    own = F.col("quoted_status").isNotNull()
    return F.when(own, pick("quoted_status")).otherwise(pick("retweeted_status.quoted_status"))


def _kind(reply: Column, quote: Column) -> Column:
    return (
        F.when(reply & quote, "reply_with_quote").when(reply, "reply").when(quote, "quote").otherwise("standalone")
    )


def flatten_posts(
    posts: DataFrame,
    seeds: DataFrame,
    keywords: DataFrame | None = None,
    only_female: bool = False,
    literal_rows: int = LITERAL_ROWS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The tidy table of 24 columns. ``keywords`` switches keyword tracking on; ``keep`` names columns to take along.

    ``seeds.user_id`` carries no prefix, as in the source file.
    """
    reply_id = prefixed(_reply("in_reply_to_user_id"))
    is_quote = F.col("quoted_status").isNotNull() | F.col("retweeted_status.quoted_status").isNotNull()
    base = posts.select(
        prefixed(F.col("id")).alias("id"),
        F.col("user.screen_name").alias("screen_name"),
        prefixed(F.col("user.id")).alias("user_id"),
        post_text().alias("text"),
        F.col("retweeted_status.user.screen_name").alias("rt_from_screen_name"),
        prefixed(F.col("retweeted_status.user.id")).alias("rt_from_user_id"),
        prefixed(F.col("retweeted_status.id")).alias("rt_from_id"),
        _quote(lambda q: F.col(f"{q}.user.screen_name")).alias("qt_from_screen_name"),
        _quote(full_text).alias("qt_status"),
        _reply("in_reply_to_screen_name").alias("in_reply_to_screen_name"),
        reply_id.alias("in_reply_to_user_id"),
        prefixed(_reply("in_reply_to_status_id")).alias("in_reply_to_status_id"),
        post_mentions().alias("mentions"),
        parse_created_at(F.col("created_at")).alias("datetime"),
        F.col("place").alias("location"),
        _kind(_reply("in_reply_to_user_id").isNotNull(), is_quote).alias("tweet_type"),
        *keep,
    )
    return _target_columns(base, seeds, keywords, only_female, literal_rows, keep)


def _target_columns(
    base: DataFrame, seeds: DataFrame, keywords: DataFrame | None, only_female: bool, literal_rows: int, keep: tuple[str, ...]
) -> DataFrame:
    base, tests = seed_tests(base, seeds, F.col("mentions"), F.col("in_reply_to_user_id"), literal_rows)
    base = base.withColumn("f_seed", F.filter("mentions", tests.is_female)).withColumn(
        "m_seed", F.filter("mentions", tests.is_male)
    )
    if only_female:
        base = base.where(F.size("f_seed") > 0)

    directed_f, directed_m = F.size("f_seed") > 0, F.size("m_seed") > 0
    reply = F.col("in_reply_to_user_id").isNotNull()
    mention_target = F.when(reply, tests.is_seed_id(F.col("in_reply_to_user_id"))).otherwise(directed_f | directed_m)
    base = base.withColumn("text_clean", clean_text(F.col("text")))
    if keywords is None:
        base = base.withColumn("keywords", F.expr("array()").cast("array<string>"))
        keyword_target = F.lit(None).cast("boolean")
    else:
        base = attach_keywords(base, "text_clean", keywords)
        keyword_target = F.size("keywords") > 0
    return (
        base.withColumn("directed_at_f", directed_f.cast("int"))
        .withColumn("directed_at_m", directed_m.cast("int"))
        .withColumn("hashtags", hashtags(F.col("text")))
        .withColumn("valid", computed_once(F.when(mention_target, True).otherwise(keyword_target)))
        .select(*TIDY.names, *keep)
    )


def raw_projection(tidy: DataFrame, tracking: bool = False) -> DataFrame:
    """The raw table: six columns, keywords null when they were not tracked."""
    keywords = F.col("keywords") if tracking else F.lit(None).cast("array<string>")
    return tidy.select("id", "text", "datetime", "user_id", keywords.alias("keywords"), "valid")


def valid_posts(tidy: DataFrame) -> DataFrame:
    return tidy.where("valid")


def directed_at(tidy: DataFrame, gender: str = "F") -> DataFrame:
    return tidy.where(F.col(f"directed_at_{gender.lower()}") == 1)


def narrow(tidy: DataFrame) -> DataFrame:
    """The nine columns kept for valid posts."""
    return tidy.select(
        "datetime", "id", "user_id", "screen_name", "text", "text_clean", "f_seed", "m_seed", "hashtags"
    )


def post_counts(tidy: DataFrame) -> DataFrame:
    """The log line: valid posts, and how many are directed at each gender, in one pass."""
    return tidy.where("valid").agg(
        F.count("*").alias("n_posts"),
        F.count_if(F.col("directed_at_f") == 1).alias("n_female"),
        F.count_if(F.col("directed_at_m") == 1).alias("n_male"),
    )
