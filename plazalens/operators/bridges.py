"""Long tables: post id to mention, hashtag, insult; abuse flags; authors."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.operators.dims import left_join_dimension


def post_kind(retweeted_user: Column) -> Column:
    return F.when(retweeted_user.isNull(), "original").otherwise("rt")


def mention_pairs(posts: DataFrame, gender: str = "F") -> DataFrame:
    """(mention, id) of seed mentions. The retweet source rides along, so no join on id brings it back."""
    return posts.select(F.explode(f"{gender.lower()}_seed").alias("mention"), "id", "rt_from_user_id")


def hashtag_pairs(posts: DataFrame) -> DataFrame:
    return posts.select(F.explode("hashtags").alias("hashtag"), "id")


def insult_pairs(insult_posts: DataFrame) -> DataFrame:
    return insult_posts.select(F.explode("insults_name").alias("insult"), "id")


def abuse_flags(posts: DataFrame) -> DataFrame:
    return posts.select("id", "abuse")


def author_rows(posts: DataFrame) -> DataFrame:
    return posts.select("user_id", "id", "rt_from_user_id")


def mention_bridge(pairs: DataFrame, influencers: DataFrame) -> DataFrame:
    """Seed id, post id and kind of each mention; a handle the seed list spells differently has a null seed id."""
    joined = left_join_dimension(pairs, influencers, "mention", spread_by=F.col("id"))
    return joined.select("influencer_id", "id", "rt_from_user_id", post_kind(F.col("rt_from_user_id")).alias("tweet_type"))


def abuse_with_insults(abuse: DataFrame, insults: DataFrame) -> DataFrame:
    """Abuse flags fanned out by insult names, posts without one kept."""
    return abuse.join(insults, "id", "left").select("id", "abuse", "insult")


def author_abuse(abuse_insults: DataFrame, authors: DataFrame) -> DataFrame:
    return abuse_insults.join(authors, "id", "left")
