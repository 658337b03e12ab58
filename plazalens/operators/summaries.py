"""Hourly summaries.

The defining rule is a chain of left joins on the post id (post, mentions, abuse flags, insult names) followed by row
counts. A row count over such a chain is a product of per-table counts, so nothing is fanned out here: each table is
counted per id first, which also shrinks hot ids before the shuffle, and the products are summed. Counting by mention
comes before the seed join, so a seed that holds a third of all mentions is a handful of partial sums by then.

``*_of_posts`` read enriched posts, which carry their arrays; nothing is joined on the id at all.
Rows whose group key is null are not counted anywhere.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.functions.times import hour_of
from plazalens.operators.dims import left_join_dimension

_MENTION_MEASURES = ["N_mentions", "N_abuse", "N_mentions_orig", "N_mentions_rt", "N_abuse_orig", "N_abuse_rt"]


def _fan(names: Column) -> Column:
    return F.greatest(F.coalesce(names, F.lit(0)), F.lit(1)).cast("bigint")


def post_weights(abuse: DataFrame, insults: DataFrame) -> DataFrame:
    """Per id: rows and abusive rows that the abuse-insult join would give it."""
    n = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    facts = abuse.select(
        "id", one.alias("a"), F.when(F.col("abuse") == 1, one).otherwise(n).alias("a1"), n.alias("i")
    ).unionAll(insults.select("id", n, n, one))
    per_id = facts.groupBy("id").agg(F.sum("a").alias("a"), F.sum("a1").alias("a1"), F.sum("i").alias("i"))
    return per_id.select(
        "id", F.col("a").alias("flags"), (F.col("a") * _fan(F.col("i"))).alias("fan_rows"),
        (F.col("a1") * _fan(F.col("i"))).alias("fan_abuse"),
    )


def _weighted_posts(posts: DataFrame, abuse: DataFrame, insults: DataFrame) -> DataFrame:
    base = posts.select("id", hour_of(F.col("ts")).alias("Hour"), "user_id", F.col("rt").isNotNull().alias("is_rt"))
    joined = base.join(post_weights(abuse, insults), "id", "left")
    no_flags = F.coalesce(F.col("flags"), F.lit(0)) == 0
    return joined.select(
        "id", "Hour", "user_id", "is_rt",
        # a post without an abuse row still is one row of the chain
        F.when(no_flags, F.lit(1).cast("bigint")).otherwise(F.col("fan_rows")).alias("fan"),
        F.when(no_flags, F.lit(0).cast("bigint")).otherwise(F.col("fan_abuse")).alias("fan_abuse"),
    )


def _mention_sums(rows: Column, abusive: Column, is_rt: Column) -> list[Column]:
    zero = F.lit(0).cast("bigint")
    values = {
        "N_mentions": rows,
        "N_abuse": abusive,
        "N_mentions_orig": F.when(~is_rt, rows).otherwise(zero),
        "N_mentions_rt": F.when(is_rt, rows).otherwise(zero),
        "N_abuse_orig": F.when(~is_rt, abusive).otherwise(zero),
        "N_abuse_rt": F.when(is_rt, abusive).otherwise(zero),
    }
    return [F.sum(v).alias(name) for name, v in values.items()]


def _by_influencer(counted: DataFrame, influencers: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Counts by mention to counts by influencer. ``counted`` is already one row per (Hour, mention, ...)."""
    counted = counted.where(F.col("mention").isNotNull() & F.col("Hour").isNotNull())
    known = influencers.where(F.col("influencer_id").isNotNull())
    joined = left_join_dimension(counted, known, "mention", spread_by=F.col("Hour"), how="inner")
    return joined.groupBy("Hour", "influencer_id", *keys).agg(*[F.sum(m).alias(m) for m in measures])


def _mention_counts(mentions: DataFrame) -> DataFrame:
    """(id, mention, n): a post with a hot id keeps one row per seed it mentions."""
    return mentions.groupBy("id", "mention").agg(F.count("*").alias("n"))


def mentions_abuse_summary(
    posts: DataFrame, mentions: DataFrame, influencers: DataFrame, abuse: DataFrame, insults: DataFrame
) -> DataFrame:
    """Mentions and abusive mentions by hour and seed, split by original/retweet.

    Tables: posts(id, ts, user_id, rt), mentions(id, mention), influencers(mention, influencer_id),
    abuse(id, abuse), insults(id, insult). Post ids are unique. A post with three insult names counts three times.
    """
    joined = _mention_counts(mentions).join(_weighted_posts(posts, abuse, insults), "id")
    sums = _mention_sums(F.col("n") * F.col("fan"), F.col("n") * F.col("fan_abuse"), F.col("is_rt"))
    counted = joined.groupBy("Hour", "mention").agg(*sums)
    return _by_influencer(counted, influencers, [], _MENTION_MEASURES)


def mentions_abuse_distinct(
    posts: DataFrame, mentions: DataFrame, influencers: DataFrame, abuse: DataFrame
) -> DataFrame:
    """The same columns, each post counted once per seed."""
    known = influencers.where(F.col("influencer_id").isNotNull())
    pairs = left_join_dimension(
        mentions.select("id", "mention").distinct(), known, "mention", spread_by=F.col("id"), how="inner"
    )
    pairs = pairs.select("id", "influencer_id").distinct()
    flagged = abuse.groupBy("id").agg(F.max((F.col("abuse") == 1).cast("int")).alias("flag"))
    base = posts.select("id", hour_of(F.col("ts")).alias("Hour"), F.col("rt").isNotNull().alias("is_rt"))
    per_post = base.join(flagged, "id", "left").withColumn("flag", F.coalesce("flag", F.lit(0)).cast("bigint"))
    joined = pairs.join(per_post, "id").where(F.col("Hour").isNotNull())
    sums = _mention_sums(F.lit(1).cast("bigint"), F.col("flag"), F.col("is_rt"))
    return joined.groupBy("Hour", "influencer_id").agg(*sums)


def hashtags_summary(posts: DataFrame, mentions: DataFrame, influencers: DataFrame, hashtags: DataFrame) -> DataFrame:
    """Hashtags by hour and seed. Repeats in one post count."""
    tags = hashtags.where(F.col("hashtag").isNotNull()).groupBy("id", "hashtag").agg(F.count("*").alias("h"))
    base = posts.select("id", hour_of(F.col("ts")).alias("Hour"))
    joined = _mention_counts(mentions).join(base, "id").join(tags, "id")
    counted = joined.groupBy("Hour", "mention", "hashtag").agg(F.sum(F.col("n") * F.col("h")).alias("N_hashtags"))
    out = _by_influencer(counted, influencers, ["hashtag"], ["N_hashtags"])
    return out.withColumnRenamed("hashtag", "Hashtag")


def insults_summary(
    posts: DataFrame, mentions: DataFrame, influencers: DataFrame, abuse: DataFrame, insults: DataFrame
) -> DataFrame:
    """Insult names by hour and seed."""
    names = insults.where(F.col("insult").isNotNull()).groupBy("id", "insult").agg(F.count("*").alias("i"))
    flags = abuse.groupBy("id").agg(F.count("*").alias("a"))
    base = posts.select("id", hour_of(F.col("ts")).alias("Hour")).join(flags, "id")
    joined = _mention_counts(mentions).join(base, "id").join(names, "id")
    rows = F.sum(F.col("n") * F.col("a") * F.col("i")).alias("N_abuse")
    counted = joined.groupBy("Hour", "mention", "insult").agg(rows)
    out = _by_influencer(counted, influencers, ["insult"], ["N_abuse"])
    return out.withColumnRenamed("insult", "Insults")


def subcategory_summary(insult_counts: DataFrame, categories: DataFrame) -> DataFrame:
    """Subcategories by hour and seed, from the insult summary: the join meets grouped counts, not rows."""
    dim = categories.select(F.col("Insulto").alias("Insults"), "Subcategoría").where(
        F.col("Subcategoría").isNotNull() & F.col("Insults").isNotNull()
    )
    joined = left_join_dimension(insult_counts, dim, "Insults", spread_by=F.col("influencer_id"), how="inner")
    return joined.groupBy("Hour", "influencer_id", "Subcategoría").agg(F.sum("N_abuse").alias("N_abuse"))


def _author_sums(rows: Column, abusive: Column, is_rt: Column) -> list[Column]:
    zero = F.lit(0).cast("bigint")
    values = {
        "N_user": rows,
        "N_user_abuse": abusive,
        "N_user_original": F.when(~is_rt, rows).otherwise(zero),
        "N_user_rt": F.when(is_rt, rows).otherwise(zero),
        "N_user_abuse_original": F.when(~is_rt, abusive).otherwise(zero),
        "N_user_abuse_rt": F.when(is_rt, abusive).otherwise(zero),
    }
    return [F.sum(v).alias(name) for name, v in values.items()]


def users_abuse_summary(posts: DataFrame, abuse: DataFrame, insults: DataFrame) -> DataFrame:
    """Posts and abusive posts by hour and author. Posts count once; abusive ones count once per insult name."""
    weighted = _weighted_posts(posts, abuse, insults).where(F.col("Hour").isNotNull() & F.col("user_id").isNotNull())
    return weighted.groupBy("Hour", "user_id").agg(
        *_author_sums(F.lit(1).cast("bigint"), F.col("fan_abuse"), F.col("is_rt"))
    )


# --- the same five tables from enriched posts: id, datetime, user_id, rt_from_user_id, f_seed/m_seed, hashtags,
# --- abuse, insults_name (null or empty where none was found)


def _post_facts(posts: DataFrame) -> DataFrame:
    abusive = F.coalesce(F.col("abuse") == 1, F.lit(False))
    fan = _fan(F.size(F.coalesce("insults_name", F.expr("array()").cast("array<string>"))))
    return posts.select(
        "*",
        hour_of(F.col("datetime")).alias("Hour"),
        F.col("rt_from_user_id").isNotNull().alias("is_rt"),
        fan.alias("fan"),
        F.when(abusive, fan).otherwise(F.lit(0).cast("bigint")).alias("fan_abuse"),
    )


def mentions_abuse_of_posts(posts: DataFrame, influencers: DataFrame, gender: str = "F") -> DataFrame:
    seed = f"{gender.lower()}_seed"
    facts = _post_facts(posts).select("Hour", "is_rt", "fan", "fan_abuse", F.explode(seed).alias("mention"))
    counted = facts.groupBy("Hour", "mention").agg(
        *_mention_sums(F.col("fan"), F.col("fan_abuse"), F.col("is_rt"))
    )
    return _by_influencer(counted, influencers, [], _MENTION_MEASURES)


def hashtags_of_posts(posts: DataFrame, influencers: DataFrame, gender: str = "F") -> DataFrame:
    rows = _post_facts(posts).select("Hour", "hashtags", F.explode(f"{gender.lower()}_seed").alias("mention"))
    rows = rows.select("Hour", "mention", F.explode("hashtags").alias("Hashtag"))
    counted = rows.groupBy("Hour", "mention", "Hashtag").agg(F.count("*").alias("N_hashtags"))
    return _by_influencer(counted, influencers, ["Hashtag"], ["N_hashtags"])


def insults_of_posts(posts: DataFrame, influencers: DataFrame, gender: str = "F") -> DataFrame:
    rows = _post_facts(posts).select("Hour", "insults_name", F.explode(f"{gender.lower()}_seed").alias("mention"))
    rows = rows.select("Hour", "mention", F.explode("insults_name").alias("Insults"))
    counted = rows.groupBy("Hour", "mention", "Insults").agg(F.count("*").alias("N_abuse"))
    return _by_influencer(counted, influencers, ["Insults"], ["N_abuse"])


def users_abuse_of_posts(posts: DataFrame) -> DataFrame:
    facts = _post_facts(posts).where(F.col("Hour").isNotNull() & F.col("user_id").isNotNull())
    return facts.groupBy("Hour", "user_id").agg(
        *_author_sums(F.lit(1).cast("bigint"), F.col("fan_abuse"), F.col("is_rt"))
    )
