"""The hourly run: raw posts to six tables."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazalens.functions.text import clean_model_text
from plazalens.operators.dedup import drop_repeated_posts
from plazalens.operators.dictionary import compile_dictionary
from plazalens.operators.flatten import directed_at, flatten_posts, raw_projection, valid_posts
from plazalens.operators.insults import with_insult_names
from plazalens.operators.seeds import as_tokens, influencers, with_group_tokens
from plazalens.operators.summaries import (
    hashtags_of_posts,
    insults_of_posts,
    mentions_abuse_of_posts,
    subcategory_summary,
    users_abuse_of_posts,
)
from plazalens.sinks.tables import read_batch, write_batch
from plazalens.sources.posts import good_posts


@dataclass
class Dimensions:
    seeds: DataFrame
    insults: DataFrame
    categories: DataFrame
    keywords: DataFrame | None = None


# Adds ``abuse`` to posts that have ``replaced_text``
Classify = Callable[[DataFrame], DataFrame]


def model_text(posts: DataFrame, seeds: DataFrame, entities: str = "html5") -> DataFrame:
    """Adds ``replaced_text``: the text cleaned for the classifier, handles replaced by their group."""
    cleaned = posts.withColumn("_cleaned", clean_model_text(F.col("text"), entities))
    return with_group_tokens(cleaned, "_cleaned", as_tokens(seeds), "replaced_text").drop("_cleaned")


def detect(tidy: DataFrame, dims: Dimensions, classify: Classify, gender: str = "F", entities: str = "html5") -> DataFrame:
    """Valid posts directed at seeds of one gender, with ``abuse`` and ``insults_name``."""
    targeted = directed_at(valid_posts(tidy), gender)
    scored = classify(model_text(targeted, dims.seeds, entities))
    return with_insult_names(scored, compile_dictionary(dims.insults))


def summaries(enriched: DataFrame, dims: Dimensions, gender: str = "F") -> dict[str, DataFrame]:
    seeds = influencers(dims.seeds)
    insults = insults_of_posts(enriched, seeds, gender)
    return {
        "mentions_and_abuse_summary": mentions_abuse_of_posts(enriched, seeds, gender),
        "hashtags_summary": hashtags_of_posts(enriched, seeds, gender),
        "insults_summary": insults,
        "subc_summary": subcategory_summary(insults, dims.categories),
        "users_abuse_summary": users_abuse_of_posts(enriched),
    }


def run_batch(
    spark: SparkSession, posts: DataFrame, dims: Dimensions, classify: Classify, out: str, batch_id: int | str
) -> None:
    """One batch of raw posts into ``out/<table>/batch_id=...``.

    The tidy and the enriched posts are written before they are read several times: parsing, classifying and the
    pattern search run once, and a lost executor costs the tasks it had, not the run.
    """
    tidy = flatten_posts(drop_repeated_posts(good_posts(posts)), dims.seeds, dims.keywords)
    write_batch(tidy, f"{out}/tidy", batch_id)
    tidy = read_batch(spark, f"{out}/tidy", batch_id)
    write_batch(raw_projection(tidy, dims.keywords is not None), f"{out}/raw_data", batch_id)
    write_batch(detect(tidy, dims, classify), f"{out}/enriched", batch_id)
    enriched = read_batch(spark, f"{out}/enriched", batch_id)
    for table, df in summaries(enriched, dims).items():
        write_batch(df, f"{out}/{table}", batch_id)
