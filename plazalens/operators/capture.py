"""Capture stage: which posts are kept, and the fields added on arrival."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from plazalens.functions.handles import EDGE
from plazalens.functions.patterns import java_pattern
from plazalens.functions.times import as_utc, iso_ticks, parse_created_at, short_date


def _has_word(text: Column, words: list[str]) -> Column:
    """Any tracked word in the text, case ignored. Handles share one branch, so the engine looks at each ``@`` once."""
    handles = [re.escape(w[1:]) for w in words if w.startswith("@")]
    others = [f"(?:{w})" for w in words if not w.startswith("@")]
    # a handle ends at an edge, or @ana would capture @anabel
    branches = ([f"@(?:{'|'.join(handles)})(?:[{EDGE}]|$)"] if handles else []) + others
    if not branches:
        return F.lit(False)
    return F.coalesce(text.rlike(java_pattern("|".join(branches), ignore_case=True)), F.lit(False))


def _one_of(c: Column, ids: list[str]) -> Column:
    return F.coalesce(c.cast("string").isin(ids), F.lit(False)) if ids else F.lit(False)


def capture_filter(posts: DataFrame, ids: list[str], words: list[str], text: Column) -> DataFrame:
    """Posts by or in reply to a followed account, or holding a tracked word.

    One capture follows one page of accounts (:func:`plazalens.operators.seeds.seed_pages`), so both lists are short.
    """
    return posts.where(
        _one_of(F.col("user.id"), ids) | _one_of(F.col("in_reply_to_user_id"), ids) | _has_word(text, words)
    )


def capture_filter_flat(posts: DataFrame, ids: list[str], words: list[str]) -> DataFrame:
    return posts.where(_one_of(F.col("author_id"), ids) | _has_word(F.col("text"), words))


def enrich_capture(posts: DataFrame) -> DataFrame:
    """Numeric id kept aside, string id in its place, capture date and ISO time from the creation time."""
    at = parse_created_at(F.col("created_at"))
    return (
        posts.withColumn("id_num", F.expr("try_cast(id as bigint)"))
        .withColumn("id", F.coalesce("id_str", "id"))
        .withColumn("date", short_date(at))
        .withColumn("datetime", iso_ticks(at))
    )


def flatten_flat(posts: DataFrame) -> DataFrame:
    """The flat feed's six fields from id, text, author and creation time (a timestamp)."""
    at = F.col("created_at")
    if isinstance(posts.schema["created_at"].dataType, TimestampType):
        at = as_utc(at)
    iso = _iso(at)
    return posts.select(
        "id", "text", "author_id", iso.alias("created_at"), F.to_date(at).cast("string").alias("date"),
        iso.alias("datetime"),
    )


def _iso(ts: Column) -> Column:
    # a fraction is shown only when there is one
    whole = F.date_trunc("second", ts) == ts
    return F.concat(
        F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        ),
        F.lit("+00:00"),
    )


def with_arrival(posts: DataFrame) -> DataFrame:
    """Arrival date and hour, the keys of the raw store."""
    now = F.current_timestamp()
    return posts.withColumn("arrival_date", F.date_format(now, "dd-MM-yyyy")).withColumn(
        "arrival_hour", F.date_format(now, "HH")
    )
