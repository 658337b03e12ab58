"""Repeated captures of one post."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_repeated_posts(posts: DataFrame, key: str = "id") -> DataFrame:
    """One row per post id, the least in column order, so a re-run keeps the same copy.

    Written as an aggregate: copies are reduced before the shuffle, so a post captured a billion times costs one row
    per map task. Posts without an id are kept as they are.
    """
    rest = [c for c in posts.columns if c != key]
    known = posts.where(F.col(key).isNotNull())
    kept = known.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(key, "_row.*")
    return kept.select(*posts.columns).unionByName(posts.where(F.col(key).isNull()))


def drop_repeated_within(stream: DataFrame, key: str = "id", event_time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """The streaming form: an id is remembered until the watermark has passed it. Posts without an id are kept as they are, each
    under a key of its own, so that they don't share a state partition either."""
    once = F.coalesce(F.concat(F.lit("id "), F.col(key).cast("string")), F.concat(F.lit("row "), F.expr("uuid()")))
    keyed = stream.withWatermark(event_time, delay).withColumn("_once", once)
    return keyed.dropDuplicatesWithinWatermark(["_once"]).drop("_once")
