"""Capture as a stream: follow a page of accounts, keep matching posts by arrival hour."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plazalens.operators.capture import capture_filter, enrich_capture, with_arrival
from plazalens.operators.flatten import post_text
from plazalens.sources.posts import good_posts


def capture_posts(stream: DataFrame, ids: list[str], words: list[str]) -> DataFrame:
    return enrich_capture(capture_filter(good_posts(stream), ids, words, post_text()))


def store_raw(
    captured: DataFrame, out: str, checkpoint: str, compression: str = "none", trigger: dict | None = None
) -> StreamingQuery:
    """JSON lines under ``arrival_date=/arrival_hour=``; the file sink's log makes each post appear once."""
    return (
        with_arrival(captured)
        .writeStream.partitionBy("arrival_date", "arrival_hour")
        .format("json")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .option("compression", compression)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def follow_handles(stream: DataFrame) -> DataFrame:
    """The columns handle tracking needs from nested posts."""
    from plazalens.functions.times import parse_created_at

    return stream.select(
        F.col("user.id").alias("user_id"),
        F.col("user.screen_name").alias("screen_name"),
        parse_created_at(F.col("created_at")).alias("datetime"),
    )
