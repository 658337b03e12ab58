"""Hour counts of a stream whose posts come in any order: late posts amend hours that had closed, and are reported."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType, TimestampNTZType

from plazalens.functions.times import as_utc, hour_of
from plazalens.operators.dedup import drop_repeated_posts
from plazalens.operators.summaries import mentions_abuse_of_posts
from plazalens.schemas import SUMMARIES
from plazalens.sinks.hours import SOURCES, HourStore, period_of, periods_of, remember, unread, unseen

COUNTS, LATE, PROGRESS = "mentions_and_abuse_summary", "late_posts", "progress"
_LATE = StructType([StructField("Hour", TimestampNTZType()), StructField("posts", LongType())])
_PROGRESS = StructType([StructField("newest", TimestampNTZType())])


def _closed_up_to(store: HourStore, delay: str):
    """The time up to which hours are closed: the newest post of all commits, less the delay. Null before the first."""
    newest = store.read(PROGRESS, _PROGRESS, merged=False).agg(F.max("newest").alias("newest"))
    return newest.select((F.col("newest") - F.expr(f"interval {delay}")).alias("closed")).first()[0]


def count_batch(
    posts: DataFrame, influencers: DataFrame, root: str, delay: str = "1 hour", seed: str = "f_seed", source: str = "source",
    unit: str = "hour",
) -> int | None:
    """One batch of posts into the hour counts under ``root``, as one commit; its number, or None where nothing was new.

    ``posts``: id, ts (timestamp), is_rt, abuse, insults_name, the mention array and ``source``, which names what the batch was read from;
    what a commit has read is passed over. A post is known by id and period (``unit``). A post whose hour had closed before this batch counts like any
    other; such posts are added up by hour in the table LATE. Posts without a time are in no hour.
    """
    spark = posts.sparkSession
    store = HourStore(spark, root)
    change = store.change()
    closed = _closed_up_to(store, delay)
    at = as_utc(F.col("ts"))
    rows = posts.withColumn("datetime", at).withColumn("Hour", hour_of(at)).drop("ts")
    rows = change.scratch(unread(store, rows.withColumn("period", period_of(F.col("Hour"), unit)), source), "batch")
    if rows.isEmpty():
        return None
    none = F.lit("none").alias("period")
    change.append(SOURCES, rows.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("posts")).select("*", none))
    periods = periods_of(rows)
    once = drop_repeated_posts(rows.drop(source))
    fresh = change.scratch(unseen(store, once, periods, rows), "fresh")
    # the summary tells retweets by the author they repeat
    facts = fresh.select("datetime", F.when(F.col("is_rt"), "rt").alias("rt_from_user_id"), "abuse", "insults_name", F.col(seed).alias("f_seed"))
    counts = mentions_abuse_of_posts(facts, influencers)
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in SUMMARIES[COUNTS].fields]
    change.merge(COUNTS, counts.select(*typed, period_of(F.col("Hour"), unit).alias("period")), ["Hour", "influencer_id"], periods)
    over = F.col("Hour") + F.expr("interval 1 hour") <= F.lit(closed).cast("timestamp_ntz")
    late = fresh.where(over).groupBy("Hour").agg(F.count("*").alias("posts"))
    change.append(LATE, late.select("*", period_of(F.col("Hour"), unit).alias("period")))
    change.append(PROGRESS, fresh.agg(F.max("datetime").alias("newest")).select("*", none))
    remember(change, fresh.select("id", "period"), periods)
    change.commit()
    return change.version


def run_hour_counts(
    stream: DataFrame, influencers: DataFrame, root: str, checkpoint: str, delay: str = "1 hour", trigger: dict | None = None,
    unit: str = "hour",
) -> StreamingQuery:
    """Counts each micro-batch. A batch that repeats, or a fresh checkpoint, counts no post with an id twice; without an id the batch is
    known by checkpoint and number."""

    def load(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumn("source", F.lit(f"{checkpoint}#{batch_id}"))
        count_batch(named, influencers, root, delay, unit=unit)

    started = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return started.trigger(**(trigger or {"availableNow": True})).start()


def hour_counts(spark: SparkSession, root: str, delay: str = "1 hour", closed_only: bool = False) -> DataFrame:
    """The counts as of the last commit: all hours, open ones included, or the closed ones only."""
    store = HourStore(spark, root)
    counts = store.read(COUNTS, SUMMARIES[COUNTS]).drop("period")
    if closed_only:
        up_to = F.lit(_closed_up_to(store, delay)).cast("timestamp_ntz")
        counts = counts.where(F.col("Hour") + F.expr("interval 1 hour") <= up_to)
    return counts


def late_posts(spark: SparkSession, root: str) -> DataFrame:
    """Hour, posts: how many posts came after their hour had closed."""
    late = HourStore(spark, root).read(LATE, _LATE, merged=False)
    return late.groupBy("Hour").agg(F.sum("posts").alias("posts"))
