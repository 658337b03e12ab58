"""Handle changes of seed accounts, taken from the posts themselves: a list with versions, and how long each handle was valid.

The list is a table of commits (``sinks/hours.py``): a version is the whole list, its number is the commit's and not the batch's. So a
repeated batch changes nothing, and a fresh checkpoint goes on where the list stands.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from plazalens.operators.dims import left_join_dimension
from plazalens.operators.seeds import apply_handle_changes, latest_handles
from plazalens.sinks.hours import SOURCE_SCHEMA, SOURCES, Change, HourStore

LIST, HANDLES = "seed_list", "handles"
HANDLE_SCHEMA = StructType([StructField(c, StringType()) for c in ("user_id", "screen_name", "valid_from")])


def _commit(change: Change, seeds: DataFrame, handles: DataFrame, source: str) -> None:
    whole = F.lit("all").alias("period")
    change.append(LIST, seeds.select("*", whole))
    change.append(HANDLES, handles.select("user_id", "screen_name", F.col("updated").alias("valid_from"), whole))
    change.append(SOURCES, change.spark.createDataFrame([(source, 0, "all")], "source string, posts long, period string"))
    change.commit()


def start_seeds(seeds: DataFrame, folder: str) -> None:
    """The first version. Does nothing where the folder holds a list already."""
    store = HourStore(seeds.sparkSession, folder)
    if store.last() < 0:
        _commit(store.change(), seeds, seeds.where("user_id is not null").select("user_id", "screen_name", "updated").distinct(), "start")


def read_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """The list as of the last commit."""
    store = HourStore(spark, folder)
    schema = spark.read.parquet(f"{folder}/{LIST}").drop("version", "period").schema
    return store.read(LIST, schema).drop("period")


def handle_history(spark: SparkSession, folder: str) -> DataFrame:
    """user_id, screen_name, valid_from, valid_to: when each seed account was seen under which handle; null is open."""
    held = HourStore(spark, folder).read(HANDLES, HANDLE_SCHEMA, merged=False).drop("period")
    then = Window.partitionBy("user_id").orderBy(F.col("valid_from").asc_nulls_first(), "screen_name")
    return held.withColumn("valid_to", F.lead("valid_from").over(then))


def track_handles(
    spark: SparkSession, accounts: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """A new version of the list in ``folder`` for each batch that changes a handle; ``start_seeds`` puts the first one there.

    ``accounts`` has user_id, screen_name and datetime. Only seed accounts are grouped; a post older than an account's last change
    changes nothing, whatever batch it comes with.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        store, mark = HourStore(batch.sparkSession, folder), f"{checkpoint}#{batch_id}"
        if not store.read(SOURCES, SOURCE_SCHEMA, merged=False).where(F.col("source") == mark).isEmpty():
            return
        change = store.change()
        seeds = read_seeds(batch.sparkSession, folder)
        ids = seeds.where("user_id is not null").select("user_id").distinct()
        own = left_join_dimension(batch.withColumn("user_id", F.col("user_id").cast("string")), ids, "user_id", how="left_semi")
        known = change.scratch(apply_handle_changes(seeds, latest_handles(own)), "changed")
        fields = ("user_id", "screen_name", "updated")
        new = known.where("user_id is not null").select(*fields).subtract(seeds.select(*fields))
        if not new.isEmpty():
            _commit(change, known, new, mark)

    return (
        accounts.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
