"""What a raw file's name and age say."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.functions.times import file_hour, hours_between


def with_file_hour(df: DataFrame, name: str = "file_name", now: Column | None = None) -> DataFrame:
    """Adds ``file_hour`` and ``age_hours`` from the hour in a file name."""
    now = F.localtimestamp() if now is None else now
    hour = file_hour(F.col(name))
    return df.withColumn("file_hour", hour).withColumn("age_hours", hours_between(hour, now))


def source_files(posts: DataFrame) -> DataFrame:
    """The raw files a scan covers, one row each, with hour and age."""
    names = posts.select(F.col("_metadata.file_name").alias("file_name")).distinct()
    return with_file_hour(names)


def older_than(df: DataFrame, hours: float) -> DataFrame:
    return df.where(F.col("age_hours") > hours)
