"""Dimension tables. CSV has explicit schemas, so ids never pass through a floating-point column."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plazalens.schemas import CATEGORIES, INSULTS, KEYWORDS, SEEDS


def read_dimension(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    """Columns of ``schema`` by name; a column the file lacks is null. ``ord`` counts the rows from 0, file by file in the order of their
    paths, where the files don't have it."""
    if fmt == "csv":
        # by name, whatever the file's column order; everything arrives as text and is cast once
        have = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    else:
        have = spark.read.format(fmt).load(path)
    if "ord" in schema.names and "ord" not in have.columns:
        have = _numbered(have)
    cols = [
        (F.col(f"`{f.name}`") if f.name in have.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return have.select(*cols)


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``ord``. Files are dealt to tasks by size, so places in the scan say nothing across files, nor across blocks of one; within a
    block they follow its rows. A CSV file is one block, as a value may hold line breaks."""
    block = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block")]
    placed = rows.select("*", *block, F.monotonically_increasing_id().alias("_at"))
    held = placed.groupBy("_path", "_block").agg(F.count("*").alias("_n"))
    # a row a block of the files
    earlier = F.sum("_n").over(Window.orderBy("_path", "_block")) - F.col("_n")
    before = held.select(F.col("_path").alias("_p"), F.col("_block").alias("_b"), earlier.alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_path", "_block").orderBy("_at")) - 1
    found = placed.withColumn("_nth", nth).join(before, (F.col("_path") == F.col("_p")) & (F.col("_block") == F.col("_b")))
    return found.select(*[f"`{c}`" for c in rows.columns], (F.col("_before") + F.col("_nth")).alias("ord"))


def read_seeds(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_dimension(spark, path, SEEDS, fmt)


def read_keywords(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_dimension(spark, path, KEYWORDS, fmt)


def read_insults(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_dimension(spark, path, INSULTS, fmt)


def read_categories(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_dimension(spark, path, CATEGORIES, fmt)
