"""Shared pieces of the training-data operators: scratch tables, column guards, text measures."""

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# ASCII white space separates words, nothing else does
WORD = r"[^\x20\x09-\x0D]+"


def parked(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: later stages survive lost executors and read no more than they need.
    ``codec`` in place of the session's: zstd is slower to write and takes less disk."""
    path = f"{shared_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def need(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that further columns of the input can't clash with the operator's own."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, other letters untouched. Plain lower() does the same where only ASCII is there, and is faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
