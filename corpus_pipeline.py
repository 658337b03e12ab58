"""From raw documents to a training mix: five stages, each over all that its predecessor kept.

Every stage but the last returns the columns of ``documents``. Rows are told apart by id and text together, so null and repeated ids
do no harm; of rows that repeat both, one stays after near-duplicate removal. An empty table passes through as one.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from plazalens.llm import decontam, language, mixing, neardup, secrets
from plazalens.llm.common import count_words, parked, table

MARK = "[SECRET]"


def _key() -> Column:
    """A row's identity: id and whole text."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return F.md5(F.concat(doc_id, F.lit("|"), F.coalesce("text", F.lit(""))))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; a missing label becomes the predicted one."""
    found = language.identify(docs, language.fit(docs), *docs.columns).where(F.col("lang_pred") != language.UND)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of least id (null ids last)."""
    identity = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", _key().alias("key"))
    found = neardup.near_duplicates(docs.select(identity.alias("doc_id"), "text"))
    kept = found.where("kept").select(F.col("id.key").alias("_key")).distinct()
    rows = docs.withColumn("_key", _key()).join(kept, "_key", "left_semi")
    return rows.dropDuplicates(["_key"]).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), *docs.columns)
    return found.where("n_hit = 0").select(*docs.columns)


@F.pandas_udf(StringType())
def _masked(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for texts, starts, stops in batches:
        rows = zip(texts, starts, stops)
        yield pd.Series([t if t is None else secrets.masked(t, list(zip(a, b)), MARK) for t, a, b in rows], dtype=object)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked and ``n_chars`` follows; all documents stay."""
    found = secrets.find_secrets(docs, *docs.columns)
    hit, clean = found.where(F.size("spans") > 0), found.where(F.size("spans") == 0)
    hit = hit.withColumn("text", _masked("text", "spans.start", "spans.stop"))
    hit = hit.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns).unionByName(hit.select(*docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``repeats``: how often it takes each."""
    keyed = docs.withColumn("_key", _key())
    mix = mixing.mix(keyed.select(F.col("_key").alias("doc_id"), "source", "text"), count_words(F.col("text")))
    taken = mix.where("repeats > 0").select(F.col("doc_id").alias("_key"), "repeats")
    taken = taken.groupBy("_key").agg(F.sum("repeats").alias("repeats"))
    return keyed.join(taken, "_key").select(*docs.columns, "repeats")


STAGES = [
    ("language", known_language),
    ("neardup", near_duplicates),
    ("decontam", decontaminated),
    ("secrets", without_secrets),
    ("mixing", mixed),
]

# Learned models and the hashed choice of the mix have no SQL form; tests/llm holds the stages against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = parked(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
