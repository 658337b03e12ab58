"""A built-in classifier as two tables: naive Bayes over words, fitted and applied by joins and sums."""

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.operators.dims import BROADCAST_ROWS, left_join_dimension
from plazalens.session import shared_dir

WORDS = r"[^\x20\x09-\x0D]+"
# Weights are whole millionths, so a sum has one value whatever its order
SCALE = 1_000_000
# The commonest words, this many at most, go to every task and are weighed where the texts are
COMMON_WORDS = BROADCAST_ROWS
# Words are told apart as common or rare by the logarithm of their number, in steps of this share of an octave
STEPS = 16


@dataclass
class WordModel:
    """``weights`` (word, seen, weight) of all words and how often each was seen, and the weight of the class itself."""

    weights: DataFrame
    prior: int


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS), 0)


def _scaled(x: Column) -> Column:
    return F.round(x * SCALE).cast("bigint")


def fit_word_model(labelled: DataFrame, text: str = "text", label: str = "label") -> WordModel:
    """From rows with a text and a label of 0 or 1; rows without a label, or with another, teach nothing, a null text has no words.

    A word's weight is the log of how much likelier it is in class 1, each count raised by one. The table has a row a word and is counted
    once, into the shared folder; the driver sees five totals. Without rows of both classes there is nothing to tell apart, and the model
    finds class 0.
    """
    spark = labelled.sparkSession
    rows = labelled.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    in_class = [F.count_if(F.col("label") == k) for k in (0, 1)]
    docs = rows.agg(*in_class).first()
    counts = rows.select("label", F.explode(_words(F.col("text"))).alias("word")).groupBy("word")
    folder = f"{shared_dir(spark)}/words-{uuid.uuid4().hex}"
    counts.agg(*[c.alias(f"n{k}") for k, c in enumerate(in_class)]).write.parquet(folder)
    counts = spark.read.parquet(folder).withColumn("seen", F.col("n0") + F.col("n1"))
    none, one, distinct = (n or 0 for n in counts.agg(F.sum("n0"), F.sum("n1"), F.count("*")).first())
    if not docs[0] or not docs[1]:
        return WordModel(counts.select("word", "seen", F.lit(0).cast("bigint").alias("weight")), -1)
    share = lambda n, total: F.log((F.col(n) + 1) / F.lit(float(total + distinct)))
    weights = counts.select("word", "seen", _scaled(share("n1", one) - share("n0", none)).alias("weight"))
    prior = spark.range(1).select(_scaled(F.log(F.lit(docs[1] / docs[0])))).first()[0]
    return WordModel(weights, prior)


def _common_and_rare(weights: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The weights of the commonest words, ``most`` at most, and those of the others."""
    step = F.floor(F.log2("seen") * STEPS)
    sizes = weights.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()  # a row a step, whatever the words
    least, held = float("inf"), 0
    for at, words in sorted(map(tuple, sizes), reverse=True):
        held += words
        if held > most:
            break
        least = at
    common = step >= F.lit(least)
    return weights.where(common).select("word", "weight"), weights.where(~common).select("word", "weight")


def classify_words(posts: DataFrame, model: WordModel, text: str = "text", common_words: int = COMMON_WORDS) -> DataFrame:
    """Adds ``abuse``: 1 where the weights of the text's words and the prior add up above 0. Words the model hasn't seen weigh nothing, a
    null text has no class. Equal texts are scored once. Common words are weighed where the text is, so that a text is moved once, and of
    its words only the rare ones, which have no key that many rows share, unless texts to score are full of words that the labelled ones
    hardly have; those are left to Spark's skew handling."""
    common, rare = _common_and_rare(model.weights, common_words)
    keyed = posts.withColumn("_text_key", F.md5(F.col(f"`{text}`")))
    texts = keyed.where(F.col("_text_key").isNotNull()).groupBy("_text_key").agg(F.first(f"`{text}`").alias("_t"))
    words = texts.select("_text_key", F.explode(_words(F.col("_t"))).alias("word"))
    near = words.join(F.broadcast(common.withColumnRenamed("weight", "_near")), "word", "left")
    # a row for all common words of a text, which no word can be taken for, as it begins with a blank; the others are a row each
    left = F.when(F.col("_near").isNull(), F.col("word")).otherwise(F.concat(F.lit(" "), F.col("_text_key")))
    counts = near.groupBy("_text_key", left.alias("word")).agg(F.sum("_near").alias("_near"), F.count("*").alias("n"))
    weighed = left_join_dimension(counts, rare, "word")
    weight = F.coalesce(F.col("_near"), F.col("n") * F.col("weight"), F.lit(0))
    sums = weighed.groupBy("_text_key").agg(F.sum(weight).alias("_sum"))
    found = keyed.join(sums, "_text_key", "left")
    score = F.coalesce("_sum", F.lit(0)) + F.lit(model.prior)
    return found.select(*[f"`{c}`" for c in posts.columns], F.when(F.col("_text_key").isNotNull(), (score > 0).cast("int")).alias("abuse"))
