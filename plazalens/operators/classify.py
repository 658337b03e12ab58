"""Abuse classification with a scorer the caller brings, and a Spark ML model as the built-in one."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Texts per model call
BATCH = 10


def classify_posts(
    posts: DataFrame,
    load_scorer: Callable[[], Callable[[list[str]], list]],
    text: str = "replaced_text",
    batch: int = BATCH,
) -> DataFrame:
    """Adds ``abuse`` (class index) and ``abuse_error``.

    ``load_scorer`` runs once per Arrow worker and task and returns ``texts -> one list of class scores per text``.
    A batch whose scorer fails leaves its posts in place, with a null class and the error.
    """

    @F.pandas_udf("abuse int, abuse_error string")
    def score(chunks: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = load_scorer()
        for texts in chunks:
            classes, errors = [], []
            for at in range(0, len(texts), batch):
                part = ["" if t is None else t for t in texts.iloc[at : at + batch]]
                try:
                    got = [max(range(len(s)), key=s.__getitem__) for s in scorer(part)]
                    if len(got) != len(part):
                        raise ValueError(f"{len(got)} scores for {len(part)} texts")
                    classes += got
                    errors += [None] * len(part)
                except Exception as e:
                    classes += [None] * len(part)
                    errors += [f"{type(e).__name__}: {e}"] * len(part)
            yield pd.DataFrame(
                {"abuse": pd.array(classes, dtype="Int32"), "abuse_error": pd.Series(errors, dtype="object")}
            )

    return posts.withColumn("_scored", score(F.col(text))).select(
        *posts.columns, F.col("_scored.abuse").alias("abuse"), F.col("_scored.abuse_error").alias("abuse_error")
    )


def fit_default_model(labelled: DataFrame, text: str = "text", label: str = "label", features: int = 1 << 16) -> PipelineModel:
    """Hashed words and a logistic regression. No randomness: the same labelled rows give the same model."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"\s+"),
        HashingTF(inputCol="_words", outputCol="_features", numFeatures=features),
        LogisticRegression(
            featuresCol="_features", labelCol=label, predictionCol="_class", rawPredictionCol="_raw",
            probabilityCol="_probability", maxIter=10, regParam=0.01,
        ),
    ]
    return Pipeline(stages=stages).fit(labelled)


def classify_with_model(posts: DataFrame, model: PipelineModel) -> DataFrame:
    """``abuse`` from a fitted Spark ML model; scoring stays in the JVM."""
    return model.transform(posts).select(*posts.columns, F.col("_class").cast("int").alias("abuse"))
