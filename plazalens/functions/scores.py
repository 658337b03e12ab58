"""Class scores."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax_class(scores: Column) -> Column:
    """Index of the largest score, the first one on ties. Softmax keeps the order, so raw scores do."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")
