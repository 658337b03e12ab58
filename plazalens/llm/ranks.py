"""Places of rows in order, within groups of any size."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plazalens.llm.common import parked


def numbered(df: DataFrame, group: str, *order: str) -> DataFrame:
    """Adds ``idx``, the row's place from 0 within its ``group`` by ``order``, and ``n``, the rows of the group.

    Rows are dealt in ranges of (group, order), so a group of all rows is many ranges. A place is that in the range plus what earlier
    ranges hold of the group. Rows alike in group and order take their places in any order; they are dealt to several ranges too. The
    names beginning with ``_at`` are the function's own. Nulls come first, as groups and in the order; no rows, no places.
    """
    salted = parked(df.withColumn("_at_salt", F.monotonically_increasing_id()), "unranked")
    keys = [group, *order, "_at_salt"]
    ranges = salted.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    rows = parked(ranges.drop("_at_salt"), "ranked").withColumn("_at_part", F.shiftright("_at", 33))
    group_key = F.col(group).alias("_at_group")
    parts = rows.groupBy(group_key, F.col("_at_part").alias("_at_in")).agg(F.count("*").alias("_at_n"), F.min("_at").alias("_at_first"))
    whole = Window.partitionBy("_at_group")
    earlier = F.sum("_at_n").over(whole.orderBy("_at_in")) - F.col("_at_n")
    parts = parts.select("*", earlier.alias("_at_before"), F.sum("_at_n").over(whole).alias("n"))
    found = rows.join(parts, F.col(group).eqNullSafe(F.col("_at_group")) & (F.col("_at_part") == F.col("_at_in")))
    return found.select(*df.columns, (F.col("_at") - F.col("_at_first") + F.col("_at_before")).alias("idx"), "n")


