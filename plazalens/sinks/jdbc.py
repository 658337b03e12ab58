"""Relational target over JDBC."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, TimestampNTZType

from plazalens.schemas import JDBC_TYPES
from plazalens.sinks.tables import read_batch


def for_jdbc(df: DataFrame) -> DataFrame:
    """Arrays as JSON text, flags as text, hours as timestamps: the types the target tables declare."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, ArrayType):
            c = F.to_json(c)
        elif isinstance(f.dataType, BooleanType):
            c = c.cast("string")
        elif isinstance(f.dataType, TimestampNTZType):
            c = c.cast("timestamp")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def jdbc_options(table: str, url: str, batch_size: int = 5000, connections: int = 8, **more: str) -> dict[str, str]:
    """Writer options: rows per round trip, and at most ``connections`` sessions on the target at a time."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), "numPartitions": str(connections), **more}
    if table in JDBC_TYPES:
        options["createTableColumnTypes"] = JDBC_TYPES[table]
    return options


def append_jdbc(df: DataFrame, table: str, url: str, **options) -> None:
    for_jdbc(df).write.format("jdbc").options(**jdbc_options(table, url, **options)).mode("append").save()


def load_batch(spark: SparkSession, folder: str, table: str, batch_id: int | str, url: str, **options) -> None:
    """Loads a committed batch folder. The rows go to a staging table of the batch, replaced when the load repeats;
    moving them on is one transaction on the target's side."""
    staged = for_jdbc(read_batch(spark, f"{folder}/{table}", batch_id))
    settings = jdbc_options(table, url, **options) | {"dbtable": f"{table}_batch_{batch_id}"}
    staged.write.format("jdbc").options(**settings).mode("overwrite").save()
