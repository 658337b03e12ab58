"""Raw post sources: JSON lines, plain or gzip, batch or stream."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plazalens.schemas import CORRUPT, FLAT_POST, POST

_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _not_archived(df: DataFrame, archived: bool) -> DataFrame:
    return df if archived else df.where(~F.contains("_metadata.file_name", F.lit("gz")))


def read_posts(spark: SparkSession, path, schema: StructType = POST, archived: bool = False) -> DataFrame:
    """Posts of every ``*.json*`` file below ``path``, malformed lines kept aside in ``_corrupt``.

    Compressed files are archived ones: skipped, unless ``archived`` is set, which reads both.
    """
    reader = spark.read.schema(schema).options(**_OPTIONS).option("pathGlobFilter", "*.json*")
    return _not_archived(reader.json(path), archived)


def read_flat_posts(spark: SparkSession, path, archived: bool = False) -> DataFrame:
    return read_posts(spark, path, FLAT_POST, archived)


def stream_posts(
    spark: SparkSession,
    path: str,
    schema: StructType = POST,
    archive_dir: str | None = None,
    max_files_per_trigger: int | None = None,
    source: str | None = None,
) -> DataFrame:
    """The same source as a stream. With ``archive_dir``, files whose batch is committed move there. ``source`` names a column for the
    path of a post's file."""
    reader = spark.readStream.schema(schema).options(**_OPTIONS).option("pathGlobFilter", "*.json*")
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    posts = _not_archived(reader.json(path), archived=False)
    return posts.select("*", F.col("_metadata.file_path").alias(source)) if source else posts


def parse_lines(lines: DataFrame, column: str, schema: StructType = POST) -> DataFrame:
    """Posts from a column of JSON text (a message feed), other columns dropped."""
    parsed = F.from_json(F.col(column), schema, _OPTIONS)
    return lines.select(parsed.alias("_post")).select("_post.*")


def _is_post() -> Column:
    # a JSON scan refuses to read the quarantine column alone, so the test names a second one; the length is never -1
    return F.col(CORRUPT).isNull() & (F.char_length(F.concat_ws("", F.col("id").cast("string"))) >= 0)


def good_posts(posts: DataFrame) -> DataFrame:
    return posts.where(_is_post()).drop(CORRUPT)


def bad_lines(posts: DataFrame) -> DataFrame:
    """The quarantine: lines that are not a JSON object."""
    return posts.where(~_is_post()).select(F.col(CORRUPT).alias("line"))
