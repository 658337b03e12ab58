"""Session settings and the shared folder."""

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Safe on any cluster size: AQE sizes, coalesces and splits shuffle partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # texts can be long: fewer rows per Arrow batch keeps a Python worker's memory flat
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

# What one task holds: a sort or a table of groups takes some 40 times the compressed bytes that it reads. Spark's own sizes (128 MB of a
# scan, 64 MB of a shuffle) let that grow to gigabytes a task before it stops.
TASK_SIZES = {
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in (SETTINGS | TASK_SIZES).items():
        builder = builder.config(key, value)
    return builder


def bound_tasks(spark: SparkSession) -> None:
    """Gives a session that was built elsewhere the task sizes, where it has none of its own."""
    for key, value in TASK_SIZES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    key = spark.sparkContext.applicationId
    if key not in _local_dirs:
        _local_dirs[key] = tempfile.mkdtemp(prefix="plazalens-")
    return _local_dirs[key]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's source to the Python workers, once per application: they need it wherever the driver was started from."""
    if (key := spark.sparkContext.applicationId) in _shipped:
        return
    root = Path(__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="plazalens-"), "plazalens.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(path.relative_to(root.parent)))
    # read by the driver alone, which hands it to the executors
    spark.sparkContext.addPyFile(archive)
    _shipped.add(key)
