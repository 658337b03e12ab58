import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from plazalens.session import configure

    builder = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
    builder = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    session = configure(builder.config("spark.ui.showConsoleProgress", "false")).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
