import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfmark.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (SparkSession.builder.master("local[8]").appName("shelfmark-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "4g")
               .config("spark.sql.maxMetadataStringLength", "2000")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints"))))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def rows(spark):
    """Evaluates columns over one row of input given as Python values and a schema."""
    def evaluate(values, schema, **columns):
        df = spark.createDataFrame(values, schema)
        return [tuple(r) for r in df.select(
            *[c.alias(n) for n, c in columns.items()]).collect()]
    return evaluate
