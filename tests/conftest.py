import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sorterlog.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        configure(SparkSession.builder.master("local[4]").appName("tests"))
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", tmp_path_factory.mktemp("staged").as_uri()).config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """Rows as a sorted list of tuples, nulls sortable."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is None, str(v)) for v in t])


@pytest.fixture
def one(spark):
    """Evaluate one expression over literal values of a single string column `c`."""

    def run(values, expression):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
        return [r[0] for r in df.orderBy("i").select(expression.alias("x")).collect()]

    return run
